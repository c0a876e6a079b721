"""Near-duplicate documents by bottom-k sketches of one hash function.

Words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased. A document's set holds the 64-bit
fingerprints of its distinct five-word shingles (fewer words: the whole sequence as
one; no words: empty, linked with nothing).

1. Documents with equal sets form a class; one row a class goes on.
2. A class keeps the `k` smallest fingerprints of its set. Inverted lists of these
   retained values bring classes together.
3. Two sets of similarity 0.75 share a least number of retained values (`least_overlap`: all
   that the bound implies when the sets fit in the sketch, else six standard deviations below the
   mean), so it is enough to list a class under its rarest `size - overlap + 1` values. Values that
   thousands of unrelated documents share (licence lines, passages) fall out of the lists that
   way, and no pair does.
4. A list is not expanded into pairs. Its hub is the member whose retained values are shared most;
   each member is compared with the hubs of its lists: first by the union-sketch estimate, then on
   full sets. Families of copies collapse around their original here.
5. Members of one hub that still are in different components are compared with each other in blocks
   of bounded size, on full sets inside a task; only links that join components come out, at most
   one a row. Two members of any list share its hub, so no pair is left out.

Defined cases: a null text has an empty set; equal rows are one class; several rows with
one doc_id are several documents that share the id; a null doc_id never is a component's id
unless all its members have none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.textscan import SPACED, chunks_of, rolling, scan_words, text_buffer
from tallyhouse.storage import settle

WIDTH = 5
SIMILARITY = (75, 100)
SKETCH = 64
#: Standard deviations that an estimate is trusted to; beyond lies less than one pair in 10^8.
DEVIATIONS = 6
#: Members and fingerprints of a block of step 5.
BLOCK_ROWS, BLOCK_VALUES = 1024, 1 << 20
COLUMNS = 4096
#: Rows of 16 bytes that may be broadcast: 8 MB at most.
BROADCAST_ROWS = 500_000
CHUNK = 2 << 20
SET_KEY, KEPT_ID, KEPT_KEY = "__set_key", "__kept_id", "__kept_key"


def shingle_sets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of all texts, one after the other, and n + 1 offsets."""
    data, offsets = text_buffer(column)
    words = scan_words(data, offsets, SPACED)
    n = len(offsets) - 1
    counts = np.bincount(words.doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    grams = rolling(words.hash, width)
    sets: list[np.ndarray] = []
    bounds = np.zeros(n + 1, np.int64)
    for i in range(n):
        a, c = int(first[i]), int(counts[i])
        if c >= width:
            values = np.sort(grams[a : a + c - width + 1])
            if len(values) > 1:
                values = values[np.concatenate([[True], values[1:] != values[:-1]])]
        elif c:
            values = rolling(words.hash[a : a + c], c) ^ np.uint64(c)
        else:
            values = np.zeros(0, np.uint64)
        sets.append(values)
        bounds[i + 1] = bounds[i] + len(values)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), bounds


def _signed(values: np.ndarray) -> pa.Array:
    """Fingerprints as signed longs of the same order: their top bit is flipped."""
    return pa.array((values ^ np.uint64(1 << 63)).view(np.int64))


def _key(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _sketches(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, "text", CHUNK):
            values, bounds = shingle_sets(batch.column(1), width)
            sizes = np.diff(bounds)
            keys = [_key(values[bounds[i] : bounds[i + 1]]) for i in range(len(sizes))]
            kept = np.minimum(sizes, k)
            at = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
            pick = np.repeat(bounds[:-1] - at[:-1], kept) + np.arange(at[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at), _signed(values[pick])),
                ],
                names=["doc_id", "n_shingles", "set_key", "sketch"],
            )

    return run


def sketched(docs: DataFrame, width: int = WIDTH, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, set_key, sketch of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sketches(width, k), "doc_id long, n_shingles long, set_key binary, sketch array<long>")


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, "text", CHUNK):
            values, bounds = shingle_sets(batch.column(0), width)
            keys = [_key(values[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _signed(values))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], names=["set_key", "shingles"])

    return run


def full_sets(docs: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """node and full set of the wanted classes (node, doc_id, set_key), computed from the texts again."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    if wanted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    picked = picked.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    found = picked.mapInArrow(_sets(width), "set_key binary, shingles array<long>")
    found = found.join(wanted.select("set_key", "node"), "set_key").select("node", "shingles")
    return found.dropDuplicates(["node"])


def _min_links(edges: DataFrame) -> DataFrame:
    """Each end with the smallest node next to it or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, comp for every node that has a link; comp is the smallest node reachable.

    Alternates large-star and small-star steps, each written, until nothing moves.
    """
    edges = settle(edges.filter("a <> b").select("a", "b").distinct())
    while True:
        large = _min_links(edges).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = settle(large.filter("a <> b").distinct())
        low = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("u", "m")).filter("a <> b").distinct()
        after = settle(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
        moved = after.join(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti")
        if moved.isEmpty():
            break
        edges = after
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return settle(after.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots))


def least_overlap(n: Column, k: int) -> Column:
    """How many retained values a set of n fingerprints shares at least with any set that it is linked with."""
    low, high = SIMILARITY
    other = n * high / low
    spread = F.sqrt(F.lit(k * low * (high - low) / high**2) * F.greatest(other - k, F.lit(0.0)) / F.greatest(other - 1, F.lit(1.0)))
    sampled = F.least(n * low / high, F.lit(k * low / high) - DEVIATIONS * spread)
    return F.greatest(F.when(other <= k, F.ceil(n * low / high)).otherwise(F.floor(sampled)), F.lit(1)).cast("int")


def listed(classes: DataFrame, k: int) -> DataFrame:
    """value, node, score: each class under its rarest retained values, lists of one left out."""
    entries = classes.select("node", "n_shingles", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    kept = settle(entries.join(shared, "value"))
    size = F.least("n_shingles", F.lit(k))
    per_class = Window.partitionBy("node")
    rank = F.row_number().over(per_class.orderBy("held", "value"))
    alone = size - F.count(F.lit(1)).over(per_class)
    prefix = size - least_overlap(F.col("n_shingles"), k) + 1
    ranked = kept.select("node", "value", (rank + alone).alias("place"), prefix.alias("prefix"), F.sum("held").over(per_class).alias("score"))
    return ranked.filter("place <= prefix").select("value", "node", "score")


def _estimate(k: int) -> Column:
    """Similarity from the k smallest values of the union of two sketches."""
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    return both / F.size(union)


def hub_links(classes: DataFrame, members: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """The members (hub, node) whose full sets reach the similarity with their hub, as a, b."""
    low, high = SIMILARITY
    side = lambda s: classes.select(F.col("node").alias(s), F.col("sketch").alias(f"sketch_{s}"), F.col("n_shingles").alias(f"n_{s}"))
    near = members.select(F.col("node").alias("a"), F.col("hub").alias("b")).join(side("a"), "a").join(side("b"), "b")
    fits = F.least("n_a", "n_b") * high >= F.greatest("n_a", "n_b") * low
    least = low / high - DEVIATIONS * math.sqrt(low * (high - low) / high**2 / k)
    likely = settle(near.filter(fits).filter(_estimate(k) >= least).select("a", "b", "n_a", "n_b"))
    of = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    checked = likely.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", common.alias("common"))
    return settle(checked.filter(F.col("common") * high >= (F.col("n_a") + F.col("n_b") - F.col("common")) * low).select("a", "b"))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, some columns at a time."""
    values = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    order = np.argsort(values)
    values, row = values[order], row[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    group = np.cumsum(fresh) - 1
    several = np.bincount(group)[group] > 1
    row, group = row[several], group[several]
    column = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1 if len(group) else group
    total = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        held[row[a:b], column[a:b] - at] = 1
        total += held[: len(left)] @ held[len(left) :].T
    return total


def block_links(sets: list[np.ndarray], nodes: list[int], comps: list[int], first: np.ndarray) -> list[tuple[int, int]]:
    """Links between components among the rows of two blocks (`first` marks one; none marked: one block), a forest of them."""
    low, high = SIMILARITY
    at = np.flatnonzero(first), np.flatnonzero(~first)
    if not len(at[0]) or not len(at[1]):
        at = (np.arange(len(sets)),) * 2
    common = _common([sets[i] for i in at[0]], [sets[i] for i in at[1]])
    size = np.array([len(x) for x in sets])
    comp = np.array(comps)
    linked = common * high >= (size[at[0]][:, None] + size[at[1]][None, :] - common) * low
    linked &= comp[at[0]][:, None] != comp[at[1]][None, :]
    root = {c: c for c in comps}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        where = at[1][np.flatnonzero(linked[i])]
        _, pick = np.unique(comp[where], return_index=True)
        for j in where[pick].tolist():
            x, y = find(comps[at[0][i]]), find(comps[j])
            if x != y:
                root[x] = y
                out.append((nodes[at[0][i]], nodes[j]))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (hub, low, high, mine, node, comp, shingles) sorted by the first three; one group is held at a time."""
    key, held = None, []

    def compared() -> pa.RecordBatch:
        found = block_links([h[2] for h in held], [h[0] for h in held], [h[1] for h in held], np.array([h[3] for h in held])) if len(held) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    for batch in batches:
        hubs, lows, highs, mine, nodes, comps = (batch.column(i).to_pylist() for i in range(6))
        lists = batch.column(6)
        values = lists.values.to_numpy(zero_copy_only=False)
        bounds = lists.offsets.to_numpy()
        for i in range(batch.num_rows):
            now = (hubs[i], lows[i], highs[i])
            if now != key:
                if held:
                    yield compared()
                key, held = now, []
            held.append((nodes[i], comps[i], values[bounds[i] : bounds[i + 1]].copy(), mine[i]))
    if held:
        yield compared()


def rest_links(members: DataFrame, comp: DataFrame | None, classes: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Links between members of one hub that are in different components; None where all are in one."""
    rest = members.join(classes.select("node", "n_shingles"), "node")
    if comp is None:
        rest = rest.withColumn("comp", F.col("node"))
    else:
        rest = rest.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rest = settle(rest.select("hub", "node", "comp", "n_shingles"))
    spread = rest.groupBy("hub").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("values"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("values") / BLOCK_VALUES)).cast("int")
    spread = settle(spread.filter("lo < hi").select("hub", blocks.alias("blocks")))
    if spread.isEmpty():
        return None
    open_ = rest.join(spread, "hub").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    open_ = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_ = open_.select("hub", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("mine"), "node", "comp")
    rows = open_.join(sets, "node").select("hub", "low", "high", F.expr("mine and low < high").alias("mine"), "node", "comp", "shingles")
    rows = rows.repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high")
    return settle(rows.mapInArrow(_blocks, "a long, b long"))


def near_links(docs: DataFrame, classes: DataFrame, width: int, k: int) -> DataFrame | None:
    """node, comp of the classes that have a link to another class; None without links."""
    spark = docs.sparkSession
    lists = settle(listed(classes, k))
    hubs = lists.groupBy("value").agg(F.max_by("node", "score").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = settle(lists.join(settle(hubs.select("value", "hub")), "value").filter("node <> hub").select("hub", "node").distinct())
    if members.isEmpty():
        return None
    nodes = members.select("node").union(members.select("hub")).distinct()
    wanted = settle(classes.join(nodes, "node", "left_semi").select("node", "doc_id", "set_key"))
    sets = settle(full_sets(docs, wanted, width))
    links = hub_links(classes, members, sets, k)
    comp = None if links.isEmpty() else components(spark, links)
    more = rest_links(members, comp, classes, sets)
    if more is None or more.isEmpty():
        return comp
    return components(spark, links.union(more))


def near_duplicates(docs: DataFrame, width: int = WIDTH, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row, with the set_key of its class and its component.

    component_id is the smallest doc_id that links lead to; kept marks the row with that id.
    """
    rows = settle(sketched(docs, width, k))
    classes = (
        rows.filter("set_key is not null")
        .withColumn("node", F.monotonically_increasing_id())
        .groupBy("set_key")
        .agg(F.min("node").alias("node"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    )
    classes = settle(classes)
    comp = near_links(docs, classes, width, k)
    named = classes.select("set_key", "node", "doc_id")
    if comp is None:
        named = named.select("set_key", F.col("node").alias("comp"), F.col("doc_id").alias("component_id"))
    else:
        named = settle(named.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
        least = settle(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
        named = named.select("set_key", "comp").join(least, "comp")
    named = settle(named.select("set_key", "comp", "component_id"))
    out = rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), "set_key", "comp")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _with_key(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, "text", CHUNK):
            values, bounds = shingle_sets(batch.column(batch.schema.get_field_index("text")), width)
            keys = [_key(values[bounds[i] : bounds[i + 1]]) for i in range(len(bounds) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, SET_KEY])

    return run


def deduplicate(docs: DataFrame, width: int = WIDTH, k: int = SKETCH) -> DataFrame:
    """The documents with one row of each group, the one that bears the component's id.

    Rows without words all stay. Ids that several rows bear, and null ids, cannot name a
    row: those rows are keyed by their set again, and one row of each group stays too.
    """
    docs, as_they_came = set_aside(docs, ("doc_id", "text"))
    result = settle(near_duplicates(docs, width, k))
    names = F.col("doc_id").eqNullSafe(F.col("component_id"))
    twice = settle(result.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").select("doc_id"))
    keep = result.filter(names).select("doc_id", "set_key", "comp")
    single = settle(keep.join(twice, "doc_id", "left_anti").filter("doc_id is not null").select(F.col("doc_id").alias(KEPT_ID)))
    if single.count() <= BROADCAST_ROWS:
        single = F.broadcast(single)
    plain = docs.join(single, F.col("doc_id") == F.col(KEPT_ID), "left_semi")
    if twice.isEmpty():
        return as_they_came(plain)
    among = keep.join(twice, keep.doc_id.eqNullSafe(twice.doc_id), "left_semi").filter("set_key is not null")
    chosen = settle(among.groupBy("comp", "doc_id").agg(F.min("set_key").alias(KEPT_KEY)).select(F.col("doc_id").alias(KEPT_ID), KEPT_KEY))
    shared = docs.join(twice.select(F.col("doc_id").alias(KEPT_ID)), F.col("doc_id").eqNullSafe(F.col(KEPT_ID)), "left_semi")
    keyed = settle(shared.mapInArrow(_with_key(width), T.StructType([*docs.schema.fields, T.StructField(SET_KEY, T.BinaryType())])))
    match = F.col("doc_id").eqNullSafe(F.col(KEPT_ID)) & (F.col(SET_KEY) == F.col(KEPT_KEY))
    picked = keyed.join(chosen, match, "left_semi").dropDuplicates(["doc_id", SET_KEY])
    empty = keyed.filter(F.col(SET_KEY).isNull())
    return as_they_came(plain.unionByName(picked.unionByName(empty).drop(SET_KEY)))
