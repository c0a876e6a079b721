"""Line dedup within one word edit, by a deletion-neighbourhood join.

Lines are split at line feeds. A line's words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased. A line of one
word of a script without spaces (Chinese, Japanese, Thai and the like in half its code points or more) is
spelled: its code points take the place of words. Every line with a word takes part in copies; the near
join begins at `MIN_WORDS` words or `MIN_CHARACTERS` code points, as one edit of fewer is
another line rather than a near one. Of lines with equal words, and of lines one word
edit apart (one word replaced, inserted or left out), the earliest by (doc_id, line) is the
first: a line is a copy if an earlier line has its words, and near if an earlier line that differs is
within one edit of it.

1. Equal lines collapse to one row each (64-bit fingerprint, earliest place).
2. Two lines within one edit agree on the first or on the second half of the shorter one. Lines
   that share no half with another line have no partner and go no further.
3. The others emit all variants with one word left out as hashed keys: `replaced` keys hold the place
   of the missing word, so that equal keys mean one replaced word, and all members of a key are within
   one edit of each other; `left` keys do not, and only join a whole line with the variants of
   longer ones (two variants may each lack another word).
4. A group is never expanded into pairs: a replaced key offers its earliest line, a whole line is
   offered to all its longer ones, and the earliest longer one to the whole line. The word sequences of all
   lines so offered are compared, and the earliest that holds counts.

Defined cases: a null text has no lines; a null doc_id is later than any other; equal places (rows
that repeat a doc_id and line) are told apart by their words; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.textscan import SPACED, _powers, chunks_of, mix, scan_words, text_buffer
from tallyhouse.storage import settle

#: Number of a row within one call.
ROW = "_row"
#: Words, or code points of a spelled line, from which one edit makes a near line.
MIN_WORDS, MIN_CHARACTERS = 6, 12
CHUNK = 4 << 20
#: Documents whose lines emit variants may be broadcast by id up to this many (about 40 bytes each and 8 a line).
BROADCAST_LINES = 400_000
#: Rows of two numbers (8 MB) that may be broadcast to find their many partners.
BROADCAST_KEYS = 500_000
LATE = (1 << 63) - 1


def _units(data: np.ndarray, words, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all units, the number of each word's units, and whether a word (one of those alone in a line) is spelled."""
    spelled, counts = np.zeros(len(words.start), bool), np.ones(len(words.start), np.int64)
    if not (data >= 0xE0).any():
        return words.hash, counts, spelled
    after = np.append(data[1:], 0)
    wide = (data == 0xE0) & (after >= 0xB8) | (data == 0xE1) & (after < 0xA0) | (data >= 0xE3) & (data < 0xEE) | (data == 0xF0) & (after >= 0xA0)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    wides = np.flatnonzero(wide)
    a, b = words.start[alone], words.end[alone]
    points = np.searchsorted(starts, b) - np.searchsorted(starts, a)
    use = 2 * (np.searchsorted(wides, b) - np.searchsorted(wides, a)) >= points
    spelled[alone[use]] = True
    counts[alone[use]] = points[use]
    word = np.repeat(np.arange(len(counts)), counts)
    hashes, own = words.hash[word], spelled[word]
    place = np.arange(len(word)) - (np.cumsum(counts) - counts)[word]
    at = starts[np.searchsorted(starts, words.start[word[own]]) + place[own]]
    padded = np.concatenate([data, np.zeros(3, data.dtype)]).astype(np.uint64)
    lead = padded[at]
    size = 1 + (lead >= 0xC0).astype(int) + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead + np.where((lead >= 0x41) & (lead <= 0x5A), 0x20, 0).astype(np.uint64)
    for i in (1, 2, 3):
        code = code * np.uint64(256) + np.where(size > i, padded[at + i], 0).astype(np.uint64)
    hashes[own] = mix((code + np.uint64(1 << 40)) * np.uint64(0x9FB21C651E98DF25))
    return hashes, counts, spelled


class Lines:
    """Lines of a batch: document, line number, number of words, range of units (words or code points), and polynomial sums over these."""

    def __init__(self, column: pa.Array):
        data, offsets = text_buffer(column)
        words = scan_words(data, offsets, SPACED)
        feeds = np.flatnonzero(data == 0x0A)
        line = np.searchsorted(feeds, words.start) if len(words.start) else np.zeros(0, np.int64)
        # a document's end ends its line too
        key = line + words.doc
        opens = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.n_words = np.append(opens[1:], len(key))[: len(opens)] - opens
        self.doc = words.doc[opens]
        self.number = line[opens] - np.searchsorted(feeds, offsets[self.doc]) if len(opens) else opens
        self.words, units, spelled = _units(data, words, opens[self.n_words == 1])
        ends = np.cumsum(units)
        self.first = (ends - units)[opens]
        self.last = np.append(self.first[1:], len(self.words))[: len(opens)]
        self.size = self.last - self.first
        self.near = self.size >= np.where(spelled[opens], MIN_CHARACTERS, MIN_WORDS)
        power, self.inverse = _powers(len(self.words) + 2)
        self.power = power
        self.sums = np.zeros(len(self.words) + 1, np.uint64)
        np.cumsum(self.words * power[: len(self.words)], out=self.sums[1:])

    def hash(self, a: np.ndarray, b: np.ndarray, *salt: int | np.ndarray) -> np.ndarray:
        """Fingerprint of the words from a to b, as if they began at place 0."""
        total = (self.sums[b] - self.sums[a]) * self.inverse[a]
        for s in (b - a, *salt):
            total = mix(total + np.asarray(s).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        return total


def _signed(values: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.array(values.view(np.int64), kind or pa.int64())


def _survey(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, line, n_words, line_hash of every line of that many words, and four half keys if it is long enough for the near join."""
        for batch in chunks_of(batches, "text", CHUNK):
            lines = Lines(batch.column(1))
            use = np.flatnonzero(lines.n_words >= least)
            own = lines.hash(lines.first[use], lines.last[use])
            near = lines.near[use]
            a, b, n = lines.first[use][near], lines.last[use][near], lines.size[use][near]
            halves = []
            for m in (n, n - 1):
                halves += [lines.hash(a, a + m // 2, m, 1), lines.hash(b - (m - m // 2), b, m, 2)]
            at = np.concatenate([[0], np.cumsum(4 * near)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(lines.doc[use])), pa.array(lines.number[use]), pa.array(lines.n_words[use]), _signed(own),
                    pa.ListArray.from_arrays(pa.array(at), _signed(np.stack(halves, axis=1).reshape(-1))),
                ],
                names=["doc_id", "line", "n_words", "line_hash", "halves"],
            )

    return run


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, words, keys and own key of the wanted lines of each document (text, hashes and numbers of the lines)."""
    for batch in chunks_of(batches, "text", CHUNK):
        lines = Lines(batch.column(0))
        wanted = [dict(zip(h, r)) for h, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        own = lines.hash(lines.first, lines.last).view(np.int64).tolist()
        long_enough = lines.near.tolist()
        named = [(i, wanted[d].get(own[i])) for i, d in enumerate(lines.doc.tolist()) if long_enough[i]]
        use = np.array([i for i, r in named if r is not None], np.int64)
        rank = [r for _, r in named if r is not None]
        a, b, n = lines.first[use], lines.last[use], lines.size[use]
        at = np.concatenate([[0], np.cumsum(n)])
        row = np.repeat(np.arange(len(use)), n)
        place = np.arange(at[-1]) - at[row]
        gone = a[row] + place
        head = (lines.sums[gone] - lines.sums[a[row]]) * lines.inverse[a[row]]
        tail = (lines.sums[b[row]] - lines.sums[gone + 1]) * lines.inverse[a[row] + 1]
        left = mix(head + tail + (n[row] - 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        replaced = mix(left + (place + 1).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        whole = (lines.sums[b] - lines.sums[a]) * lines.inverse[a]
        whole = mix(whole + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        lefts = [np.unique(left[at[i] : at[i + 1]]) for i in range(len(use))]
        sizes = np.cumsum([0, *map(len, lefts)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rank, pa.int64()),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _signed(lines.words[gone] if len(gone) else np.zeros(0, np.uint64))),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), _signed(replaced)),
                pa.ListArray.from_arrays(pa.array(sizes), _signed(np.concatenate(lefts) if lefts else np.zeros(0, np.uint64))),
                _signed(whole),
            ],
            names=["rank", "words", "replaced", "left", "whole"],
        )


def _one_left_out(a: str, b: str) -> str:
    """Whether b is a without one word: behind the first place where they differ, b goes on as a does one later."""
    place = f"cast(array_position(zip_with({a}, {b}, (x, y) -> x = y), false) as int)"
    return f"({place} = 0 or slice({a}, greatest({place}, 1) + 1, size({a})) = slice({b}, greatest({place}, 1), size({a})))"


def _one_edit(a: str, b: str) -> Column:
    """Whether two word arrays differ by one replaced, inserted or missing word."""
    return F.expr(
        f"""case when size({a}) = size({b}) then aggregate(zip_with({a}, {b}, (x, y) -> if(x = y, 0, 1)), 0, (s, d) -> s + d) = 1
        when size({a}) - size({b}) = 1 then {_one_left_out(a, b)} when size({b}) - size({a}) = 1 then {_one_left_out(b, a)} else false end"""
    )


def _place(doc: str = "doc_id", line: str = "line") -> Column:
    return F.struct(F.coalesce(F.col(doc), F.lit(LATE)).alias("doc"), F.col(line).alias("line"))


def _few(keys: DataFrame) -> DataFrame:
    """Written keys, as a broadcast while they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def surveyed(docs: DataFrame, least: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settle(rows.mapInArrow(_survey(least), "doc_id long, line long, n_words long, line_hash long, halves array<long>"))


def near_firsts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """line_hash, first_hash: each near line and the earliest line found within one edit of it."""
    distinct = settle(lines.groupBy("line_hash").agg(F.min(_place()).alias("at"), F.first("halves").alias("halves")))
    halves = distinct.select("line_hash", F.explode("halves").alias("half"))
    paired = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("half").alias("shared"))
    alive = settle(halves.join(_few(settle(paired)), F.col("half") == F.col("shared"), "left_semi").select("line_hash").distinct())
    # numbered in the order of their places: a key's row is 16 bytes, and the earliest is the least number
    alive = alive.join(distinct.select("line_hash", "at"), "line_hash").repartitionByRange("at", "line_hash")
    alive = settle(alive.sortWithinPartitions("at", "line_hash").withColumn("rank", F.monotonically_increasing_id()))
    if alive.isEmpty():
        return alive.select("line_hash", F.col("line_hash").alias("first_hash"))
    wanted = alive.groupBy(F.col("at.doc").alias("wanted_doc")).agg(F.collect_list(F.struct("line_hash", "rank")).alias("wanted"))
    wanted = wanted.select("wanted_doc", F.col("wanted.line_hash").alias("hashes"), F.col("wanted.rank").alias("ranks"))
    if alive.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    text = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LATE)).alias("doc"), F.col("text").cast("string").alias("text"))
    found = text.join(wanted, F.col("doc") == F.col("wanted_doc")).select("text", "hashes", "ranks")
    found = settle(found.mapInArrow(_variants, "rank long, words array<long>, replaced array<long>, left array<long>, whole long"))
    keyed = found.select("rank", F.explode("replaced").alias("key"))
    earliest = keyed.groupBy("key").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    earliest = settle(earliest.filter("first < last").select(F.col("key").alias("group"), "first"))
    later = keyed.join(_few(earliest), (F.col("key") == F.col("group")) & (F.col("rank") > F.col("first")))
    variants = found.select("rank", F.explode("left").alias("key"))
    ends = variants.select("key", F.col("rank").alias("longer"), F.lit(None).cast("long").alias("whole"))
    ends = ends.union(found.select(F.col("whole").alias("key"), F.lit(None).cast("long"), F.col("rank")))
    met = ends.groupBy("key").agg(F.min("longer").alias("longer"), F.min("whole").alias("whole"))
    met = settle(met.filter("longer is not null and whole is not null").withColumnRenamed("key", "group"))
    longer = variants.join(_few(met.select("group", "whole")), (F.col("key") == F.col("group")) & (F.col("rank") > F.col("whole")))
    pairs = later.select("rank", "first").union(longer.select("rank", "whole")).union(met.filter("longer < whole").select("whole", "longer"))
    pairs = settle(pairs.distinct())
    involved = pairs.select("rank").union(pairs.select("first")).distinct()
    words = settle(found.join(_few(settle(involved)), "rank", "left_semi").groupBy("rank").agg(F.first("words").alias("words")))
    mine, theirs = words.toDF("r1", "mine"), words.toDF("r2", "theirs")
    checked = pairs.join(mine, F.col("rank") == F.col("r1")).join(theirs, F.col("first") == F.col("r2"))
    checked = settle(checked.filter(_one_edit("mine", "theirs")).groupBy("rank").agg(F.min("first").alias("first")))
    firsts = alive.select(F.col("rank").alias("r3"), F.col("line_hash").alias("first_hash"))
    return settle(checked.join(alive.select("rank", "line_hash"), "rank").join(firsts, F.col("first") == F.col("r3")).select("line_hash", "first_hash"))


def line_verdicts(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, line, n_words, verdict (first, copy, near) and the place of the line it repeats, for every line of that many words."""
    lines = surveyed(docs, least)
    near = near_firsts(docs, lines)
    distinct = lines.groupBy("line_hash").agg(F.min(_place()).alias("at"))
    distinct = settle(distinct)
    known = distinct.join(near, "line_hash", "left")
    first = distinct.select(F.col("line_hash").alias("of_hash"), F.col("at").alias("of_at"))
    known = settle(known.join(first, F.col("first_hash") == F.col("of_hash"), "left").select(F.col("line_hash").alias("known_hash"), "at", "of_at"))
    out = lines.drop("halves").join(known, F.col("line_hash") == F.col("known_hash"))
    is_first = F.col("at") == _place()
    verdict = F.when(~is_first, "copy").when(F.col("of_at").isNotNull(), "near").otherwise("first")
    of = F.when(~is_first, F.col("at")).otherwise(F.col("of_at"))
    of_doc = F.when(of["doc"] != LATE, of["doc"])
    return out.select("doc_id", "line", "n_words", verdict.alias("verdict"), of_doc.alias("of_doc"), of["line"].alias("of_line"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without copied and near lines; all other columns as they came.

    Every row is a document of its own, in the order of its id and its text's hash (null ids last): rows that
    share an id, or have none, keep their own lines, and of equal rows the later ones lose all theirs.
    """
    plain, as_they_came = set_aside(docs, ("text",))
    order = [F.lit(0)]
    if "doc_id" in docs.columns:
        named = F.col(f"_column_{docs.columns.index('doc_id')}").cast("long")
        order = [named.isNull(), named]
    order = [*order, F.xxhash64("text")]
    numbered = plain.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(ROW, F.monotonically_increasing_id())
    numbered = settle(numbered)
    verdicts = line_verdicts(numbered.select(F.col(ROW).alias("doc_id"), "text"), least=1).filter("verdict <> 'first'")
    gone = settle(verdicts.groupBy(F.col("doc_id").alias("_gone_of")).agg(F.collect_set("line").alias("_gone")))
    joined = numbered.join(gone, F.col(ROW) == F.col("_gone_of"), "left")
    kept = F.expr(r"array_join(filter(split(text, '\n'), (x, i) -> not array_contains(_gone, cast(i as bigint))), '\n')")
    return as_they_came(joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept)))
