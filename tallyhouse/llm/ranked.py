"""Ranked lexical search on a length-stratified index.

Terms are the maximal runs of digits, letters A-Z (lower-cased) and all signs beyond ASCII. A document of n
terms has the normaliser m = 50 + (50 n N div L), so all documents of one m share the impact of a term that
occurs tf times, (10^9 tf) div (1000 tf + 20 m).

Index. One pass counts lengths: N, L and the documents of each m follow. A second pass sends every
document's distinct terms (64-bit fingerprints) and counts to its stratum; strata of over BLOCK_DOCS documents
are dealt to several tasks. A task inverts its strata into blocks of at most BLOCK_DOCS documents of one
m: sorted terms, and the postings of each by rising tf, as runs of equal tf. The index is a written table.

Search. Queries travel in blocks of bounded size that tasks read from the shared folder; each block is one
scan of the index for document frequencies and one for scores. A task takes a group of index blocks, bounds
every query's score in each of them (the impact of a term's largest tf, that is its last run), and visits
them by falling bound, in waves of doubling length; a query whose k-th score so far exceeds the bound of all blocks it
has left leaves. Impacts are computed once a run. The k best of each query and task meet in a window. Scores are 64-bit integers.

Defined cases: a null text has no terms and ranks nowhere, nor does a query without terms; rows that repeat
an id are ranked as rows of their own; a null id comes after all others of its score; every query row gets
a list, equal and null ids included; without documents or queries the result is empty. Other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import files
from tallyhouse.llm.textscan import ALNUM, chunks_of, scan_words, text_buffer
from tallyhouse.session import fresh_dir
from tallyhouse.storage import settle

TOP = 50
#: Documents (of a stratum that go to one task, too) and postings of an index block.
BLOCK_DOCS, BLOCK_POSTINGS = 1024, 1 << 20
#: Queries and distinct terms of a query block.
QUERIES, QUERY_TERMS = 4096, 1 << 18
#: Index blocks and bytes of them that a task orders at once.
GROUP, GROUP_BYTES = 512, 64 << 20
#: Scores held at once: queries times documents.
CELLS = 1 << 22
CHUNK = 2 << 20
INDEX = "m long, n_docs int, ids array<long>, terms binary, term_docs binary, term_runs binary, run_tf binary, run_docs binary, places binary"


def normaliser(n, n_docs: int, n_terms: int):
    return 50 + (50 * n * n_docs) // n_terms


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks_of(batches, "text", CHUNK):
        data, offsets = text_buffer(batch.column(0))
        word = np.zeros(len(data) + 1, bool)
        np.not_equal(ALNUM[data], 0, out=word[1:])
        opens = word[1:] & ~word[:-1]
        edges = offsets[:-1][np.diff(offsets) > 0]
        opens[edges] = word[1:][edges]
        seen = np.concatenate([[0], np.cumsum(opens)])
        n, docs = np.unique(seen[offsets[1:]] - seen[offsets[:-1]], return_counts=True)
        yield pa.RecordBatch.from_pydict({"n": pa.array(n), "docs": pa.array(docs)})


def _forward(n_docs: int, n_terms: int, hot: dict[int, int]):
    """Distinct terms and counts of each document with terms; members of hot strata are dealt in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in chunks_of(batches, "text", CHUNK):
            words = scan_words(*text_buffer(batch.column(1)), ALNUM)
            counts = np.bincount(words.doc, minlength=batch.num_rows)
            first = np.cumsum(counts) - counts
            rows = np.flatnonzero(counts)
            terms, tfs = [], []
            for i in rows.tolist():
                term, tf = np.unique(words.hash[first[i] : first[i] + counts[i]], return_counts=True)
                terms.append(term.tobytes())
                tfs.append(tf.astype(np.uint32).tobytes())
            m = normaliser(counts[rows].astype(np.int64), n_docs, n_terms)
            deal = np.fromiter((hot.get(x, 1) for x in m.tolist()), np.int64, len(m))
            part = (turn + np.arange(len(m))) % deal
            turn += len(m)
            columns = {"m": pa.array(m), "part": pa.array(part), "doc_id": batch.column(0).take(pa.array(rows))}
            yield pa.RecordBatch.from_pydict({**columns, "terms": pa.array(terms, pa.binary()), "tfs": pa.array(tfs, pa.binary())})

    return run


def _block(m: int, ids: list, terms: list[bytes], tfs: list[bytes]) -> dict:
    sizes = np.fromiter((len(t) // 4 for t in tfs), np.int64, len(tfs))
    term = np.frombuffer(b"".join(terms), np.uint64)
    tf = np.frombuffer(b"".join(tfs), np.uint32)
    place = np.repeat(np.arange(len(ids), dtype=np.uint16), sizes)
    order = np.lexsort((place, tf, term))
    term, tf = term[order], tf[order]
    new_term = np.concatenate([[True], term[1:] != term[:-1]])
    new_run = new_term | np.concatenate([[True], tf[1:] != tf[:-1]])
    at, run_at = np.flatnonzero(new_term), np.flatnonzero(new_run)
    return {
        "m": m, "n_docs": len(ids), "ids": ids, "terms": term[at].tobytes(),
        "term_docs": np.diff(at, append=len(term)).astype(np.uint32).tobytes(),
        "term_runs": np.diff(np.flatnonzero(new_term[run_at]), append=len(run_at)).astype(np.uint32).tobytes(),
        "run_tf": tf[run_at].tobytes(), "run_docs": np.diff(run_at, append=len(term)).astype(np.uint16).tobytes(),
        "places": place[order].tobytes(),
    }


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that come by m."""
    schema = pa.schema(
        [("m", pa.int64()), ("n_docs", pa.int32()), ("ids", pa.list_(pa.int64()))]
        + [(c, pa.binary()) for c in ("terms", "term_docs", "term_runs", "run_tf", "run_docs", "places")]
    )
    m, ids, terms, tfs, held = None, [], [], [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (row[0] != m or len(ids) == BLOCK_DOCS or held + len(row[3]) // 4 > BLOCK_POSTINGS):
                yield pa.RecordBatch.from_pylist([_block(m, ids, terms, tfs)], schema=schema)
                ids, terms, tfs, held = [], [], [], 0
            m = row[0]
            ids.append(row[1])
            terms.append(row[2])
            tfs.append(row[3])
            held += len(row[3]) // 4
    if ids:
        yield pa.RecordBatch.from_pylist([_block(m, ids, terms, tfs)], schema=schema)


@dataclass
class Index:
    """Written blocks, and the numbers of documents with terms and of all their terms."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame) -> Index:
    """Index every document, whole."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lengths = settle(rows.select("text").mapInArrow(_lengths, "n long, docs long").filter("n > 0").groupBy("n").agg(F.sum("docs").alias("docs")))
    total = lengths.agg(F.sum("docs").alias("docs"), F.sum(F.col("n") * F.col("docs")).alias("terms")).first()
    n_docs, n_terms = total.docs or 0, total.terms or 0
    if not n_docs:
        return Index(spark.createDataFrame([], INDEX), 0, 0)
    # large strata: 65,536 of the shorter documents at most, and one for each 1.3 million documents beyond
    # (a document of m over 65,586 has 1,300 times the mean length, so at most one in 1,300 has)
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {n_terms}L")
    large = lengths.groupBy(m.alias("m")).agg(F.sum("docs").alias("docs")).filter(F.col("docs") > BLOCK_DOCS)
    hot = {r.m: -(-r.docs // BLOCK_DOCS) for r in large.collect()}
    forward = rows.mapInArrow(_forward(n_docs, n_terms, hot), "m long, part long, doc_id long, terms binary, tfs binary")
    dealt = forward.repartition(F.col("m"), F.col("part")).sortWithinPartitions("m", "part")
    return Index(settle(dealt.select("m", "doc_id", "terms", "tfs").mapInArrow(_inverted, INDEX)), n_docs, n_terms)


def _query_files(folder: str):
    """Query blocks of bounded size, one file each: ids and distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written(ids, terms):
            path = f"{folder}/queries-{uuid.uuid4().hex}.arrow"
            table = pa.table({"item_id": pa.concat_arrays(ids), "terms": pa.array(terms, pa.list_(pa.uint64()))})
            with files.open_output(path) as out, pa.ipc.new_stream(out, table.schema) as stream:
                stream.write_table(table)
            return pa.RecordBatch.from_pydict({"path": [path]})

        ids, terms, held = [], [], 0
        for batch in chunks_of(batches, "text", CHUNK):
            words = scan_words(*text_buffer(batch.column(1)), ALNUM)
            counts = np.bincount(words.doc, minlength=batch.num_rows)
            first = np.cumsum(counts) - counts
            for i in np.flatnonzero(counts).tolist():
                mine = np.unique(words.hash[first[i] : first[i] + counts[i]])
                if terms and (len(terms) == QUERIES or held + len(mine) > QUERY_TERMS):
                    yield written(ids, terms)
                    ids, terms, held = [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                terms.append(mine)
                held += len(mine)
        if terms:
            yield written(ids, terms)

    return run


class _Queries:
    """A query block: sorted distinct terms, and the queries that hold each."""

    def __init__(self, path: str):
        with files.open_input(path) as stream:
            table = pa.ipc.open_stream(stream).read_all().combine_chunks()
        self.ids = table.column("item_id").combine_chunks()
        lists = table.column("terms").combine_chunks()
        flat = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        self.terms, code = np.unique(flat, return_inverse=True)
        order = np.argsort(code, kind="stable")
        self.holders = owner[order]
        self.ends = np.cumsum(np.bincount(code, minlength=len(self.terms)))

    def found(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the block's terms among sorted ones, and which of the block's they are."""
        at = np.searchsorted(terms, self.terms)
        at[at == len(terms)] = 0
        mine = np.flatnonzero(terms[at] == self.terms)
        return at[mine], mine


def _frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Queries(path)
        total = np.zeros(len(queries.terms), np.int64)
        for batch in batches:
            for terms, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, mine = queries.found(np.frombuffer(terms, np.uint64))
                total[mine] += np.frombuffer(docs, np.uint32)[at]
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(term), "docs": pa.array(total[term])})

    return run


class _Best:
    """The k best documents of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.least = np.ones(queries, np.int64)
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.none = np.zeros(0, bool)
        self.new: list[tuple] = []
        self.n_new = 0

    def add(self, query, score, doc, none) -> None:
        self.new.append((query, score, doc, none))
        self.n_new += len(query)
        if self.n_new > max(len(self.query), CELLS >> 6):
            self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        held = self.query, self.score, self.doc, self.none
        query, score, doc, none = (np.concatenate([old, *parts]) for old, parts in zip(held, zip(*self.new)))
        order = np.lexsort((doc, none, -score, query))
        query, score, doc, none = query[order], score[order], doc[order], none[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        rank = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
        last = rank == self.k - 1
        self.least[query[last]] = score[last]
        kept = rank < self.k
        self.query, self.score, self.doc, self.none = query[kept], score[kept], doc[kept], none[kept]
        self.new, self.n_new = [], 0


class _Stratum:
    """One index block against a query block: its terms' runs, their impacts, and a bound for each query."""

    def __init__(self, row: dict, queries: _Queries, weights: np.ndarray):
        self.docs = row["n_docs"]
        self.ids = row["ids"]
        at, mine = queries.found(np.frombuffer(row["terms"], np.uint64))
        use = weights[mine] > 0
        self.term = mine[use]
        at = at[use]
        docs, runs = np.frombuffer(row["term_docs"], np.uint32), np.frombuffer(row["term_runs"], np.uint32)
        self.begin = (np.cumsum(docs, dtype=np.int64) - docs)[at]
        self.size = docs[at].astype(np.int64)
        run_end = np.cumsum(runs, dtype=np.int64)
        run_tf = np.frombuffer(row["run_tf"], np.uint32).astype(np.int64)
        self.impacts = impact(run_tf, row["m"])
        self.most = self.impacts[run_end[at] - 1] * weights[self.term]
        self.run_docs = np.frombuffer(row["run_docs"], np.uint16)
        self.places = np.frombuffer(row["places"], np.uint16)

    def bounds(self, queries: _Queries) -> np.ndarray:
        ends = queries.ends[self.term]
        sizes = ends - np.where(self.term > 0, queries.ends[self.term - 1], 0)
        pick = np.repeat(ends - np.cumsum(sizes), sizes) + np.arange(int(sizes.sum()))
        out = np.zeros(len(queries.ids), np.int64)
        np.add.at(out, queries.holders[pick], np.repeat(self.most, sizes))
        return out

    def scores(self, queries: _Queries, weights: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores of the wanted queries (rows) for all documents of the block."""
        out = np.zeros((len(wanted), self.docs), np.int64)
        row = np.full(len(queries.ids), -1, np.int64)
        row[wanted] = np.arange(len(wanted))
        impacts = np.repeat(self.impacts, self.run_docs)
        for term, a, n in zip(self.term.tolist(), self.begin.tolist(), self.size.tolist()):
            rows = row[queries.holders[(queries.ends[term - 1] if term else 0) : queries.ends[term]]]
            rows = rows[rows >= 0]
            if len(rows):
                out[rows[:, None], self.places[a : a + n]] += weights[term] * impacts[a : a + n]
        return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    group, held = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names) if name != "ids"}
            row["ids"] = batch.column("ids").slice(i, 1).flatten()
            group.append(row)
            held += sum(len(v) for v in row.values() if isinstance(v, bytes))
            if len(group) == GROUP or held > GROUP_BYTES:
                yield group
                group, held = [], 0
    if group:
        yield group


def _searched(path: str, weights: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Queries(path)
        n = len(queries.ids)
        best = _Best(n, k)
        for group in _groups(batches):
            strata = [_Stratum(row, queries, weights) for row in group]
            bounds = np.stack([s.bounds(queries) for s in strata], axis=1)
            order = np.argsort(-bounds, axis=1, kind="stable")
            at, wave = 0, 1
            while at < len(strata):
                visits = order[:, at : at + wave]
                bound = np.take_along_axis(bounds, visits, axis=1)
                # an equal score may still win by its id
                open_ = bound >= best.least[:, None]
                if not open_[:, 0].any():
                    break
                who, column = np.nonzero(open_)
                stratum = visits[who, column]
                for i in np.unique(stratum).tolist():
                    wanted = who[stratum == i]
                    s = strata[i]
                    ids = s.ids.to_numpy(zero_copy_only=False) if not s.ids.null_count else s.ids.fill_null(0).to_numpy()
                    none = s.ids.is_null().to_numpy(zero_copy_only=False)
                    step = max(CELLS // s.docs, 1)
                    for a in range(0, len(wanted), step):
                        some = wanted[a : a + step]
                        scores = s.scores(queries, weights, some)
                        row, doc = np.nonzero(scores >= best.least[some][:, None])
                        if len(row):
                            best.add(some[row], scores[row, doc], ids[doc], none[doc])
                best.settle()
                at, wave = at + wave, wave * 2
        best.settle()
        if len(best.query):
            doc_id = pa.array(best.doc, pa.int64(), mask=best.none)
            columns = {"query": pa.array(best.query), "item_id": queries.ids.take(pa.array(best.query)), "doc_id": doc_id, "score": pa.array(best.score)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def search(index: Index, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = items.sparkSession
    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    told = settle(items.select("item_id", F.col("text").cast("string").alias("text")))
    many = -(-told.count() // (QUERIES - QUERIES // 8))
    paths = []
    if many and index.n_docs:
        folder = fresh_dir(spark, "queries")
        paths = [r.path for r in settle(told.repartition(many).mapInArrow(_query_files(folder), "path string")).collect()]
    ranked = []
    for path in paths:
        counted = index.blocks.select("terms", "term_docs").mapInArrow(_frequencies(path), "term long, docs long")
        # at most QUERY_TERMS rows, or the terms of one query
        counted = counted.groupBy("term").agg(F.sum("docs").alias("docs")).toPandas()
        weights = np.zeros(int(counted.term.max()) + 1 if len(counted) else 1, np.int64)
        weights[counted.term.to_numpy()] = np.floor(1000 * np.log((2 * index.n_docs + 2) / (2 * counted.docs.to_numpy() + 1))).astype(np.int64)
        ranked.append(_merged(index, path, weights, k, kind))
    return reduce(DataFrame.unionByName, ranked) if ranked else spark.createDataFrame([], schema)


def _merged(index: Index, path: str, weights: np.ndarray, k: int, kind: T.DataType) -> DataFrame:
    names = ("query", T.LongType()), ("item_id", kind), ("doc_id", T.LongType()), ("score", T.LongType())
    schema = T.StructType([T.StructField(n, t) for n, t in names])
    found = index.blocks.mapInArrow(_searched(path, weights, k), schema)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The k best documents of every item, all documents indexed."""
    return search(build_index(docs), items, k)
