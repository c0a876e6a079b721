"""Benchmark decontamination with one FM-index per training shard.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Every 13 consecutive
words of a benchmark item are a test phrase; an item of fewer words is one phrase.

A shard is a run of documents of about `SHARD` bytes that one task holds at a time (a longer
document is a shard of its own). Its words, with a separator after each document, are sorted
by suffix (prefix doubling over the groups still tied); the last column of that order is kept
as a wavelet matrix with packed bits and block counts. All phrases are searched backward
together, two ranks a word; the rows found are walked to the next sampled suffix position.
Covered words merge to removal spans.

Documents never leave their task and are not shuffled. The distinct phrases, each with its items,
are written in blocks of about `BLOCK` (20 MB); a task builds a shard's index once and searches
block after block in it, with one block in memory, so a benchmark of any size works. The driver
sees the block files' names only.

Defined cases: a null text or item has no words; repeated rows each get their own result;
an item whose id is null marks words but is not listed; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import files
from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.textscan import ALNUM, Words, chunks_of, scan_words, text_buffer
from tallyhouse.session import fresh_dir
from tallyhouse.storage import settle

WINDOW = 13
SHARD = 4 << 20
BLOCK = 200_000
EMITTED = 50_000
SAMPLE = 16

N_WORDS, SPANS, HITS, ITEMS = "__n_words", "__spans", "__hit_words", "__items"
SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; the shorter of two equal ones comes first."""
    n = len(symbols)
    width = int(n + 2).bit_length()
    wide = max(int(symbols.max()).bit_length(), 1) if n else 1
    position = np.arange(n, dtype=np.uint64)
    after = np.zeros(n, np.uint64)
    after[:-1] = symbols[1:] + 1
    first = symbols.astype(np.uint64) + np.uint64(1)
    order, fresh = _sorted_pairs(first, after, position, wide + 1, width)
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    reach = 2
    while True:
        group = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        if len(slots) == n:
            sa = order.astype(np.int64)
        else:
            sa[slots] = order
        rank[order.astype(np.int64)] = group
        last = np.empty(len(fresh), bool)
        last[:-1] = fresh[1:]
        last[-1:] = True
        tied = ~(fresh & last)
        slots = slots[tied]
        if not len(slots):
            return sa
        position = sa[slots]
        follow = position + reach
        after = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0).astype(np.uint64)
        order, fresh = _sorted_pairs(rank[position].astype(np.uint64), after, position.astype(np.uint64), width, width)
        reach *= 2


def _sorted_pairs(first, second, position, wide: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions by (first, second), and where a new pair begins. Packed into one word where it fits."""
    if 2 * wide + width <= 64:
        keys = (first << np.uint64(wide + width)) | (second << np.uint64(width)) | position
        keys.sort()
        pair = keys >> np.uint64(width)
        order = keys & np.uint64((1 << width) - 1)
        fresh = np.empty(len(keys), bool)
        fresh[:1] = True
        np.not_equal(pair[1:], pair[:-1], out=fresh[1:])
        return order, fresh
    by = np.lexsort((second, first))
    first, second = first[by], second[by]
    fresh = np.ones(len(by), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return position[by], fresh


class Bits:
    """A bit vector with constant-time ranks: packed words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        block, shift = i >> 6, (i & 63).astype(np.uint64)
        return self.before[block] + np.bitwise_count(self.words[block] & ((np.uint64(1) << shift) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Symbols 1 and up; 0 ends the text."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        text = np.append(symbols, 0).astype(np.int64)
        sa = suffix_order(text)
        column = text[sa - 1].astype(np.int32)
        self.size, self.sigma = len(text), int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        self.marked = Bits(sa % sample == 0)
        self.samples = sa[sa % sample == 0]
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(max(self.sigma - 1, 1).bit_length())):
            ones = (column >> level) & 1 != 0
            zeros = ~ones
            low = column[zeros]
            self.levels.append((level, Bits(ones), len(low)))
            column = np.concatenate([low, column[ones]])
        self.home = np.zeros(self.sigma, np.int64)
        opens = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        self.home[column[opens]] = opens

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first i of the last column."""
        for level, bits, zeros in self.levels:
            one = bits.rank(i)
            i = np.where((symbol >> level) & 1 != 0, zeros + one, i - one)
        return i - self.home[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one symbol earlier."""
        symbol, i = np.zeros(len(row), np.int64), row
        for level, bits, zeros in self.levels:
            one, bit = bits.rank(i), bits.get(i)
            i = np.where(bit, zeros + one, i - one)
            symbol |= bit.astype(np.int64) << level
        return self.before[symbol] + i - self.home[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase; column -1 - t of a phrase is its t-th symbol from the end."""
        low = np.zeros(len(lengths), np.int64)
        high = np.full(len(lengths), self.size, np.int64)
        live = np.arange(len(lengths))
        for t in range(phrases.shape[1]):
            live = live[lengths[live] > t]
            if not len(live):
                break
            symbol = phrases[live, -1 - t]
            both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
            low[live] = self.before[symbol] + both[: len(live)]
            high[live] = self.before[symbol] + both[len(live) :]
            gone = low[live] >= high[live]
            high[live[gone]] = low[live[gone]] = 0
            live = live[~gone]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by walking back to a sampled one."""
        found = np.zeros(len(rows), np.int64)
        open_, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(open_):
            there = self.marked.get(row)
            found[open_[there]] = self.samples[self.marked.rank(row[there])] + steps
            open_, row = open_[~there], row[~there]
            if len(row):
                row = self.back(row)
            steps += 1
        return found


@dataclass
class Phrases:
    """Distinct phrases as word fingerprints, right-aligned; pairs of phrase and item by phrase."""

    words: np.ndarray
    lengths: np.ndarray
    of_phrase: np.ndarray
    names: pa.Array


def _phrases(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks_of(batches, "text", SHARD):
            data, offsets = text_buffer(batch.column(1))
            words = scan_words(data, offsets, ALNUM)
            word_from = np.searchsorted(words.doc, np.arange(len(offsets)))
            for doc, item in enumerate(batch.column(0).to_pylist()):
                held = words.hash[word_from[doc] : word_from[doc + 1]]
                if not len(held):
                    continue
                windows = np.lib.stride_tricks.sliding_window_view(held, min(window, len(held)))
                # a long item goes out in parts
                for i in range(0, len(windows), EMITTED):
                    part = np.ascontiguousarray(windows[i : i + EMITTED])
                    ends = np.arange(len(part) + 1, dtype=np.int32) * np.int32(8 * part.shape[1])
                    phrase = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(part)])
                    yield pa.RecordBatch.from_arrays([phrase, pa.array([item] * len(part), pa.string())], names=["phrase", "item"])

    return run


def write_phrases(benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> list[str]:
    """Write the distinct test phrases with their items; returns the block files, each phrase in one of them."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    pairs = settle(rows.mapInArrow(_phrases(window), "phrase binary, item string").distinct())
    blocks = -(-pairs.select("phrase").distinct().count() // block)
    folder = fresh_dir(spark, "phrases")
    pairs.repartition(max(blocks, 1), "phrase").write.parquet(folder)
    return sorted(spark.read.schema(pairs.schema).parquet(folder).inputFiles())


def read_phrases(path: str, window: int = WINDOW) -> Phrases:
    """One block of phrases."""
    with files.open_input(path) as source:
        pairs = pq.read_table(source).combine_chunks()
    if not len(pairs):
        return Phrases(np.zeros((0, window), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string()))
    coded = pairs["phrase"].chunk(0).dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy()
    lengths = pc.binary_length(distinct).to_numpy().astype(np.int64) // 8
    words = np.zeros((len(distinct), window), np.uint64)
    words[np.arange(window)[None, :] >= (window - lengths)[:, None]] = np.frombuffer(distinct.buffers()[2], np.uint64, int(lengths.sum()))
    order = np.argsort(codes, kind="stable")
    return Phrases(words, lengths, codes[order].astype(np.int64), pairs["item"].chunk(0).take(pa.array(order)))


class Shard:
    """The words of a shard; its index is built once, for the first block with a phrase of known words."""

    def __init__(self, words: Words):
        self.codes, self.distinct = pd.factorize(words.hash)
        self.where = np.arange(len(self.codes)) + words.doc
        self.sorter = np.argsort(self.distinct)

    @cached_property
    def index(self) -> FMIndex:
        symbols = np.ones(int(self.where[-1]) + 2, np.int64)
        symbols[self.where] = self.codes + 2
        return FMIndex(symbols)

    @cached_property
    def word_at(self) -> np.ndarray:
        at = np.zeros(int(self.where[-1]) + 2, np.int64)
        at[self.where] = np.arange(len(self.codes))
        return at

    def occurrences(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """First word and phrase of every occurrence in the shard."""
        none = np.zeros(0, np.int64)
        if not len(self.codes) or not len(phrases.lengths):
            return none, none
        slot = np.minimum(np.searchsorted(self.distinct, phrases.words, sorter=self.sorter), len(self.distinct) - 1)
        known = self.distinct[self.sorter[slot]] == phrases.words
        known |= np.arange(phrases.words.shape[1])[None, :] < (phrases.words.shape[1] - phrases.lengths)[:, None]
        ready = np.flatnonzero(known.all(axis=1))
        if not len(ready):
            return none, none
        low, high = self.index.search(self.sorter[slot[ready]] + 2, phrases.lengths[ready])
        count = high - low
        rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return self.word_at[self.index.locate(rows)], np.repeat(ready, count)


def _points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte offset of one text."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]


def _marker(paths: list[str], window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = read_phrases(paths[0], window) if len(paths) == 1 else None
        for batch in chunks_of(batches, "text", SHARD):
            names = batch.schema.names
            column = lambda name: batch.column(names.index(name))  # noqa: B023, E731
            data, offsets = text_buffer(column("text"))
            n = len(offsets) - 1
            words = scan_words(data, offsets, ALNUM)
            shard = Shard(words)
            edge = np.zeros(len(words.hash) + 1, np.int64)
            items: list[set] = [set() for _ in range(n)]
            for path in paths:
                phrases = only or read_phrases(path, window)
                at, phrase = shard.occurrences(phrases)
                if not len(at):
                    continue
                edge += np.bincount(at, minlength=len(edge))
                edge -= np.bincount(at + phrases.lengths[phrase], minlength=len(edge))
                for code in np.unique(words.doc[at] * len(phrases.lengths) + phrase).tolist():
                    doc, p = divmod(code, len(phrases.lengths))
                    a, b = np.searchsorted(phrases.of_phrase, [p, p + 1])
                    items[doc].update(phrases.names[a:b].to_pylist())
            hit = np.cumsum(edge[:-1]) > 0
            marked: list[list] = [[] for _ in range(n)]
            touched = np.unique(words.doc[hit])
            word_from = np.searchsorted(words.doc, np.arange(n + 1))
            for doc in touched.tolist():
                marked[doc] = (np.flatnonzero(hit[word_from[doc] : word_from[doc + 1]])).tolist()
            spans: list[list] = [[] for _ in range(n)]
            for doc in range(n):
                if marked[doc]:
                    w = np.array(marked[doc])
                    opens = np.flatnonzero(np.concatenate([[True], np.diff(w) > 1]))
                    closes = np.append(opens[1:], len(w)) - 1
                    base, text = word_from[doc], data[offsets[doc] : offsets[doc + 1]]
                    start = _points(text, words.start[base + w[opens]] - offsets[doc])
                    end = _points(text, words.end[base + w[closes]] - offsets[doc])
                    spans[doc] = [{"start": int(s), "end": int(e)} for s, e in zip(start, end)]
            extra = {
                N_WORDS: pa.array(np.diff(word_from)),
                SPANS: pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                HITS: pa.array(marked, pa.list_(pa.int64())),
                ITEMS: pa.array([sorted(i for i in s if i is not None) for s in items], pa.list_(pa.string())),
            }
            kept = [x for x in names if x not in extra and (keep_text or x != "text")]
            yield pa.RecordBatch.from_arrays([*[column(x) for x in kept], *extra.values()], names=[*kept, *extra])

    return run


def marked_documents(docs: DataFrame, benchmark: DataFrame, keep_text: bool = True, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """All columns with the number of words, the removal spans in code points, hit word places and items."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    extra = [T.StructField(N_WORDS, T.LongType()), T.StructField(SPANS, SPAN_TYPE), T.StructField(HITS, T.ArrayType(T.LongType())), T.StructField(ITEMS, T.ArrayType(T.StringType()))]
    fields = [f for f in docs.schema.fields if f.name not in (N_WORDS, SPANS, HITS, ITEMS) and (keep_text or f.name != "text")]
    marker = _marker(write_phrases(benchmark, window, block), window, keep_text)
    return docs.mapInArrow(marker, T.StructType([*fields, *extra]))


def contaminated() -> Column:
    n_hit = F.size(HITS)
    return (n_hit > 0) & (20 * n_hit >= F.col(N_WORDS))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the removal spans of every document."""
    marked = marked_documents(docs.select("doc_id", "text"), benchmark, keep_text=False)
    items = F.array_sort(F.array_distinct(ITEMS))
    return marked.select(
        "doc_id",
        F.col(N_WORDS).alias("n_words"),
        F.size(HITS).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        F.col(SPANS).alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they came."""
    plain, as_they_came = set_aside(docs, ("text",))
    return as_they_came(marked_documents(plain, benchmark).filter(~contaminated()))


def cut_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents with the removal spans cut out of their text."""
    plain, as_they_came = set_aside(docs, ("text",))
    marked = marked_documents(plain, benchmark)
    pieces = F.expr(
        f"transform(sequence(0, size({SPANS})), i -> substring(text, "
        f"if(i = 0, 1L, {SPANS}[greatest(i - 1, 0)].end + 1), "
        f"if(i = size({SPANS}), length(text), {SPANS}[least(i, size({SPANS}) - 1)].start) - if(i = 0, 0L, {SPANS}[greatest(i - 1, 0)].end)))"
    )
    cleaned = F.when(F.size(SPANS) > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    return as_they_came(marked.withColumn("text", cleaned))
