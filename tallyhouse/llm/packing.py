"""Packing of tokenized documents into sequences by a configuration linear program.

1. Texts are encoded in place, an end id follows each document, and what is longer than a sequence is cut
   into full pieces and a rest. Pieces (no texts) are written, each with its place among the pieces of its
   length in its task.
2. The histogram of lengths, one number for each length up to the capacity, is all the driver sees.
3. Covering program: use as few sequences as possible so that every length is covered as often as it
   occurs. A configuration says how many pieces of each length share a sequence. Multiplicative weights
   solve it: a length's price is a power of its share of a sequence times a weight that falls
   exponentially with the covered share of its pieces; each round prices all fill levels by a knapsack
   dynamic program, takes the best configurations through the dearest lengths, and raises each by a
   bounded step. Prices divided by the best value are a feasible dual: they bound the optimum from below.
4. Rounding: whole parts of the configurations that fill a sequence, never beyond what is left. The program
   is solved again for the rest while that places pieces; the last ones are packed best-fit by falling
   length, on the histogram as well. On small tables (few pieces of each length) whole parts are rare
   and best fit places most.
5. The plan is a table of ranges: of the pieces of a length, those numbered from - to lie in these
   sequences at this place. Its size depends on the capacity and on ROUNDS, not on the documents. Piece
   numbers are a sum over tasks plus the place in the task, so no length, however common, meets in a task.

Defined cases: a null or empty text is its end id alone; repeated rows and null ids are documents of their
own; an empty table has no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.textscan import chunks_of, process_cache, text_buffer
from tallyhouse.llm.word_ids import WordIds
from tallyhouse.storage import settle

CAPACITY = 2048
END_ID = 0
CHUNK = 2 << 20
#: Rounds of the weights, configurations a round, and how often the rest is solved again.
ROUNDS, SEEDS, SOLVES = 60, 64, 6
#: Power of the length in its price, rate at which weights fall, and the largest step as a share of what is left.
LONG, RATE, STEP = 1.2, 0.5, 0.5
#: Share of a solution that is left to the next one, so that short pieces remain for the last long ones.
RESERVE = 0.05

Config = tuple[tuple[int, int], ...]


def _fill(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Best value of each fill level; pieces of any number."""
    best = np.zeros(capacity + 1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(int(lengths[0]), capacity + 1):
        k = upto[c]
        best[c] = max(best[c - 1], (best[c - lengths[:k]] + prices[:k]).max())
    return best


def _through(seed: int, best: np.ndarray, prices: np.ndarray, lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration through a length: the dearest filling beside it that what is left allows."""
    took = {seed: 1}
    room = capacity - int(lengths[seed])
    free = np.searchsorted(lengths, room, "right")
    while free:
        value = best[room - lengths[:free]] + prices[:free]
        i = int(value.argmax())
        while took.get(i, 0) >= left[i]:
            value[i] = -1.0
            i = int(value.argmax())
            if value[i] < 0:
                return took
        took[i] = took.get(i, 0) + 1
        room -= int(lengths[i])
        free = np.searchsorted(lengths, room, "right")
    return took


def solve(counts: np.ndarray, capacity: int) -> tuple[dict[Config, float], float]:
    """Fractional sequences of each configuration for the counts (index: length), and a lower bound on the program."""
    lengths = np.flatnonzero(counts)
    need = counts[lengths].astype(float)
    left = need.copy()
    size = lengths / capacity
    found: dict[Config, float] = {}
    bound = float((need * size).sum())
    for _ in range(ROUNDS):
        share = left / need
        live = np.flatnonzero(share > 0)
        if not len(live):
            break
        # the size itself prices a perfect packing; lengths that lag behind gain, long ones a little
        prices = size[live] ** LONG * np.exp(RATE * (share[live] - 1))
        best = _fill(prices, lengths[live], capacity)
        bound = max(bound, float((need[live] * prices).sum() / best[-1]))
        for seed in np.argsort(-prices, kind="stable")[:SEEDS].tolist():
            if left[live[seed]] <= 0:
                continue
            took = _through(seed, best, prices, lengths[live], np.ceil(left[live]), capacity)
            items = [(int(live[i]), a) for i, a in took.items()]
            step = min(left[i] / a for i, a in items)
            step = step * STEP if step > 1 else step
            for i, a in items:
                left[i] = max(left[i] - a * step, 0.0)
                if left[i] < 1e-9 * need[i]:
                    left[i] = 0.0
            key = tuple(sorted(((int(lengths[i]), a) for i, a in items), reverse=True))
            found[key] = found.get(key, 0.0) + step
    return found, bound


@dataclass
class Plan:
    """Configurations with the number of sequences each takes, in order, and the lower bound of the program."""

    capacity: int
    parts: list[tuple[Config, int]] = field(default_factory=list)
    bound: float = 0.0

    @property
    def sequences(self) -> int:
        return sum(k for _, k in self.parts)

    def ranges(self) -> dict[str, np.ndarray]:
        """By (length, first): numbered pieces from `first` on, `copies` a sequence, from sequence `base` at `offset`."""
        rows, used, base = [], {}, 0
        for config, k in self.parts:
            offset = 0
            for length, copies in config:
                first = used.get(length, 0)
                rows.append((length, first, copies, base, offset))
                used[length] = first + copies * k
                offset += length * copies
            base += k
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return dict(zip(("length", "first", "copies", "base", "offset"), table.T.copy()))


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Config, int]]:
    """Best fit by falling length; sequences of equal contents are one entry with their number."""
    open_: dict[int, list[tuple[Config, int]]] = {capacity: [((), 1 << 62)]}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            room = min(f for f in open_ if f >= length)
            config, k = open_[room].pop()
            a = min(room // length, left)
            m = min(k, left // a)
            if k > m:
                open_[room].append((config, k - m))
            elif not open_[room]:
                del open_[room]
            open_.setdefault(room - a * length, []).append(((*config, (length, a)), m))
            left -= a * m
    return [(config, k) for group in open_.values() for config, k in group if config]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Sequences for so many pieces of each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out = Plan(capacity)
    if counts[capacity]:
        out.parts.append((((capacity, 1),), int(counts[capacity])))
    out.bound = float(counts[capacity])
    counts[capacity] = 0
    for turn in range(SOLVES):
        if not counts.any():
            break
        found, bound = solve(counts, capacity)
        out.bound += 0 if turn else bound
        before = counts.sum()
        for config, x in sorted(found.items(), key=lambda x: (-x[1], x[0])):
            if sum(n * a for n, a in config) == capacity:
                k = min(int(x * (1 - RESERVE)), *(int(counts[n]) // a for n, a in config))
                if k > 0:
                    out.parts.append((config, k))
                    for n, a in config:
                        counts[n] -= a * k
        if before - counts.sum() < before / 100:
            break
    out.parts += _best_fit(counts, capacity)
    return out


def _cut(tokenizer: str, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache()
        if cache.get("word_ids_of") != hash(tokenizer):
            cache["word_ids_of"], cache["word_ids"] = hash(tokenizer), WordIds(tokenizer)
        encoder: WordIds = cache["word_ids"]
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in chunks_of(batches, "text", CHUNK):
            ids, counts = encoder.encode(*text_buffer(batch.column(1)))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            parts = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(counts[doc] - start, capacity)
            at = (np.cumsum(counts) - counts)[doc] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            runs = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - (np.cumsum(runs) - runs)[length[order]]
            nth += seen[length]
            seen += runs
            columns = {
                "doc_id": batch.column(0).take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)), "start": pa.array(start),
                "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                "task": pa.array(np.full(len(doc), task, np.int64)), "nth": pa.array(nth),
            }
            if with_ids:
                # pieces follow each other: document by document, whole
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    return run


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The written pieces, with their task and their number among the task's pieces of that length."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"{PIECES}, task long, nth long" + (", ids array<int>" if with_ids else "")
    return settle(rows.mapInArrow(_cut(tokenizer, end_id, capacity, with_ids), schema))


def _placed(ranges: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ranges of a length lie together, by their first number
        shift = np.int64(1) << 48
        keys = ranges["length"] * shift + ranges["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            row = np.searchsorted(keys, length * shift + number, "right") - 1
            into = number - ranges["first"][row]
            copies = ranges["copies"][row]
            kept = [batch.column(c) for c in batch.schema.names if c != "number"]
            names = [c for c in batch.schema.names if c != "number"]
            places = [pa.array(ranges["base"][row] + into // copies), pa.array(ranges["offset"][row] + into % copies * length)]
            yield pa.RecordBatch.from_arrays([*kept, *places], names=[*names, "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and the ids if asked for)."""
    pieces = pieces_of(docs, tokenizer_path, end_id, capacity, with_ids)
    held = settle(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    # one number a length: `capacity` rows at most
    histogram = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = plan(histogram, capacity).ranges()
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    begins = settle(held.select("task", "length", before.alias("before")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    numbered = pieces.join(begins, ["task", "length"]).select(*columns, (F.col("before") + F.col("nth")).alias("number"))
    schema = PIECES + (", ids array<int>" if with_ids else "") + ", sequence_id long, offset long"
    return numbered.mapInArrow(_placed(ranges), schema)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from pieces that were packed with their ids; a sequence is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
