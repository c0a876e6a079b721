"""Vectorised word scanning of Arrow text columns.

A batch of texts is one byte buffer with document offsets. Words are maximal runs of
bytes that a 256-entry table maps to a non-zero code, never across documents. The
table also folds case. UTF-8 bytes of 0x80 and more always have one class here, so a
byte table is as good as a code point table.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes scanned at once; working arrays are 8 bytes a text byte.
PIECE = 1 << 20

_P = 0x9E3779B97F4A7C15 | 1


def process_cache() -> dict:
    """What a process keeps between tasks; never part of a pickled function."""
    return sys.__dict__.setdefault("_tallyhouse_cache", {})


def _fold_table(is_word) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in range(255):
        low = b + 32 if 0x41 <= b <= 0x5A else b
        if is_word(low):
            table[b] = low + 1
    return table


#: Words of `[^\x20\x09-\x0D]+`, A-Z lower-cased.
SPACED = _fold_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM = _fold_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    kept = process_cache().get("powers")
    if kept is None or len(kept[0]) < n:
        kept = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            steps = np.full(max(n, PIECE + 1), base, np.uint64)
            steps[0] = 1
            kept.append(np.cumprod(steps))
        process_cache()["powers"] = kept
    return kept[0], kept[1]


@dataclass
class Words:
    """Words of a buffer in order; `doc` is the index of the document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    buffers = column.buffers()
    if n == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if buffers[2] is None else np.frombuffer(buffers[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about PIECE bytes that split no word."""
    total, at = len(data), 0
    while at < total:
        end = min(at + PIECE, total)
        while end < total:
            k = int(np.searchsorted(offsets, end, "right")) - 1
            if offsets[k] == end:
                break
            if offsets[k] > at:
                end = int(offsets[k])
                break
            gaps = np.flatnonzero(table[data[end : end + PIECE]] == 0)
            stop = int(offsets[k + 1])
            end = min(stop, end + int(gaps[0]) if len(gaps) else end + PIECE, total)
            if len(gaps) or end == stop:
                break
        yield at, end
        at = end


def scan_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """All words of the buffer with 64-bit fingerprints."""
    starts, ends, hashes = [], [], []
    inner = offsets[1:-1]
    for a, b in _cuts(data, offsets, table):
        code = table[data[a:b]]
        word = np.empty(b - a + 2, bool)
        word[0] = word[-1] = False
        np.not_equal(code, 0, out=word[1:-1])
        opens = word[1:-1] & ~word[:-2]
        closes = word[1:-1] & ~word[2:]
        lo, hi = np.searchsorted(inner, [a, b])
        edge = inner[lo:hi]
        edge = edge[edge < b] - a
        if len(edge):
            opens[edge] = word[edge + 1]
            back = edge[edge > 0] - 1
            closes[back] = word[back + 1]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes)
        power, inverse = _powers(b - a)
        sums = np.empty(b - a + 1, np.uint64)
        sums[0] = 0
        np.cumsum(code * power[: b - a], out=sums[1:])
        hashes.append(mix((sums[e + 1] - sums[s]) * inverse[s] + (e + 1 - s).astype(np.uint64)))
        starts.append(s + a)
        ends.append(e + 1 + a)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    fingerprint = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, fingerprint, doc)


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of `width` consecutive words, at the place of the first."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += words[j : j + n] * np.uint64(pow(_P, 2 * j + 1, 1 << 64))
    return mix(total)


def chunks_of(batches, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of at most `limit` text bytes, or of one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = text_buffer(column)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    release()


def release() -> None:
    """Give memory that a task has freed back to the machine: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass
