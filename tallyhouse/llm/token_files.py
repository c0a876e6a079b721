"""Token-id files: documents in ascending doc_id order, tokenized, coded in blocks, with a document table.

The text is cut at places where the tokenizer always starts anew (one space or line feed
between two characters that are not white space), so equal pieces are encoded once a task and
the ids of a text are those of its pieces in order. The tokenizers library encodes every
distinct piece.

Documents are range-partitioned by (doc_id, hash of the text) and sorted. A task writes one
file: segments of at most LANES x BLOCK ids (see id_coder), then the document table (doc_id and number
of ids of each document, end id included) and a footer. A file is named by a fresh id and
counts only when its row is in the manifest, so a repeated or lost task leaves no trace in the result.
Files before a file in the manifest give the place of its first id; one row a file reaches the driver.

Defined cases: a null text has no ids but the end id; null doc_ids come first; rows with equal
ids are ordered by their text's hash; an empty table makes no files.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import files, id_coder
from tallyhouse.llm.textscan import PIECE, _powers, chunks_of, mix, process_cache, text_buffer
from tallyhouse.session import fresh_dir
from tallyhouse.storage import settle

END_ID = 2
CHUNK = 2 << 20
#: Distinct pieces a task remembers before it starts anew.
MEMORY = 150_000
FOOTER = b"IDCF"


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where texts may be cut: each document's start, and single spaces or line feeds within words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    graph = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data < 0xE0)
    ends = graph.copy()
    ends[1:] |= lead[:-1] & (data[1:] >= 0x80) & (data[1:] < 0xC0)
    cut = np.zeros(n, bool)
    cut[1:-1] = ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) & ends[:-2] & (graph | lead)[2:]
    starts = offsets[:-1][np.diff(offsets) > 0]
    # a document's first and last bytes lean on a neighbour's bytes: no cut there
    cut[np.minimum(offsets[1:], n) - 1] = False
    cut[starts] = True
    return np.flatnonzero(cut)


class Pieces:
    """Encodes texts piece by piece and remembers the pieces."""

    def __init__(self, tokenizer: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = special_as_text
        self.known: dict[int, list[int]] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the number of ids of each text."""
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        ids, sizes = [], []
        at = 0
        while at < len(starts):
            to = max(int(np.searchsorted(ends, starts[at] + PIECE, "right")), at + 1)
            part, size = self._window(data, starts[at:to], ends[at:to])
            ids.append(part)
            sizes.append(size)
            at = to
        doc = np.searchsorted(offsets, starts, "right") - 1
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        counts = np.bincount(doc, weights=size, minlength=len(offsets) - 1).astype(np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int64)), counts

    def _window(self, data, starts, ends):
        a, b = int(starts[0]), int(ends[-1])
        power, inverse = _powers(b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b] + np.uint64(1)) * power[: b - a], out=sums[1:])
        s, e = starts - a, ends - a
        codes, distinct = pd.factorize(mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)))
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        keys = distinct.tolist()
        if len(self.known) > MEMORY:
            self.known.clear()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        texts = [data[starts[first[i]] : ends[first[i]]].tobytes().decode("utf-8", "replace") for i in new]
        for i, got in zip(new, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.known[keys[i]] = got.ids
        lists = [self.known[k] for k in keys]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(size.sum()))
        base = np.cumsum(size) - size
        each = size[codes]
        place = np.repeat(base[codes] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
        return flat[place], each


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # special tokens as the library reads them by default
        pieces = Pieces(tokenizer, special_as_text=False)
        limit = id_coder.BLOCK * id_coder.LANES
        name = f"{folder}/ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        out, held, n_held, total, table = None, [], 0, 0, []
        for batch in chunks_of(batches, "text", CHUNK):
            if out is None:
                out = files.open_output(name)
            data, offsets = text_buffer(batch.column(1))
            ids, counts = pieces.encode(data, offsets)
            ends = np.cumsum(counts)
            held.append(np.insert(ids, ends, end_id).astype(np.uint32))
            n_held += len(held[-1])
            table.append((batch.column(0), counts + 1))
            while n_held >= limit:
                joined = np.concatenate(held)
                out.write(id_coder.pack(joined[:limit]))
                held, n_held, total = [joined[limit:]], n_held - limit, total + limit
        if out is None:
            return
        if n_held:
            out.write(id_coder.pack(np.concatenate(held)))
            total += n_held
        at = out.tell()
        sink = pa.BufferOutputStream()
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            for ids_, counts in table:
                stream.write_batch(pa.RecordBatch.from_arrays([ids_, pa.array(counts)], schema=schema))
        body = sink.getvalue().to_pybytes()
        out.write(body)
        out.write(FOOTER + struct.pack("<QQI", at, total, zlib.crc32(body)))
        size = out.tell()
        out.close()
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "path": [name], "n_ids": [total], "n_bytes": [size]})

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write the files; returns their manifest: part, path, n_ids, n_bytes."""
    folder = folder or fresh_dir(docs.sparkSession, "token-ids")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    manifest = rows.mapInArrow(_writer(folder, tokenizer, end_id), "part long, path string, n_ids long, n_bytes long")
    return settle(manifest)


def document_table(stream) -> pa.Table:
    """The document table of one file."""
    stream.seek(stream.size() - 24)
    at, _, check = struct.unpack("<QQI", stream.read(24)[4:])
    stream.seek(at)
    body = stream.read(stream.size() - 24 - at)
    if zlib.crc32(body) != check:
        raise ValueError("damaged document table")
    return pa.ipc.open_stream(body).read_all()


def file_ids(stream) -> Iterator[np.ndarray]:
    """The ids of one file, segment by segment."""
    stream.seek(stream.size() - 24)
    (end,) = struct.unpack("<Q", stream.read(24)[4:12])
    stream.seek(0)
    while stream.tell() < end:
        yield id_coder.read_segment(stream)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with files.open_input(path) as stream:
                table = document_table(stream)
                counts = table.column("n_tokens").to_numpy()
                ends = np.cumsum(counts)
                crc = np.zeros(len(counts), np.int64)
                doc, seen, part = 0, 0, 0
                for ids in file_ids(stream):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    while doc < len(ends) and ends[doc] <= seen + len(ids):
                        crc[doc] = zlib.crc32(raw[4 * max(int(ends[doc] - counts[doc]) - seen, 0) : 4 * (int(ends[doc]) - seen)], part)
                        doc, part = doc + 1, 0
                    rest = max(int(ends[doc] - counts[doc]) - seen, 0) if doc < len(ends) else len(ids)
                    part = zlib.crc32(raw[4 * rest :], part)
                    seen += len(ids)
                if doc < len(ends) or seen != (ends[-1] if len(ends) else 0):
                    raise ValueError(f"{path}: ids and document table differ")
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks(), pa.array(base + ends - counts), pa.array(counts), pa.array(crc)],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    listing = manifest.select("part", "path", "n_ids").orderBy("part").collect()
    base = np.cumsum([0, *[r.n_ids for r in listing]]).tolist()
    rows = spark.createDataFrame([(r.path, b) for r, b in zip(listing, base)], "path string, base long")
    return rows.repartition(max(len(listing), 1)).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids and read the files back."""
    return read_token_files(docs.sparkSession, write_token_files(docs, tokenizer_path, end_id))


def vocabulary_size(tokenizer_path: str) -> int:
    with open(tokenizer_path, encoding="utf-8") as f:
        return len(json.load(f)["model"]["vocab"])
