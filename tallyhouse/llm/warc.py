"""WARC archives: whole-file gzip streams, a normaliser to one member a record, and an offset index.

* `write_archives` writes each page as a WARC/1.1 record into files that are one gzip stream
  each, as many crawlers leave them. Pages of equal payload (by SHA-1, at least `least_bytes`
  long) share one response, that of the largest page id; the others are revisit records of it.
* `normalise` inflates each such stream once, from front to back, and writes every record as a
  gzip member of its own, with a sidecar index (.idx: offset, length, type, record id) beside the
  archive. Records of any size pass through in pieces.
* `read_records` opens the members that the index names, in any order and on any task.

Files have fresh names and count only when their row is in the manifest or index, so repeated
tasks and lost executors leave no trace in results.

Payloads are not shuffled as long as the groups of equal payloads are few enough to broadcast
(`BROADCAST_GROUPS`); beyond that pages join them by digest, with skew splitting.

Defined cases: null html is an empty payload; a null url has no target header; control characters
in a url are percent-encoded; rows that repeat the largest id of a group are responses all;
a group without any id has responses only; a null page id reads back as null.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import files
from tallyhouse.llm.textscan import chunks_of
from tallyhouse.session import fresh_dir
from tallyhouse.storage import settle

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 0
LEVEL = 3
#: Uncompressed bytes after which a task begins its next file.
FILE_BYTES = 64 << 20
PIECE = 1 << 20
BROADCAST_GROUPS = 200_000
END = b"\r\n\r\n"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None) -> bytes:
    """One WARC record; with `response` a revisit of that page, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    block = http if response is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
    if response is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(response)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def headers(head: bytes) -> dict[str, str]:
    """Lower-case names and values of a WARC or HTTP head, its first line as ''."""
    first, *rest = head.decode("utf-8", "replace").split("\r\n")
    return {"": first} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest if x)}


def _gzip(level: int):
    return zlib.compressobj(level, zlib.DEFLATED, 31)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, pack, path, held, count = None, None, "", 0, 0
        done: dict[str, list] = {"path": [], "n_records": []}

        def close() -> None:
            out.write(pack.flush())
            out.close()
            done["path"].append(path)
            done["n_records"].append(count)

        for batch in chunks_of(batches, "html", 8 * PIECE):
            for page_id, url, html, response in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    path, held, count = f"{folder}/mono-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, pack = files.open_output(path), _gzip(LEVEL)
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                data = record(page_id, url, payload, digest, response)
                out.write(pack.compress(data))
                held, count = held + len(data), count + 1
                if held >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict(done, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64())]))

    return run


def write_archives(pages: DataFrame, least_bytes: int = LEAST_BYTES, folder: str | None = None) -> DataFrame:
    """Write all pages as whole-file gzip archives; returns path, n_records."""
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= least_bytes, F.unhex(F.sha1(F.col("html").cast("binary")))))
    groups = rows.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    groups = settle(groups.filter("n > 1 and digest is not null and response is not null").select(F.col("digest").alias("of"), "response"))
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    known = rows.join(groups, F.col("digest") == F.col("of"), "left")
    revisits = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return settle(known.select("page_id", "url", "html", revisits.alias("response")).mapInArrow(_write(folder), "path string, n_records long"))


class Stream:
    """The bytes of a gzip file of one or many members, inflated in pieces."""

    def __init__(self, source, limit: int | None = None):
        self.source, self.left, self.inflate, self.buffer = source, limit, zlib.decompressobj(31), b""

    def fill(self) -> bool:
        """Take in another piece; False at the end."""
        while True:
            if self.inflate.eof:
                data, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            else:
                data = self.inflate.unconsumed_tail
            if not data:
                size = PIECE if self.left is None else min(PIECE, self.left)
                data = self.source.read(size)
                if self.left is not None:
                    self.left -= len(data)
            self.buffer += (got := self.inflate.decompress(data, PIECE))
            if got:
                return True
            if not data:
                return False

    def head(self) -> bytes | None:
        """Up to an empty line, which is passed over; None at the end."""
        while (at := self.buffer.find(END)) < 0:
            if not self.fill():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a record")
                return None
        found, self.buffer = self.buffer[:at], self.buffer[at + 4 :]
        return found

    def body(self, size: int) -> Iterator[bytes]:
        """The next bytes, in pieces."""
        while size:
            if not self.buffer and not self.fill():
                raise ValueError("the archive ends within a record")
            piece, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(piece)
            yield piece


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = f"{folder}/records-{uuid.uuid4().hex}"
                index: dict[str, list] = {"path": [], "offset": [], "length": [], "record_type": [], "record_id": []}
                with files.open_input(source) as raw, files.open_output(f"{name}.warc.gz") as out:
                    stream, at = Stream(raw), 0
                    while (head := stream.head()) is not None:
                        told, member, length = headers(head), _gzip(LEVEL), 0
                        length += out.write(member.compress(head + END))
                        for piece in stream.body(int(told["content-length"])):
                            length += out.write(member.compress(piece))
                        if b"".join(stream.body(4)) != END:
                            raise ValueError(f"{source}: a record does not end where its length says")
                        length += out.write(member.compress(END) + member.flush())
                        for key, value in zip(index, (f"{name}.warc.gz", at, length, told["warc-type"], told["warc-record-id"])):
                            index[key].append(value)
                        at += length
                with files.open_output(f"{name}.idx") as out:
                    for row in zip(*[index[k] for k in ("offset", "length", "record_type", "record_id")]):
                        out.write(json.dumps(row).encode() + b"\n")
                yield pa.RecordBatch.from_pydict(index)

    return run


def normalise(archives: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite whole-file streams (`path`) record by record; returns the offset index."""
    folder = folder or fresh_dir(archives.sparkSession, "warc-records")
    paths = archives.select("path")
    rows = paths.repartition(max(paths.count(), 1))
    return settle(rows.mapInArrow(_normalise(folder), "path string, offset long, length long, record_type string, record_id string"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
    name, source = None, None
    for batch in batches:
        rows = []
        for path, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
            if path != name:
                if source is not None:
                    source.close()
                name, source = path, files.open_input(path)
            source.seek(offset)
            stream = Stream(source, length)
            told = headers(stream.head())
            http = headers(stream.head())
            digest = told["warc-payload-digest"].removeprefix("sha1:")
            size = int(http["content-length"])
            if told["warc-type"] == "response":
                found = hashlib.sha1()
                for piece in stream.body(size):
                    found.update(piece)
                if base64.b32encode(found.digest()).decode() != digest:
                    raise ValueError(f"{path} at {offset}: the payload is damaged")
            rows.append((_id_of(told["warc-record-id"]), size, digest, told["warc-type"], _id_of(told.get("warc-refers-to")), told.get("warc-target-uri")))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    if source is not None:
        source.close()


def read_records(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record of an index."""
    rows = index.select("path", "offset", "length")
    # as many tasks as files: the cost follows the archives' bytes, not the index rows
    tasks = max(rows.select("path").distinct().count(), 1)
    rows = rows.repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")
    return rows.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archived(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write, normalise and read back all pages."""
    return read_records(normalise(write_archives(pages, least_bytes)))
