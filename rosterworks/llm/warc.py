"""WARC archives: a writer of one gzip member per record and a sequential reader.

Records follow WARC/1.1. A page whose payload an earlier record holds becomes a revisit record
(identical-payload-digest) that refers to it and keeps only the HTTP header. The reader walks through
an archive member by member: it inflates incrementally, takes the WARC header up to the blank line,
then exactly Content-Length bytes of block, and checks the block and payload digests. It holds one
record at a time.

Archives lie in any store that pyarrow's file systems open (file, hdfs, s3, gs). What a failed task left
is never read: the table of archives, which Spark commits, names those of finished tasks alone.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shared_dir

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16
LEVEL = 6


def digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


class Members:
    """Bytes of one gzip member after another, inflated as they are asked for."""

    def __init__(self, stream) -> None:
        self.stream, self.raw, self.plain, self.inflate, self.done = stream, b"", bytearray(), None, False

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        if self.inflate is not None:
            while self._more():
                self.plain.clear()
            if not self.inflate.eof:
                raise ValueError("the archive ends inside a record")
            self.raw = self.inflate.unused_data + self.raw
        self.plain.clear()
        self.raw = self.raw or self.stream.read(CHUNK)
        self.inflate = zlib.decompressobj(31) if self.raw else None
        return bool(self.raw)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.raw or self.stream.read(CHUNK)
        if not self.inflate.unconsumed_tail:
            self.raw = b""
        if not data:
            return False
        self.plain += self.inflate.decompress(data, CHUNK * 4)
        return True

    def until(self, end: bytes) -> bytes:
        """What comes before ``end``, which is skipped."""
        seen = 0
        while (at := self.plain.find(end, seen)) < 0:
            seen = max(0, len(self.plain) - len(end))
            if not self._more():
                raise ValueError("a record header does not end")
        out = bytes(self.plain[:at])
        del self.plain[: at + len(end)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.plain) < n:
            if not self._more():
                raise ValueError("a block is shorter than its Content-Length")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def _number(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").rstrip(">")
    return int(text) if text else None


def read_records(stream) -> Iterator[dict]:
    """The records of an archive in order: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload (None in revisits). ValueError if a record is cut short or fails its digests."""
    members = Members(stream)
    while members.next_member():
        version, *lines = members.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record: {version[:20]!r}")
        head = _fields(lines)
        block = members.exactly(int(head["content-length"]))
        if "sha1:" + digest(block) != head["warc-block-digest"]:
            raise ValueError(f"block digest of {head['warc-record-id']} differs")
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = head["warc-type"] == "revisit"
        claimed = head["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and digest(payload) != claimed:
            raise ValueError(f"payload digest of {head['warc-record-id']} differs")
        yield {
            "page_id": _number(head["warc-record-id"]),
            "url": head.get("warc-target-uri"),
            "record_type": head["warc-type"],
            "refers_to": _number(head["warc-refers-to"]) if revisit else None,
            "payload_bytes": int(_fields(http.decode().split("\r\n"))["content-length"]) if revisit else len(payload),
            "payload_digest": claimed,
            "payload": None if revisit else payload,
        }


def _store(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (arrow_fs.LocalFileSystem(), folder)


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        made, out, size, count, path = [], None, 0, 0, ""
        try:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    if out is None:
                        path, size, count = f"{root}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(path, compression=None)
                    data = record(page_id, url, (html or "").encode(), refers_to)
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= archive_bytes:
                        out.close()
                        made.append((path, count, size))
                        out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            made.append((path, count, size))
        columns = zip(*made) if made else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = 0, archive_bytes: int = 1 << 28) -> DataFrame:
    """Write a record for every row of pages (page_id, url, html); returns path, records, bytes of each archive.

    Of records with equal payloads of at least ``revisit_bytes`` bytes, that with the smallest page_id
    is the response and the others revisit it; shorter payloads are all responses. Null html is an
    empty payload; a null page_id never is the smallest, and payloads that only such rows hold
    are responses. Rows that repeat page_id and payload of a response are responses themselves.
    More columns are ignored; an empty table makes no archive.
    """
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit(""))).alias("sum"), F.octet_length(F.coalesce("html", F.lit(""))).alias("size"))
    shared = rows.groupBy("sum").agg(F.min("page_id").alias("first"), F.count("*").alias("n"), F.first("size").alias("size"))
    shared = materialize(shared.where((F.col("n") > 1) & (F.col("size") >= revisit_bytes) & F.col("first").isNotNull()).select("sum", "first"), "payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    routed = rows.join(shared, "sum", "left").select("page_id", "url", "html", refers.alias("refers_to"))
    return materialize(routed.mapInArrow(_write(folder, archive_bytes), "path string, records long, bytes long"), "archives")


_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}


def _read(folder: str, names: list[str], batch_bytes: int = 1 << 24):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        schema = pa.schema([(n, _FIELDS[n]) for n in names])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None, buffer_size=CHUNK) as stream:
                    for found in read_records(stream):
                        rows.append({n: found[n] for n in names})
                        size += 300 + (len(found["payload"] or b"") if "payload" in names else 0)
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives in ``archives`` (path): one task reads one or a few of them, in order."""
    names = [n for n in _FIELDS if with_payload or n != "payload"]
    sql = {"page_id": "long", "refers_to": "long", "payload_bytes": "long", "payload": "binary"}
    tasks = max(1, archives.count())
    return archives.select("path").repartition(tasks).mapInArrow(_read(folder, names), ", ".join(f"{n} {sql.get(n, 'string')}" for n in names))


def round_trip(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Write pages to archives in the shared folder and read them again: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    archives = write_archives(pages, folder, revisit_bytes)
    return read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
