"""WARC archives from and to a chunked record table.

The table has one row per chunk of a record's payload: record number, chunk number, the chunk, and the
bytes and SHA-1 of the payload up to the chunk's end, so its last row carries the whole payload's. Payloads
longer than a chunk pass through writer and reader chunk by chunk; neither holds a whole record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import blobs
from cohortflow.llm.scratch import new_folder, written

CHUNK_BYTES = 1 << 18
CHUNK_SCHEMA = (
    "record long, page_id long, url string, chunk int, last boolean, bytes long, digest string, payload binary"
)
MANIFEST_SCHEMA = "uri string, records long"
RECORD_SCHEMA = (
    "uri string, record int, page_id long, url string, record_type string, refers_to long, "
    "chunk int, last boolean, bytes long, digest string, payload binary"
)
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- the chunk table ------------------------------------------------------------------------------


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in ddl.split(","))])


def _collected(rows: Iterable[tuple[tuple, int]], schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows, cut by the given sizes."""
    held, size = [], 0
    for row, weight in rows:
        held.append(row)
        size += weight + 200
        if size >= limit:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def chunked(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of pages (page_id, url, html); a null or empty html has one empty chunk."""
    schema = _arrow(CHUNK_SCHEMA)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                names = ("record", "page_id", "url", "html")
                for number, page, url, html in zip(*(batch.column(c) for c in names)):
                    number, page, url = number.as_py(), page.as_py(), url.as_py()
                    body = memoryview(html.as_buffer()) if html.is_valid else memoryview(b"")
                    running, size = hashlib.sha1(), len(body)
                    for k, low in enumerate(range(0, max(size, 1), chunk_bytes)):
                        part = body[low : low + chunk_bytes]
                        running.update(part)
                        high = low + len(part)
                        yield (number, page, url, k, high == size, high, running.hexdigest(), bytes(part)), len(part)

        yield from _collected(rows(), schema)

    pages = pages.select(
        F.monotonically_increasing_id().alias("record"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.col("html").cast("string"), "UTF-8").alias("html"),
    )
    return pages.mapInArrow(cut, CHUNK_SCHEMA)


def revisits(chunks: DataFrame, least_bytes: int) -> DataFrame:
    """(record, refers_to) of the records whose payload another record, with a larger page_id, has too."""
    whole = chunks.where("last").select("record", "page_id", "bytes", "digest")
    whole = whole.where(F.col("page_id").isNotNull() & (F.col("bytes") >= least_bytes))
    targets = (
        whole.groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return whole.join(targets, ["digest", "bytes"]).where("page_id < refers_to").select("record", "refers_to")


# -- writing --------------------------------------------------------------------------------------


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _uri_text(url: str | None) -> str | None:
    """A url on one header line: percent signs, controls and blanks are escaped."""
    if url is None:
        return None
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _plain_uri(text: str | None) -> str | None:
    return None if text is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def _write_archives(folder: str, date: str, level: int):
    schema = _arrow(MANIFEST_SCHEMA)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = member = None
        records = 0

        def begin():
            return zlib.compressobj(level, zlib.DEFLATED, 31)

        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = blobs.Writer(folder, "archive")
                member, about = begin(), b"software: cohortflow\r\nformat: WARC File Format 1.1\r\n"
                kind = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None)), ("WARC-Date", date)]
                kind += [("Content-Type", "application/warc-fields"), ("Content-Length", len(about))]
                out.write(member.compress(_header(kind) + about + b"\r\n\r\n") + member.flush())
            names = ("page_id", "url", "chunk", "last", "total", "whole_digest", "refers_to")
            rows = zip(*(batch.column(c).to_pylist() for c in names), batch.column("payload"))
            for page_id, url, chunk, last, total, digest, refers_to, payload in rows:
                revisit = refers_to is not None
                if chunk == 0:
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {total}\r\n\r\n"
                    fields = [
                        ("WARC-Type", "revisit" if revisit else "response"),
                        ("WARC-Record-ID", _record_id(page_id)),
                        ("WARC-Date", date),
                        ("WARC-Target-URI", _uri_text(url)),
                        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
                        ("WARC-Refers-To", _record_id(refers_to) if revisit else None),
                        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                        ("X-Page-ID", page_id),
                        ("X-Payload-Length", total),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("Content-Length", len(http) + (0 if revisit else total)),
                    ]
                    member = begin()
                    out.write(member.compress(_header(fields) + http.encode()))
                    records += 1
                if not revisit:
                    out.write(member.compress(memoryview(payload.as_buffer())))
                if last or revisit:
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
        if out is not None:
            out.close()
            yield _batch([(out.uri, records)], schema)

    return write


def write_warc(
    pages: DataFrame,
    least_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
    chunk_bytes: int = CHUNK_BYTES,
    level: int = 5,
    folder: str | None = None,
) -> DataFrame:
    """One WARC record per row of `pages` (page_id, url, html) in gzip archives; returns their manifest.

    The payload is html in UTF-8; null counts as empty. Of records with equal payloads of at least
    `least_bytes`, the one with the largest page_id is a response and those with smaller ids revisit it; rows
    that repeat that id are responses too. A null page_id is always a response and never referred to. A null
    url has no target field. Other columns are ignored; no rows, no archives. Every record is a gzip member of
    its own. Manifest: uri, records.
    """
    spark = pages.sparkSession
    chunks = written(chunked(pages, chunk_bytes), "chunks")
    found = revisits(chunks, least_bytes)
    whole = chunks.where("last").select(
        "record", F.col("bytes").alias("total"), F.col("digest").alias("whole_digest")
    )
    facts = whole.join(found, "record", "left")
    rows = chunks.select("record", "page_id", "url", "chunk", "last", "payload").repartition("record")
    rows = rows.join(facts, "record").where("refers_to is null or chunk = 0")
    rows = rows.sortWithinPartitions("record", "chunk")
    write = _write_archives(folder or new_folder(spark, "warc"), date, level)
    return written(rows.mapInArrow(write, MANIFEST_SCHEMA), "manifest")


# -- reading --------------------------------------------------------------------------------------


class _Members:
    """The decompressed bytes of a file of gzip members, read front to back."""

    def __init__(self, source, size: int = 1 << 16):
        self.source, self.size = source, size
        self.raw, self.held, self.inflate = b"", b"", None

    def _more(self) -> bool:
        """Some more bytes into `held`; False at the end."""
        if not self.raw:
            self.raw = self.source.read(self.size)
        if not self.raw:
            return False
        self.inflate = self.inflate or zlib.decompressobj(31)
        self.held += self.inflate.decompress(self.raw, 4 * self.size)
        if self.inflate.eof:
            self.raw, self.inflate = self.inflate.unused_data, None
        else:
            self.raw = self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and including `mark`; None at the end of the file."""
        while mark not in self.held:
            if not self._more():
                if self.held.strip():
                    raise ValueError("an archive ends inside a header")
                return None
        found, self.held = self.held.split(mark, 1)
        return found + mark

    def take(self, most: int) -> bytes:
        """`most` bytes; fewer only where the file ends."""
        parts, size = [], 0
        while size < most and (self.held or self._more()):
            part = self.held[: most - size]
            self.held = self.held[len(part) :]
            parts.append(part)
            size += len(part)
        return b"".join(parts)


def _read_records(source, chunk_bytes: int):
    """(number, fields, chunk number, last, bytes so far, running digest, chunk) of responses and revisits."""
    members, number = _Members(source), 0
    while (head := members.until(b"\r\n\r\n")) is not None:
        lines = head.decode().strip().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"not a record of {VERSION}: {lines[0]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        left = int(fields["Content-Length"])
        if fields["WARC-Type"] == "revisit":
            members.take(left)
            digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            yield number, fields, 0, True, int(fields["X-Payload-Length"]), digest, b""
            number += 1
        elif fields["WARC-Type"] == "response":
            left -= len(members.until(b"\r\n\r\n"))
            running, chunk, done = hashlib.sha1(), 0, 0
            while True:
                part = members.take(min(chunk_bytes, left - done))
                done += len(part)
                running.update(part)
                last = done == left or not part
                yield number, fields, chunk, last, done, running.hexdigest(), part
                chunk += 1
                if last:
                    break
            written_digest = "sha1:" + base64.b32encode(running.digest()).decode()
            if done != left or fields["WARC-Payload-Digest"] != written_digest:
                raise ValueError(f"a payload does not match its digest: {fields['WARC-Record-ID']}")
            number += 1
        else:
            members.take(left)
        if members.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")


def read_warc(manifest: DataFrame, payloads: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the archives in a manifest, in no promised order of records.

    Columns: uri, record (number in its archive), page_id, url, record_type, refers_to, chunk, last, bytes and
    digest (of the payload so far; of the whole payload for a revisit, which has one empty chunk), payload.
    Without `payloads` only each record's last row is given, its payload null. A payload that does not match
    its digest is an error.
    """
    schema = _arrow(RECORD_SCHEMA)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for uri in batch.column("uri").to_pylist():
                    with blobs.stream(uri) as source:
                        for number, fields, chunk, last, size, digest, part in _read_records(source, chunk_bytes):
                            if not payloads and not last:
                                continue
                            page = fields.get("X-Page-ID")
                            target = fields.get("WARC-Refers-To")
                            yield (
                                uri, number, None if page is None else int(page),
                                _plain_uri(fields.get("WARC-Target-URI")), fields["WARC-Type"],
                                None if target is None else int(target.removeprefix("<urn:page:").rstrip(">")),
                                chunk, last, size, digest, part if payloads else None,
                            ), len(part) * payloads

        yield from _collected(rows(), schema)

    files = max(1, manifest.count())
    return manifest.select("uri").repartition(files).mapInArrow(read, RECORD_SCHEMA)


def page_records(manifest: DataFrame) -> DataFrame:
    """Per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return read_warc(manifest, payloads=False).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to",
    )
