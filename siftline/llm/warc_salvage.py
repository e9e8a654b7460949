"""Operator 10: WARC archives, written with revisit records and read back by a
reader that salvages damaged files.

A record is one gzip member (or plain). The reader checks each record: version
line, header, stated length, the two line breaks behind the block, the gzip
check sum and the block digest. Where a check fails, it searches for the next
place that starts a valid record (a gzip member whose content starts with a
version line, or a version line on its own), goes on there, and logs the bytes
between as a quarantined gap. A record whose block digest fails is quarantined
as a whole. So damage costs only the records it touches.

Pages of equal payload: the one with the smallest page_id is the response, the
others are revisits that refer to it. A revisit keeps the HTTP header of its
response, whose Content-Length is that of the full payload, and the payload
digest, so nothing has to be looked up when it is read.

Layout on Spark: digests are grouped on narrow rows (a hot payload collapses
map-side), only pages that have a copy join the result by page, and each task
writes files of about ``file_bytes`` under names new in each attempt, listed in
a manifest of committed tasks. The reader takes a file a row and holds a window
of the file and one record.

Defined cases: null html is an empty payload; a null url is left out; line
breaks in a url are percent-encoded. Rows without page_id never are the page
others refer to if one has an id; alone they are responses. Repeated rows of
the smallest id are all responses. An empty table gives no file. Extra columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as cm

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = ("path string, offset long, page_id long, url string, record_type string, refers_to long, "
                 "payload_bytes long, payload_digest string, payload binary")
GAP_SCHEMA = "path string, gap_start long, gap_end long, reason string"
_VERSION = re.compile(rb"WARC/[0-9]\.[0-9]\r\n")


def digest32(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


# -------------------------------------------------------------------- writing

def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, compress: bool = True) -> bytes:
    """One record; a revisit (``refers_to`` given) has the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}:{digest}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{digest32(block)}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    if not compress:
        return raw
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_pages(pages: DataFrame, out_dir: str, file_bytes: int = 64 << 20, compress: bool = True) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) under ``out_dir``; returns the
    manifest (path, n_records, n_bytes)."""
    spark = pages.sparkSession
    src = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url"), F.col("html"))
    digest = F.unhex(F.sha1(cm.utf8("html")))
    # the pages that are not the first of their payload: narrow rows only
    narrow = src.select("page_id", digest.alias("digest"))
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last"),
                                          F.count(F.lit(1)).alias("_n"), F.count("page_id").alias("_ids"))
             .where((F.col("_n") > 1) & F.col("refers_to").isNotNull()
                    & ((F.col("_last") > F.col("refers_to")) | (F.col("_ids") < F.col("_n"))))
             .select("digest", "refers_to"))
    copies = (narrow.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
              .select("page_id", "digest", "refers_to").distinct())
    rows = src.withColumn("digest", digest).alias("a").join(
        copies.alias("b"), F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & (F.col("a.digest") == F.col("b.digest")),
        "left").select("a.page_id", "a.url", "a.html", "b.refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = cm.file_store(f"{out_dir}/data")
        store.create_dir(folder, recursive=True)
        out, name, n, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_arrays([pa.array([f"{out_dir}/data/{name}"]), pa.array([n], pa.int64()),
                                               pa.array([size], pa.int64())], names=["path", "n_records", "n_bytes"])
        for b in cm.parts(batches, 4_000_000, "html"):
            for page_id, url, html, refers in zip(*(b.column(c).to_pylist()
                                                    for c in ("page_id", "url", "html", "refers_to"))):
                payload = (html or "").encode()
                raw = record_bytes(page_id, url, payload, digest32(payload), refers, compress)
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc{'.gz' * compress}", 0, 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= file_bytes:
                    yield close()
        if out is not None:
            yield close()
    schema = "path string, n_records long, n_bytes long"
    rows.mapInArrow(write, schema).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(schema).parquet(f"{out_dir}/manifest")


# -------------------------------------------------------------------- reading

class Damaged(Exception):
    """A check of the record at hand failed."""


class Window:
    """Random access to a file through a bounded read-ahead."""

    def __init__(self, source, size: int, ahead: int = 1 << 20):
        self.source, self.size, self.ahead, self.at, self.held = source, size, ahead, 0, b""

    def read(self, start: int, n: int) -> bytes:
        n = max(0, min(n, self.size - start))
        if not (self.at <= start and start + n <= self.at + len(self.held)):
            self.held, self.at = bytes(self.source.read_at(min(max(n, self.ahead), self.size - start), start)), start
        return self.held[start - self.at:start - self.at + n]

    def find(self, pattern: re.Pattern, start: int, overlap: int = 16) -> int:
        """Where ``pattern`` next matches from ``start`` on, or -1."""
        while start < self.size:
            part = self.read(start, self.ahead)
            if m := pattern.search(part):
                return start + m.start()
            if start + len(part) >= self.size:
                return -1
            start += len(part) - overlap
        return -1


def _record(take) -> tuple[dict, bytes]:
    """Headers and block of one record; ``take(n)`` gives the next n bytes
    (fewer at the end) and ``take(None)`` up to and with an empty line."""
    head = take(None)
    if not _VERSION.match(head):
        raise Damaged("no version line")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:-2]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no content length")
    block = take(int(length))
    if len(block) < int(length):
        raise Damaged("block cut short")
    if take(4) != b"\r\n\r\n":
        raise Damaged("length does not lead to the record's end")
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and digest != digest32(block):
        raise Damaged("block digest")
    return headers, block


def _member(w: Window, at: int, step: int = 1 << 16, end_limit: int | None = None) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``."""
    z, out, pos = zlib.decompressobj(31), [], at
    while not z.eof:
        part = w.read(pos, step)
        if not part:
            raise Damaged("member cut short")
        try:
            out.append(z.decompress(part))
        except zlib.error as e:
            raise Damaged(f"gzip: {str(e)[:60]}") from None
        pos += len(part)
        if len(out) == 1 and len(out[0]) >= 10 and not _VERSION.match(out[0]):
            raise Damaged("no version line")
    return b"".join(out), pos - len(z.unused_data)


def _parse_at(w: Window, at: int) -> tuple[dict, bytes, int]:
    """The record at ``at`` and the place behind it."""
    if w.read(at, 2) == b"\x1f\x8b":
        raw, end = _member(w, at)
        pos = 0

        def take(n):
            nonlocal pos
            stop = raw.find(b"\r\n\r\n", pos) + 4 if n is None else pos + n
            if n is None and stop < 4:
                raise Damaged("header without end")
            part, pos = raw[pos:stop], min(stop, len(raw))
            return part
        headers, block = _record(take)
        if pos != len(raw):
            raise Damaged("bytes behind the record in its member")
        return headers, block, end
    pos = at

    def take_plain(n):
        nonlocal pos
        if n is None:
            if not _VERSION.match(w.read(pos, 10)):
                raise Damaged("no version line")
            size = 4096
            while (stop := (head := w.read(pos, size)).find(b"\r\n\r\n")) < 0:
                if len(head) < size or size > 1 << 20:
                    raise Damaged("header without end")
                size *= 4
            part = head[:stop + 4]
        else:
            part = w.read(pos, n)
        pos += len(part)
        return part
    headers, block = _record(take_plain)
    return headers, block, pos


_START = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]\.[0-9]\r\n")


def salvage(source, size: int) -> Iterator[tuple]:
    """("record", offset, headers, block) and ("gap", start, end, reason) of a
    file, in order; records and gaps together cover it."""
    w, at, gap, reason = Window(source, size), 0, None, ""
    while at < size:
        try:
            headers, block, end = _parse_at(w, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = w.find(_START, at + 1)
            if at < 0:
                break
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        yield "record", at, headers, block
        at = end
    if gap is not None:
        yield "gap", gap, size, reason


def _whole(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None


def _row(path: str, offset: int, headers: dict, block: bytes, keep_payload: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type", "")
    if kind == "revisit":
        m = re.search(rb"(?im)^content-length:\s*([0-9]+)", http)
        n, digest = int(m[1]) if m else None, headers.get("warc-payload-digest", "").partition(":")[2]
    else:
        n, digest = len(payload), digest32(payload)
    return {"path": path, "offset": offset, "page_id": _whole(headers.get("x-page-id")),
            "url": headers.get("warc-target-uri"), "record_type": kind,
            "refers_to": _whole(headers.get("x-refers-to-page-id")), "payload_bytes": n, "payload_digest": digest,
            "payload": payload if keep_payload and kind == "response" else None}


def read_archives(files: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records of the files named in column ``path``. A payload digest is
    counted from the payload where there is one. Where ``files`` says in a column
    ``n_records`` how many a file was written with, one that gives another number
    is an error, which names the gaps: a damaged archive loses nothing unnoticed.
    Files without that column are salvaged, and ``quarantined`` has their gaps."""
    counted = "n_records" in files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("payload", pa.binary())])
        for b in batches:
            for path, n in zip(b.column("path").to_pylist(), b.column("n_records").to_pylist()):
                store, name = cm.file_store(path)
                with store.open_input_file(name) as f:
                    rows, held, read, gaps = [], 0, 0, []
                    for x in salvage(f, f.size()):
                        if x[0] == "record":
                            rows.append(_row(path, *x[1:], keep_payload))
                            held, read = held + (len(x[3]) if keep_payload else 500), read + 1
                        elif len(gaps) < 10:
                            gaps.append(x[1:])
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                if n is not None and read != n:
                    raise ValueError(f"{path}: {read} records of {n} could be read; first gaps (start, end, reason): {gaps}")
    named = files.select("path", F.col("n_records").cast("long") if counted else F.lit(None).cast("long").alias("n_records"))
    return _spread(named).mapInArrow(run, RECORD_SCHEMA)


def quarantined(files: DataFrame) -> DataFrame:
    """The byte gaps of the files that the reader could not use."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                store, name = cm.file_store(path)
                with store.open_input_file(name) as f:
                    gaps = [x[1:] for x in salvage(f, f.size()) if x[0] == "gap"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(gaps), pa.string()), pa.array([g[0] for g in gaps], pa.int64()),
                     pa.array([g[1] for g in gaps], pa.int64()), pa.array([g[2] for g in gaps], pa.string())],
                    names=["path", "gap_start", "gap_end", "reason"])
    return _spread(files.select("path")).mapInArrow(run, GAP_SCHEMA)


def _spread(files: DataFrame) -> DataFrame:
    """A file or so a task."""
    return files.repartition(max(1, min(files.count(), 20_000)))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back:
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    out = cm.scratch_path(pages.sparkSession, "llm-warc")
    return read_archives(write_pages(pages, out), keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
