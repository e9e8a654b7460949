"""Operator 1: token ids as directly addressable codes (DAC).

Each id is cut into chunks of a few bits. Level 1 holds the lowest chunk of
every token, level 2 the next chunk of those tokens that have one, and so on.
A continuation bitmap beside each level says which tokens go on, and a rank
directory (ones before each block of 512 bits) turns a token's place on one
level into its place on the next. Any token is read by a few bit reads, with
no block to decode.

One segment holds whole documents in ascending order::

    magic "DACTOK1\\n" | header length u32 | header JSON | sections
    level k: chunks (width w, packed little-endian), bitmap, rank directory u32
    documents: ids i64, null flags u8, token starts u64 (n_docs + 1)

The chunk widths of a segment are those of the least total size, found from the
ids' bit lengths. The header names each section's place, so a reader opens any
token with reads of a few bytes.

Layout on Spark: documents are range-partitioned by id (one shuffle of the
texts), each task writes one file of segments of about ``segment_tokens`` tokens,
and a manifest table names each segment's file and place in it. A file's name is
new in each task attempt, and only the manifest rows of committed tasks name
files, so an attempt that was lost leaves at most a file nobody reads. The rows
of ``MANIFEST_TASKS`` neighbouring tasks go into one manifest file, and the
segments are read back by tasks of about ``task_tokens`` tokens, so many small
partitions do not become as many small files.

Defined cases: a null text is empty, and an empty document is its end id
alone. Rows with a null id come first; rows of equal id are ordered by a hash
of the text. An empty table gives an empty manifest. Extra columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as cm

MAGIC = b"DACTOK1\n"
RANK_BITS = 512


# ------------------------------------------------------------------ the codes

def chunk_widths(ids: np.ndarray, levels: int = 2) -> list[int]:
    """Widths of the levels of least total size for these ids, at most
    ``levels`` of them: dynamic programming over bit lengths."""
    if not len(ids):
        return [1]
    lengths = np.searchsorted(1 << np.arange(1, 32), ids, side="right") + 1
    top = int(lengths.max())
    longer = len(ids) - np.cumsum(np.bincount(lengths, minlength=top + 1))[:top + 1]  # ids of over b bits
    longer[0] = len(ids)
    best = {0: (0.0, [])}
    for _ in range(levels):
        step = dict(best)
        for b, (cost, widths) in best.items():
            for e in range(b + 1, top + 1):
                bits = longer[b] * (e - b + (1.0 + 32 / RANK_BITS) * (e < top))
                if e not in step or cost + bits < step[e][0]:
                    step[e] = (cost + bits, [*widths, e - b])
        best = step
    return best[top][1]


def pack(values: np.ndarray, width: int) -> bytes:
    """``values`` in ``width`` bits each, lowest bit first. Eight values fill
    ``width`` whole bytes, so each of the eight is moved for all rows at once."""
    rows = -(-len(values) // 8)
    v = np.zeros(rows * 8, np.uint64 if width > 24 else np.uint32)
    v[:len(values)] = values
    v = v.reshape(rows, 8)
    out = np.zeros((rows, width + 8), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        x = v[:, j] << v.dtype.type(shift)
        for k in range(-(-(width + shift) // 8)):
            out[:, byte + k] |= (x >> v.dtype.type(8 * k)).astype(np.uint8)
    return np.ascontiguousarray(out[:, :width]).tobytes()[:-(-len(values) * width // 8)]


def unpack(raw: np.ndarray, count: int, width: int) -> np.ndarray:
    """``count`` values of ``width`` bits from the start of ``raw``."""
    if not count:
        return np.zeros(0, np.uint32)
    rows = -(-count // 8)
    kind = np.uint64 if width > 24 else np.uint32
    padded = np.zeros(rows * width + 8, np.uint8)
    padded[:min(len(raw), rows * width)] = raw[:rows * width]
    out = np.empty((rows, 8), np.uint32)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        x = np.zeros(rows, kind)
        for k in range(-(-(width + shift) // 8)):
            x |= padded[byte + k:byte + k + (rows - 1) * width + 1:width].astype(kind) << kind(8 * k)
        out[:, j] = (x >> kind(shift)) & kind((1 << width) - 1)
    return out.ravel()[:count]


def to_bytes(doc_ids: list, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment's content. ``starts`` has one more entry than there are
    documents."""
    widths = chunk_widths(ids)
    parts, places, levels, at = [], {}, [], 0

    def put(raw: bytes) -> int:
        nonlocal at
        parts.append(raw)
        at += len(raw)
        return at - len(raw)
    rest = ids.astype(np.uint32)
    for k, w in enumerate(widths):
        level = {"n": len(rest), "width": w, "chunks": put(pack(rest & np.uint32((1 << w) - 1), w))}
        if k + 1 < len(widths):
            rest = rest >> np.uint32(w)
            more = rest > 0
            padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, np.uint8)
            padded[:len(more)] = more
            ones = np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.uint32), dtype=np.uint32)
            level["bitmap"] = put(np.packbits(padded, bitorder="little").tobytes())
            level["ranks"] = put(np.concatenate([np.zeros(1, "<u4"), ones.astype("<u4")]).tobytes())
            rest = rest[more]
        levels.append(level)
    places["ids"] = put(np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes())
    places["nulls"] = put(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    places["starts"] = put(starts.astype("<u8").tobytes())
    head = json.dumps({"n_tokens": len(ids), "n_docs": len(doc_ids), "levels": levels, **places}).encode()
    return b"".join([MAGIC, np.array([len(head)], "<u4").tobytes(), head, *parts])


class DacFile:
    """Reads the segment at ``place`` through ``read_at(size, offset)`` of an
    open file."""

    def __init__(self, source, place: int = 0):
        self.source = source
        head = bytes(source.read_at(12, place))
        if head[:8] != MAGIC:
            raise ValueError("not a DAC token file")
        size = int(np.frombuffer(head[8:], "<u4")[0])
        self.head = json.loads(bytes(source.read_at(size, place + 12)))
        self.base = place + 12 + size
        self.n_tokens, self.n_docs = self.head["n_tokens"], self.head["n_docs"]

    def _at(self, place: int, offset: int, size: int) -> np.ndarray:
        return np.frombuffer(self.source.read_at(size, self.base + place + offset), np.uint8)

    def _rank(self, level: dict, i: int) -> int:
        """Tokens before place ``i`` of this level that go on to the next."""
        block = i // RANK_BITS
        ones = int(self._at(level["ranks"], 4 * block, 4).view("<u4")[0])
        if i % RANK_BITS:
            bits = np.unpackbits(self._at(level["bitmap"], block * RANK_BITS // 8, RANK_BITS // 8), bitorder="little")
            ones += int(bits[:i % RANK_BITS].sum())
        return ones

    def _values(self, level: dict, lo: int, hi: int) -> np.ndarray:
        w, first = level["width"], lo // 8 * 8                  # eight values start at a whole byte
        raw = self._at(level["chunks"], first * w // 8, -(-hi * w // 8) - first * w // 8)
        return unpack(raw, hi - first, w)[lo - first:]

    def token(self, i: int) -> int:
        """Token ``i`` of the segment alone: one chunk read a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for k, level in enumerate(self.head["levels"]):
            value |= int(self._values(level, i, i + 1)[0]) << shift
            shift += level["width"]
            if k + 1 == len(self.head["levels"]):
                break
            if not self._at(level["bitmap"], i // 8, 1)[0] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """Tokens ``lo`` to ``hi`` (without ``hi``)."""
        out, where, shift = np.zeros(hi - lo, np.uint32), np.arange(hi - lo), 0
        for k, level in enumerate(self.head["levels"]):
            if lo == hi:
                break
            out[where] |= self._values(level, lo, hi) << np.uint32(shift)
            shift += level["width"]
            if k + 1 == len(self.head["levels"]):
                break
            first = lo // 8
            bits = np.unpackbits(self._at(level["bitmap"], first, -(-hi // 8) - first), bitorder="little")
            more = np.flatnonzero(bits[lo - first * 8:hi - first * 8])
            where, lo = where[more], self._rank(level, lo)
            hi = lo + len(more)
        return out

    def documents(self) -> tuple[list, np.ndarray]:
        ids = self._at(self.head["ids"], 0, 8 * self.n_docs).view("<i8")
        nulls = self._at(self.head["nulls"], 0, self.n_docs)
        starts = self._at(self.head["starts"], 0, 8 * (self.n_docs + 1)).view("<u8").astype(np.int64)
        return [None if z else int(d) for d, z in zip(ids, nulls)], starts


# ------------------------------------------------------------------- on Spark

MANIFEST = "part int, seq int, path string, place long, n_docs long, n_tokens long, n_bytes long"
MANIFEST_TASKS = 64


def write_tokens(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 0,
                 segment_tokens: int = 3_000_000) -> DataFrame:
    """Encode ``text`` of all ``docs`` and write the files and the manifest
    under ``out_dir``, a folder all executors share; returns the manifest."""
    spark = docs.sparkSession
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
            .withColumn("h", F.xxhash64("text"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("h"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("h")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (store, folder) = cm.encoder(tokenizer_path), cm.file_store(f"{out_dir}/data")
        store.create_dir(folder, recursive=True)
        part, seq, place, name, out = TaskContext.get().partitionId(), 0, 0, f"{uuid.uuid4().hex}.dac", None
        held, total = [], 0  # (ids, sizes, doc ids) of the segment at hand

        def flush() -> pa.RecordBatch:
            nonlocal held, total, seq, place, out
            ids = np.concatenate([h[0] for h in held])
            starts = np.concatenate([[0], np.cumsum(np.concatenate([h[1] for h in held]))])
            raw = to_bytes([d for h in held for d in h[2]], starts, ids)
            out = out or store.open_output_stream(f"{folder}/{name}")
            out.write(raw)
            row = [part, seq, f"{out_dir}/data/{name}", place, len(starts) - 1, len(ids), len(raw)]
            held, total, seq, place = [], 0, seq + 1, place + len(raw)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4))],
                names=["part", "seq", "path", "place", "n_docs", "n_tokens", "n_bytes"])
        for b in cm.parts(batches, 6_000_000):
            ids, sizes, _ = enc.batch(cm.texts_of(b))
            whole = np.full(len(ids) + len(sizes), end_id, np.int32)  # each document's own end
            whole[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
            held.append((whole, sizes + 1, b.column("doc_id").to_pylist()))
            total += len(whole)
            if total >= segment_tokens:
                yield flush()
        if held:
            yield flush()
        if out is not None:
            out.close()
    # a task's rows go together, whatever file name its last attempt has
    (rows.mapInArrow(write, MANIFEST).withColumn("tasks", F.floor(F.col("part") / MANIFEST_TASKS))
     .repartition("tasks").drop("tasks").write.parquet(f"{out_dir}/manifest"))
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


def read_tokens(manifest: DataFrame, slice_tokens: int = 1_000_000, task_tokens: int = 2_000_000) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    The ids before a segment are those of lower tasks, a running sum with a row
    a task, and those of its task's earlier segments."""
    lower = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    tasks = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"))
    segments = (manifest.withColumn("own", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).join(tasks, "part")
                .select("path", "place", (F.col("before") + F.col("own")).alias("base")))
    size = manifest.agg(F.count(F.lit(1)).alias("segments"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")).first()
    n = max(1, min(size.segments, -(-size.tokens // task_tokens), 20_000))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, place, base in zip(*(b.column(c).to_pylist() for c in ("path", "place", "base"))):
                store, name = cm.file_store(path)
                with store.open_input_file(name) as source:
                    f = DacFile(source, place)
                    doc_ids, starts = f.documents()
                    crcs = np.zeros(f.n_docs, np.int64)
                    d = 0
                    while d < f.n_docs:
                        e = max(d + 1, int(np.searchsorted(starts, starts[d] + slice_tokens, "right")) - 1)
                        e = min(e, f.n_docs)
                        raw = memoryview(f.tokens(int(starts[d]), int(starts[e])).astype("<u4").tobytes())
                        off = (starts[d:e + 1] - starts[d]) * 4
                        for k in range(e - d):
                            crcs[d + k] = zlib.crc32(raw[off[k]:off[k + 1]])
                        d = e
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(starts[:-1] + base, pa.int64()),
                     pa.array(np.diff(starts), pa.int64()), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return segments.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write all documents' ids to files in the shared folder and read them
    back as one digest row a document."""
    spark: SparkSession = docs.sparkSession
    out = cm.scratch_path(spark, "llm-dac-tokens")
    return read_tokens(write_tokens(docs, out, tokenizer_path, end_id))
