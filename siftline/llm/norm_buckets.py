"""Buckets of vectors of like length, for operators that look for the largest
inner products.

Rows are dealt by length, longest first, and each task packs its rows into
buckets, one file each in the shared folder; a committed manifest names them.
Consecutive buckets form groups. Queries come in blocks. Every block first looks
through the group of the longest vectors, which gives each query a threshold:
its k-th best score so far. By Cauchy and Schwarz a query scores at most its own
length times a vector's, so of the other groups a block is sent only to those
whose longest vector reaches the threshold of one of its queries. A task opens
the files it needs: neither buckets nor queries are copied through a shuffle.

There are at most ``MOST`` blocks and ``MOST`` groups a table, so the units of
work are a bounded number of small rows, whatever the tables' sizes.
"""

from __future__ import annotations

import io
import uuid
from typing import Callable, Iterator, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as cm

MOST = 1024
SLACK = 1 + 1e-9         # bounds in doubles are widened by this
FOUND = "query_id long, vec_id long, score long"
LONGS = (-(1 << 63), (1 << 63) - 1)


def save(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def load(path: str) -> dict[str, np.ndarray]:
    store, name = cm.file_store(path)
    with store.open_input_file(name) as f, np.load(io.BytesIO(f.read())) as held:
        return {k: held[k] for k in held.files}


def write_file(folder: str, raw: bytes) -> str:
    """A new file in a shared folder; its name is new in each task attempt."""
    store, path = cm.file_store(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.npz"
    with store.open_output_stream(f"{path}/{name}") as f:
        f.write(raw)
    return f"{folder}/{name}"


class Block(Protocol):
    """Some queries with what they found so far."""

    def scan(self, bucket: dict[str, np.ndarray]) -> None: ...
    def need(self) -> float: ...                                   # the least length a vector must have
    def found(self) -> tuple[list[int], list[int], list[int]]: ...
    def arrays(self) -> dict[str, np.ndarray]: ...                 # with thresholds, for ``from_arrays``


class Best:
    """The k best (score, id) of each of n queries and the thresholds they set."""

    def __init__(self, n: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n)]
        self.theta = np.full(n, -np.inf)

    def offer(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates of query ``i``; ties go to the smaller id."""
        if len(ids) > self.k:
            order = np.array(sorted(range(len(ids)), key=lambda r: (-scores[r], ids[r]))[:self.k]) if scores.dtype == object \
                else np.lexsort((ids, -scores))[:self.k]
            ids, scores = ids[order], scores[order]
        self.rows[i] = sorted([*self.rows[i], *((-int(s), int(v)) for s, v in zip(scores, ids))])[:self.k]
        if len(self.rows[i]) == self.k:
            last = -self.rows[i][-1][0]
            at = float(last)
            self.theta[i] = max(self.theta[i], at if at <= last else np.nextafter(at, -np.inf))

    def found(self, query_ids) -> tuple[list[int], list[int], list[int]]:
        rows = [(int(q), v, -s) for q, own in zip(query_ids, self.rows) for s, v in own]
        return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def write_buckets(rows: DataFrame, length: Column, tie: str, pack: Callable[[pa.Table], tuple[dict, float]], name: str,
                  bucket_rows: int, buckets_a_task: int = 4) -> DataFrame:
    """The manifest (dim, path, n, longest) of the buckets of ``rows``, which
    have a column ``dim``; vectors of different dim share no bucket. Vectors of
    equal length are told apart by ``tie``, so any number of them spreads."""
    folder = cm.scratch_path(rows.sparkSession, f"llm-{name}")
    order = ["dim", F.desc("length"), tie]
    dealt = rows.withColumn("length", length)
    parts = max(1, -(-rows.count() // (bucket_rows * buckets_a_task)))
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            arrays, longest = pack(t)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in ((t.column("dim")[0].as_py(), pa.int32()), (write_file(folder, save(arrays)), pa.string()),
                                                     (t.num_rows, pa.int64()), (longest, pa.float64()))],
                names=["dim", "path", "n", "longest"])
        held, n, dim = [], 0, None
        for b in batches:
            dims, at = b.column("dim").to_numpy(), 0
            while at < b.num_rows:
                if n and (n == bucket_rows or dims[at] != dim):
                    yield put(held)
                    held, n = [], 0
                dim = dims[at]
                upto = min(at + bucket_rows - n, int(np.searchsorted(dims, dim, "right")))
                held.append(b.slice(at, upto - at))
                n, at = n + upto - at, upto
        if n:
            yield put(held)
    return cm.staged(dealt.mapInArrow(run, "dim int, path string, n long, longest double"), name)


def grouped(manifest: DataFrame, group_buckets: int = 8) -> DataFrame:
    """dim, g (from 0, longest first), longest, paths."""
    n = manifest.groupBy("dim").agg(F.greatest(F.lit(group_buckets), F.ceil(F.count(F.lit(1)) / MOST)).alias("own"))
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("longest"), "path")) - 1     # a row a bucket
    return (manifest.withColumn("place", place).join(n, "dim")
            .groupBy("dim", F.floor(F.col("place") / F.col("own")).cast("int").alias("g"))
            .agg(F.max("longest").alias("longest"),
                 F.transform(F.sort_array(F.collect_list(F.struct("place", "path"))), lambda x: x["path"]).alias("paths")))


def search(manifest: DataFrame, asked: DataFrame, make: Callable[[pd.DataFrame], Block],
           again: Callable[[dict], Block], k: int, name: str) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of each query. ``asked``:
    query rows with dim and block; ``make`` makes a block of its rows, and
    ``again`` one of its arrays."""
    spark = asked.sparkSession
    folder = cm.scratch_path(spark, f"llm-{name}-blocks")
    groups = cm.staged(grouped(manifest), f"{name}-groups")
    first = groups.where(F.col("g") == 0).select("dim", F.col("paths").alias("first"))

    def seed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = make(rows)
        for path in rows["first"].iloc[0]:
            block.scan(load(path))
        q, v, s = block.found()
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "need": [block.need()], "path": [write_file(folder, save(block.arrays()))],
                             "query_id": [q], "vec_id": [v], "score": [s]})
    n_blocks = max(1, asked.agg(F.max("block")).first()[0] or 0)
    seeds = cm.staged(
        asked.join(first, "dim").repartition(n_blocks + 1, "dim", "block").groupBy("dim", "block").applyInPandas(
            seed, "dim int, block int, need double, path string, query_id array<long>, vec_id array<long>, score array<long>"),
        f"{name}-seeds")
    lengths = groups.groupBy("dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("g", "longest"))),
                                                    lambda x: x["longest"]).alias("lengths"))
    reached = F.size(F.filter("lengths", lambda x: x >= F.col("need")))          # group 0 is done
    units = (seeds.join(lengths, "dim").where(reached > 1)
             .select("dim", F.explode(F.sequence(F.lit(1), reached - 1)).alias("g"), F.col("path").alias("block_path"))
             .join(groups.select("dim", "g", "paths"), ["dim", "g"]))
    units = cm.staged(units.select("block_path", "paths"), f"{name}-units")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for block_path, paths in zip(b["block_path"], b["paths"]):
                block = again(load(block_path))
                for path in paths:
                    block.scan(load(path))
                q, v, s = block.found()
                yield pd.DataFrame({"query_id": q, "vec_id": v, "score": s}).astype("int64")
    rest = units.repartition(min(max(1, units.count()), 20_000)).mapInPandas(look, FOUND)
    seeded = seeds.select(F.explode(F.arrays_zip("query_id", "vec_id", "score")).alias("x")).select("x.*")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (seeded.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
