"""First sightings of items as bucketed generations.

The question is always the same: of the items at hand, which were seen before,
and when first? First sightings never expire, so history cannot be cut by date.
Instead it is kept in generations. Each run or micro-batch adds one: its new
(item_id, first_seen) pairs, dealt by a hash of the id into buckets of about
``bucket_rows``, every bucket a folder of its own. Beside each bucket lies its
filter: its least and largest first_seen and a Bloom filter of its ids. The 48 h
rule only asks for recent sightings, so it passes over buckets of older ones.

A look-up reads the filters of the buckets that its items fall into, then only
the buckets whose filter may hold one of them. So what it reads depends on the
items at hand, not on history: a new item costs one filter a generation, a known
one also its bucket. ``FAN`` generations of like size are merged into one, with
more buckets, so there are few generations however many runs there were.

Pairs carry a tag, the run or epoch that added them. Tags that a caller no longer
counts are skipped by look-ups and dropped by merges.

The list of generations belongs to the caller, who keeps it where its own commit
makes it valid: a generation that nobody lists does not exist.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from typing import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 4                 # generations of like size that are merged
BITS = 10               # of a filter for each id
HASHES = 5              # about one id in a hundred passes by mistake
MOST_PATHS = 10_000     # beyond, generations are read whole and filtered by bucket
PAIRS = "item_id string, first_seen timestamp, tag string"
FILTERS = "gen string, bucket int, n long, least timestamp, most timestamp, bits long, words array<long>"


def _places(bits: Column) -> list[Column]:
    """The places of an id in a filter of ``bits`` bits."""
    h = F.xxhash64("item_id")
    a, b = F.shiftrightunsigned(h, 33), h.bitwiseAND(F.lit((1 << 31) - 1)).bitwiseOR(F.lit(1))
    return [(a + F.lit(k) * b) % bits for k in range(HASHES)]


def _bucket(buckets) -> Column:
    return F.pmod(F.hash("item_id"), buckets)


@dataclass(frozen=True)
class FirstSeen:
    """Generations under ``root``, a folder every executor can reach."""
    root: str
    bucket_rows: int = 1 << 16

    def _folders(self, spark: SparkSession, kind: str, pairs: Sequence[tuple[str, int]]) -> list[str]:
        """The folders of (generation, bucket) that exist."""
        own: dict[str, list[int]] = {}
        for gen, bucket in pairs:
            own.setdefault(gen, []).append(bucket)
        out = []
        for gen, buckets in own.items():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                f"{self.root}/{kind}/gen={gen}/bucket={{{','.join(map(str, buckets))}}}")
            fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            out += [f.getPath().toString() for f in fs.globStatus(p) or []]
        return out

    def _read(self, spark: SparkSession, kind: str, schema: str, pairs: Sequence[tuple[str, int]]) -> DataFrame:
        full = schema if "bucket int" in schema else f"gen string, bucket int, {schema}"
        if len(pairs) <= MOST_PATHS:
            folders = self._folders(spark, kind, pairs)
            if not folders:
                return spark.createDataFrame([], full)
            return spark.read.schema(full).option("basePath", f"{self.root}/{kind}").parquet(*folders)
        gens = sorted({g for g, _ in pairs})
        held = spark.read.schema(full).option("basePath", f"{self.root}/{kind}").parquet(*[f"{self.root}/{kind}/gen={g}" for g in gens])
        wanted = spark.createDataFrame(pd.DataFrame(pairs, columns=["gen", "bucket"]).astype({"bucket": "int32"}))
        return held.join(wanted, ["gen", "bucket"], "left_semi")

    # ------------------------------------------------------------------ look-up

    def lookup(self, spark: SparkSession, gens: Sequence[dict], items: DataFrame, skip: Iterable[str] = (),
               since: Column | None = None) -> DataFrame:
        """item_id, first_seen, tag of all pairs of the items at hand that are
        not tagged with one of ``skip``; an item may have several. ``items`` has a
        column item_id. With ``since`` only sightings after it are wanted, so
        buckets whose largest first_seen is not later are left alone."""
        if not gens:
            return spark.createDataFrame([], PAIRS)
        of = F.explode(F.array(*[F.struct(F.lit(g["id"]).alias("gen"), F.lit(int(g["buckets"])).alias("n")) for g in gens]))
        asked = (items.select("item_id").distinct().withColumn("g", of)
                 .select("item_id", F.col("g.gen").alias("gen"), _bucket(F.col("g.n")).alias("bucket")))
        touched = [(r.gen, r.bucket) for r in asked.select("gen", "bucket").distinct().collect()]       # at most all buckets
        filters = self._read(spark, "filters", FILTERS, touched)
        word = [F.try_element_at("words", (F.shiftright(p, 6) + 1).cast("int")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (p % 64).cast("int"))) != 0 for p in _places(F.col("bits"))]
        holds = word[0]
        for w in word[1:]:
            holds = holds & w
        if since is not None:
            filters = filters.where(F.col("most") > since)
        hit = asked.join(filters.select("gen", "bucket", "bits", "words"), ["gen", "bucket"]).where(holds)
        pairs = [(r.gen, r.bucket) for r in hit.select("gen", "bucket").distinct().collect()]
        rows = self._read(spark, "pairs", PAIRS, pairs).select("item_id", "first_seen", "tag")
        if since is not None:
            rows = rows.where(F.col("first_seen") > since)
        skip = list(skip)
        if skip:
            rows = rows.where(~F.col("tag").isin(skip))
        return rows.join(items.select("item_id"), "item_id", "left_semi")

    # ------------------------------------------------------------------- adding

    def add(self, spark: SparkSession, gens: Sequence[dict], pairs: DataFrame, dead: Iterable[str] = ()) -> list[dict]:
        """The generations with one more, that of ``pairs`` (item_id,
        first_seen, tag), and merged where ``FAN`` have like size. Pairs tagged
        with one of ``dead`` are left behind by merges."""
        out = [*gens]
        new = self._write(spark, pairs)
        if new is not None:
            out.append(new)
        while len(out) >= FAN and len({self._level(g) for g in out[-FAN:]}) == 1:
            old = out[-FAN:]
            rows = self._read(spark, "pairs", PAIRS, [(g["id"], b) for g in old for b in range(g["buckets"])])
            rows = rows.select("item_id", "first_seen", "tag")
            dead = list(dead)
            merged = self._write(spark, rows.where(~F.col("tag").isin(dead)) if dead else rows)
            out = [*out[:-FAN], *([merged] if merged is not None else [])]
        return out

    def _level(self, gen: dict) -> int:
        return int(math.log(max(1, gen["rows"] / self.bucket_rows), FAN))

    def _write(self, spark: SparkSession, pairs: DataFrame) -> dict | None:
        """Write a generation: first its buckets, then from these its filters."""
        gen = uuid.uuid4().hex[:16]
        gen = f"g{gen}"
        rows = pairs.select("item_id", "first_seen", "tag")
        # a generation is written as it comes and dealt from there, so that its size is known and nothing is computed twice
        rows.write.parquet(f"{self.root}/new/gen={gen}")
        rows = spark.read.schema(PAIRS).parquet(f"{self.root}/new/gen={gen}")
        n = rows.count()
        if n:
            buckets = -(-n // self.bucket_rows)
            (rows.withColumn("gen", F.lit(gen)).withColumn("bucket", _bucket(F.lit(buckets)))
             .repartition("bucket").sortWithinPartitions("bucket", "item_id")
             .write.mode("append").partitionBy("gen", "bucket").parquet(f"{self.root}/pairs"))
            self._write_filters(spark, gen, buckets)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/new/gen={gen}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return {"id": gen, "buckets": buckets, "rows": n} if n else None

    def _write_filters(self, spark: SparkSession, gen: str, buckets: int) -> None:
        held = self._read(spark, "pairs", PAIRS, [(gen, b) for b in range(buckets)])
        size = held.groupBy("gen", "bucket").agg(
            F.count(F.lit(1)).alias("n"), F.min("first_seen").alias("least"), F.max("first_seen").alias("most"))
        size = size.withColumn("bits", (F.ceil(F.col("n") * BITS / 64) * 64).cast("bigint"))
        placed = held.join(size, ["gen", "bucket"])
        placed = placed.select("gen", "bucket", "n", "least", "most", "bits", F.array(*_places(F.col("bits"))).alias("at"))

        def words(rows: pd.DataFrame) -> pd.DataFrame:
            bits = np.zeros(int(rows["bits"].iloc[0]), bool)           # a bucket's ids: a bounded number
            bits[np.concatenate(rows["at"].to_numpy())] = True
            packed = np.packbits(bits, bitorder="little").view("<i8")
            return rows.iloc[:1][["gen", "bucket", "n", "least", "most", "bits"]].assign(words=[packed])
        (placed.groupBy("gen", "bucket").applyInPandas(words, FILTERS)
         .write.mode("append").partitionBy("gen", "bucket").parquet(f"{self.root}/filters"))
