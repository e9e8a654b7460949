"""Operator 3: shards of near equal size by longest-processing-time first.

Documents of equal text form a group that stays together. Groups go, from the
largest to the smallest, to the shard with the least load, through a heap of
(load, shard).

The order of a whole corpus does not fit one machine, but its size classes do.
Groups of one size are interchangeable for the heap, so it needs only how many
groups each size has. Sizes under 4,096 bytes are classes of their own; above
that, a class spans 1/2,048 of its size, so there are at most about 84,000
classes whatever the corpus (2**50 bytes a group), and that table is what the
driver receives. The heap's work is done for a class at a time: giving ``m``
groups of size ``s`` one by one to the least-loaded shard is the same as taking
the ``m`` smallest of all values ``load + i * s``.

Large classes are placed first, with their mean size. Then the shards' true
loads are summed on Spark, and the small classes, whose sizes are exact, are
placed on top of them, so what the means left out is levelled again.

A group's shard follows from its rank within its class; ranks and slots are
counted with salted windows, so no class, shard or group of copies is ever held
by one task. Everything is DataFrame operations but the class table's heap.

Defined cases: a null text has 0 bytes (size 8) and stays with empty texts.
Rows of equal id and text get a slot each. With fewer groups than shards some
shards stay empty. An empty table gives an empty result; null ids are kept;
extra columns are not read.
"""

from __future__ import annotations

import heapq
from itertools import accumulate
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as cm

EXACT = 4096          # sizes below are classes of their own
STEPS = 2048          # classes a doubling above that


def size_class(size: Column) -> Column:
    """The lower end of a size's class."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(size.cast("double"))) - 11, F.lit(0))).cast("bigint")
    return F.when(size < EXACT, size).otherwise(size - F.pmod(size, step)).cast("bigint")


def place(loads: list[float], size: float, groups: int) -> list[int]:
    """How many of ``groups`` groups of ``size`` each shard gets when each in
    turn goes to the least-loaded shard (ties: the lower shard); ``loads`` is
    brought up to date."""
    took = [0] * len(loads)
    if groups > 4 * len(loads):
        # the bulk: groups that start below the level to which all of them fill the least-loaded shards, less one group
        level, total = 0.0, size * groups
        for k, x in enumerate(sorted(loads), 1):
            total += x
            if k == len(loads) or total / k <= sorted(loads)[k]:
                level = total / k - size
                break
        for k, x in enumerate(loads):
            took[k] = max(0, int((level - x) // size))
            loads[k] = x + took[k] * size
    heap = [(x, k) for k, x in enumerate(loads)]
    heapq.heapify(heap)
    for _ in range(groups - sum(took)):
        x, k = heap[0]
        heapq.heapreplace(heap, (x + size, k))
        loads[k], took[k] = x + size, took[k] + 1
    return took


def schedule(classes: Sequence[tuple[int, int, float]], loads: list[float]) -> list[tuple[int, list[int]]]:
    """From (class, groups, mean size), largest class first: a row a class with
    the rank at which each shard's groups end."""
    return [(cls, list(accumulate(place(loads, mean, groups)))) for cls, groups, mean in sorted(classes, reverse=True)]


def shard_by_size(docs: DataFrame, n_shards: int = 24, salts: int = 256) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard."""
    spark = docs.sparkSession
    raw = cm.utf8("text")
    rows = cm.staged(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(raw) + 8).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.unhex(F.sha2(raw, 256)).alias("grp")), "lpt-rows")
    groups = rows.groupBy("grp").agg(F.sum("size").alias("load"))
    groups = groups.withColumn("cls", size_class(F.col("load")))
    ranked = cm.staged(cm.salted_rank(groups, ["cls"], F.xxhash64("grp"), salts, [F.col("grp")], "rank"), "lpt-groups")

    classes = [(r.cls, r.n, float(r.mean)) for r in ranked.groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.avg("load").alias("mean")).collect()]  # at most about 84,000 rows

    def assigned(part: list, loads: list[float], large: bool) -> DataFrame:
        plan = spark.createDataFrame(schedule(part, loads), "cls long, ends array<long>")
        # a row a class, of which there are at most about 84,000: some 17 MB with 24 shards
        at = ranked.where((F.col("cls") >= EXACT) if large else (F.col("cls") < EXACT)).join(F.broadcast(plan), "cls")
        return at.select("grp", "load", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"))
    loads = [0.0] * n_shards
    top = assigned([c for c in classes if c[0] >= EXACT], loads, True)
    loads = [0.0] * n_shards
    for r in top.groupBy("shard").agg(F.sum("load").alias("load")).collect():  # a row a shard
        loads[r.shard] = float(r["load"])
    low = assigned([c for c in classes if c[0] < EXACT], loads, False)
    placed = cm.staged(top.unionByName(low).select("grp", "shard"), "lpt-placed")
    out = rows.join(placed, "grp").drop("grp")
    out = cm.salted_rank(out, ["shard"], F.xxhash64("doc_id", "text_crc32"), salts, [F.col("doc_id")], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
