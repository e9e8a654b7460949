"""Order helpers shared by the "first wins" rules.

``flag_first`` and ``keep_first`` avoid a window over the dedup key: a
window sends every row of a key to one task, so a key holding a third of
the data becomes one task. Instead the first position per key is found
with a partially aggregated ``min`` (hot keys collapse map-side before the
shuffle) and joined back on ``key + position``; because the position is in
the join key, a hot key is spread over all partitions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flag_first(df: DataFrame, keys: Sequence[str], order: str, flag: str = "is_first",
               eligible: Column | None = None) -> DataFrame:
    """Add boolean ``flag``: true for the row with the smallest ``order``
    among rows of the same ``keys`` (``order`` unique within ``keys``).
    Rows outside ``eligible`` are never first and do not compete."""
    cand = df if eligible is None else df.where(eligible)
    firsts = (cand.groupBy(*keys).agg(F.min(order).alias(order))
              .withColumn(flag, F.lit(True)))
    out = df.join(firsts, [*keys, order], "left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Only the first row per ``keys`` by ``order`` (``order`` unique
    within ``keys``). Unlike ``dropDuplicates`` the kept row is defined."""
    firsts = df.groupBy(*keys).agg(F.min(order).alias(order))
    return df.join(firsts, [*keys, order], "left_semi")


def positions(df: DataFrame, group: Sequence[str], order: Sequence[str],
              pos: str = "rn", block_bits: int = 16) -> DataFrame:
    """0-based position of each row within ``group`` by one integral
    ``order`` column (unique within the group), without a one-partition
    window when a group is huge.

    Rows fall into blocks of the order value (``order >> block_bits``). A
    row's position is the number of rows of its group in lower blocks (a
    running sum over the small table of per-block counts) plus its rank
    inside the block (a window whose partition holds at most
    ``2**block_bits`` rows, whatever the size of the group). Everything
    depends on data values only, so any re-execution, with any partitioning,
    gives the same positions.
    """
    if len(order) != 1:
        raise ValueError("positions() orders by one integral column")
    o = order[0]
    blocked = df.withColumn("_blk", F.shiftright(F.col(o).cast("bigint"), block_bits))
    counts = blocked.groupBy(*group, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy(*group, "_blk").orderBy(o)) - 1
    return (blocked.withColumn("_local", local).join(offsets, [*group, "_blk"])
            .withColumn(pos, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_blk", "_local", "_off"))
