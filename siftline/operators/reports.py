"""Budgets and report tables."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import TIERS
from ..functions.dates import digest_name, sweep_type_of, ts_text
from ..functions.numbers import noise_pct
from .ordering import positions


def surfaced(scored: DataFrame, min_score: int = 3, tiers: Sequence[str] = TIERS) -> DataFrame:
    """score >= min_score and the scorer's own tier is a known one (F6);
    the tier is not derived from the score."""
    return scored.where((F.col("score") >= min_score) & F.col("tier").isin(*tiers))


def _budget_of(budgets: Mapping[str, int]) -> Column:
    expr = F.lit(None).cast("bigint")
    for tier, n in budgets.items():
        expr = F.when(F.col("tier") == tier, F.lit(int(n))).otherwise(expr)
    return expr


def apply_budgets(surf: DataFrame, budgets: Mapping[str, int],
                  group: Sequence[str] = ("sweep_id",), order: str = "seq") -> DataFrame:
    """First N per tier in arrival order, not by score (W1). Tiers without
    a budget are unlimited; budgets for unknown tiers are ignored; 0 shows
    none. Adds ``rank`` (1-based).

    The filter on tiers with a budget carries the largest one as a literal, so
    Spark plans a WindowGroupLimit that keeps at most that many rows per
    (sweep, tier) on the map side, before the shuffle. Rows of other tiers are
    all shown; they are ranked by blocks (``ordering.positions``), so that an
    unlimited tier is not one task.
    """
    limited = [t for t in TIERS if t in budgets]
    w = Window.partitionBy(*group, "tier").orderBy(order)
    out = surf.where(F.col("tier").isin(limited)).withColumn("rank", F.row_number().over(w).cast("bigint"))
    top = max((int(budgets[t]) for t in limited), default=0)
    out = out.where((F.col("rank") <= F.lit(top)) & (F.col("rank") <= _budget_of(budgets)))
    if len(limited) == len(TIERS):
        return out
    rest = positions(surf.where(~F.col("tier").isin(limited)), [*group, "tier"], [order], "rank")
    return out.unionByName(rest.withColumn("rank", F.col("rank") + 1).select(*out.columns))


def tier_counts(surf: DataFrame, shown: DataFrame, group: Sequence[str] = ("sweep_id",)) -> DataFrame:
    """Per sweep: tier counts before budgets (the log's numbers) and the
    number shown after budgets (the digest text's) (A6, Q4)."""
    t = F.col("tier")
    pre = surf.groupBy(*group).agg(
        F.count_if(t == "RED").alias("red_count"), F.count_if(t == "ORANGE").alias("orange_count"),
        F.count_if(t == "YELLOW").alias("yellow_count"), F.count(F.lit(1)).alias("items_surfaced"))
    post = shown.groupBy(*group).agg(F.count(F.lit(1)).alias("items_shown"))
    return pre.join(post, list(group), "left").na.fill(0, ["items_shown"])


def stage_counts(scored: DataFrame, budgets: Mapping[str, int], min_score: int = 3,
                 group: Sequence[str] = ("sweep_id",), tiers: Sequence[str] = TIERS) -> DataFrame:
    """Per sweep, from the scored items alone, in one partial aggregation:
    items scored, surfaced (score >= min and a known tier), per-tier counts
    before budgets (the log's numbers, A6) and the number shown after
    budgets (the digest's, Q4). Shown = sum over tiers of min(count, budget)
    -- the first N of a tier are shown whatever N is, so no window is
    needed to count them."""
    t, sc = F.col("tier"), F.col("score")
    surf = (sc >= min_score) & t.isin(*tiers)
    per_tier = {k: F.count_if(surf & (t == k)) for k in tiers}
    agg = scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("items_scored"), F.count_if(surf).alias("items_surfaced"),
        *[per_tier[k].alias(f"_n_{k}") for k in tiers])
    shown = F.lit(0)
    for k in tiers:
        n = F.col(f"_n_{k}")
        shown = shown + (F.least(n, F.lit(int(budgets[k]))) if k in budgets else n)
    named = {"RED": "red_count", "ORANGE": "orange_count", "YELLOW": "yellow_count"}
    return agg.select(*group, "items_scored", "items_surfaced",
                      *[F.col(f"_n_{k}").cast("bigint").alias(named.get(k, f"{k.lower()}_count")) for k in tiers],
                      shown.cast("bigint").alias("items_shown"))


def tier_counts_from(scored: DataFrame, budgets: Mapping[str, int], min_score: int = 3,
                     group: Sequence[str] = ("sweep_id",)) -> DataFrame:
    """Tier counts of sweeps that surfaced anything."""
    return (stage_counts(scored, budgets, min_score, group).where(F.col("items_surfaced") > 0)
            .select(*group, "red_count", "orange_count", "yellow_count", "items_surfaced", "items_shown"))


def sweep_funnel(sweeps: DataFrame, fetched_counts: DataFrame, scored: DataFrame,
                 budgets: Mapping[str, int], min_score: int = 3) -> DataFrame:
    """Stage counts per sweep (A8): fetched (valid items, from the
    validation report), after dedup and window (= scored: every kept item
    is scored once), surfaced, per tier, shown. Two aggregations, no row
    shuffle beyond them; sweeps without rows get zeros."""
    st = stage_counts(scored, budgets, min_score)
    fetched = fetched_counts.groupBy("sweep_id").agg(F.sum("items_fetched").cast("bigint").alias("items_fetched"))
    cols = ["items_fetched", "items_after_dedup", "items_scored", "items_surfaced", "red_count",
            "orange_count", "yellow_count", "items_shown"]
    return (sweeps.join(fetched, "sweep_id", "left").join(st, "sweep_id", "left")
            .withColumn("items_after_dedup", F.col("items_scored")).na.fill(0, cols))


def digest_log(funnel: DataFrame, digest_dir: str = "digests", dry_run: bool = False) -> DataFrame:
    """One log row per sweep (K4); the id is the sweep id. The digest file
    name is the sweep time as ``YYYY-MM-DD_HHMM.md``."""
    path = F.lit("(dry-run)") if dry_run else F.concat(
        F.lit(digest_dir.rstrip("/") + "/"), digest_name(F.col("sweep_ts")))
    return funnel.select(
        "sweep_id", ts_text("sweep_ts").alias("sweep_ts"),
        F.coalesce(F.col("sweep_type"), sweep_type_of(F.col("sweep_ts"))).alias("sweep_type")
        if "sweep_type" in funnel.columns else sweep_type_of(F.col("sweep_ts")).alias("sweep_type"),
        "items_fetched", "items_after_dedup", "items_scored", "items_surfaced",
        "red_count", "orange_count", "yellow_count", path.alias("filepath"))


def digest_history(log: DataFrame, n: int = 10) -> DataFrame:
    """Last ``n`` digests, newest first, with the noise rate (W2, A10). The
    limit is the panel's feature (TakeOrderedAndProject: a top-n per
    partition, then a merge of n rows per partition)."""
    return (log.orderBy(F.col("sweep_id").desc()).limit(n)
            .select("sweep_id", "sweep_type", "items_fetched", "items_surfaced",
                    "red_count", "orange_count", "yellow_count",
                    noise_pct("items_surfaced", "items_fetched").alias("noise_pct")))
