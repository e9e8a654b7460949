"""Curation path: in-sweep dedup (D2), noise filters (F2, F3) and the
cross-run window (D5, J1), for one sweep or a replay of many."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keywords import blocked_site, noise_match, usable_patterns
from .ordering import keep_first


def dedup_batch(items: DataFrame, keys: Iterable[str] = ("sweep_id", "item_id")) -> DataFrame:
    """First copy of each item within a sweep by arrival ``seq``.
    ``seq`` carries the registry order of source types, so arXiv beats
    Hacker News beats RSS beats web search."""
    return keep_first(items, list(keys), "seq")


def noise_flags(items: DataFrame, skip_domains: Iterable[str], skip_patterns: Iterable[str],
                spark: SparkSession | None = None) -> DataFrame:
    """Add ``blocked_site`` (F2) and ``noise_match`` (F3) flags."""
    pats = usable_patterns(skip_patterns, spark or items.sparkSession)
    return (items.withColumn("blocked_site", blocked_site(F.col("url"), list(skip_domains)))
            .withColumn("noise_match", noise_match(F.col("title"), F.col("summary"), pats)))


def with_first_seen(items: DataFrame, key: str = "item_id", ts: str = "sweep_ts") -> DataFrame:
    """Add ``first_seen`` = earliest sweep time of the item over the replay.

    Partial ``min`` per item, joined back on the item id; AQE's skew join
    splits the partition of an item that holds a large share of rows.
    """
    firsts = items.groupBy(key).agg(F.min(ts).alias("first_seen"))
    return items.join(firsts, key, "left")


def window_keep(ts: str = "sweep_ts", first: str = "first_seen", hours: int = 48):
    """Kept unless first seen within the window before this sweep:
    suppressed iff ``first_seen > sweep_ts - window`` (strict, so a repeat
    exactly ``hours`` later passes). ``first_seen`` is never refreshed, so
    after the window the item passes on every later sweep."""
    window = F.expr(f"INTERVAL {int(hours)} HOURS")
    return (F.col(ts) == F.col(first)) | (F.col(first) <= F.col(ts) - window)


def filter_seen_replay(items: DataFrame, window_hours: int = 48) -> DataFrame:
    """D5 over many sweeps at once: equal to running the sweeps one after
    another against the seen-store."""
    return with_first_seen(items).where(window_keep(hours=window_hours)).drop("first_seen")


def filter_seen(items: DataFrame, seen: DataFrame, window_hours: int = 48) -> DataFrame:
    """D5 for one new sweep against the seen-store (``item_id``,
    ``first_seen``): left anti join on the item id, limited to store rows
    first seen inside the window. The store is partitioned by first-seen
    date, so the time predicate prunes it to the last few partitions."""
    window = F.expr(f"INTERVAL {int(window_hours)} HOURS")
    sweep_ts = items.agg(F.min("sweep_ts")).scalar()
    recent = seen.where(F.col("first_seen") > sweep_ts - window).select("item_id")
    return items.join(recent, "item_id", "left_anti")


def sweep_survivors(items: DataFrame, skip_domains: Iterable[str], skip_patterns: Iterable[str]) -> DataFrame:
    """Per (sweep, item): the row that survives the hard validity rules and
    in-sweep dedup (the first by ``seq``: dedup within a source type, then
    across source types, keeps the overall first), and whether it passes
    the noise filters. Output ``sweep_id, item_id, sweep_ts, seq, passes``.

    One partial aggregation: ``min(seq*2 + noise_bit)`` carries the
    survivor and its noise outcome in one long, so hot keys collapse
    map-side and only one row per (sweep, item) per task is shuffled.
    """
    from .validate import hard_failure
    pats = usable_patterns(skip_patterns, items.sparkSession)
    fails = blocked_site(F.col("url"), list(skip_domains)) | noise_match(F.col("title"), F.col("summary"), pats)
    code = F.shiftleft(F.col("seq"), 1) + F.when(fails, F.lit(1)).otherwise(F.lit(0))
    g = (items.where(hard_failure().isNull())
         .groupBy("sweep_id", "item_id").agg(F.min(code).alias("_c"), F.min("sweep_ts").alias("sweep_ts")))
    return g.select("sweep_id", "item_id", "sweep_ts", F.shiftright("_c", 1).alias("seq"),
                    (F.col("_c").bitwiseAND(F.lit(1)) == 0).alias("passes"))


def window_survivors(surv: DataFrame, window_hours: int = 48, prior_first: DataFrame | None = None) -> DataFrame:
    """The 48 h rule on survivors that pass the noise filters: first
    sighting per item (optionally also from a seen-store: ``item_id,
    first_seen``), then keep or suppress each (sweep, item).

    Runs on the per-(sweep, item) table, where an item has at most one row
    per sweep, so a window by item is bounded by the number of sweeps even
    for the hottest item, and the survivors are computed once.
    """
    ok = surv.where("passes").select("sweep_id", "item_id", "sweep_ts", "seq", F.lit(False).alias("_prior"))
    if prior_first is not None:   # only the store rows of items in these sweeps
        prior = prior_first.join(ok.select("item_id"), "item_id", "left_semi")
        ok = ok.unionByName(prior.select(
            F.lit(None).cast("bigint").alias("sweep_id"), "item_id", F.col("first_seen").alias("sweep_ts"),
            F.lit(None).cast("bigint").alias("seq"), F.lit(True).alias("_prior")))
    first = F.min("sweep_ts").over(Window.partitionBy("item_id"))
    return (ok.withColumn("first_seen", first).where(~F.col("_prior") & window_keep(hours=window_hours))
            .drop("_prior"))


def curate(items: DataFrame, skip_domains: Iterable[str], skip_patterns: Iterable[str],
           window_hours: int = 48, prior_first: DataFrame | None = None) -> DataFrame:
    """Raw ITEM rows -> the rows kept by validity rules, in-sweep dedup,
    noise filters and the cross-run window, for any number of sweeps.

    Aggregations run on (sweep, item) keys; the item rows themselves are
    shuffled once, for the final semi join on (sweep, item, seq), which a
    hot item cannot skew because ``seq`` is part of the key.
    """
    from .validate import hard_failure
    keep = window_survivors(sweep_survivors(items, skip_domains, skip_patterns), window_hours, prior_first)
    return items.where(hard_failure().isNull()).join(
        keep.select("sweep_id", "item_id", "seq"), ["sweep_id", "item_id", "seq"], "left_semi")
