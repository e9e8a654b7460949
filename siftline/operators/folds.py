"""State as folds over append-only logs.

The original keeps running counters in upserted tables. Here the logs are
the truth and the tables are views: every fold is a partially aggregated
``groupBy`` (a hot feed or source collapses map-side), and the incremental
forms merge a prior snapshot with a delta by the same associative rules.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ts_text
from ..functions.numbers import avg_even, bar_fill, feed_status, rate_pct, signal_band
from .ordering import keep_first

# ------------------------------------------------------------------ feed health

def feed_health_delta(log: DataFrame, keys: Sequence[str] = ("feed_id",)) -> DataFrame:
    """Per-feed summary (or per ``keys``) of a slice of the fetch log
    (``feed_id, feed_url, ts, seq, ok, status_code, error, item_count``).

    ``consecutive_failures`` counts failures after the last success of the
    slice (all failures when it has none).

    One scan and one shuffle of the log, by (feed, hour): a feed that holds a
    third of the log is spread over its hours. Inside an hour a window marks the
    failures after the hour's last success; an hour becomes one row. A second
    fold, over the rows of a feed's hours, adds up the failures of the hours after
    that of its last success and that hour's own marked ones. Nothing is joined.
    """
    keys, ok = list(keys), F.col("ok")
    hour = [*keys, "_hour"]
    rows = log.select(*keys, F.date_trunc("hour", "ts").alias("_hour"), "ts", "seq", "ok", "feed_url",
                      "status_code", "error", F.when(ok, F.col("item_count")).otherwise(F.lit(0)).alias("items"))
    last_ok = F.max(F.when(ok, F.struct("ts", "seq"))).over(Window.partitionBy(*hour))
    marked = rows.withColumn("_after", ~ok & F.coalesce(F.struct("ts", "seq") > last_ok, F.lit(True)))
    per = marked.groupBy(*hour).agg(
        F.count(F.lit(1)).alias("n"), F.sum("items").alias("items"), F.count_if(~ok).alias("fails"),
        F.count_if("_after").alias("after"), F.min(F.struct("ts", "seq", "feed_url")).alias("first_key"),
        F.max(F.when(ok, F.col("ts"))).alias("ok_ts"),
        F.max(F.when(~ok, F.struct("ts", "seq", "status_code", "error"))).alias("last_failure_key"))
    trailing = _trailing("_hour", F.col("ok_ts").isNotNull(), keys, "fails", "after")
    out = per.withColumn("_trail", trailing).groupBy(*keys).agg(
        F.min("first_key").alias("first_key"), F.sum("n").cast("bigint").alias("total_fetches"),
        F.sum("items").cast("bigint").alias("total_items"), F.max("ok_ts").alias("last_success"),
        F.max("last_failure_key").alias("last_failure_key"), F.sum("fails").cast("bigint").alias("failures"),
        F.sum("_trail").cast("bigint").alias("consecutive_failures"))
    return _health(out.withColumn("has_success", F.col("last_success").isNotNull()), keys)


def _trailing(place: str, success: Column, keys: Sequence[str], fails: str, after: str) -> Column:
    """What a row adds to its key's failures after the last success: all of its
    failures behind the last place that saw one, and those behind it there."""
    last = F.max(F.when(success, F.col(place))).over(Window.partitionBy(*keys))
    return (F.when(last.isNull() | (F.col(place) > last), F.col(fails)).when(F.col(place) == last, F.col(after))
            .otherwise(F.lit(0)))


def _health(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.select(
        *keys, F.col("first_key.feed_url").alias("feed_url"), "first_key", "total_fetches", "total_items",
        "last_success", F.col("last_failure_key.ts").alias("last_failure"),
        F.col("last_failure_key.status_code").cast("bigint").alias("last_status_code"),
        F.col("last_failure_key.error").alias("last_error"), "last_failure_key", "has_success", "failures",
        "consecutive_failures")


def fold_feed_deltas(deltas: DataFrame) -> DataFrame:
    """Per-feed state from deltas of (feed, sweep), in any order of arrival:
    failures after the last sweep that saw a success, and that sweep's own
    failures after it."""
    trailing = _trailing("sweep_id", F.col("has_success"), ["feed_id"], "failures", "consecutive_failures")
    out = deltas.withColumn("_trail", trailing).groupBy("feed_id").agg(
        F.min("first_key").alias("first_key"), F.sum("total_fetches").cast("bigint").alias("total_fetches"),
        F.sum("total_items").cast("bigint").alias("total_items"), F.max("last_success").alias("last_success"),
        F.max("last_failure_key").alias("last_failure_key"), F.max("has_success").alias("has_success"),
        F.sum("failures").cast("bigint").alias("failures"), F.sum("_trail").cast("bigint").alias("consecutive_failures"))
    return _health(out, ["feed_id"])


def merge_feed_health(prior: DataFrame, delta: DataFrame) -> DataFrame:
    """Merge an older per-feed state with a newer delta (J5, T3): the fold of
    the two as places 0 and 1. Associative, so snapshots fold in any grouping
    that keeps time order."""
    return fold_feed_deltas(prior.withColumn("sweep_id", F.lit(0)).unionByName(delta.withColumn("sweep_id", F.lit(1))))


def feed_health_view(state: DataFrame, threshold: int = 3) -> DataFrame:
    """Report columns (R2/R3): status bands, average items per fetch."""
    c = F.col("consecutive_failures")
    return state.select(
        "feed_id", "feed_url", "total_fetches", "total_items",
        ts_text("last_success").alias("last_success"), ts_text("last_failure").alias("last_failure"),
        "last_status_code", "last_error", "consecutive_failures",
        avg_even("total_items", "total_fetches").alias("avg_items"),
        feed_status(c, threshold).alias("status"),
        F.when(c == 0, F.lit("OK")).otherwise(F.concat(F.lit("FAILING ("), c.cast("string"),
                                                       F.lit("x)"))).alias("health")
    ).orderBy(F.col("consecutive_failures").desc(), F.col("feed_id"))   # O1; ties by id


def sick_feeds(state: DataFrame, threshold: int = 3) -> DataFrame:
    return state.where(F.col("consecutive_failures") >= threshold)


# --------------------------------------------------------------- source quality

def source_quality_counts(scores: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """Scoring events per source (A4), or per ``keys``; re-surfaced items
    count again."""
    s = F.col("score")
    return scores.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_scored"),
        F.count_if(s >= 3).alias("scored_3plus"),
        F.count_if(s >= 4).alias("scored_4plus"))


def merge_source_quality(prior: DataFrame, delta: DataFrame) -> DataFrame:
    """Counter merge (J5): sums per source."""
    return sum_source_counts(prior.unionByName(delta))


def sum_source_counts(counts: DataFrame) -> DataFrame:
    """Counters of sweeps or slices, in any order."""
    return counts.groupBy("source").agg(
        F.sum("total_scored").cast("bigint").alias("total_scored"),
        F.sum("scored_3plus").cast("bigint").alias("scored_3plus"),
        F.sum("scored_4plus").cast("bigint").alias("scored_4plus"))


def source_quality_view(counts: DataFrame) -> DataFrame:
    """Rates as integer percent rounded half up at two digits (A5, P9),
    signal band and bar fill (P12)."""
    sig = rate_pct("scored_3plus", "total_scored")
    return counts.select(
        "source", "total_scored", "scored_3plus", "scored_4plus",
        sig.alias("signal_pct"), rate_pct("scored_4plus", "total_scored").alias("premium_pct"),
        signal_band(sig).alias("band"), bar_fill(sig).alias("bar_fill")
    ).orderBy(F.col("signal_pct").desc(), F.col("source"))              # O2; ties by name


# ------------------------------------------------------------ items and scores

def items_seen(recorded: DataFrame) -> DataFrame:
    """Insert-if-absent as a fold (K1, J4): the first recorded copy of each
    item, with ``first_seen`` = its sweep time. Rows are unique per
    (item_id, sweep_ts) after in-sweep dedup."""
    first = keep_first(recorded, ["item_id"], "sweep_ts")
    return first.select("item_id", "url", "title", F.substring("summary", 1, 500).alias("summary"),
                        "source", "domain", "published", F.col("sweep_ts").alias("first_seen"))


def current_scores(score_log: DataFrame, seen: DataFrame, how: str = "inner") -> DataFrame:
    """Last score per item (K3): latest sweep wins; ids never recorded are
    ignored (an update, not an upsert). ``how="left"`` keeps items that were
    never scored."""
    last = score_log.groupBy("item_id").agg(F.max("sweep_ts").alias("sweep_ts"))
    latest = score_log.join(last, ["item_id", "sweep_ts"], "left_semi")
    return seen.join(latest.select("item_id", F.col("score").alias("llm_score"), "tier",
                                   F.col("reason").alias("llm_reason")), "item_id", how)


def item_state(scored: DataFrame) -> DataFrame:
    """Items seen and their current score in one partial aggregation per
    item (K1 + K3): the first recorded copy (by sweep time) and the latest
    score. Rows are unique per (item, sweep) after in-sweep dedup."""
    first = F.min_by(F.struct("url", "title", "summary", "source", "domain", "published", "sweep_ts"), "sweep_ts")
    last = F.max_by(F.struct("score", "tier", "reason"), "sweep_ts")
    return scored.groupBy("item_id").agg(first.alias("_f"), last.alias("_l")).select(
        "item_id", "_f.url", "_f.title", F.substring("_f.summary", 1, 500).alias("summary"), "_f.source",
        "_f.domain", "_f.published", F.col("_f.sweep_ts").alias("first_seen"),
        F.col("_l.score").alias("llm_score"), F.col("_l.tier").alias("tier"), F.col("_l.reason").alias("llm_reason"))


def lifetime_stats(items: DataFrame, digests: DataFrame, as_of) -> DataFrame:
    """Lifetime panel (A7, F9): one row. ``items``: ``first_seen`` and current
    ``tier`` of each item (``item_state``). ``as_of`` is a Column (a literal or
    a scalar subquery); "last 24 h" is ``first_seen > as_of - 24 h``. The
    number of digests is a scalar subquery, and item counts are one
    aggregation over the items with their current score."""
    n_digests = digests.agg(F.count(F.lit(1))).scalar()
    tier = F.col("tier")
    return items.agg(
        F.count(F.lit(1)).alias("items_seen"),
        F.count_if(F.col("first_seen") > as_of - F.expr("INTERVAL 24 HOURS")).alias("last_24h"),
        F.count_if(tier == "RED").alias("red_caught"), F.count_if(tier == "ORANGE").alias("orange_caught"),
    ).select("items_seen", "last_24h", n_digests.alias("digests"), "red_caught", "orange_caught")
