"""Digest rendering as tables (R1, F8, O3, K5) and the as-of state it
reads (feed health and source quality at the time of each sweep).

A replay renders every sweep's digest at once, so the state a digest shows
must be the state as of its sweep. Each log is first reduced to one delta
row per (key, sweep) (partial aggregation), folded with running windows
over those small rows, and each state is carried forward to the following
sweeps by exploding its validity range; no join pairs every key with
every sweep. Lines are rows ``(sweep_id, k1, k2, k3, k4, line)``; a sweep's
text is its lines sorted by key, bounded by budgets, feeds and sources.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import QUALITY_FOOTER_MIN_SCORED, SICK_FEED_THRESHOLD, TIERS
from ..functions.dates import sweep_label
from ..functions.numbers import rate_pct

# Fixed display values that must equal the original's digest text.
TIER_LABELS = {"RED": "RED (act on this)", "ORANGE": "ORANGE (shapes your model)",
               "YELLOW": "YELLOW (context)"}
CLEAN_DAY = "*Nothing above noise threshold. Clean day.*"
HEALTH_HEADER = "## FEED HEALTH"
QUALITY_HEADER = "## EXTRACTION QUALITY"
RATES_HEADER = "### Source Signal Rates"


def carry_forward(states: DataFrame, key: Sequence[str], sweeps: DataFrame) -> DataFrame:
    """Rows valid from their ``sweep_id`` until the key's next row, spread
    over the sweeps in between (sweep ids increase with time). States that
    a caller does not need (e.g. healthy feeds) should be filtered out
    before this, so the output is only the rows asked for."""
    last = sweeps.agg(F.max("sweep_id")).scalar()
    w = Window.partitionBy(*key).orderBy("sweep_id")
    nxt = F.coalesce(F.lead("sweep_id").over(w), last + F.lit(1))
    spread = (states.withColumn("_next", nxt)
              .withColumn("_s", F.explode(F.sequence(F.col("sweep_id"), F.col("_next") - F.lit(1))))
              .drop("sweep_id", "_next").withColumnRenamed("_s", "sweep_id"))
    return spread.join(sweeps.select("sweep_id"), "sweep_id", "left_semi")


def feed_health_asof(deltas: DataFrame, sweeps: DataFrame, threshold: int = SICK_FEED_THRESHOLD,
                     prior: DataFrame | None = None) -> DataFrame:
    """Sick feeds as of each sweep: ``(sweep_id, feed_id,
    consecutive_failures, last_error, last_status_code)``. ``deltas``: one row
    a feed and sweep (``folds.feed_health_delta`` by both). ``prior`` (a folded
    state as of before these sweeps) lets a run read only the new deltas: it
    enters as one delta row per feed."""
    d = deltas.select(
        "feed_id", "sweep_id", "failures", F.col("has_success").alias("_ok"),
        F.when(F.col("has_success"), F.col("consecutive_failures")).otherwise(F.lit(0)).alias("trailing"),
        F.col("last_failure_key").cast("struct<ts:timestamp,seq:bigint,status_code:int,error:string>").alias("_lf"))
    if prior is not None:
        # only the trailing failures of the prior state matter from here on
        start = sweeps.agg(F.min("sweep_id")).scalar() - F.lit(1)
        c = F.col("consecutive_failures")
        d = d.unionByName(prior.select(
            "feed_id", start.alias("sweep_id"), c.alias("failures"), F.col("has_success").alias("_ok"),
            c.alias("trailing"),
            F.col("last_failure_key").cast("struct<ts:timestamp,seq:bigint,status_code:int,error:string>")
            .alias("_lf")))
    run = Window.partitionBy("feed_id").orderBy("sweep_id").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_cum", F.sum("failures").over(run))
    base = F.last(F.when(F.col("_ok"), F.col("_cum") - F.col("trailing")), True).over(run)
    state = d.select(
        "feed_id", "sweep_id",
        (F.col("_cum") - F.coalesce(base, F.lit(0))).cast("bigint").alias("consecutive_failures"),
        F.last("_lf", True).over(run).alias("_lf"))
    # flat columns before the explode below (nested-field pruning through a
    # generator trips the optimizer); a state holds until the feed's next fetch
    # sweep, sick or not
    last = sweeps.agg(F.max("sweep_id")).scalar()
    until = F.coalesce(F.lead("sweep_id").over(Window.partitionBy("feed_id").orderBy("sweep_id")), last + F.lit(1))
    state = state.select("feed_id", "sweep_id", "consecutive_failures",
                         F.col("_lf.error").alias("last_error"),
                         F.col("_lf.status_code").cast("bigint").alias("last_status_code"), until.alias("_next"))
    spread = (state.where(F.col("consecutive_failures") >= threshold)
              .withColumn("_s", F.explode(F.sequence(F.col("sweep_id"), F.col("_next") - F.lit(1))))
              .drop("sweep_id", "_next").withColumnRenamed("_s", "sweep_id")
              .join(sweeps.select("sweep_id"), "sweep_id", "left_semi"))
    return spread.select("sweep_id", "feed_id", "consecutive_failures", "last_error", "last_status_code")


def source_quality_asof(deltas: DataFrame, sweeps: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Cumulative scoring counts per source as of each sweep. ``deltas``: one
    row a source and sweep (``folds.source_quality_counts`` by both); ``prior``
    (source, total_scored, scored_3plus, scored_4plus) is the state before
    these sweeps."""
    per = deltas.select("source", "sweep_id", F.col("total_scored").alias("n"), F.col("scored_3plus").alias("n3"),
                        F.col("scored_4plus").alias("n4"))
    if prior is not None:
        start = sweeps.agg(F.min("sweep_id")).scalar() - F.lit(1)
        per = per.unionByName(prior.select("source", start.alias("sweep_id"), F.col("total_scored").alias("n"),
                                           F.col("scored_3plus").alias("n3"), F.col("scored_4plus").alias("n4")))
    run = Window.partitionBy("source").orderBy("sweep_id").rowsBetween(Window.unboundedPreceding, 0)
    state = per.select("source", "sweep_id",
                       F.sum("n").over(run).cast("bigint").alias("total_scored"),
                       F.sum("n3").over(run).cast("bigint").alias("scored_3plus"),
                       F.sum("n4").over(run).cast("bigint").alias("scored_4plus"))
    return carry_forward(state, ["source"], sweeps)


def _line(sweep, k1, k2, k3, k4, text: Column) -> Column:
    return F.struct(sweep.alias("sweep_id"), F.lit(k1).cast("bigint").alias("k1") if not isinstance(k1, Column)
                    else k1.cast("bigint").alias("k1"),
                    (k2 if isinstance(k2, Column) else F.lit(k2)).cast("bigint").alias("k2"),
                    (k3 if isinstance(k3, Column) else F.lit(k3)).cast("bigint").alias("k3"),
                    (k4 if isinstance(k4, Column) else F.lit(k4)).cast("bigint").alias("k4"),
                    text.alias("line"))


def digest_lines(sweeps: DataFrame, sick: DataFrame, warnings: DataFrame, shown: DataFrame,
                 quality: DataFrame, orient_prompt: str = "",
                 tier_labels: Mapping[str, str] = TIER_LABELS, tiers: Sequence[str] = TIERS) -> DataFrame:
    """All digest lines of all sweeps.

    ``sweeps``: sweep_id, sweep_ts, sweep_type; ``sick``: from
    ``feed_health_asof``; ``warnings``: sweep_id, ord, warning; ``shown``:
    budgeted items (sweep_id, tier, rank, title, url, source, domain,
    reason); ``quality``: from ``source_quality_asof``.

    Each input is read once and emits all of its lines with one
    ``explode``: a section's header and closing blank line come from the
    section's first row (rank 1), not from a second pass over the input.
    """
    sid = F.col("sweep_id")
    st = F.col("sweep_type")
    nothing = F.lit(None).cast("string")

    def lines(df: DataFrame, *parts: Column) -> DataFrame:
        return df.select(F.explode(F.array(*parts)).alias("_l")).select("_l.*").where(F.col("line").isNotNull())

    # sweep lines: title, clean-day note, totals (post-budget counts)
    counts = shown.groupBy("sweep_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("tier") == "RED").alias("r"),
        F.count_if(F.col("tier") == "ORANGE").alias("o"), F.count_if(F.col("tier") == "YELLOW").alias("y"))
    tot = sweeps.join(counts, "sweep_id", "left").na.fill(0, ["n", "r", "o", "y"])
    clean = F.col("n") == 0
    sweep_parts = [
        _line(sid, 0, 0, 0, 0, F.concat(F.lit("# Digest | "), F.date_format("sweep_ts", "yyyy-MM-dd"),
                                        F.lit(" "), sweep_label(st), F.lit(" ("), F.date_format("sweep_ts", "HH:mm"), F.lit(")"))),
        _line(sid, 0, 0, 0, 1, F.lit("")),
        _line(sid, 3, 0, 0, 0, F.when(clean, F.lit(CLEAN_DAY))),
        _line(sid, 3, 0, 0, 1, F.when(clean, F.lit(""))),
        _line(sid, 4, 0, 0, 0, F.lit("---")),
        _line(sid, 4, 0, 0, 1, F.concat(
            F.lit("*"), F.col("n").cast("string"), F.lit(" items surfaced from "), st,
            F.lit(" sweep. RED: "), F.col("r").cast("string"), F.lit(", ORANGE: "),
            F.col("o").cast("string"), F.lit(", YELLOW: "), F.col("y").cast("string"), F.lit("*"))),
        _line(sid, 4, 0, 0, 2, F.lit(""))]
    if orient_prompt:
        sweep_parts.append(_line(sid, 6, 0, 0, 0, F.lit(orient_prompt)))
    out = lines(tot, *sweep_parts)

    # feed health section
    r = F.dense_rank().over(Window.partitionBy("sweep_id").orderBy("feed_id"))
    first = F.col("_r") == 1
    out = out.unionByName(lines(
        sick.withColumn("_r", r),
        _line(sid, 1, 0, 0, 0, F.when(first, F.lit(HEALTH_HEADER))),
        _line(sid, 1, 2, 0, 0, F.when(first, F.lit(""))),
        _line(sid, 1, 1, F.col("_r"), 0, F.concat(
            F.lit("- **"), F.col("feed_id"), F.lit("** -- "), F.col("consecutive_failures").cast("string"),
            F.lit(" consecutive failures. Last error: "), F.coalesce("last_error", F.lit("unknown")),
            F.lit(" (HTTP "), F.coalesce(F.col("last_status_code").cast("string"), F.lit("?")), F.lit(")")))))

    # extraction quality section
    wr = F.row_number().over(Window.partitionBy("sweep_id").orderBy("ord"))
    out = out.unionByName(lines(
        warnings.withColumn("_r", wr),
        _line(sid, 2, 0, 0, 0, F.when(first, F.lit(QUALITY_HEADER))),
        _line(sid, 2, 2, 0, 0, F.when(first, F.lit(""))),
        _line(sid, 2, 1, F.col("ord"), 0, F.concat(F.lit("- "), F.col("warning")))))

    # tier sections: the rank-1 item of a tier carries its header
    tier_ord = F.lit(None).cast("bigint")
    label = nothing
    for i, t in enumerate(tiers):
        tier_ord = F.when(F.col("tier") == t, F.lit(i)).otherwise(tier_ord)
        label = F.when(F.col("tier") == t, F.lit(tier_labels.get(t, t))).otherwise(label)
    head = F.col("rank") == 1
    reason = F.coalesce(F.col("reason"), F.lit(""))
    out = out.unionByName(lines(
        shown.withColumn("_t", tier_ord),
        _line(sid, 3, F.col("_t"), 0, 0, F.when(head, F.concat(F.lit("## "), label))),
        _line(sid, 3, F.col("_t"), 0, 1, F.when(head, F.lit(""))),
        _line(sid, 3, F.col("_t"), F.col("rank"), 0,
              F.concat(F.lit("- **["), F.col("title"), F.lit("]("), F.col("url"), F.lit(")** `"),
                       F.col("source"), F.lit("` `"), F.col("domain"), F.lit("`"))),
        _line(sid, 3, F.col("_t"), F.col("rank"), 1, F.when(reason != "", F.concat(F.lit("  "), reason))),
        _line(sid, 3, F.col("_t"), F.col("rank"), 2, F.lit(""))))

    # source signal rates: header if the sweep has any scored source, rows
    # for sources with enough scores, highest rate first
    pct = rate_pct("scored_3plus", "total_scored")
    any_r = F.row_number().over(Window.partitionBy("sweep_id").orderBy("source"))
    enough = F.col("total_scored") >= QUALITY_FOOTER_MIN_SCORED
    rate_r = F.row_number().over(Window.partitionBy("sweep_id").orderBy(
        (~enough).cast("int"), pct.desc(), F.col("source")))
    out = out.unionByName(lines(
        quality.withColumn("_r", any_r).withColumn("_q", rate_r),
        _line(sid, 5, 0, 0, 0, F.when(first, F.lit(RATES_HEADER))),
        _line(sid, 5, 2, 0, 0, F.when(first, F.lit(""))),
        _line(sid, 5, 1, F.col("_q"), 0, F.when(enough, F.concat(
            F.lit("- `"), F.col("source"), F.lit("` signal: "), pct.cast("string"), F.lit("% ("),
            F.col("scored_3plus").cast("string"), F.lit("/"), F.col("total_scored").cast("string"),
            F.lit(")"))))))
    return out


def digest_text(lines: DataFrame) -> DataFrame:
    """One markdown text per sweep (K5): lines in key order joined by
    newlines. A digest is bounded by budgets, feeds and sources."""
    srt = F.array_sort(F.collect_list(F.struct("k1", "k2", "k3", "k4", "line")))
    return lines.groupBy("sweep_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                         F.array_join(F.transform(srt, lambda x: x["line"]), "\n").alias("digest"))
