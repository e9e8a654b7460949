"""Validity cascade (F1, D1), per-source report (A1) and quality warnings
(A2, A11)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio_pct_even
from ..functions.text import is_blank
from .ordering import flag_first

REASONS = ("valid", "empty_title", "empty_url", "malformed_url", "duplicate_in_batch")


def hard_failure(title="title", url="url") -> Column:
    """First failing hard rule, or null: blank title -> blank url -> url not
    starting with lower-case ``http`` (raw text, so a leading space or
    ``HTTP`` fails and ``httpfoo`` passes)."""
    t, u = F.col(title), F.col(url)
    return (F.when(is_blank(t), F.lit("empty_title"))
            .when(is_blank(u), F.lit("empty_url"))
            .when(~u.startswith("http"), F.lit("malformed_url")))


def validate_items(items: DataFrame, scope: Sequence[str] = ("sweep_id", "source_type")) -> DataFrame:
    """Annotate every item with ``reason`` (one of REASONS, disjoint) and
    ``empty_summary`` (soft issue, counted among valid rows only).

    Duplicates are judged within ``scope`` (a sweep's source type) among
    rows that pass the hard rules; the earliest ``seq`` wins.
    """
    hard = hard_failure()
    df = items.withColumn("_hard", hard)
    df = flag_first(df, [*scope, "item_id"], "seq", "_first", eligible=F.col("_hard").isNull())
    reason = F.coalesce(F.col("_hard"),
                        F.when(~F.col("_first"), F.lit("duplicate_in_batch")),
                        F.lit("valid"))
    return (df.withColumn("reason", reason)
            .withColumn("empty_summary", (F.col("reason") == "valid") & is_blank(F.col("summary")))
            .drop("_hard", "_first"))


def validation_report(checked: DataFrame, scope: Sequence[str] = ("sweep_id", "source_type")) -> DataFrame:
    """One row per scope: total and the count of each reason (A1)."""
    r = F.col("reason")
    return checked.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(r == "valid").alias("valid"),
        F.count_if(r == "empty_title").alias("empty_title"),
        F.count_if(r == "empty_url").alias("empty_url"),
        F.count_if(r == "malformed_url").alias("malformed_url"),
        F.count_if(r == "duplicate_in_batch").alias("duplicate_in_batch"),
        F.count_if(F.col("empty_summary")).alias("empty_summary"),
    )


def report_from_items(items: DataFrame, scope: Sequence[str] = ("sweep_id", "source_type")) -> DataFrame:
    """The same report as ``validation_report(validate_items(items))``
    without touching item rows in a shuffle: hard failures are counted per
    row, and duplicates and blank summaries come from one partial
    aggregation per (scope, item) -- ``min(seq*2 + blank_bit)`` gives the
    first copy and whether its summary is blank."""
    hard = hard_failure()
    rows = items.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(hard == "empty_title").alias("empty_title"),
        F.count_if(hard == "empty_url").alias("empty_url"),
        F.count_if(hard == "malformed_url").alias("malformed_url"))
    code = F.shiftleft(F.col("seq"), 1) + F.when(is_blank(F.col("summary")), F.lit(1)).otherwise(F.lit(0))
    keys = (items.where(hard.isNull()).groupBy(*scope, "item_id")
            .agg(F.count(F.lit(1)).alias("_n"), F.min(code).alias("_c")))
    uniq = keys.groupBy(*scope).agg(
        F.sum("_n").alias("_passing"), F.count(F.lit(1)).alias("valid"),
        F.count_if(F.col("_c").bitwiseAND(F.lit(1)) == 1).alias("empty_summary"))
    j = rows.join(uniq, list(scope), "left").na.fill(0, ["_passing", "valid", "empty_summary"])
    return j.select(*scope, "total", F.col("valid").cast("bigint").alias("valid"), "empty_title", "empty_url",
                    "malformed_url", (F.col("_passing") - F.col("valid")).cast("bigint").alias("duplicate_in_batch"),
                    F.col("empty_summary").cast("bigint").alias("empty_summary"))


def quality_warning(source="source_type", total="total", valid="valid",
                    empty_summary="empty_summary", malformed="malformed_url") -> Column:
    """Warning text for one report row, or null (A2). Integer arithmetic:
    ``valid/total < .5`` is ``2*valid < total``; ``empty > .3*total`` is
    ``10*empty > 3*total``."""
    s, t, v = F.col(source), F.col(total), F.col(valid)
    e, m = F.col(empty_summary), F.col(malformed)
    tag = F.concat(F.lit("["), s, F.lit("] "))
    low = F.concat(tag, v.cast("string"), F.lit("/"), t.cast("string"), F.lit(" items valid ("),
                   ratio_pct_even(v, t).cast("string"), F.lit("%)"))
    issues = F.concat_ws(", ",
                         F.when(F.lit(10) * e > F.lit(3) * t,
                                F.concat(e.cast("string"), F.lit(" missing summaries"))),
                         F.when(m > 0, F.concat(m.cast("string"), F.lit(" malformed URLs"))))
    return (F.when(t == 0, F.concat(tag, F.lit("returned 0 items")))
            .when(F.lit(2) * v < t, low)
            .when((F.lit(10) * e > F.lit(3) * t) | (m > 0),
                  F.concat(tag, F.lit("quality issues: "), issues)))


# Fixed display values that must equal the original's, like the texts in quality_warning.
EMPTY_SWEEP_WARNING = "0 items fetched from all sources -- check config and network."


def quality_warnings(report: DataFrame, sweeps: DataFrame, sources: Sequence,
                     crashes: DataFrame | None = None) -> DataFrame:
    """Warnings per sweep in render order (A2 + A11).

    ``sweeps``: one row per sweep (``sweep_id``, optionally
    ``sweep_type``); ``sources``: the enabled source types in registry
    order, as names or ``SourceConfig``. A source that was called but gave
    no rows still gets its "returned 0 items" row, so each sweep is
    expanded to its called sources with a literal array (config-sized, no
    join) and the report is left-joined to that. A web-search source marked
    ``sweep: full`` is not called on light sweeps, so it gets no row there.
    ``crashes`` (sweep_id, source_type, error): a source whose fetch crashed
    has that as its warning and no report.
    """
    from ..sources.gating import SEARCH_SOURCE
    cfgs = [(s, None) if isinstance(s, str) else (s.name, s.sweep) for s in sources]
    srcs = F.array(*[F.struct(F.lit(n).alias("source_type"), F.lit(i).cast("bigint").alias("ord"),
                              F.lit(sw).cast("string").alias("_sweep"))
                     for i, (n, sw) in enumerate(cfgs)])
    typed = "sweep_type" in sweeps.columns
    keep = ["sweep_id"] + (["sweep_type"] if typed else [])
    grid = sweeps.select(*keep, F.explode(srcs).alias("_s")).select(*keep, "_s.*")
    if typed:
        skipped = ((F.col("sweep_type") == "light") & (F.col("source_type") == SEARCH_SOURCE)
                   & F.col("_sweep").eqNullSafe("full"))
        grid = grid.where(~skipped)
    grid = grid.select("sweep_id", "source_type", "ord")
    rep = grid.join(report, ["sweep_id", "source_type"], "left").na.fill(
        0, ["total", "valid", "empty_title", "empty_url", "malformed_url",
            "duplicate_in_batch", "empty_summary"])
    text = quality_warning()
    if crashes is not None:
        first = crashes.groupBy("sweep_id", "source_type").agg(F.min(F.coalesce("error", F.lit(""))).alias("_crash"))
        rep = rep.join(first, ["sweep_id", "source_type"], "left")
        text = F.when(F.col("_crash").isNotNull(), F.concat(
            F.lit("["), F.col("source_type"), F.lit("] fetch crashed: "), F.col("_crash"))).otherwise(text)
    # one pass over the (small) per-source report: each row emits its own
    # warning; the sweep's first source also emits the whole-sweep one
    sweep_w = Window.partitionBy("sweep_id")
    rep = (rep.withColumn("_fetched", F.sum("valid").over(sweep_w))
           .withColumn("_first", F.col("ord") == F.min("ord").over(sweep_w)))
    both = F.array(
        F.struct(F.col("ord"), F.col("source_type"), text.alias("warning")),
        F.struct(F.lit(1_000_000).cast("bigint").alias("ord"), F.lit(None).cast("string").alias("source_type"),
                 F.when(F.col("_first") & (F.col("_fetched") == 0), F.lit(EMPTY_SWEEP_WARNING)).alias("warning")))
    return (rep.select("sweep_id", F.explode(both).alias("_w")).select("sweep_id", "_w.*")
            .where(F.col("warning").isNotNull()))
