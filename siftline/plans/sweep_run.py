"""One sweep, or many at once, end to end (the original's ``run``).

raw items -> validate -> in-sweep dedup -> noise filters -> cross-run
window against the seen-store -> [curated] -> [items_seen] -> batches -> scorer ->
[responses] -> scores -> [score_log] -> budgets -> digest ->
[digests, digest_log, warnings]. Bracketed steps are log writes; each is
read back, which cuts the lineage and fixes the model's answers.

Runs as a batch job over any number of new sweeps and as the body of a
streaming ``foreachBatch`` (``streaming.sweeps``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CurationConfig, SourceConfig
from ..operators import curate as cur
from ..operators import digest as dg
from ..operators import folds as fl
from ..operators import reports as rp
from ..operators import scoring as sc
from ..operators import validate as val
from ..operators.ordering import keep_first
from ..sinks.logs import LogStore, digest_files


@dataclass
class SweepResult:
    checked: DataFrame
    curated: DataFrame
    scored: DataFrame
    digests: DataFrame
    digest_log: DataFrame


def curate_against_store(items: DataFrame, store: LogStore, spark: SparkSession, sweep_ids: list[int],
                         cfg: CurationConfig) -> DataFrame:
    """Curation of new sweeps given the seen-store.
    The first sighting of an item is the earlier of the store's (rows
    recorded by *other* sweeps, so a rerun sees the same store) and the new
    sweeps' own; the store is asked for these items only (``sinks.seen``)."""
    return cur.curate(items, cfg.skip_domains, cfg.skip_patterns, cfg.dedup_window_hours,
                      prior_first=store.seen_before(spark, items, sweep_ids, since_window(items, sweep_ids, cfg.dedup_window_hours)))


def since_window(items: DataFrame, sweep_ids: list[int], hours: int) -> F.Column | None:
    """For a single sweep only sightings inside its window can suppress an item,
    so older ones need not be read. With several sweeps they must be: an item
    that was first seen long ago passes in all of them."""
    start = items.agg(F.min("sweep_ts")).first()[0] if len(sweep_ids) == 1 else None
    return None if start is None else F.lit(start).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")


def record_seen(curated: DataFrame, store: LogStore, spark: SparkSession, sweep_ids: list[int]) -> None:
    """Insert-if-absent (K1): the first curated copy of items the store
    does not know yet, first_seen = sweep time."""
    known = store.seen_before(spark, curated, sweep_ids)
    first = keep_first(curated, ["item_id"], "sweep_ts").join(known.select("item_id"), "item_id", "left_anti")
    store.record(spark, first.select(
        "item_id", "url", "title", F.substring("summary", 1, 500).alias("summary"), "source", "domain", "published",
        F.col("sweep_ts").alias("first_seen"), F.to_date("sweep_ts").alias("first_seen_date"), "sweep_id"), sweep_ids)


def answered(prompts: DataFrame, store: LogStore, spark: SparkSession, sweep_ids: list[int], scorer: sc.Scorer,
             system_prompt: str, model: str) -> DataFrame:
    """One usable answer for each prompt that has one: those that the log has
    for the very same prompt, and new ones of the scorer for all others, in up
    to ``ATTEMPTS`` rounds, each over the prompts that are still without (M5).
    Every attempt is logged with its outcome and counts at once, so a run that
    breaks off asks nothing twice. What no attempt answered is asked again by the
    next run."""
    key = ["sweep_id", "batch", "prompt_hash"]
    asked = prompts.withColumn("prompt_hash", sc.prompt_hash(system_prompt, model))

    def have() -> DataFrame:
        return store.read(spark, "responses", sweep_ids).where("usable")
    for attempt in range(1, sc.ATTEMPTS + 1):
        open_ = asked.join(have().select(*key), key, "left_anti")
        if open_.isEmpty():
            break
        got = sc.run_scorer(open_, scorer, system_prompt, model).join(asked.select(*key, "n_items"), key)
        store.append(spark, got.select(
            *key, "response", "error", F.lit(attempt).alias("attempt"),
            sc.usable_answer(F.col("response"), F.col("n_items")).alias("usable")), "responses", sweep_ids)
    # a task that ran twice may have answered twice: one of them counts
    return (have().join(asked.select(*key), key, "left_semi")
            .groupBy("sweep_id", "batch").agg(F.min("response").alias("response")))


def counted(fetches: DataFrame, items: DataFrame) -> DataFrame:
    """Fetch-log rows with the number of items of each successful fetch that
    has none yet: the parsed items of its place in the arrival order."""
    n = (items.where(F.col("source_type") == "rss")
         .groupBy("sweep_id", F.shiftright("seq", 24).bitwiseAND(F.lit((1 << 32) - 1)).alias("_fetch"))
         .agg(F.count(F.lit(1)).cast("int").alias("_n")).withColumnRenamed("sweep_id", "_sweep"))
    return (fetches.join(n, (F.col("sweep_id") == F.col("_sweep")) & (F.col("seq") == F.col("_fetch"))
                         & F.col("item_count").isNull(), "left")
            .withColumn("item_count", F.coalesce("item_count", "_n", F.lit(0))).drop("_sweep", "_fetch", "_n"))


def run_sweeps(spark: SparkSession, items: DataFrame, sweeps: DataFrame, cfg: CurationConfig,
               store: LogStore, scorer: sc.Scorer | None = None, fetches: DataFrame | None = None,
               system_prompt: str | None = None, digest_dir: str | None = None, mode: str = "full",
               crashes: DataFrame | None = None) -> SweepResult:
    """Process new sweeps. ``items``: ITEM rows; ``sweeps``: (sweep_id,
    sweep_ts, sweep_type); ``fetches``: fetch-log rows of these sweeps;
    ``crashes`` (sweep_id, source_type, error): sources whose fetch crashed.
    The system prompt is that of the config unless one is given.

    The sweeps (a row each) are held by the driver as literals, so every log
    is read by its partitions. A run replaces what earlier runs of the same
    sweeps left, also where there is nothing new; sweeps may come in any order.
    All its logs count together, from its end on: a run that breaks off leaves
    nothing but the answers it got.

    ``mode``: ``full``; ``dry_run`` (everything, but no digest file and the
    log's path is ``(dry-run)``); ``sources_only`` (items are recorded as
    seen, then the run stops: no scoring, no digest, no digest log; the
    curated listing is the result)."""
    if mode not in ("full", "dry_run", "sources_only"):
        raise ValueError(f"unknown mode {mode}")
    from ..sources.gating import REGISTRY
    sweeps = sweeps.select("sweep_id", F.col("sweep_ts").cast("timestamp").alias("sweep_ts"), "sweep_type")
    sweeps = spark.createDataFrame(sweeps.distinct().collect(), "sweep_id bigint, sweep_ts timestamp, sweep_type string")
    ids = sorted(r.sweep_id for r in sweeps.collect())
    if not ids:
        raise ValueError("no sweeps to process")
    system_prompt = sc.config_prompt(cfg) if system_prompt is None else system_prompt
    store = store.begin()       # all logs of this run count from its commit on
    digest_dir = digest_dir or cfg.digest_dir or store.path("digest_files")
    # parsed once: report, curation and funnel read these rows. Scores come from the scorer only
    items = store.replace(spark, items, "items", ids)
    # no sources configured: every registry source, enabled by default
    sources = cfg.enabled_sources() if cfg.sources else [SourceConfig(n) for n in REGISTRY]
    checked = val.validate_items(items)          # per-row reasons, lazily, for callers
    report = val.report_from_items(items)
    warnings = store.replace(spark, val.quality_warnings(report, sweeps, sources, crashes), "warnings", ids)
    # later steps read these files, not a plan over the seen-store that record_seen rewrites
    curated = store.replace(spark, curate_against_store(items, store, spark, ids, cfg), "curated", ids)
    record_seen(curated, store, spark, ids)
    if mode == "sources_only":
        listing = curated.select("sweep_id", "seq", "domain", "source", "title")
        empty = spark.createDataFrame([], "sweep_id bigint")
        store.commit(spark)
        return SweepResult(checked, curated, listing, empty, empty)

    batched = sc.number_batches(curated, cfg.batch_size)
    responses = None if scorer is None else answered(sc.batch_prompts(batched), store, spark, ids, scorer,
                                                     system_prompt, cfg.model)
    scored_items = store.replace(spark, sc.apply_scores(batched, responses), "score_log", ids)

    surf = rp.surfaced(scored_items, cfg.min_score)
    shown = rp.apply_budgets(surf, cfg.budgets)
    # as-of state for the digests: the sweeps before these as one folded state, then a delta a sweep,
    # also of sweeps between these that other runs processed
    if fetches is not None:
        log = store.replace(spark, counted(fetches, items), "fetch_log", ids)
        store.replace(spark, fl.feed_health_delta(log, ("feed_id", "sweep_id")), "feed_delta", ids)
    store.replace(spark, fl.source_quality_counts(scored_items, ("source", "sweep_id")), "quality_delta", ids)
    feeds, state = (store.read_between(spark, name, ids[0], ids[-1]) for name in ("feed_delta", "quality_delta"))
    sick = dg.feed_health_asof(feeds, sweeps, prior=fl.fold_feed_deltas(store.deltas(spark, "feed_delta", ids[0] - 1)))
    quality = dg.source_quality_asof(state, sweeps, prior=fl.sum_source_counts(store.deltas(spark, "quality_delta", ids[0] - 1)))
    lines = dg.digest_lines(sweeps, sick, warnings, shown.select(
        "sweep_id", "tier", "rank", "title", "url", "source", "domain", "reason"), quality, cfg.orient_prompt)
    digests = store.replace(spark, dg.digest_text(lines), "digests", ids)
    if mode == "full":
        digest_files(digests.join(sweeps, "sweep_id"), digest_dir).count()
    fetched = report.select("sweep_id", F.col("valid").alias("items_fetched"))
    funnel = rp.sweep_funnel(sweeps, fetched, scored_items, cfg.budgets, cfg.min_score)
    dlog = store.replace(spark, rp.digest_log(funnel, digest_dir, dry_run=(mode == "dry_run")), "digest_log", ids)
    store.checkpoint(spark, "feed_delta", fl.fold_feed_deltas)
    store.checkpoint(spark, "quality_delta", fl.sum_source_counts)
    store.commit(spark)
    return SweepResult(checked, curated, scored_items, digests, dlog)


# ------------------------------------------------------------- raw payloads

RAW_FETCH = ("sweep_id bigint, sweep_ts timestamp, sweep_type string, source_type string, feed_name string, "
             "feed_url string, query string, domain string, fetch_seq bigint, status_code int, error string, "
             "body string")


#: the fetch_seq of a row that says a source's fetch crashed, with the message in ``error``
CRASHED = -1


def arrival_seq(src_rank, fetch_seq, part, pos) -> F.Column:
    """Arrival order as one bigint: registry rank of the source type, then
    fetch (feed / query) order, then RSS-before-Atom, then position in the
    payload (U1). Bits: 6 | 32 | 1 | 23, so that it may be doubled; what does
    not fit is an error."""
    fits = ((src_rank < 64) & (fetch_seq >= 0) & (fetch_seq < (1 << 32)) & (pos < (1 << 23)))
    return F.when(fits, F.shiftleft(src_rank.cast("bigint"), 56) + F.shiftleft(fetch_seq.cast("bigint"), 24)
                  + F.shiftleft(part.cast("bigint"), 23) + pos.cast("bigint")).otherwise(
        F.raise_error(F.lit("arrival order beyond its bits")).cast("bigint"))


def items_from_raw(raw: DataFrame, cfg: CurationConfig, spark: SparkSession,
                   hn_top: DataFrame | None = None, hn_stories: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Landed payloads of one or more sweeps -> (ITEM rows, fetch-log rows).

    Gating (S8) drops disabled and skipped sources; each registered source
    type goes through its parser (S1-S6, X1); failed fetches (``error`` set)
    give no items; RSS fetches also give fetch-log rows (K2), whose numbers of
    items ``run_sweeps`` counts from the parsed items, so that no body is
    parsed twice. ``hn_top``
    (sweep_id, rank, id) and ``hn_stories`` (sweep_id, id, body) carry the
    top-story list; it is gated like the source's payloads, in the sweeps that
    ``raw`` names.
    """
    from ..functions.ids import item_id
    from ..sources import gating
    from ..sources import xml_feeds as xf

    if cfg.source_keys:   # domains of feeds and search terms
        raw = raw.withColumn("domain", F.coalesce("domain", gating.key_domain(
            cfg.source_keys, F.col("source_type"), F.coalesce("feed_name", "query"))))
    gated = gating.gate(raw, cfg.sources, cfg.default_domain)
    live = gated.where((F.col("action") == "fetch") & F.col("error").isNull() & (F.col("fetch_seq") != CRASHED))
    # a row a sweep, with the sources that crashed in it: held by the driver, as ``run_sweeps`` does
    crash = F.when((F.col("action") == "fetch") & (F.col("fetch_seq") == CRASHED), F.col("source_type"))
    known = gated.groupBy("sweep_id", F.unix_micros("sweep_ts").alias("at"), "sweep_type").agg(
        F.collect_set(crash).alias("crashed")).collect()
    items = None
    for rank, (name, parse) in enumerate(gating.REGISTRY.items()):
        called = gating.called_sweeps(gating.local_rows(
            spark, [(r.sweep_id, r["at"], r.sweep_type) for r in known if name not in r.crashed],
            "sweep_id bigint, at bigint, sweep_type string").select(
                "sweep_id", F.timestamp_micros("at").alias("sweep_ts"), "sweep_type"), name, cfg.sources)
        rows = parse(gating.Landed(live.where(F.col("source_type") == name), cfg, called, hn_top, hn_stories)) \
            .select(*gating.ITEM).join(called.select("sweep_id", "sweep_ts"), "sweep_id")
        part = rows.select(
            "sweep_id", "sweep_ts", F.lit(name).alias("source_type"),
            arrival_seq(F.lit(rank), F.col("fetch_seq"), F.col("part"), F.col("pos")).alias("seq"),
            item_id(F.col("url")).alias("item_id"), "title", "url", "summary", "source", "domain", "published")
        items = part if items is None else items.unionByName(part)
    fetches = xf.fetch_log_rows(gated.where((F.col("source_type") == "rss") & (F.col("action") == "fetch")
                                            & (F.col("fetch_seq") != CRASHED)), count=False)
    return items, fetches


def crashes_from_raw(raw: DataFrame) -> DataFrame:
    """(sweep_id, source_type, error) of the sources whose fetch crashed."""
    return raw.where(F.col("fetch_seq") == CRASHED).select("sweep_id", "source_type", "error")


def health_panels(spark: SparkSession, store: LogStore, as_of_sweep=None) -> dict[str, DataFrame]:
    """The original's health report and dashboard panels (R2, R3) from the
    log store: feed health (status bands, average items per fetch),
    source signal rates, the last ten digests and lifetime counts. State is
    folded from the last checkpoint and the sweeps' deltas after it, whatever
    order they came in."""
    upto = None if as_of_sweep is None else int(as_of_sweep)
    feed_state = fl.fold_feed_deltas(store.deltas(spark, "feed_delta", upto))
    quality = fl.sum_source_counts(store.deltas(spark, "quality_delta", upto))
    seen = store.read(spark, "items_seen")
    scores = store.read(spark, "score_log")
    current = fl.current_scores(scores, seen, "left")
    digests = store.read(spark, "digest_log")
    as_of = seen.agg(F.max("first_seen")).scalar()
    return {
        "feed_health": fl.feed_health_view(feed_state),
        "source_quality": fl.source_quality_view(quality),
        "digest_history": rp.digest_history(digests),
        "lifetime": fl.lifetime_stats(current, digests, as_of),
    }
