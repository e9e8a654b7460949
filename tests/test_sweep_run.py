"""Sweep pipeline: incremental = replay, reruns replace what they left, late
sweeps count, answers fit their prompts; streams with different micro-batch
sizes give the same rows."""

import json
import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftline.config import FIXTURE_CONFIG as CFG
from siftline.config import CurationConfig, DomainConfig, SourceConfig
from siftline.functions.dates import sweep_type_of
from siftline.operators import scoring as sc
from siftline.plans import catalog, fixtures as fx
from siftline.operators import curate as cur
from siftline.plans.sweep_run import RAW_FETCH, arrival_seq, crashes_from_raw, health_panels, items_from_raw, run_sweeps
from siftline.sinks.logs import LogStore
from siftline.streaming import sweeps as sw

from fixture_paths import SMOKE


def _sweeps(items):
    return (items.groupBy("sweep_id").agg(F.min("sweep_ts").alias("sweep_ts"))
            .withColumn("sweep_type", sweep_type_of(F.col("sweep_ts"))))


def test_incremental_equals_replay_and_rerun_is_idempotent(spark, tmpdir_path):
    items = fx.feed_item_rows(spark, SMOKE).where(F.col("sweep_id") <= 6)
    log = fx.fetch_log(spark, SMOKE).withColumn("sweep_id", F.dayofmonth("ts").cast("long")) \
        .where(F.col("sweep_id") <= 6)
    store = LogStore(tmpdir_path + "/logs")
    scorer = sc.keyword_scorer(["purchase", "signup"], strong=["user 1"])
    curated = []
    for lo, hi in [(1, 3), (4, 6)]:
        part = items.where(F.col("sweep_id").between(lo, hi))
        res = run_sweeps(spark, part, _sweeps(part), CFG, store, scorer=scorer,
                         fetches=log.where(F.col("sweep_id").between(lo, hi)), digest_dir=tmpdir_path + "/md")
        curated += [(r.sweep_id, r.seq) for r in res.curated.collect()]
        assert res.digests.count() == hi - lo + 1
    replay = catalog._curated(spark, SMOKE).where(F.col("sweep_id") <= 6)
    assert sorted(curated) == sorted((r.sweep_id, r.seq) for r in replay.collect())

    # the same six sweeps in one run: same digests (snapshots + deltas = full fold)
    one = LogStore(tmpdir_path + "/one")
    whole = run_sweeps(spark, items, _sweeps(items), CFG, one, scorer=scorer, fetches=log, digest_dir=tmpdir_path + "/md1")
    d_one = {r.sweep_id: r.digest for r in whole.digests.collect()}
    d_two = {r.sweep_id: r.digest for r in store.read(spark, "digests").collect()}
    assert d_one == d_two and len(d_one) == 6
    assert any("## FEED HEALTH" in t for t in d_one.values())

    counts = {n: store.read(spark, n).count() for n in ("items_seen", "score_log", "digest_log", "responses")}
    part = items.where(F.col("sweep_id").between(4, 6))
    run_sweeps(spark, part, _sweeps(part), CFG, store, scorer=scorer, digest_dir=tmpdir_path + "/md")
    assert counts == {n: store.read(spark, n).count() for n in counts}
    scores = {r.score for r in store.read(spark, "score_log").collect()}
    assert scores <= {1, 3, 4} and 1 in scores         # the injected scorer ran
    assert store.read(spark, "digest_log").select("sweep_id").distinct().count() == 6


def test_stream_dedup_independent_of_batch_size(spark, tmpdir_path):
    rows = catalog._deduped(spark, SMOKE).select("sweep_id", "sweep_ts", "item_id", "seq")
    outs = []
    for per in (1, 100):
        root = f"{tmpdir_path}/d{per}"
        sw.land(rows.withColumn("landing", F.lit(0)), f"{root}/landing", "landing")
        sw.dedup_stream(spark, f"{root}/landing", rows.schema, f"{root}/out", f"{root}/ck", per_trigger=per)
        outs.append(sorted((r.sweep_id, r.seq, r.kept) for r in sw.dedup_emitted(spark, f"{root}/out").collect()))
    assert outs[0] == outs[1]
    assert any(not k for _, _, k in outs[0]) and any(k for _, _, k in outs[0])


ITEM = ("sweep_id long, sweep_ts timestamp, source_type string, seq long, item_id string, title string, url string, "
        "summary string, source string, domain string, published string")


def _item(sweep, seq, title="t", url=None, source="rss"):
    url = f"http://x/{seq}" if url is None else url
    return (sweep, datetime(2024, 1, sweep, 7), source, seq, f"id{seq}", title, url, "s", source, "d", "")


def _sweep_rows(spark, *ids):
    return spark.createDataFrame([(i, datetime(2024, 1, i, 7), "full") for i in ids],
                                 "sweep_id long, sweep_ts timestamp, sweep_type string")


def test_a_sweep_in_several_files_and_batches(spark, tmpdir_path):
    df = spark.createDataFrame([_item(1, k) for k in range(4)], ITEM)
    for part in (df.where("seq < 2"), df.where("seq >= 2")):
        part.coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/landing")
    store = LogStore(f"{tmpdir_path}/logs")
    sw.curate_stream(spark, f"{tmpdir_path}/landing", df.schema, store, f"{tmpdir_path}/ck", (), (), per_trigger=1)
    assert sorted(r.seq for r in store.read(spark, "curated").collect()) == [0, 1, 2, 3]


def test_late_rows_of_an_earlier_sweep_change_later_ones(spark, tmpdir_path):
    """Sweep 2's item was already in sweep 1, whose row lands last."""
    late = (1, datetime(2024, 1, 1, 7), "rss", 9, "same", "t", "http://x/s", "s", "rss", "d", "")
    soon = (2, datetime(2024, 1, 2, 7), "rss", 5, "same", "t", "http://x/s", "s", "rss", "d", "")
    store = LogStore(f"{tmpdir_path}/logs")
    for row in (soon, late):
        spark.createDataFrame([row], ITEM).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/landing")
        sw.curate_stream(spark, f"{tmpdir_path}/landing", spark.createDataFrame([], ITEM).schema, store,
                         f"{tmpdir_path}/ck", (), (), per_trigger=1)
    assert [(r.sweep_id, r.seq) for r in store.read(spark, "curated").collect()] == [(1, 9)]
    assert [(r.sweep_id, r.item_id) for r in store.read(spark, "items_seen").collect()] == [(1, "same")]


def test_new_sweeps_are_scored_though_others_have_answers(spark, tmpdir_path):
    store = LogStore(tmpdir_path + "/logs")
    scorer = sc.keyword_scorer(["t"])
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    for upto in (1, 2):
        items = spark.createDataFrame([_item(s, s) for s in range(1, upto + 1)], ITEM)
        run_sweeps(spark, items, _sweep_rows(spark, *range(1, upto + 1)), cfg, store, scorer=scorer)
    assert {(r.sweep_id, r.score, r.reason) for r in store.read(spark, "score_log").collect()} == {
        (1, 3, "keyword match"), (2, 3, "keyword match")}
    assert store.read(spark, "responses").count() == 2          # sweep 1 was not asked about again


def test_answers_only_fit_their_own_prompt(spark, tmpdir_path):
    store = LogStore(tmpdir_path + "/logs")
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    for title in ("plain", "alarm"):
        items = spark.createDataFrame([_item(1, 1, title)], ITEM)
        run_sweeps(spark, items, _sweep_rows(spark, 1), cfg, store, scorer=sc.keyword_scorer(["alarm"]))
    assert [r.score for r in store.read(spark, "score_log").collect()] == [3]


def test_a_rerun_with_nothing_leaves_nothing(spark, tmpdir_path):
    store = LogStore(tmpdir_path + "/logs")
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    bad = spark.createDataFrame([_item(1, 1), _item(1, 2, url="ftp://a"), _item(1, 3, title=" ")], ITEM)
    first = run_sweeps(spark, bad, _sweep_rows(spark, 1), cfg, store)
    assert "[rss] 1/3 items valid (33%)" in first.digests.first().digest
    for items in (spark.createDataFrame([_item(1, 7), _item(1, 8)], ITEM), spark.createDataFrame([], ITEM)):
        again = run_sweeps(spark, items, _sweep_rows(spark, 1), cfg, store)
        assert "items valid" not in again.digests.first().digest
    for name in ("items", "items_seen", "curated", "score_log", "quality_delta"):
        assert store.read(spark, name).count() == 0, name
    assert [r.warning for r in store.read(spark, "warnings").orderBy("ord").collect()] == [
        "[rss] returned 0 items", "0 items fetched from all sources -- check config and network."]


def test_late_sweeps_count_in_the_panels(spark, tmpdir_path):
    store = LogStore(tmpdir_path + "/logs")
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    for s in (2, 1, 3):
        items = spark.createDataFrame([_item(s, 10 * s + k) for k in range(3)], ITEM)
        run_sweeps(spark, items, _sweep_rows(spark, s), cfg, store)
    panels = health_panels(spark, store)
    assert [r.total_scored for r in panels["source_quality"].collect()] == [9]
    assert panels["lifetime"].first()["items_seen"] == 9


def test_logs_are_read_by_partition(spark, tmpdir_path):
    store = LogStore(tmpdir_path + "/logs")
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    for s in (1, 2, 3):
        run_sweeps(spark, spark.createDataFrame([_item(s, s)], ITEM), _sweep_rows(spark, s), cfg, store)
    for name in ("items", "curated", "items_seen", "score_log", "digests", "warnings"):
        files = store.read(spark, name, [2]).inputFiles()
        assert all("sweep_id=2/" in f for f in files) and (files or name == "warnings"), name


def test_digest_files_and_title(spark, tmpdir_path):
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    res = run_sweeps(spark, spark.createDataFrame([_item(1, 1)], ITEM), _sweep_rows(spark, 1), cfg,
                     LogStore(tmpdir_path + "/logs"))
    path = res.digest_log.first().filepath
    assert path == f"{tmpdir_path}/md/2024-01-01_0700.md"
    with open(path) as f:
        text = f.read()
    assert text == res.digests.first().digest and text.startswith("# Digest | 2024-01-01 Morning (07:00)")
    assert os.listdir(tmpdir_path + "/md") == ["2024-01-01_0700.md"]


def test_the_prompt_comes_from_the_config(spark, tmpdir_path):
    asked = []

    def scorer(batches, system, model):
        for pdf in batches:
            pdf["response"] = [json.dumps([{"idx": 0, "score": 3, "why": f"{model}: {system}"}])] * len(pdf)
            yield pdf
    cfg = CurationConfig(sources=(SourceConfig("rss"),), model="m1", description="a gardener", projects=("Roses",),
                         noise_notes=("Weeds",), digest_dir=tmpdir_path + "/md",
                         domains=(DomainConfig("soil", 2.0, ("clay", "loam", "peat", "silt", "sand", "chalk")),))
    run_sweeps(spark, spark.createDataFrame([_item(1, 1)], ITEM), _sweep_rows(spark, 1), cfg,
               LogStore(tmpdir_path + "/logs"), scorer=scorer)
    reason = LogStore(tmpdir_path + "/logs").read(spark, "score_log").first().reason
    assert reason.startswith("m1: ") and "a gardener" in reason and "1. Roses" in reason and "- Weeds" in reason
    assert "  soil (weight 2.0): clay, loam, peat, silt, sand\n" in reason and "chalk" not in reason
    assert not asked


RSS = ('<rss><channel><item><title>Same story</title><link>https://a.example/x/</link>'
       '<description>d1</description></item></channel></rss>')


def _raw(spark, rows):
    return spark.createDataFrame([(s, datetime(2024, 1, s, 7 if kind == "full" else 13), kind, src, feed, "u", query, None,
                                   seq, None, err, body) for s, kind, src, feed, query, seq, err, body in rows], RAW_FETCH)


def test_sources_are_enabled_by_default_and_keys_count_once(spark):
    cfg = CurationConfig(sources=(SourceConfig("arxiv"),), source_keys=(("rss", "feed", "a"), ("rss", "feed", "b")))
    items, _ = items_from_raw(_raw(spark, [(1, "full", "rss", "feed", None, 0, None, RSS)]), cfg, spark)
    assert [(r.title, r.domain) for r in items.collect()] == [("Same story", "a")]


def test_search_points_hits_and_top_list(spark):
    hits = {"hits": [{"url": f"https://h.example/{k}", "objectID": str(k), "points": 30, "title": f"h{k}"} for k in range(14)]}
    raw = _raw(spark, [(1, "full", "hackernews", None, "q", 0, None, json.dumps(hits)),
                       (2, "light", "rss", "feed", None, 0, None, RSS)])
    top = spark.createDataFrame([(s, k, 100 + k) for s in (1, 2) for k in range(1, 61)], "sweep_id long, rank long, id long")
    stories = spark.createDataFrame([(s, 100 + k, json.dumps({"type": "story", "title": f"term {k}", "score": 30, "id": k,
                                                              "url": f"https://t.example/{k}"}))
                                     for s in (1, 2) for k in range(1, 61)], "sweep_id long, id long, body string")
    on = CurationConfig(min_points=10, top_n=40, keywords=("term",))
    got = [(r.sweep_id, r.title[0]) for r in items_from_raw(raw, on, spark, top, stories)[0].where(
        "source_type = 'hackernews'").collect()]
    assert {k: got.count(k) for k in set(got)} == {(1, "h"): 10, (1, "t"): 40, (2, "t"): 20}
    off = CurationConfig(min_points=10, top_n=40, keywords=("term",), sources=(SourceConfig("hackernews", enabled=False),))
    assert items_from_raw(raw, off, spark, top, stories)[0].where("source_type = 'hackernews'").count() == 0


def test_a_crashed_source_warns_and_has_no_report(spark, tmpdir_path):
    raw = _raw(spark, [(1, "full", "rss", "feed", None, 0, None, RSS), (1, "full", "arxiv", None, None, -1, "boom", None)])
    cfg = CurationConfig(sources=(SourceConfig("arxiv"), SourceConfig("rss")), digest_dir=tmpdir_path + "/md")
    items, fetches = items_from_raw(raw, cfg, spark)
    res = run_sweeps(spark, items, raw.select("sweep_id", "sweep_ts", "sweep_type").distinct(), cfg,
                     LogStore(tmpdir_path + "/logs"), fetches=fetches, crashes=crashes_from_raw(raw))
    text = res.digests.first().digest
    assert "- [arxiv] fetch crashed: boom" in text and "[arxiv] returned" not in text


def test_plug_in_sources_and_arrival_order(spark):
    from siftline.sources import gating

    def bulletin(x):
        return x.rows.select("sweep_id", "fetch_seq", F.lit(0).alias("part"), F.lit(0).alias("pos"),
                             F.col("body").alias("title"), F.concat(F.lit("http://b/"), "body").alias("url"),
                             F.lit("").alias("summary"), F.lit("bulletin").alias("source"), "domain", F.lit("").alias("published"))
    gating.register("bulletin", bulletin)
    try:
        raw = _raw(spark, [(1, "full", "bulletin", None, None, 0, None, "news"), (1, "full", "rss", "feed", None, 0, None, RSS)])
        items, _ = items_from_raw(raw, CurationConfig(), spark)
        rows = items.orderBy("seq").collect()
        assert [r.source_type for r in rows] == ["rss", "bulletin"] and rows[0].seq > 0
        kept = cur.curate(items, (), ()).collect()
        assert len(kept) == 2
    finally:
        del gating.REGISTRY["bulletin"]
    big = spark.range(1).select(arrival_seq(F.lit(15), F.lit((1 << 32) - 1), F.lit(1), F.lit((1 << 23) - 1)).alias("s"))
    assert 0 < 2 * big.first().s < 1 << 63
    with pytest.raises(Exception, match="arrival order"):
        spark.range(1).select(arrival_seq(F.lit(64), F.lit(0), F.lit(0), F.lit(0))).collect()


def test_raw_payloads_through_a_sweep(spark, tmpdir_path):
    """RSS + arXiv + HN search + web-search payloads of two sweeps -> items
    in registry order -> the whole sweep pipeline."""
    t1, t2 = datetime(2024, 1, 1, 7), datetime(2024, 1, 1, 13)
    rss = ('<rss><channel><item><title>Same story</title><link>https://a.example/x/</link>'
           '<description>d1</description></item><item><title>Only rss</title><link>https://a.example/y</link>'
           '</item></channel></rss>')
    arxiv = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Same story</title>'
             '<id>https://A.example/x</id><summary>paper</summary><published>2024-01-01T00:00:00Z</published>'
             '</entry></feed>')
    hn = json.dumps({"hits": [{"url": "https://h.example/1", "objectID": "1", "points": 80, "title": "HN one"},
                              {"url": "https://h.example/2", "objectID": "2", "points": 10, "title": "low"}]})
    serp = json.dumps({"news_results": [{"link": "https://s.example/1", "title": "web", "snippet": "s"}]})
    rows = [(1, t1, "full", "rss", "feed", "https://feed", None, None, 0, None, None, rss),
            (1, t1, "full", "rss", "dead", "https://dead", None, None, 1, 404, "Not Found", None),
            (1, t1, "full", "arxiv", None, None, None, None, 0, None, None, arxiv),
            (1, t1, "full", "hackernews", None, None, "q", None, 0, None, None, hn),
            (1, t1, "full", "serp", None, None, "q", None, 0, None, None, serp),
            (2, t2, "light", "rss", "feed", "https://feed", None, None, 0, None, None, rss),
            (2, t2, "light", "serp", None, None, "q", None, 0, None, None, serp)]
    raw = spark.createDataFrame(rows, RAW_FETCH)
    cfg = CurationConfig(sources=(SourceConfig("arxiv"), SourceConfig("hackernews"), SourceConfig("rss"),
                                  SourceConfig("serp", sweep="full")), digest_dir=tmpdir_path + "/md")
    items, fetches = items_from_raw(raw, cfg, spark)
    got = sorted((r.sweep_id, r.source_type, r.title) for r in items.collect())
    assert got == [(1, "arxiv", "Same story"), (1, "hackernews", "HN one"), (1, "rss", "Only rss"),
                   (1, "rss", "Same story"), (1, "serp", "web"), (2, "rss", "Only rss"), (2, "rss", "Same story")]
    sweeps = raw.select("sweep_id", "sweep_ts", "sweep_type").distinct()
    res = run_sweeps(spark, items, sweeps, cfg, LogStore(tmpdir_path + "/logs"), fetches=fetches)
    cur = {(r.sweep_id, r.source_type, r.title) for r in res.curated.collect()}
    # the arXiv copy of "Same story" wins over the RSS copy (registry order);
    # sweep 2 repeats within 48 h, so nothing passes the window there
    assert cur == {(1, "arxiv", "Same story"), (1, "hackernews", "HN one"), (1, "rss", "Only rss"),
                   (1, "serp", "web")}
    assert sorted((r.feed_id, r.ok, r.item_count) for r in LogStore(tmpdir_path + "/logs").read(spark, "fetch_log").collect()) == [
        ("rss:dead", False, 0), ("rss:feed", True, 2), ("rss:feed", True, 2)]
    log = {r.sweep_id: (r.items_fetched, r.items_after_dedup) for r in res.digest_log.collect()}
    assert log == {1: (5, 4), 2: (2, 0)}


def test_single_sweep_runs_match_replay(spark, tmpdir_path):
    items = fx.feed_item_rows(spark, SMOKE).where(F.col("sweep_id") <= 5)
    store, cfg = LogStore(tmpdir_path + "/logs"), replace(CFG, digest_dir=tmpdir_path + "/md")
    got = []
    for s in range(1, 6):
        part = items.where(F.col("sweep_id") == s)
        got += [(r.sweep_id, r.seq) for r in run_sweeps(spark, part, _sweeps(part), cfg, store).curated.collect()]
    replay = catalog._curated(spark, SMOKE).where(F.col("sweep_id") <= 5)
    assert sorted(got) == sorted((r.sweep_id, r.seq) for r in replay.collect())


def test_dry_run_and_sources_only(spark, tmpdir_path):
    items = fx.feed_item_rows(spark, SMOKE).where(F.col("sweep_id") == 2)
    dry = run_sweeps(spark, items, _sweeps(items), CFG, LogStore(tmpdir_path + "/a"), mode="dry_run",
                     digest_dir=tmpdir_path + "/md")
    assert {r.filepath for r in dry.digest_log.collect()} == {"(dry-run)"}
    assert not os.path.exists(tmpdir_path + "/md")
    store = LogStore(tmpdir_path + "/b")
    src = run_sweeps(spark, items, _sweeps(items), CFG, store, mode="sources_only")
    assert src.scored.columns == ["sweep_id", "seq", "domain", "source", "title"]
    assert store.read(spark, "items_seen").count() == src.curated.count() > 0
    assert not store.exists(spark, "digest_log") and not store.exists(spark, "score_log")


def test_sweep_with_no_items(spark, tmpdir_path):
    items = fx.feed_item_rows(spark, SMOKE).where(F.col("sweep_id") == 3)
    sweeps = spark.createDataFrame([(3, datetime(2024, 1, 3), "full"), (40, datetime(2024, 2, 9, 12), "light")],
                                   "sweep_id long, sweep_ts timestamp, sweep_type string")
    cfg = CurationConfig(sources=(SourceConfig("click"), SourceConfig("view")), digest_dir=tmpdir_path + "/md")
    res = run_sweeps(spark, items, sweeps, cfg, LogStore(tmpdir_path + "/logs"))
    log = {r.sweep_id: (r.items_fetched, r.items_scored, r.sweep_type) for r in res.digest_log.collect()}
    assert log[40] == (0, 0, "light") and log[3][0] > 0
    text = {r.sweep_id: r.digest for r in res.digests.collect()}[40]
    assert text.startswith("# Digest | 2024-02-09 Midday/Evening")
    assert "- [click] returned 0 items" in text and "- [view] returned 0 items" in text
    assert "- 0 items fetched from all sources -- check config and network." in text
    assert "*Nothing above noise threshold. Clean day.*" in text
    assert "*0 items surfaced from light sweep. RED: 0, ORANGE: 0, YELLOW: 0*" in text


def test_health_panels_from_deltas_equal_folds(spark, tmpdir_path):
    from siftline.operators import folds as fl
    items = fx.feed_item_rows(spark, SMOKE).where(F.col("sweep_id") <= 4)
    log = fx.fetch_log(spark, SMOKE).withColumn("sweep_id", F.dayofmonth("ts").cast("long")) \
        .where(F.col("sweep_id") <= 4)
    store = LogStore(tmpdir_path + "/logs")
    for lo, hi in [(1, 2), (3, 4)]:
        part = items.where(F.col("sweep_id").between(lo, hi))
        run_sweeps(spark, part, _sweeps(part), CFG, store, fetches=log.where(F.col("sweep_id").between(lo, hi)),
                   digest_dir=tmpdir_path + "/md")
    p = health_panels(spark, store)
    got = sorted(tuple(r) for r in p["feed_health"].collect())
    want = sorted(tuple(r) for r in fl.feed_health_view(fl.feed_health_delta(store.read(spark, "fetch_log"))).collect())
    assert got == want and got
    q = sorted(tuple(r) for r in p["source_quality"].collect())
    q2 = sorted(tuple(r) for r in fl.source_quality_view(fl.source_quality_counts(store.read(spark, "score_log"))).collect())
    assert q == q2
    assert p["digest_history"].count() == 4 and p["lifetime"].first()["digests"] == 4
