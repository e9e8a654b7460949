"""Config loading (S9), source gating (S8), empty-sweep warnings."""

import pytest

from siftline.config import SourceConfig, from_mapping
from siftline.operators import validate as val
from siftline.sources import gating


def test_config_requires_sections_and_reads_defaults():
    with pytest.raises(ValueError):
        from_mapping({"profile": {}, "sources": {}})
    cfg = from_mapping({
        "profile": {"description": "d", "projects": ["p"]},
        "domains": {"a": {"keywords": ["k1", "k2"]}, "b": {"keywords": ["k3"]}},
        "sources": {"rss": {"enabled": True}, "serp": {"enabled": False, "sweep": "full"}},
        "scoring": {"tier_budgets": {"RED": 1}},
        "noise_filters": {"skip_domains": ["x.com"], "skip_patterns": ["a.*b"]},
    })
    assert cfg.keywords == ("k1", "k2", "k3")
    assert cfg.dedup_window_hours == 48 and cfg.batch_size == 40 and cfg.min_score == 3
    assert [s.name for s in cfg.enabled_sources()] == ["arxiv", "hackernews", "rss"]     # a source not named is enabled
    assert cfg.budgets == {"RED": 1}
    with pytest.raises(ValueError):
        from_mapping({"profile": {}, "sources": {}, "domains": {}, "scoring": {"tier_budgets": {"RED": -1}}})


def test_gating_rules(spark):
    cfg = [SourceConfig("arxiv", domain="papers"), SourceConfig("serp", sweep="full"),
           SourceConfig("hackernews", enabled=False), SourceConfig("rss")]
    cfg_unset = [SourceConfig("serp")]
    f = spark.createDataFrame([("arxiv", "light"), ("serp", "light"), ("serp", "full"), ("hackernews", "full"),
                               ("rss", "light"), ("podcast", "full")], "source_type string, sweep_type string")
    got = {(r.source_type, r.sweep_type): (r.action, r.domain) for r in gating.gate(f, cfg).collect()}
    assert got == {("arxiv", "light"): ("fetch", "papers"), ("serp", "light"): ("skipped", "ai_research"),
                   ("serp", "full"): ("fetch", "ai_research"), ("hackernews", "full"): ("disabled", "ai_research"),
                   ("rss", "light"): ("fetch", "ai_research"), ("podcast", "full"): ("unknown", "ai_research")}
    unset = gating.gate(f.where("source_type = 'serp'"), cfg_unset).collect()
    assert {(r.sweep_type, r.action) for r in unset} == {("light", "empty"), ("full", "fetch")}


def test_empty_sweep_and_ratio_warnings(spark):
    items = spark.createDataFrame(
        [(1, "a", i, f"id{i}", "t" if i % 2 else " ", "http://x/" + str(i), "" if i < 4 else "s")
         for i in range(10)]
        + [(1, "c", 100 + i, f"c{i}", "t" if i < 4 else "", "http://c/" + str(i), "s") for i in range(10)],
        "sweep_id long, source_type string, seq long, item_id string, title string, url string, summary string")
    sweeps = spark.createDataFrame([(1,), (2,)], "sweep_id long")
    w = {(r.sweep_id, r.source_type): r.warning
         for r in val.quality_warnings(val.report_from_items(items), sweeps, ["a", "b", "c"]).collect()}
    assert w[(1, "b")] == "[b] returned 0 items"
    assert w[(2, "a")] == "[a] returned 0 items"
    assert w[(2, None)] == "0 items fetched from all sources -- check config and network."
    assert (1, "a") not in w                      # exactly 50 % valid: no warning
    assert w[(1, "c")] == "[c] 4/10 items valid (40%)"
    assert (1, None) not in w


def test_report_from_items_equals_row_level_report(spark):
    rows = [(s, t, i, f"id{i % 7}", "" if i % 11 == 0 else "t", "http://u" if i % 13 else "ftp://u",
             "" if i % 5 == 0 else "s") for s in (1, 2) for t in ("x", "y") for i in range(60)]
    items = spark.createDataFrame(rows, "sweep_id long, source_type string, seq long, item_id string, "
                                        "title string, url string, summary string")
    a = sorted(tuple(r) for r in val.report_from_items(items).collect())
    b = sorted(tuple(r) for r in val.validation_report(val.validate_items(items)).select(
        "sweep_id", "source_type", "total", "valid", "empty_title", "empty_url", "malformed_url",
        "duplicate_in_batch", "empty_summary").collect())
    assert a == b


def test_skipped_search_source_gives_no_warning(spark):
    items = spark.createDataFrame([(1, "rss", 0, "a", "t", "http://a", "s"), (2, "rss", 1, "a", "t", "http://a", "s")],
                                  "sweep_id long, source_type string, seq long, item_id string, title string, "
                                  "url string, summary string")
    sweeps = spark.createDataFrame([(1, "full"), (2, "light")], "sweep_id long, sweep_type string")
    srcs = [SourceConfig("rss"), SourceConfig("serp", sweep="full")]
    w = {(r.sweep_id, r.source_type) for r in val.quality_warnings(val.report_from_items(items), sweeps, srcs).collect()}
    assert w == {(1, "serp")}               # called on the full sweep, explicitly skipped on the light one
    unset = [SourceConfig("rss"), SourceConfig("serp")]
    w2 = {(r.sweep_id, r.source_type) for r in val.quality_warnings(val.report_from_items(items), sweeps, unset).collect()}
    assert w2 == {(1, "serp"), (2, "serp")}   # sweep unset: called on light sweeps too, returns nothing


def test_scale_conf_sizes_partitions():
    from siftline.session import scale_conf
    c = scale_conf(100 << 40)                       # 100 TB
    assert c["spark.sql.shuffle.partitions"] == "409600"        # x 256 MB
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert int(scale_conf(1 << 40)["spark.sql.shuffle.partitions"]) == 4096


def test_feed_and_term_domains(spark):
    from siftline.plans.sweep_run import RAW_FETCH, items_from_raw
    cfg = from_mapping({
        "profile": {}, "domains": {},
        "sources": {"rss": {"feeds": [{"name": "blog", "url": "u", "domain": "tools"}, {"name": "plain", "url": "v"}]},
                    "arxiv": {"domain": "papers"}}})
    assert ("rss", "blog", "tools") in cfg.source_keys
    rss = '<rss><channel><item><title>T</title><link>http://x</link></item></channel></rss>'
    raw = spark.createDataFrame([(1, None, "full", "rss", "blog", "u", None, None, 0, None, None, rss),
                                 (1, None, "full", "rss", "plain", "v", None, None, 1, None, None, rss)], RAW_FETCH)
    items, _ = items_from_raw(raw, cfg, spark)
    assert sorted((r.source, r.domain) for r in items.collect()) == [("rss:blog", "tools"),
                                                                      ("rss:plain", "ai_research")]
