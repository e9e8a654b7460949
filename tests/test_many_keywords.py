"""Thousands of keywords, the indexed corpus, and config that moves no payload."""

import random
import string

import pytest
from pyspark.sql import functions as F

from siftline.config import CurationConfig, SourceConfig
from siftline.operators.keyword_match import containing, keyword_table, with_matches, without
from siftline.plans.sweep_run import RAW_FETCH, items_from_raw
from siftline.sources.corpus import corpus_search
from siftline.sources.corpus_index import CorpusIndex


def _texts(n=80, seed=2):
    rng = random.Random(seed)
    alphabet = "abcAB é\n.'%"
    return [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(n)] + [(n, None), (n + 1, "")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_matches_equal_containment(spark, block_bytes):
    rng, rows = random.Random(3), _texts()
    kws = ["".join(rng.choice("abcB é.'%") for _ in range(rng.randrange(1, 4))) for _ in range(150)] + ["", "AB", "ab"]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "id int, text string, ord int")
    got = {r.id: [x.keyword for x in r.matches] for r in with_matches(df, "text", keyword_table(spark, kws), block_bytes=block_bytes).collect()}
    order = list(dict.fromkeys(k.lower() for k in kws))
    assert got == {i: [k for k in order if k in (t or "").lower()] for i, t in rows}


def test_few_and_many_keywords_agree(spark):
    rows = spark.createDataFrame(_texts(), "id int, text string")
    for kws in (["ab", "É", "c."], ["ab", "É", "c."] + ["zz" + c + d for c in string.ascii_letters for d in "0123"]):
        assert len(kws) == 3 or len(kws) > 32
        got = {r.id: r.m for r in containing(rows, "text", kws, "m").collect()}
        want = {i: "|".join(k for k in ("ab", "é", "c.") if k in (t or "").lower()) for i, t in _texts()}
        assert got == {i: m for i, m in want.items() if m}
        assert {r.id for r in without(rows, "text", kws).collect()} == {i for i, m in want.items() if not m}


def test_the_plan_does_not_grow_with_the_keywords(spark):
    rows = spark.createDataFrame(_texts(), "id int, text string")
    sizes = []
    for n in (10, 10_000):
        df = with_matches(rows, "text", spark.range(n).select(F.col("id").alias("ord"), F.concat(F.lit("kw"), "id").alias("keyword")))
        sizes.append(len(df._jdf.queryExecution().toString()))
    assert abs(sizes[0] - sizes[1]) < 400           # ids differ in digits


@pytest.mark.parametrize("kws", [("ab", "a b", "c. a"), ("", "x"), (" ", "b c a"), ("B É",), ("nowhere", "no where"), ()])
def test_indexed_search_equals_the_scan(spark, tmpdir_path, kws):
    rng = random.Random(5)
    words = ["ab", "a", "b", "c.", "cab", "É", "bé", "", "x\ny"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(12))), rng.choice(["en", "de", "fr", None]), rng.randrange(50))
            for i in range(150)] + [(150, None, "en", 3)]
    corpus = spark.createDataFrame(rows, "doc long, text string, lang string, day long")
    index = CorpusIndex(f"{tmpdir_path}/index", buckets=16).build(corpus, "doc", ["text"], "lang", "day")
    found = index.matches(spark, kws, ["en", "de"])
    want = corpus_search(corpus, kws, ["en", "de"], ["text"], "lang", "day", max_results=1000)
    assert sorted((r.doc, r.category, r.recency, r.matched) for r in found.collect()) == \
        sorted((r.doc, r.lang, r.day, r.matched) for r in want.collect())
    top = index.search(spark, kws, ["en", "de"], max_results=8, sweep_type="light").collect()
    assert len(top) <= 4 and [r.recency for r in top] == sorted((r.recency for r in top), reverse=True)


def test_a_search_reads_its_buckets_only(spark, tmpdir_path):
    corpus = spark.range(200).select("id", F.concat(F.lit("common word"), "id").alias("text"), F.lit("en").alias("lang"))
    index = CorpusIndex(f"{tmpdir_path}/index", buckets=32).build(corpus, "id", ["text"], "lang", "id")
    files = [f for f in index.matches(spark, ["common word17"], ["en"]).inputFiles() if "/postings/" in f]
    assert files and len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 12       # words that begin with word17, and common
    assert index.search(spark, ["common word17"], ["en"]).count() == 11


def test_the_index_moves_a_row_a_word_and_block(spark, tmpdir_path):
    corpus = spark.range(300, numPartitions=1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200)), lambda k: F.concat(
        F.lit("w"), (k * 7 + F.col("id")) % 100)), " ").alias("text"), F.lit("en").alias("lang"))
    index = CorpusIndex(f"{tmpdir_path}/index", buckets=4).build(corpus, "id", ["text"], "lang", "id")
    rows = spark.read.parquet(f"{tmpdir_path}/index/postings")
    assert rows.count() == 100                       # of 60,000 words, 30,000 of them different ones of a text
    assert rows.agg(F.sum(F.size("doc")), F.sum(F.size("at"))).first() == (30_000, 60_000)
    for kws in (["w5"], ["w12 w19 w26"], ["w99 w6", "w3 w4"]):
        got = {(r.doc, r.matched) for r in index.matches(spark, kws, ["en"]).collect()}
        assert got == {(r.id, r.matched) for r in corpus_search(corpus, kws, ["en"], ["text"], "lang", "id", max_results=1000).collect()}


def test_rows_without_an_id_category_or_text_stay(spark, tmpdir_path):
    corpus = spark.createDataFrame([(None, "a b", "en", 1), (1, None, "en", None), (2, "a b a", None, 2), (3, "", "de", 3), (4, "b a b", "en", 4)],
                                   "doc long, text string, lang string, day long")
    index = CorpusIndex(f"{tmpdir_path}/index", buckets=4).build(corpus, "doc", ["text"], "lang", "day")
    at = spark.read.parquet(f"{tmpdir_path}/index/postings")
    assert at.agg(F.sum(F.size("at"))).first()[0] == 2 + 1 + 3 + 1 + 3
    got = index.matches(spark, ["a b", ""], ["en", "de"]).collect()
    assert sorted((r.doc or 0, r.recency or 0, r.matched) for r in got) == [(0, 1, "a b|"), (1, 0, ""), (3, 3, ""), (4, 4, "a b|")]


def test_payloads_are_not_moved_for_config(spark):
    raw = spark.createDataFrame([], RAW_FETCH)
    cfg = CurationConfig(sources=(SourceConfig("arxiv"), SourceConfig("rss", domain="d")),
                         source_keys=tuple(("rss", f"feed{k}", f"d{k}") for k in range(300)))
    items, fetches = items_from_raw(raw, cfg, spark)
    for df in (items, fetches):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [ln for ln in plan.splitlines() if "Exchange hashpartitioning(source_type" in ln]
        assert "SortMergeJoin [source_type" not in plan
