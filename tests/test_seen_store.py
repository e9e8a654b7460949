"""First sightings in bucketed generations, the manifest that makes runs whole,
and the stream that decides by them."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siftline.config import CurationConfig, SourceConfig
from siftline.operators import scoring as sc
from siftline.plans import sweep_run
from siftline.plans.sweep_run import health_panels, run_sweeps
from siftline.sinks.logs import LogStore
from siftline.sinks.seen import FirstSeen
from siftline.streaming import sweeps as sw

T0 = datetime(2024, 1, 1, 7)
ITEM = ("sweep_id long, sweep_ts timestamp, source_type string, seq long, item_id string, title string, url string, "
        "summary string, source string, domain string, published string")


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "item_id string, first_seen timestamp, tag string")


def _items(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "item_id string")


def _bytes(df):
    return sum(os.path.getsize(f.replace("file://", "").replace("file:", "")) for f in df.inputFiles())


def test_lookup_finds_all_and_merges(spark, tmpdir_path):
    index, gens, want = FirstSeen(tmpdir_path, bucket_rows=50), [], {}
    for run in range(5):
        rows = [(f"i{run * 37 + k}", T0 + timedelta(hours=run), f"t{run}") for k in range(60)]
        for i, ts, tag in rows:
            want.setdefault(i, set()).add((ts, tag))
        gens = index.add(spark, gens, _pairs(spark, rows))
    assert len(gens) < 5 and sum(g["rows"] for g in gens) == 300 and max(g["buckets"] for g in gens) > 1
    asked = [f"i{k}" for k in range(0, 300, 7)]
    got = {}
    for r in index.lookup(spark, gens, _items(spark, asked + asked)).collect():
        got.setdefault(r.item_id, set()).add((r.first_seen, r.tag))
    assert got == {i: want[i] for i in asked if i in want}
    late = index.lookup(spark, gens, _items(spark, asked), since=F.lit(T0 + timedelta(hours=2))).collect()
    assert {(r.item_id, r.tag) for r in late} == {(i, t) for i in asked for ts, t in want.get(i, ()) if ts > T0 + timedelta(hours=2)}
    assert all(r.tag != "t3" for r in index.lookup(spark, gens, _items(spark, asked), ["t3"]).collect())
    assert index.lookup(spark, [], _items(spark, asked)).collect() == []


def test_a_merge_leaves_dead_tags_behind(spark, tmpdir_path):
    index, gens = FirstSeen(tmpdir_path), []
    for run in range(4):
        gens = index.add(spark, gens, _pairs(spark, [(f"i{run}", T0, f"t{run}")]), dead=["t1"])
    assert [g["rows"] for g in gens] == [3]
    assert {r.item_id for r in index.lookup(spark, gens, _items(spark, [f"i{k}" for k in range(4)])).collect()} == {"i0", "i2", "i3"}


def test_bytes_read_stay_flat_while_the_store_grows(spark, tmpdir_path):
    """A sweep of 8 items, 2 of them known, against stores of 600 and 6,000."""
    read, found = [], []
    for size in (600, 6_000):
        index = FirstSeen(f"{tmpdir_path}/{size}", bucket_rows=50)
        gens = index.add(spark, [], spark.range(size).select(
            F.sha2(F.col("id").cast("string"), 256).alias("item_id"), F.lit(T0).alias("first_seen"), F.lit("t").alias("tag")))
        ids = [r.x for r in spark.range(2).select(F.sha2(F.col("id").cast("string"), 256).alias("x")).collect()]
        rows = index.lookup(spark, gens, _items(spark, ids + [f"new{k}" for k in range(6)]))
        whole = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{tmpdir_path}/{size}/pairs") for f in fs if f.endswith(".parquet"))
        read.append((_bytes(rows), whole))
        found.append(rows.count())
    assert found == [2, 2]
    assert read[1][0] < 1.5 * read[0][0] and read[1][1] > 8 * read[0][1]
    assert read[1][0] < read[1][1] / 20


def _row(sweep, seq, item):
    return (sweep, T0 + timedelta(hours=20 * sweep), item, seq)


def _loop(rows, hours=48):
    first = {}
    for s, ts, item, seq in rows:
        first[item] = min(first.get(item, ts), ts)
    return sorted((s, item, seq, first[item], ts == first[item] or first[item] <= ts - timedelta(hours=hours))
                  for s, ts, item, seq in rows)


@pytest.mark.parametrize("order", ["rising", "falling"])
def test_the_stream_decides_in_any_order(spark, tmpdir_path, order):
    rng = random.Random(4)
    rows = [_row(s, 100 * s + k, f"i{rng.randrange(30)}") for s in range(1, 5) for k in range(12)]
    sweeps = list(range(1, 5))
    if order == "falling":
        sweeps.reverse()
    schema = spark.createDataFrame(rows, "sweep_id long, sweep_ts timestamp, item_id string, seq long").schema
    for s in sweeps:                                  # one micro-batch a sweep, a restart between
        spark.createDataFrame([r for r in rows if r[0] == s], schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/landing")
        sw.dedup_stream(spark, f"{tmpdir_path}/landing", schema, f"{tmpdir_path}/out", f"{tmpdir_path}/ck", per_trigger=1)
    got = sorted((r.sweep_id, r.item_id, r.seq, r.first_seen, r.kept) for r in sw.dedup_emitted(spark, f"{tmpdir_path}/out").collect())
    assert got == _loop(rows)
    emitted = spark.read.parquet(f"{tmpdir_path}/out/decisions")
    if order == "rising":                             # nothing had to be emitted twice
        assert emitted.count() == len(rows)
        assert sorted((r.seq, r.kept) for r in emitted.collect()) == sorted((seq, k) for _, _, seq, _, k in _loop(rows))


def _sweep(spark, s, items):
    rows = [(s, T0 + timedelta(days=s), "rss", k, i, "t", f"http://x/{i}", "s", "rss", "d", "") for k, i in enumerate(items)]
    return (spark.createDataFrame(rows, ITEM),
            spark.createDataFrame([(s, T0 + timedelta(days=s), "full")], "sweep_id long, sweep_ts timestamp, sweep_type string"))


def test_a_run_that_breaks_off_leaves_nothing(spark, tmpdir_path, monkeypatch):
    store = LogStore(tmpdir_path + "/logs")
    cfg = CurationConfig(sources=(SourceConfig("rss"),), digest_dir=tmpdir_path + "/md")
    scorer = sc.keyword_scorer(["t"])
    run_sweeps(spark, *_sweep(spark, 1, ["a", "b"]), cfg, store, scorer=scorer)
    names = ("items", "curated", "items_seen", "score_log", "quality_delta", "digests", "digest_log", "warnings")
    before = {n: sorted(map(str, store.read(spark, n).collect())) for n in names}

    def broken(*args, **kwargs):
        raise RuntimeError("lost")
    for where, sweep, ids in (("digest_files", 2, ["a", "d"]), ("record_seen", 1, ["c"])):      # a new one, and one again
        with monkeypatch.context() as m:
            m.setattr(sweep_run, where, broken)
            with pytest.raises(RuntimeError, match="lost"):
                run_sweeps(spark, *_sweep(spark, sweep, ids), cfg, store, scorer=scorer)
    assert {n: sorted(map(str, store.read(spark, n).collect())) for n in names} == before
    assert [r.total_scored for r in health_panels(spark, store)["source_quality"].collect()] == [2]
    run_sweeps(spark, *_sweep(spark, 2, ["a", "d"]), cfg, store, scorer=scorer)
    assert {r.item_id for r in store.read(spark, "curated", [2]).collect()} == {"d"}
    assert {r.item_id for r in store.read(spark, "items_seen").collect()} == {"a", "b", "d"}


def test_two_writers_do_not_go_unnoticed(spark, tmpdir_path, monkeypatch):
    store = LogStore(tmpdir_path + "/logs")
    df = spark.createDataFrame([(1, 0, "rss", "w")], "sweep_id long, ord long, source_type string, warning string")
    store.replace(spark, df, "warnings", [1])
    stale = store._manifest(spark)
    store.replace(spark, df, "warnings", [2])
    monkeypatch.setattr(LogStore, "_manifest", lambda self, spark: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        store.replace(spark, df, "warnings", [3])


def test_old_partitions_go_one_commit_later(spark, tmpdir_path):
    store = LogStore(tmpdir_path + "/logs")
    df = spark.createDataFrame([(1, 0, "rss", "w")], "sweep_id long, ord long, source_type string, warning string")
    frames = [store.replace(spark, df, "warnings", [1]) for _ in range(3)]
    assert frames[1].count() == frames[2].count() == 1          # the last but one is still there
    runs = os.listdir(f"{tmpdir_path}/logs/warnings/sweep_id=1")
    assert len([r for r in runs if r.startswith("run=")]) == 2


def _prompts(spark, n):
    return spark.createDataFrame([(1, b, 2, f"prompt {b}") for b in range(n)], "sweep_id long, batch long, n_items long, prompt string")


def _ask(spark, store, prompts, scorer):
    got = sweep_run.answered(prompts, store, spark, [1], scorer, "", "")
    return {r.batch: r.response for r in got.collect()}


GOOD = '[{"idx": 0, "score": 3}]'


def test_failed_attempts_are_asked_again(spark, tmpdir_path):
    store, folder = LogStore(tmpdir_path + "/logs"), tmpdir_path

    def scorer(batches):
        for pdf in batches:
            out = []
            for b in pdf["batch"]:
                path = f"{folder}/asked-{b}"
                with open(path, "a") as f:
                    f.write("x")
                asked = os.path.getsize(path)
                if b == 2 and len(pdf) > 1:
                    raise TimeoutError("slow")
                if b == 4:
                    raise ValueError("never")
                out.append({0: GOOD, 1: "rubbish" if asked == 1 else GOOD, 2: GOOD, 3: '[{"score": 3}]'}[b])
            pdf["response"] = out
            yield pdf
    prompts = _prompts(spark, 5).coalesce(1)
    assert _ask(spark, store, prompts, scorer) == {0: GOOD, 1: GOOD, 2: GOOD}
    log = store.read(spark, "responses")
    tries = {r.batch: r.n for r in log.groupBy("batch").agg(F.max("attempt").alias("n")).collect()}
    assert tries == {0: 1, 1: 1, 2: 1, 3: 3, 4: 3} or tries == {0: 1, 1: 2, 2: 1, 3: 3, 4: 3}
    assert {r.error for r in log.where("batch = 4").collect()} == {"ValueError: never"}
    again = _ask(spark, store, prompts, lambda batches: (p.assign(response=GOOD) for p in batches))
    assert again == {b: GOOD for b in range(5)}                  # the next run asks the failed ones anew
    assert store.read(spark, "responses").where("usable").groupBy("batch").count().where("count > 1").count() == 0


def test_scorers_that_answer_twice_or_not_at_all(spark, tmpdir_path):
    import pandas as pd
    store = LogStore(tmpdir_path + "/logs")

    def scorer(batches):
        for pdf in batches:
            own = pdf[pdf["batch"] != 1]
            yield pd.concat([own.assign(response=GOOD), own.assign(response="no"), own.assign(batch=99, response=GOOD)])
    assert _ask(spark, store, _prompts(spark, 3), scorer) == {0: GOOD, 2: GOOD}


@pytest.mark.parametrize("text,ok", [
    ("x " + GOOD + " y", True), ("[]", True), ("", False), (None, False), ("[1, 2", False), ('[{"score": 3}]', False),
    ('[{"idx": 0}]', False), ('[{"idx": 7}]', True), ('[{"idx": 0}, {"idx": 0, "score": 1}]', True),
    ('[{"idx": 0, "score": 1}, {"idx": 0}]', False), ('[{"idx": 1, "score": 1}, {"idx": 5}]', True)])
def test_usable_answers(spark, text, ok):
    df = spark.createDataFrame([(text, 2)], "t string, n long")
    assert df.select(sc.usable_answer(F.col("t"), F.col("n")).alias("x")).first().x is ok


def test_checkpoints_bound_what_panels_read(spark, tmpdir_path):
    from siftline.operators import folds as fl
    store = LogStore(tmpdir_path + "/logs")

    def add(s, n, every=4):
        run = store.begin()
        df = spark.createDataFrame([("a", s, n, 1, 0), (f"s{s % 3}", s, 2, 2, 1)],
                                   "source string, sweep_id long, total_scored long, scored_3plus long, scored_4plus long")
        run.replace(spark, df, "quality_delta", [s])
        run.checkpoint(spark, "quality_delta", fl.sum_source_counts, every)
        run.commit(spark)

    def state(upto=None):
        rows = fl.sum_source_counts(store.deltas(spark, "quality_delta", upto)).collect()
        plain = store.read(spark, "quality_delta").where(F.lit(True) if upto is None else F.col("sweep_id") <= upto)
        want = fl.sum_source_counts(plain).collect()
        assert sorted(map(str, rows)) == sorted(map(str, want))
        return {r.source: r.total_scored for r in rows}

    def files(upto=None):
        return len(store.deltas(spark, "quality_delta", upto).inputFiles())
    for s in range(10, 20):
        add(s, s)
        assert files() <= 5                                  # a checkpoint and at most three sweeps, in whatever files
    assert state()["a"] == sum(range(10, 20)) and state(16)["a"] == sum(range(10, 17))
    add(12, 500)                                             # a rerun: later checkpoints end
    assert state()["a"] == sum(range(10, 20)) + 488 and state(16)["a"] == sum(range(10, 17)) + 488
    add(5, 1000, every=99)                                   # a late sweep
    assert state()["a"] == sum(range(10, 20)) + 1488 and state(11)["a"] == 1021
