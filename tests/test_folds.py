"""Closed-form folds against a sequential loop written from the rules."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from siftline.operators import curate as cur
from siftline.operators import digest as dg
from siftline.operators import folds as fl


def _events(n, feeds=6, seed=7):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        ok = rnd.random() < 0.55
        rows.append((f"rss:{rnd.randrange(feeds)}", f"http://f/{i % 3}", t0 + timedelta(minutes=7 * i), i, ok,
                     None if ok else rnd.choice([0, 404, 500]), None if ok else f"e{i}", rnd.randrange(20)))
    return rows


SCHEMA = ("feed_id string, feed_url string, ts timestamp, seq long, ok boolean, status_code int, "
          "error string, item_count int")


def _loop(rows):
    st = {}
    for feed, url, ts, seq, ok, code, err, n in sorted(rows, key=lambda r: (r[2], r[3])):
        s = st.setdefault(feed, dict(feed_url=url, total_fetches=0, total_items=0, last_success=None,
                                     last_failure=None, last_status_code=None, last_error=None,
                                     consecutive_failures=0))
        s["total_fetches"] += 1
        if ok:
            s["total_items"] += n
            s["last_success"] = ts
            s["consecutive_failures"] = 0
        else:
            s["last_failure"], s["last_status_code"], s["last_error"] = ts, code, err
            s["consecutive_failures"] += 1
    return st


def _cmp(got, want):
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        for f in ("feed_url", "total_fetches", "total_items", "last_success", "last_failure",
                  "last_status_code", "last_error", "consecutive_failures"):
            assert g[f] == w[f], (k, f, g[f], w[f])


def test_feed_health_fold_equals_loop(spark):
    rows = _events(400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.feed_id: r.asDict() for r in fl.feed_health_delta(df).collect()}
    _cmp(got, _loop(rows))


def test_feed_health_merge_equals_loop(spark):
    rows = _events(300, seed=3)
    df = spark.createDataFrame(rows, SCHEMA)
    state = None
    for lo in range(0, 300, 70):            # five snapshots merged in time order
        delta = fl.feed_health_delta(df.where((F.col("seq") >= lo) & (F.col("seq") < lo + 70)))
        state = delta if state is None else fl.merge_feed_health(state, delta)
    _cmp({r.feed_id: r.asDict() for r in state.collect()}, _loop(rows))


def test_feed_health_asof_equals_loop(spark):
    rows = _events(300, feeds=4, seed=11)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("sweep_id", F.floor(F.col("seq") / 20).cast("long"))
    sweeps = spark.range(0, 15).withColumnRenamed("id", "sweep_id")
    got = {(r.sweep_id, r.feed_id): (r.consecutive_failures, r.last_error)
           for r in dg.feed_health_asof(fl.feed_health_delta(df, ("feed_id", "sweep_id")), sweeps).collect()}
    want = {}
    for s in range(15):
        st = _loop([r for r in rows if r[3] // 20 <= s])
        for feed, v in st.items():
            if v["consecutive_failures"] >= 3:
                want[(s, feed)] = (v["consecutive_failures"], v["last_error"])
    assert got == want


def test_window_replay_equals_sequential(spark):
    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    # sweeps 3 per day; offsets include exactly 48 h, 47 h 59 min and 49 h
    times = sorted({t0 + timedelta(hours=h) for h in [0, 8, 16, 24, 47, 48, 49, 56, 96, 97, 120, 145]}
                   | {t0 + timedelta(hours=47, minutes=59)})
    rows = []
    seq = 0
    for si, t in enumerate(times):
        for item in rnd.sample(range(12), 6):
            rows.append((si, t, f"i{item}", seq))
            seq += 1
    df = spark.createDataFrame(rows, "sweep_id long, sweep_ts timestamp, item_id string, seq long")
    got = {(r.sweep_id, r.item_id) for r in cur.filter_seen_replay(df, 48).collect()}
    seen, want = {}, set()
    for si, t in enumerate(times):
        for s, tt, item, _ in rows:
            if s != si:
                continue
            first = seen.get(item)
            if first is not None and first > t - timedelta(hours=48):
                continue
            want.add((si, item))
            seen.setdefault(item, t)
    assert got == want


def test_incremental_window_equals_replay(spark):
    t0 = datetime(2024, 1, 1)
    seen = spark.createDataFrame([("a", t0), ("b", t0 - timedelta(hours=48)), ("c", t0 - timedelta(hours=30))],
                                 "item_id string, first_seen timestamp")
    new = spark.createDataFrame([(9, t0 + timedelta(hours=18), x, i) for i, x in enumerate("abcd")],
                                "sweep_id long, sweep_ts timestamp, item_id string, seq long")
    assert sorted(r.item_id for r in cur.filter_seen(new, seen, 48).collect()) == ["b", "c", "d"]
