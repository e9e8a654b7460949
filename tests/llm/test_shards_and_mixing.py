"""Operators 3 and 9."""

import heapq
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.llm import lpt_shards as lpt
from siftline.llm import soft_mixing as mx


@pytest.mark.parametrize("groups", [0, 1, 23, 24, 97, 1000, 12_345])
def test_a_class_at_once_equals_one_group_at_a_time(groups):
    rng = np.random.default_rng(groups)
    loads = [float(x) for x in rng.integers(0, 5000, 24)]
    heap, want = [(x, k) for k, x in enumerate(loads)], [0] * 24
    heapq.heapify(heap)
    for _ in range(groups):
        x, k = heap[0]
        heapq.heapreplace(heap, (x + 137.0, k))
        want[k] += 1
    assert lpt.place(loads, 137.0, groups) == want
    assert sorted(loads) == sorted(x for x, _ in heap)


def checked(rows, texts):
    """The contract's laws; shard loads."""
    slots, shard_of, loads = defaultdict(list), {}, Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24
        assert shard_of.setdefault(r.text_crc32, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    return loads


def test_shards_are_near_equal(spark, documents):
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    loads = checked(lpt.shard_by_size(documents).collect(), texts)
    plain = sorted((n * (len(t.encode()) + 8) for t, n in Counter(t for _, t in texts).items()), reverse=True)
    heap = [0] * 24
    for s in plain:
        heapq.heapreplace(heap, heap[0] + s)
    assert max(loads.values()) <= max(heap) * 1.001


def test_a_third_of_copies_stays_together(spark):
    rows = [(i, "copy") if i % 3 == 0 else (i, f"text {i} " + "x" * (i % 50)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    loads = checked(lpt.shard_by_size(df, salts=8).collect(), rows)
    rest = sorted(loads.values())[:-1]
    assert rest[-1] - rest[0] <= 80


def test_shard_edge_cases(spark, edge_docs, no_docs):
    checked(lpt.shard_by_size(edge_docs).collect(), [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert lpt.shard_by_size(no_docs).count() == 0


def test_size_classes_are_few(spark):
    sizes = spark.range(1, 2_000_000).select(F.col("id").alias("s")).unionByName(
        spark.range(0, 50).select(F.pow(F.lit(2.0), F.col("id")).cast("long").alias("s")))
    worst = sizes.withColumn("c", lpt.size_class(F.col("s"))).select(
        F.max((F.col("s") - F.col("c")) / F.col("s")).alias("w"), F.min(F.col("s") - F.col("c")).alias("low"),
        F.max(F.when(F.col("s") < 4096, F.col("s") - F.col("c"))).alias("exact")).first()
    assert worst.w <= 1 / 1024 and worst.low == 0 and worst.exact == 0


# ---------------------------------------------------------------------- mixing

def brute_rates(n, p, want, ridge=1e-3, rounds=100):
    r, share = np.ones(len(n)), n / n.sum()
    have = (share[:, None] * p).sum(axis=0)
    for _ in range(rounds):
        off = (share[:, None] * p * r[:, None]).sum(axis=0) - want
        if np.abs(off).max() < 1e-4:
            break
        step = 1 / (1 + ridge)
        r = np.maximum(0, r * (1 - step * ridge) + step * ridge - step * (p * (off / have)).sum(axis=1))
    return r


def test_rates_equal_a_plain_projected_gradient(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([2, 1, 1], 400)
    n = rng.integers(0, 500, 400)
    df = spark.createDataFrame([(i, int(k), *map(float, q)) for i, (k, q) in enumerate(zip(n, p))],
                               "doc_id long, n_tokens long, p_high double, p_low double, p_toxic double")
    want = {"high": 0.5, "low": 0.3, "toxic": 0.2}
    got = {r.doc_id: r.rate for r in mx.fit_rates(df, want).collect()}
    rates = np.array([got[i] for i in range(400)])
    assert np.allclose(rates, brute_rates(n, p, np.array([0.5, 0.3, 0.2])), atol=1e-6)
    totals = (n[:, None] * p * rates[:, None]).sum(axis=0) / n.sum()
    assert np.abs(totals - [0.5, 0.3, 0.2]).max() < 0.01 and rates.min() >= 0


def test_unreachable_targets_leave_rates_at_the_nearest(spark):
    df = spark.createDataFrame([(i, 10, 0.5, 0.3, 0.2) for i in range(20)],
                               "doc_id long, n_tokens long, p_high double, p_low double, p_toxic double")
    rates = [r.rate for r in mx.fit_rates(df, {"high": 1.0, "low": 0.0, "toxic": 0.0}).collect()]
    assert max(rates) - min(rates) < 1e-9 and 0 < rates[0]


@pytest.fixture(scope="module")
def labelled(spark):
    good, bad = "ein gutes wort nach dem anderen hier".split(), "scum idiot loser".split()
    rows, labels = [], []
    for i in range(300):
        kind = i % 3
        words = [good[(i * 7 + k) % len(good)] + str((i + k) % 9) for k in range(20)]
        if kind == 1:
            words = [w + "***" for w in words]
        if kind == 2:
            words[3:6] = bad
        rows.append((i, " ".join(words)))
        if i < 240:
            labels.append((i, int(kind != 1), int(kind == 2)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents_get_their_domain(labelled):
    docs, labels = labelled
    rows = [r for r in mx.posteriors(docs, labels).collect() if r.doc_id >= 240]
    right = [max(("p_high", "p_low", "p_toxic"), key=lambda c: r[c]) == ("p_high", "p_low", "p_toxic")[r.doc_id % 3]
             for r in rows]
    assert len(rows) == 60 and np.mean(right) > 0.95
    assert all(abs(r.p_high + r.p_low + r.p_toxic - 1) < 1e-9 for r in rows)


def test_mixing_changes_how_often_documents_occur(labelled):
    docs, labels = labelled
    rates = {r.doc_id: r for r in mx.mix_rates(docs, labels, {"high": 0.8, "low": 0.15, "toxic": 0.05}).collect()}
    out = mx.mix(docs, labels, {"high": 0.8, "low": 0.15, "toxic": 0.05})
    assert out.columns == docs.columns
    times = Counter(r.doc_id for r in out.collect())
    assert all(times[i] == r.copies for i, r in rates.items())
    of = [np.mean([times[i] for i in range(300) if i % 3 == k]) for k in range(3)]
    assert of[0] > 1.5 and of[2] < 0.5


def test_the_registered_targets_are_asked_for_and_reached(labelled):
    docs, labels = labelled
    trace = []
    rows = mx.mix_rates(docs, labels, trace=trace).collect()
    n = sum(r.n_tokens for r in rows)
    totals = [sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows) / n for d in mx.DOMAINS]
    assert np.abs(np.array(totals) - [0.77, 0.18, 0.05]).max() < 0.01
    assert 1 < len(trace) <= 100


def test_mixing_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(0, None, None), (0, 1, 1), (None, 1, 0), (1, 1, 0), (99, 0, 1), (2, 0, None)],
                                   "doc_id long, quality int, toxic int")
    got = mx.mix_rates(edge_docs, labels).collect()
    assert len(got) == edge_docs.select("doc_id", "text").distinct().count()
    assert all(r.rate >= 0 and abs(r.p_high + r.p_low + r.p_toxic - 1) < 1e-9 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {0}
    mixed = mx.mix(edge_docs, labels)
    assert mixed.columns == edge_docs.columns
    mixed.collect()
    none = spark.createDataFrame([], labels.schema)
    assert all(abs(r.p_high - 1 / 3) < 1e-9 for r in mx.mix_rates(edge_docs, none).collect())
    assert mx.mix_rates(no_docs, labels).count() == 0 and mx.mix(no_docs, none).count() == 0
