"""Operators 11 to 13: phrase streams, exact products and lexical ranking by
buckets of like length, each against a brute-force version."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from siftline.llm import lexical_search as ls
from siftline.llm import norm_buckets as nb
from siftline.llm import phrase_streams as ps
from siftline.llm import product_search as px

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------- operator 11

def brute_phrases(rows, max_words=3, min_count=10, containment=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    out = []
    for (lang, words), a in found.items():
        if any(g == lang and len(longer) > len(words) and 100 * b >= containment * a
               and any(longer[i:i + len(words)] == words for i in range(len(longer)))
               for (g, longer), b in found.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(words), a, left, right, n[lang], score))
    res = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        res += [(r[0], i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(res)


def phrase_rows(seed=3, n=300):
    rng = np.random.default_rng(seed)
    words = ["alpha", "Beta", "gam\x01ma", "dél", "É", "x", "und", "of", "a\x1fb", "zz"]
    rows = []
    for i in range(n):
        parts = [words[k] for k in np.minimum(rng.geometric(0.35, rng.integers(0, 60)) - 1, 9)]
        seps = [[" ", "  ", "\t", ". ", ",", "\n", " ! "][k] for k in rng.choice(7, len(parts), p=[.7, .05, .05, .05, .05, .05, .05])]
        rows.append(("".join(p + s for p, s in zip(parts, seps)), ["en", "de", None, "und"][i % 4]))
    return rows + [(None, "en"), ("", "en"), (" \t . ", None), ("of " * 4000, "hot"), ("one. two", "few")]


@pytest.mark.parametrize("range_rows,max_words,containment", [(50_000, 3, 50), (7, 3, 50), (3, 4, 80), (5, 2, 50)])
def test_phrases_equal_brute_force(spark, range_rows, max_words, containment):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, g, 1, "w") for t, g in rows], "text string, lang string, f long, words string").repartition(3)
    got = ps.mine_phrases(docs, max_words, 10, containment, 2000, range_rows).collect()
    want = brute_phrases(rows, max_words, 10, containment)
    assert sorted(tuple(r) for r in got) == want and len(want) > 20


def test_phrases_of_small_blocks_and_top(spark):
    rows = phrase_rows(5, 120)
    docs = spark.createDataFrame(rows, "text string, lang string")
    small = ps.count_phrases(docs, 3, 10, block_bytes=500, part_bytes=300)
    large = ps.count_phrases(docs, 3, 10)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert sorted(tuple(r) for r in ps.mine_phrases(docs, top=4).collect()) == brute_phrases(rows, top=4)


def test_too_many_words_for_one_number():
    rng = np.random.default_rng(1)
    codes, of = rng.integers(0, 40, 500), np.sort(rng.integers(0, 3, 500)).astype(np.int32)
    one, two = ps.prefix_order(of, codes, 7, 40, 3), ps.prefix_order(of, codes, 7, 1 << 31, 3)
    assert all((a == b).all() for a, b in zip(one, two))


def test_phrases_of_empty_tables(spark, no_docs):
    assert ps.mine_phrases(no_docs).collect() == []
    assert ps.mine_phrases(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []


# ------------------------------------------------------------------- operator 12

def brute_products(rows, divisor, k, scale=256.0):
    v = {}
    for i, x in rows:
        if i is None or not x or any(c is None or not math.isfinite(c) or not math.isfinite(scale * c) for c in x):
            continue
        v.setdefault((i, tuple(math.floor(Fraction(scale * c)) for c in x)), None)
    out = []
    for q in sorted({i for i, _ in v if i % divisor == 0}):
        best = set()
        for (i, x) in v:
            if i == q:
                best |= {(-sum(a * b for a, b in zip(x, y)), j) for j, y in v if j != q and len(x) == len(y)}
        out += [(q, r, j, -s) for r, (s, j) in enumerate(sorted(best)[:k], 1)]
    return out


@pytest.mark.parametrize("spread,bucket_rows", [(0.05, 64), (3.0, 64), (0.0, 512)])
def test_products_equal_brute_force(spark, spread, bucket_rows):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(12, 16))
    rows = [(int(i), [float(c) for c in base[i % 12] * (1 + rng.exponential(spread)) + rng.normal(scale=0.01, size=16)])
            for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]                    # a hot vector, all ties
    got = px.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), 50, 5,
                          bucket_rows=bucket_rows, block_rows=4).collect()
    assert sorted(tuple(r) for r in got) == brute_products(rows, 50, 5)


def test_products_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [0.0, 0.0]), (50, [-1.0, -3.0]), (8, [1.0, 2.0, 3.0]), (100, [2.0, 2.0, 2.0]), (0, [1.0, 2.0]), (9, [1e307, 1.0]),
            (None, [1.0, 1.0]), (10, [1.0, 2.0]), (-50, [3.0, 0.25]), (150, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    assert sorted(tuple(r) for r in px.top_products(df).collect()) == sorted(brute_products(rows, 50, 5))
    assert px.top_products(df.where("vec_id = 1")).collect() == []
    assert px.top_products(df.limit(0)).collect() == []


def test_products_beyond_doubles(spark):
    """Scores that neither single nor double precision holds."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(scale=2.0 ** 20, size=6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in px.top_products(df, 10, 5, bucket_rows=16).collect()) == brute_products(rows, 10, 5)
    big = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [1e30, 3.0])]
    got = px.top_products(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, (1 << 63) - 1), (2, (1 << 63) - 1)]


def test_coordinates_prune_and_lose_nothing():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(3000, 8)) * 100)
    bucket, _ = px.pack(pa.table({"embedding": [list(r / 256) for r in x], "vec_id": np.arange(3000)}), 256.0)
    q = px.Queries(np.array([-1]), x[:1] + 1, 5)
    exact = np.sort(x @ q.x[0])[::-1]
    q.best.theta[0] = exact[4]
    c = float(exact[4] / (q.size[0] * bucket["size"][0]))
    near = q._by_coordinate(0, c, bucket)
    assert set(bucket["ids"][near]) >= set(np.flatnonzero(x @ q.x[0] >= exact[4])) and len(near) < 1500


# ------------------------------------------------------------------- operator 13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_ranks(docs, items, k):
    d = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    d = [x for x in d if x[1]]
    n_docs, n_terms = len(d), sum(sum(c.values()) for _, c in d)
    df = Counter(t for _, c in d for t in c)
    own = {}
    for i, t in items:
        if i is not None:
            own.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in own.items():
        rows = []
        for i, c in d:
            n, s = sum(c.values()), 0
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            for t in terms & set(c):
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0 and i is not None:
                rows.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out)


def lexical_rows(n=260):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(150)] + ["Éa", "ÀB", "x-y", "naïve"]
    text = lambda size: " ".join(words[k] for k in np.minimum(rng.zipf(1.4, size), len(words)) - 1)
    docs = [(i, text(rng.integers(1, 80))) for i in range(n)]
    docs += [(900 + i, "w1 w1 w2 w50") for i in range(40)]                 # ties
    docs += [(950, None), (951, ""), (952, " -- "), (None, "w50 w51"), (953, "W60 " * 3000), (953, "w60 w61"), (954, "w1"), (954, "w1")]
    items = [(i, text(rng.integers(1, 30))) for i in range(25)] + [(30, None), (31, "nothing known"), (32, "w50"), (32, "w51"), (None, "w1")]
    return docs, items


@pytest.mark.parametrize("bucket_rows,block_bytes", [(16, 8 << 20), (2048, 700)])
def test_ranks_equal_brute_force(spark, bucket_rows, block_bytes):
    docs, items = lexical_rows()
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n long, score long").repartition(4)
    b = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int")
    got = ls.rank_documents(d, b, 10, bucket_rows, items_a_block=4, block_bytes=block_bytes).collect()
    assert sorted(tuple(r) for r in got) == brute_ranks(docs, items, 10)


def test_ranks_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ls.rank_documents(d.limit(0), b).collect() == [] and ls.rank_documents(d, b.limit(0)).collect() == []
    assert [tuple(r) for r in ls.rank_documents(d, b).collect()] == brute_ranks([(1, "a b")], [(1, "a")], 10)


def test_groups_are_left_out_by_their_length(spark, tmp_path):
    """Vectors too short for every query are never opened."""
    rows = [(i, [float(100 if i < 64 else 1), float(i % 7)]) for i in range(640)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in px.top_products(df, 50, 5, bucket_rows=8).collect()) == brute_products(rows, 50, 5)
    best = nb.Best(1, 2)
    best.offer(0, np.array([5, 3, 9]), np.array([7, 7, 8]))
    assert best.rows[0] == [(-8, 9), (-7, 3)] and best.theta[0] == 7
