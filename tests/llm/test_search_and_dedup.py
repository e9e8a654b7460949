"""Operators 5, 6 and 7 against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.llm import hnsw_search as hn
from siftline.llm import hyperminhash_dedup as hm
from siftline.llm import string_tiling as st
from llm_paths import SMALL


# -------------------------------------------------------------------- neighbours

def exact(rows, q, k=5):
    v = dict(rows)[q]
    near = []
    for i, w in rows:
        if i != q and len(w) == len(v):
            a, b = np.array(v, float), np.array(w, float)
            near.append((-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i))
    return [(i, -s) for s, i in sorted(near)[:k]]


def test_recall_and_scores(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    v = df.selectExpr("vec_id", "CAST(embedding AS array<double>) embedding").cache()
    index = hn.build_index(v, 5, shard_rows=120)
    assert index.count() == 5 and sum(r.n for r in index.select("n").collect()) == len(rows)
    got = {}
    for r in hn.search_index(index, v.where("vec_id % 10 = 0"), 5, block_rows=7).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q in [i for i, _ in rows if i % 10 == 0]:
        want, own = exact(rows, q), [got[q][k] for k in range(1, 6)]
        hits += len({i for i, _ in want} & {i for i, _ in own})
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        of = {i: s for i, s in exact(rows, q, len(rows))}
        assert all(abs(of[i] - s) < 1e-12 for i, s in own)
    assert hits / (5 * len(got)) >= 0.95


def test_graph_round_trip_and_links():
    x = np.random.default_rng(1).normal(size=(700, 8))
    g = hn.Graph.build(x, np.c_[np.arange(700), np.full((700, 5), -1)])
    again = hn.Graph.from_bytes(g.to_bytes())
    assert (again.vectors == g.vectors).all() and len(again.levels) == len(g.levels)
    near = g.levels[0][1]
    assert near.shape == (700, 2 * hn.LINKS) and (near < 700).all() and ((near >= 0).sum(axis=1) > 0).all()
    reached, todo = {0}, [0]
    while todo:
        for j in near[todo.pop()]:
            if j >= 0 and j not in reached:
                reached.add(int(j))
                todo.append(int(j))
    assert len(reached) > 690


def test_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0], 9) for i in range(40)] + [
        (50, None, 1), (51, [0.0, 0.0, 0.0], 1), (52, [1.0, None, 2.0], 1), (53, [nan, 1.0, 1.0], 1), (54, [inf, 1.0, 1.0], 1),
        (55, [], 1), (None, [1.0, 2.0, 3.0], 1), (100, [1.0, 2.0, 2.9], 2), (100, [1.0, 2.0, 2.9], 2), (150, [3.0, 1.0], 0),
        (200, [1e-200, 0.0, 1e-200], 0), (201, [-1.0, 0.0, 0.5], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int")
    got = {}
    for r in hn.nearest_of_every(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200]               # 150 has no candidate of its length, 50 no vector
    assert [i for _, i, _ in sorted(got[0])] == [1, 2, 3, 4, 5]
    assert [i for _, i, _ in sorted(got[100])] == [0, 1, 2, 3, 4]
    assert [k for k, _, _ in sorted(got[200])] == [1, 2, 3, 4, 5] and all(-1 <= s <= 1 for _, _, s in got[200])
    assert hn.nearest_of_every(df.limit(0)).count() == 0


# -------------------------------------------------------------- benchmark leaks

def brute_tiles(doc, item, least):
    """The definition: again and again the longest common unmarked run."""
    free_d, free_q, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = 0
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and free_d[a + n] and free_q[b + n]:
                    n += 1
                best = max(best, n)
        if best < least:
            return out
        for a in range(len(doc) - best + 1):
            for b in range(len(item) - best + 1):
                if all(doc[a + n] == item[b + n] and free_d[a + n] and free_q[b + n] for n in range(best)):
                    out.append(best)
                    for n in range(best):
                        free_d[a + n] = free_q[b + n] = False


@pytest.mark.parametrize("seed", range(6))
def test_tiles_equal_the_definition(seed):
    rng = np.random.default_rng(seed)
    item = rng.integers(1, 4 if seed % 2 else 40, 40)
    doc = np.concatenate([rng.integers(1, 40, 9), item[20:], rng.integers(1, 40, 5), item[3:18], item[:9]])
    block = st.Block([(1, " ".join(f"w{x}" for x in item))], 3)
    found = list(block.search(" ".join(f"w{x}" for x in doc)))
    assert len(found) == 1 and sorted(n for _, _, n in found[0][1]) == sorted(brute_tiles(doc.tolist(), item.tolist(), 3))


def test_reordered_passages_are_found_and_clean_ones_left(spark):
    item = [f"term{k}" for k in range(40)]
    common = " ".join(f"plain{k % 50}" for k in range(300))
    docs = [(1, common), (2, common + " " + " ".join(item)), (3, " ".join([*item[20:], "and then", *item[:20]]) + " " + common),
            (4, common + " " + " ".join(item[:8])), (5, " ".join(item).upper().replace(" ", ", ")), (6, None), (7, ""),
            (8, " ".join(item[::-1])), (None, " ".join(item)), (2, common)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(10, " ".join(item), 1), (11, "too short here", 1), (12, None, 1), (13, "", 1)],
                                  "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in st.find_leaks(df, bench).collect()}
    assert set(got) == {(2, 10), (3, 10), (5, 10), (None, 10)}
    assert got[3, 10].n_tiles == 2 and got[3, 10].covered == 40 and got[3, 10].longest == 20
    kept = st.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in kept.collect()) == sorted(
        (i, len(t or "")) for k, (i, t) in enumerate(docs) if k in (0, 3, 5, 6, 7, 9))
    small = st.find_leaks(df, bench, block_bytes=40)              # several passes, the same leaks
    assert {(r.doc_id, r.item_id) for r in small.collect()} == set(got)
    assert st.find_leaks(df, bench.limit(0)).count() == 0 and st.find_leaks(df.limit(0), bench).count() == 0
    assert st.drop_contaminated(df, bench.limit(0)).count() == len(docs)


def test_leaks_equal_a_plain_search(spark, documents):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r.item_id: st.words_of(r.text) for r in bench.collect()}
    want = set()
    for r in documents.collect():
        text = " " + " ".join(st.words_of(r.text)) + " "
        want |= {(r.doc_id, i) for i, w in items.items() if len(w) >= 5 and f" {' '.join(w)} " in text}
    got = {(r.doc_id, r.item_id) for r in st.find_leaks(documents, bench).collect()}
    assert want and want <= got and len(got) <= len(want) + 2


# -------------------------------------------------------------- near-duplicates

def brute_components(rows, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), i if not s else least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def components_of(df, percent):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in hm.near_duplicates(df, percent).collect()), key=repr)


def test_components_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert components_of(documents, 85) == brute_components(rows, 85)


def edited(rng, words, n):
    words = list(words)
    for k in rng.choice(len(words), n, replace=False):
        words[k] = f"new{rng.integers(1 << 30)}"
    return " ".join(words)


def test_a_group_that_only_its_origin_holds_together(spark):
    """Copies are near the text they derive from and too far from each other."""
    rng = np.random.default_rng(5)
    origin = [f"w{k}" for k in range(200)]
    rows = [(k, edited(rng, origin, 3)) for k in range(60)] + [(60, " ".join(origin))] + [(100 + k, "x " * k) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = components_of(df, 85)
    assert got == brute_components(rows, 85)
    assert Counter(c for _, _, c in got)[0] == 61


def test_dedup_edge_cases(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert components_of(edge_docs, 80) == brute_components(rows, 80)
    kept = {(r.doc_id, r.kept) for r in hm.near_duplicates(edge_docs).collect()}
    assert {(0, True), (1, False), (2, False), (3, True), (4, True), (None, False)} <= kept
    out = hm.drop_near_duplicates(edge_docs)
    assert out.columns == edge_docs.columns
    assert {1, 2, 11}.isdisjoint({r.doc_id for r in out.collect()})
    assert hm.near_duplicates(no_docs).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
        b = a.copy()
        n = int(4000 * (1 - share) / (1 + share))
        b[:n] = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(a), np.unique(b)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        near, used = hm.estimate(hm.sketch(a)[None], hm.sketch(b)[None])
        assert used[0] == hm.BUCKETS and abs(near[0] - true) < 5 * np.sqrt(true * (1 - true) / hm.BUCKETS)


@pytest.mark.parametrize("t", [0.8, 0.85, 0.9])
def test_bands_lose_almost_nothing(t):
    r = hm.bands(t)
    assert (1 - t ** r) ** (hm.BUCKETS // r) <= 1e-4


def test_rows_are_dropped_by_id_and_text(spark):
    one, two = (" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b"))
    rows = [(3, two), (5, one), (5, two), (6, one), (None, one), (None, "alone in its group it is"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in hm.drop_near_duplicates(df).collect()}
    assert got == {(3, two), (5, one), (None, "alone in its group it is"), (7, None)}


# ------------------------------------------------- repeated words, hot buckets

@pytest.mark.parametrize("most", [0, 7, 60])
def test_tiles_by_length_equal_tiles_by_seeds(most, monkeypatch):
    rng = np.random.default_rng(8)
    for trial in range(150):
        letters = [chr(97 + k) for k in range(rng.choice([1, 2, 3, 6]))]
        doc = " ".join(rng.choice(letters, rng.integers(3, 60)))
        block = st.Block([(k, " ".join(rng.choice(letters, rng.integers(3, 30)))) for k in range(3)], 3)
        monkeypatch.setattr(st, "MOST_PAIRS", 10 ** 9)
        seeds = {i: t for i, t, _ in block.search(doc)}
        monkeypatch.setattr(st, "MOST_PAIRS", most)
        assert {i: t for i, t, _ in block.search(doc)} == seeds


def test_a_million_repeated_words():
    block = st.Block([(1, "a " * 10_000), (2, "a b " * 3000)], 5)
    got = {i: (t, n) for i, t, n in block.search("a " * 1_000_000)}
    assert got == {1: ([(0, 0, 10_000)], 10_000)}


def test_texts_of_null_ids_are_joined_once(spark):
    """Each class reads its own text, however many rows have no id."""
    rows = [(None, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(60)] + [(7, f"p{k} q r s t u v") for k in range(40)]
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string")
    sketches = hm._signatures(docs, 5).where("key is not null")
    wanted = sketches.groupBy("key").agg(F.min("row").alias("row")).join(sketches, ["key", "row"]).select(
        F.col("row").alias("node"), "key", F.col("doc_id").alias("text_id"), F.col("h").alias("text_h"))
    wanted = hm.cm.staged(wanted, "test-wanted")
    assert hm._sets(docs, wanted, 5).count() == 200          # two equal rows a class
