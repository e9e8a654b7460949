"""Operators 4 and 8."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from siftline.llm import bigru_langid as lid
from siftline.llm import katz_lm as lm


class Brute:
    """The same model by plain dictionaries."""

    def __init__(self, docs):
        self.docs = [(i, (t or "").encode().lower().split() + [b""]) for i, t in docs]
        train = [w for i, w in self.docs if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
        self.u = Counter(x for w in train for x in w)
        self.N, self.V = sum(self.u.values()), len(self.u)
        self.b, self.h = Counter(), Counter()
        for w in train:
            for a, c in zip([None, *w[:-1]], w):
                self.b[a, c] += 1
                self.h[a] += 1
        self.d1, self.d2 = lm.discounts(Counter(self.u.values())), lm.discounts(Counter(self.b.values()))
        free = sum((1 - self.less(self.d1, c)) * c for c in self.u.values())
        self.total = self.N if free > 0 else self.N + 1
        self.unknown = (free if free > 0 else 1) / self.total
        follow = defaultdict(list)
        for (a, c), r in self.b.items():
            follow[a].append((c, r))
        self.alpha = {}
        for a, seen in follow.items():
            f = sum((1 - self.less(self.d2, r)) * r for _, r in seen)
            under = self.h[a] if f > 0 else self.h[a] + 1
            self.alpha[a] = under, (f if f > 0 else 1) / under / (1 - sum(self.p1(c) for c, _ in seen))

    @staticmethod
    def less(d, r):
        return d[r] if r <= lm.KATZ else 1.0

    def p1(self, w):
        return self.less(self.d1, self.u[w]) * self.u[w] / self.total if self.u[w] else self.unknown

    def p(self, a, w):
        if a not in self.alpha:
            return self.p1(w)
        under, alpha = self.alpha[a]
        r = self.b[a, w]
        return self.less(self.d2, r) * r / under if r else alpha * self.p1(w)

    def rows(self):
        for i, w in self.docs:
            yield (i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(self.u[x] > 0 for x in w), self.N,
                   sum(math.log10((self.u[x] + 1) / (self.N + self.V + 1)) for x in w),
                   sum(math.log10(self.p(a, x)) for a, x in zip([None, *w[:-1]], w)))


def same(df, docs, **kw):
    want = sorted(Brute(docs).rows(), key=repr)
    got = sorted((tuple(r) for r in lm.score(df, **kw).collect()), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_scores_equal_brute_force(spark, documents):
    same(documents, [(r.doc_id, r.text) for r in documents.collect()], chunk_chars=60_000, bucket_tokens=8_000)


def test_distributions_sum_to_one(documents):
    m = Brute([(r.doc_id, r.text) for r in documents.collect()])
    words = [*m.u, b"never seen"]
    for a in [None, *list(m.alpha)[:20]]:
        assert abs(sum(m.p(a, w) for w in words) - 1) < 1e-9
    held = [r for r in m.rows() if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)       # better than the add-one base on unseen documents


def test_lm_edge_cases(spark, edge_docs, no_docs):
    same(edge_docs, [(r.doc_id, r.text) for r in edge_docs.collect()], chunk_chars=2_000, bucket_tokens=500)
    assert lm.score(no_docs).count() == 0
    only_held = [(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    df = spark.createDataFrame(only_held, "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score(df).collect()} == {(0, 0, 0.0, 0.0)}


def test_good_turing_discounts():
    n = {r: int(1e6 / r ** 2.5) for r in range(1, 8)}
    d = lm.discounts(n)
    assert d[0] == 1 and all(0 < d[r] < 1 for r in range(1, 6)) and list(d[1:]) == sorted(d[1:])
    assert lm.discounts({}).tolist() == [1.0] * 6
    assert all(0 < x < 1 for x in lm.discounts({1: 5})[1:])


def test_hot_histories_spread_over_buckets():
    v, keys = 1000, np.arange(3 * 1001, 4 * 1001, dtype=np.uint64)
    assert len(set(lm.bucket_of(keys, v, 0, 50))) == 1
    assert len(set(lm.bucket_of(keys, v, 10, 50))) == 50


# -------------------------------------------------------------------- language

@pytest.mark.parametrize("name", ["table", "rec", "cand", "out", "bias"])
def test_gradients_by_differences(name):
    m = lid.BiGRU(["a", "b", "c"], hidden=3)
    for n in m.names():
        setattr(m, n, getattr(m, n).astype(np.float64))
    rows, labels = lid.windows_of([b"abcab", b"cabbage x", b"zz"], 6)[0], np.array([0, 1, 1, 2])
    grads = dict(zip(m.names(), m.gradients(rows, labels)[1]))
    p, g = getattr(m, name), grads[name]
    at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
    p[at] += 1e-3
    up = m.gradients(rows, labels)[0]
    p[at] -= 2e-3
    down = m.gradients(rows, labels)[0]
    assert abs((up - down) / 2e-3 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_pads_leave_states_and_scores_alone():
    m = lid.BiGRU(["a", "b"], hidden=4)
    short, padded = lid.windows_of([b"hello"], 5)[0], lid.windows_of([b"hello"], 9)[0]
    a, b = m.probabilities(short), m.probabilities(padded)
    assert np.allclose(a, b[:5], atol=1e-5)


def test_held_out_languages(spark, documents):
    rows = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    got = lid.identify(documents).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got) and len(held) > 20
    assert np.mean([rows[r.doc_id] == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark, edge_docs, no_docs, documents):
    got = lid.predict(edge_docs, lid.fit(documents, docs_per_lang=40)).collect()
    assert len(got) == edge_docs.count()
    letters = [any(c.isalpha() for c in r.text or "") for r in edge_docs.collect()]
    assert sum(r.lang_pred == "und" for r in got) == len(letters) - sum(letters)
    assert all((r.lang_pred == "und") == (r.score == 0) for r in got)
    assert {r.lang_pred for r in got if r.doc_id == 8} == {"fr"}
    assert lid.identify(no_docs).count() == 0
    unlabelled = documents.selectExpr("doc_id", "text", "CAST(NULL AS STRING) lang").limit(5)
    assert {(r.lang_pred, r.score) for r in lid.identify(unlabelled).collect()} == {("und", 0.0)}
    kept = lid.drop_unidentified(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted(
        (r.doc_id or -1) for r, l in zip(edge_docs.collect(), letters) if l)


def plain_language(model, text, window=128):
    """The label probabilities of a text, byte by byte."""
    h, total, raw = model.hidden, np.zeros(len(model.labels)), text.encode()
    for lo in range(0, len(raw), window):
        part, ways = raw[lo:lo + window], []
        for d, order in ((0, range(len(part))), (1, range(len(part) - 1, -1, -1))):
            state, at = np.zeros(h), {}
            for t in order:
                x, a = model.table[d][part[t]].astype(float), state @ model.rec[d].astype(float)
                z, r = (1 / (1 + np.exp(-(x[k:k + h] + a[k:k + h]))) for k in (0, h))
                c = np.tanh(r * (a[2 * h:] + model.cand[d][0]) + x[2 * h:])
                state = z * state + (1 - z) * c
                at[t] = state
            ways.append(at)
        for t in range(len(part)):
            y = np.exp(np.concatenate([ways[0][t], ways[1][t]]) @ model.out + model.bias)
            total += y / y.sum()
    return total / max(1, len(raw))


def test_query_equals_plain_loops(spark, documents):
    rows = documents.withColumn("held", lid.held_out(documents["doc_id"])).collect()
    model = lid.fit(documents.where(~lid.held_out(documents["doc_id"])))
    got = {r.doc_id: r for r in lid.identify(documents).collect()}
    assert len(got) == len(rows)
    for r in sorted(rows, key=lambda r: len(r.text or ""))[::4][:30]:
        have = got[r.doc_id]
        assert have.held_out == r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not r.text or not lid.LETTER.search(r.text):
            assert (have.lang_pred, have.score) == ("und", 0.0)
            continue
        p = plain_language(model, r.text)
        assert abs(have.score - p.max()) < 1e-4
        assert have.lang_pred == model.labels[int(p.argmax())] or np.sort(p)[-1] - np.sort(p)[-2] < 1e-4
