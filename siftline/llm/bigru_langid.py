"""Operator 8: language identification by a bidirectional gated recurrent
network over bytes.

Each byte of a text is a step of two gated recurrent units, one from the left,
one from the right. A softmax over both states labels every position, and the
mean of the positions' probabilities is the document's. The network is trained
in numpy by back-propagation through time, with Adam.

A text is run in windows of ``window`` bytes side by side (all windows, so the
whole text), each with states of its own; a short last window is padded with a
symbol that leaves the state as it is.

Training takes a bounded sample of the labelled rows, as its parameters say:
``docs_per_lang`` documents of each language, those with the least hash of
their id, and ``windows_per_doc`` windows of each. Prediction is one pass over
the texts without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
Without a labelled row nothing is learned, and all documents are ``und``. Null
labels are not learned. With one language, it is predicted with score 1.
Repeated rows are predicted each; extra columns are not read.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as cm

PAD = 256
LETTER = re.compile(r"[^\W\d_]")
UND = "und"


# ------------------------------------------------------------------ the model

class BiGRU:
    """Both directions lie on the first axis of every array.

    ``table``: what a byte adds to the gates (update, reset, candidate);
    ``rec``: what the state adds; ``out``, ``bias``: states to labels.
    """

    def __init__(self, labels: list[str], hidden: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.table = rng.normal(0, 0.3, (2, 257, 3 * hidden)).astype(np.float32)
        self.rec = rng.normal(0, hidden ** -0.5, (2, hidden, 3 * hidden)).astype(np.float32)
        self.cand = np.zeros((2, 1, hidden), np.float32)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)
        self._hold_on_pad()

    def _hold_on_pad(self) -> None:
        self.table[:, PAD, :] = 0
        self.table[:, PAD, :self.hidden] = 60.0     # update gate 1: the state stays

    def names(self) -> list[str]:
        return ["table", "rec", "cand", "out", "bias"]

    def states(self, windows: np.ndarray, keep: bool = False):
        """States (steps, 2, windows, hidden), the second direction in its own
        order of steps; with ``keep`` what the backward pass needs."""
        n, steps, h = windows.shape[0], windows.shape[1], self.hidden
        half = np.ones(3 * h, np.float32)
        half[:2 * h] = 0.5                          # sigmoid(x) = (1 + tanh(x / 2)) / 2
        table, rec = self.table * half, self.rec * half
        ways = (windows.T, windows.T[::-1])
        hs = np.empty((steps, 2, n, h), np.float32)
        state, kept = np.zeros((2, n, h), np.float32), []
        x = np.empty((2, n, 3 * h), np.float32)
        for t in range(steps):
            for d in (0, 1):
                np.take(table[d], ways[d][t], axis=0, out=x[d], mode="clip")
            a = state @ rec
            zr = x[..., :2 * h] + a[..., :2 * h]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            inner = a[..., 2 * h:] + self.cand
            c = zr[..., h:] * inner
            c += x[..., 2 * h:]
            np.tanh(c, out=c)
            if keep:
                kept.append((state, zr, inner, c))
            diff = state - c
            diff *= zr[..., :h]
            diff += c
            state = hs[t]
            state[...] = diff
        return (hs, kept) if keep else hs

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Label probabilities of every position: (steps, windows, labels)."""
        hs, h = self.states(windows), self.hidden
        p = hs[:, 0] @ self.out[:h]
        p += hs[::-1, 1] @ self.out[h:]
        p += self.bias
        p -= p.max(axis=2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=2, keepdims=True)
        return p

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the positions and its gradients, in the
        order of ``names``: back-propagation through time."""
        h, steps = self.hidden, windows.shape[1]
        hs, kept = self.states(windows, keep=True)
        logits = hs[:, 0] @ self.out[:h] + hs[::-1, 1] @ self.out[h:] + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        real = (windows.T != PAD).astype(np.float32)
        total = max(real.sum(), 1.0)
        rows = np.arange(len(labels))
        loss = float(-(np.log(p[:, rows, labels] + 1e-12) * real).sum() / total)
        p[:, rows, labels] -= 1
        p *= (real / total)[..., None]
        g_out = np.concatenate([np.einsum("tnh,tnl->hl", hs[:, 0], p), np.einsum("tnh,tnl->hl", hs[::-1, 1], p)])
        into = np.stack([p @ self.out[:h].T, (p @ self.out[h:].T)[::-1]], axis=1)  # by each way's own steps
        g_table, g_rec, g_cand = np.zeros_like(self.table), np.zeros_like(self.rec), np.zeros_like(self.cand)
        ways = (windows.T, windows.T[::-1])
        back = np.zeros_like(into[0])
        for t in range(steps - 1, -1, -1):
            state, zr, inner, c = kept[t]
            z, r = zr[..., :h], zr[..., h:]
            back = back + into[t]
            d_c = back * (1 - z) * (1 - c * c)
            d_z = back * (state - c) * z * (1 - z)
            d_r = d_c * inner * r * (1 - r)
            d_inner = d_c * r
            gates = np.concatenate([d_z, d_r, d_inner], axis=2)
            g_rec += state.transpose(0, 2, 1) @ gates
            g_cand += d_inner.sum(axis=1, keepdims=True)
            adds = np.concatenate([d_z, d_r, d_c], axis=2)
            for d in (0, 1):
                np.add.at(g_table[d], ways[d][t], adds[d])
            back = back * z + gates @ self.rec.transpose(0, 2, 1)
        g_table[:, PAD] = 0
        return loss, [g_table, g_rec, g_cand, g_out, p.sum(axis=(0, 1))]

    def train(self, windows: np.ndarray, labels: np.ndarray, rounds: int = 250, batch: int = 96,
              rate: float = 0.02, seed: int = 2) -> list[float]:
        """Adam over batches that hold each label equally often."""
        rng, losses = np.random.default_rng(seed), []
        of = [np.flatnonzero(labels == k) for k in range(len(self.labels))]
        params = [getattr(self, n) for n in self.names()]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            pick = np.concatenate([rng.choice(o, -(-batch // len(of))) for o in of])
            loss, grads = self.gradients(windows[pick], labels[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            now = rate * min(1.0, 2.0 * (1 - step / (rounds + 1)))
            for p, g, mk, vk in zip(params, grads, m, v):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                mk += 0.1 * (g - mk)
                vk += 0.01 * (g * g - vk)
                p -= now * (mk / (1 - 0.9 ** step)) / (np.sqrt(vk / (1 - 0.99 ** step)) + 1e-8)
            self._hold_on_pad()
        return losses


def windows_of(raws: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the byte strings, padded, and how many each string has."""
    number = np.array([-(-len(r) // window) for r in raws], np.int64)
    out = np.full(int(number.sum()) * window, PAD, np.uint16)
    at = (np.cumsum(number) - number) * window
    for r, a in zip(raws, at):
        out[a:a + len(r)] = np.frombuffer(r, np.uint8)
    return out.reshape(-1, window), number


def document_scores(model: BiGRU, texts: list[str], window: int, side_by_side: int = 512) -> np.ndarray:
    """Mean label probabilities of each text over all its bytes."""
    raws = [t.encode() for t in texts]
    rows, number = windows_of(raws, window)
    sums = np.zeros((len(rows), len(model.labels)))
    for lo in range(0, len(rows), side_by_side):
        part = rows[lo:lo + side_by_side]
        p = model.probabilities(part)
        p *= (part.T != PAD)[..., None]
        sums[lo:lo + side_by_side] = p.sum(axis=0)
    out = np.zeros((len(raws), len(model.labels)))
    np.add.at(out, np.repeat(np.arange(len(raws)), number), sums)
    return out / np.maximum([len(r) for r in raws], 1)[:, None]


# ------------------------------------------------------------------- on Spark

def fit(labelled: DataFrame, docs_per_lang: int = 400, windows_per_doc: int = 4, window: int = 64,
        hidden: int = 8, rounds: int = 250) -> BiGRU | None:
    """Train on a bounded sample of ``labelled`` (doc_id, text, lang); None if
    there is no labelled text."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = rows.select("doc_id", "lang").distinct().withColumn("key", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    # of a large language only ids with a small key can be among the first: three times as many as are wanted, about
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))       # a row a language, as the network has an output
    few = ids.join(F.broadcast(sizes), "lang").where(
        F.col("key") <= F.lit(float(1 << 40)) * (3 * docs_per_lang) / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))
    ids = few.withColumn("rank", rank).where(F.col("rank") <= docs_per_lang).select("doc_id", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cm.parts(batches, 1_000_000):
            found = []
            for doc_id, lang, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                raw = text.encode()
                if not LETTER.search(text):
                    continue
                step = max(window, len(raw) // windows_per_doc)
                parts = [raw[k:k + window] for k in range(0, len(raw), step)][:windows_per_doc]
                found.append((doc_id, lang, parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2] for f in found], pa.list_(pa.binary()))], names=["doc_id", "lang", "parts"])
    picked = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text").join(
        F.broadcast(ids), ["doc_id", "lang"])       # at most docs_per_lang rows a language
    sample = picked.select("doc_id", "lang", "text").mapInArrow(cut, "doc_id long, lang string, parts array<binary>")
    sample = sorted((r.lang, r.doc_id, [bytes(p) for p in r.parts])
                    for r in sample.dropDuplicates(["doc_id", "lang"]).collect())
    if not sample:
        return None
    labels = sorted({s[0] for s in sample})
    model = BiGRU(labels, hidden)
    raws = [p for s in sample for p in s[2]]
    of = np.array([labels.index(s[0]) for s in sample for _ in s[2]])
    if len(labels) > 1:
        model.train(windows_of(raws, window)[0], of, rounds)
    return model


def predict(docs: DataFrame, model: BiGRU | None, window: int = 128) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)      # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cm.parts(batches, 1_000_000):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *_labelled(held.value, cm.texts_of(b), window)],
                                             names=["doc_id", "lang_pred", "score"])
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def _labelled(model: BiGRU | None, texts: list[str], window: int) -> list[pa.Array]:
    known = [k for k, t in enumerate(texts) if model is not None and LETTER.search(t)]
    lang, score = [UND] * len(texts), np.zeros(len(texts))
    if known:
        p = document_scores(model, [texts[k] for k in known], window)
        for k, row in zip(known, p):
            lang[k], score[k] = model.labels[int(row.argmax())], min(1.0, float(row.max()))
    return [pa.array(lang, pa.string()), pa.array(score)]


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the other folds."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is ``und``; learned from
    all labelled documents."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs))
    kept = [f for f in docs.schema.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cm.parts(batches, 1_000_000):
            lang = _labelled(held.value, cm.texts_of(b), 128)[0]
            yield b.filter(pa.array([x != UND for x in lang.to_pylist()], pa.bool_()))
    return docs.select(*kept).mapInArrow(run, docs.schema)
