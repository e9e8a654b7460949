"""Operator 13: ranked lexical search by buckets of impact vectors of like
length.

A term's impact in a document is its weight times the document's saturated
term frequency, an integer; a document's score for an item is the sum of the
impacts of the item's terms, the inner product of an impact vector with a vector
of ones. Only terms that some item holds matter, so impact vectors are kept over
these. Documents are grouped by the length of their vectors (``norm_buckets``);
a bucket keeps for each term the documents that hold it and their frequencies,
from which impacts are made again when it is opened.

For an item with threshold t (its k-th best score so far) in a bucket:

* Cauchy-Schwarz: sqrt(terms) * longest < t: the bucket is skipped;
* coordinate bounds: a term adds at most its largest impact in the bucket. The
  terms with the least ones, whose sum (or whose Cauchy-Schwarz bound) stays
  below t, cannot bring a document to t alone. Only documents that hold one of
  the others are looked at; what these give, plus the bound on the rest (by the
  largest impacts, and by what is left of the document's length), must reach t;
* the survivors are scored again with all terms, in 64-bit integers.

Terms, weights and impacts are fixed by the query's contract: N documents with a
term, L terms in them, n of one document, df documents with the term, tf;
weight floor(1000 * ln((2N + 2) / (2df + 1))); m = 10 + (90 * n * N) div L; impact
weight * ((1000000000 * tf) div (1000 * tf + 8 * m)).

The items are worked on in blocks of at most ``block_bytes`` of text (or one
item, if a single one is larger), each a pass over all documents; the terms of a
block are held by every task.

Defined cases: null or empty texts have no terms; such documents are not counted
and not found, such items find nothing. Items of equal id are one item with the
terms of all. Rows without item_id are skipped; documents without doc_id count
but are not found. Repeated rows are documents of their own. Documents that score
0 are not returned. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as cm
from . import norm_buckets as nb
from . import text_bytes as tb

#: bytes that are part of no term, fixed by the query's contract
BREAKS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TABLE = tb.byte_table(spaces=BREAKS)
VECTOR = "doc_id long, n long, terms array<int>, tfs array<int>"


# ------------------------------------------------------------- term frequencies

def frequencies(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number of terms of each text; and of those in the vocabulary: where
    each text's end (in rows), the term's place and its frequency."""
    codes, number, words = tb.words(tb.mapped(texts, TABLE))
    of = np.repeat(np.arange(len(texts)), number)[codes >= 0]
    codes = codes[codes >= 0]
    n = np.bincount(of, minlength=len(texts))
    known = pc.fill_null(pc.index_in(words, vocabulary.cast(words.type)), -1).to_numpy().astype(np.int64)
    term = known[codes] if len(codes) else codes
    key, tf = np.unique((of * max(1, len(vocabulary)) + term)[term >= 0], return_counts=True)
    ends = np.cumsum(np.bincount(key // max(1, len(vocabulary)), minlength=len(texts)))
    return n, ends, key % max(1, len(vocabulary)), tf


def term_vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n, terms, tfs of the documents with a term; ``terms`` are places
    in the vocabulary, rising."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(held.value, pa.string())
        for b in cm.parts(batches, 4_000_000):
            n, ends, terms, tfs = frequencies(b.column("text"), known)
            ends = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            out = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return cm.staged(rows.mapInArrow(run, VECTOR), "lexical-vectors")


def statistics(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each place in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, terms = np.zeros(size, np.int64), 0, 0
        for b in batches:
            df += np.bincount(b.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
            docs, terms = docs + b.num_rows, terms + int(b.column("n").to_numpy().sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]), pa.int32()),
                                          pa.array(np.concatenate([[terms, docs], df[some]]), pa.int64())], names=["term", "x"])
    sums = {r.term: r.x for r in vectors.mapInArrow(run, "term int, x long").groupBy("term").agg(F.sum("x").alias("x")).collect()}
    return sums.get(-1, 0), sums.get(-2, 0), np.array([sums.get(t, 0) for t in range(size)], np.int64)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 10 + (90 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


# --------------------------------------------------------------- buckets, blocks

def least(x: np.ndarray) -> np.ndarray:
    """In the narrowest unsigned type that holds it."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def pack(t: pa.Table) -> tuple[dict, float]:
    """A bucket: of each term it holds, the documents (places) in order and
    their frequencies."""
    terms, tfs = (t.column(c).chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
    doc = np.repeat(np.arange(t.num_rows), np.diff(t.column("terms").chunk(0).offsets.to_numpy()))
    order = np.argsort(terms, kind="stable")
    held, start = np.unique(terms[order], return_index=True)
    size = np.sqrt(t.column("length").to_numpy())
    return {"ids": t.column("doc_id").to_numpy(), "n": t.column("n").to_numpy(), "size": size, "terms": held,
            "start": np.append(start, len(order)), "doc": least(doc[order]), "tf": least(tfs[order])}, float(size.max())


class Items:
    """A block of items (``norm_buckets.Block``)."""

    def __init__(self, ids: np.ndarray, terms: list[np.ndarray], k: int, weight: np.ndarray, totals: tuple[int, int],
                 theta: np.ndarray | None = None):
        self.ids, self.terms, self.k, self.weight, self.totals = ids, terms, k, weight, totals
        self.best = nb.Best(len(ids), k)
        if theta is not None:
            self.best.theta[:] = theta

    def arrays(self) -> dict[str, np.ndarray]:
        return {"ids": self.ids, "k": np.array(self.k), "weight": self.weight, "totals": np.array(self.totals),
                "theta": self.best.theta, "flat": np.concatenate([np.zeros(0, np.int64), *self.terms]),
                "ends": np.cumsum([len(t) for t in self.terms])}

    @classmethod
    def from_arrays(cls, a: dict[str, np.ndarray]) -> "Items":
        return cls(a["ids"], np.split(a["flat"], a["ends"][:-1]), int(a["k"]), a["weight"], tuple(a["totals"].tolist()), a["theta"])

    def found(self):
        return self.best.found(self.ids)

    def need(self) -> float:
        sizes = np.sqrt([len(t) for t in self.terms]) * nb.SLACK
        return float(np.where(self.best.theta > 0, self.best.theta / np.maximum(sizes, 1e-300), 0.0).min(initial=np.inf))

    def scan(self, b: dict[str, np.ndarray]) -> None:
        span = np.diff(b["start"])
        doc = b["doc"].astype(np.int64)
        value = impacts(np.repeat(self.weight[b["terms"]], span), b["tf"].astype(np.int64), b["n"][doc], *self.totals)
        most = np.maximum.reduceat(value, b["start"][:-1]) if len(value) else np.zeros(0, np.int64)
        longest = float(b["size"].max()) * nb.SLACK
        for i, terms in enumerate(self.terms):
            theta = self.best.theta[i]
            if np.sqrt(len(terms)) * longest < theta:
                continue
            at = np.searchsorted(b["terms"], terms)
            at = at[(at < len(b["terms"])) & (b["terms"][np.minimum(at, len(b["terms"]) - 1)] == terms)]
            at = at[most[at] > 0]
            if not len(at) or most[at].sum() < theta:
                continue
            at = at[np.argsort(most[at], kind="stable")]
            bound = np.minimum(np.cumsum(most[at]), np.sqrt(np.arange(1, len(at) + 1)) * longest)
            rest = int(np.searchsorted(bound, theta, "left"))          # so many terms stay below together
            if rest == len(at):
                continue
            total, squares = np.zeros(len(b["ids"]), np.int64), np.zeros(len(b["ids"]))
            for t in at[rest:]:
                own = slice(b["start"][t], b["start"][t + 1])
                total[doc[own]] += value[own]
                squares[doc[own]] += value[own].astype(np.float64) ** 2
            near = np.flatnonzero(total)
            if rest:
                left = np.sqrt(rest * np.maximum(0.0, (b["size"][near] * nb.SLACK) ** 2 - squares[near] / nb.SLACK)) * nb.SLACK
                near = near[total[near] + np.minimum(float(most[at[:rest]].sum()), left) >= theta]
                for t in at[:rest]:
                    own = doc[b["start"][t]:b["start"][t + 1]]
                    place = np.minimum(np.searchsorted(own, near), len(own) - 1)
                    total[near] += np.where(own[place] == near, value[b["start"][t] + place], 0)
            near = near[total[near] >= theta]
            if len(near):
                self.best.offer(i, b["ids"][near], total[near])


# ------------------------------------------------------------------------ search

def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, list[str]]]]:
    """(item_id, distinct terms) of the items, a block at a time."""
    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"),
                                                            F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // (block_bytes // 2)) or 1          # hashing deals out unevenly
    for k in range(n):
        own: dict[int, set[str]] = {}
        held = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()
        for r in held:
            words = tb.words(tb.mapped(pa.array([r.text], pa.string()), TABLE))[2].to_pylist()
            own.setdefault(r.item_id, set()).update(w for w in words if w)
        yield sorted((i, sorted(t)) for i, t in own.items() if t)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, bucket_rows: int = 2048, items_a_block: int = 32,
                   block_bytes: int = 8 << 20) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each item."""
    spark, out = docs.sparkSession, None
    for block in item_blocks(items, block_bytes):
        if not block:
            continue
        vocabulary = sorted({t for _, terms in block for t in terms})
        place = {t: i for i, t in enumerate(vocabulary)}
        vectors = term_vectors(docs, vocabulary)
        n_docs, n_terms, df = statistics(vectors, len(vocabulary))
        weight, totals = weights(n_docs, df), (n_docs, n_terms)
        held = spark.sparkContext.broadcast(weight)

        def measured(batches: Iterator[pa.RecordBatch], held=held, totals=totals) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ends = np.append(0, np.cumsum(pc.list_value_length(b.column("terms")).to_numpy(zero_copy_only=False)))
                terms, tfs = (b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "tfs"))
                x = impacts(held.value[terms], tfs, np.repeat(b.column("n").to_numpy(), np.diff(ends)), *totals).astype(np.float64)
                size = np.add.reduceat(x * x, ends[:-1]) if len(x) else x      # every document here has a term
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size, pa.float64())], names=[*b.schema.names, "measure"])
        rows = (vectors.where(F.col("doc_id").isNotNull() & (F.size("terms") > 0)).mapInArrow(measured, f"{VECTOR}, measure double")
                .where(F.col("measure") > 0).withColumn("dim", F.lit(0)))
        manifest = nb.write_buckets(rows, F.col("measure"), "doc_id", pack, "lexical-buckets", bucket_rows)
        n_blocks = min(nb.MOST, -(-len(block) // items_a_block))
        asked = spark.createDataFrame([(0, j % n_blocks, i, [place[t] for t in terms]) for j, (i, terms) in enumerate(block)],
                                      "dim int, block int, item_id long, terms array<int>")

        def make(own: pd.DataFrame, held=held, totals=totals) -> Items:
            terms = [np.sort(np.asarray(t, np.int64)) for t in own["terms"]]
            return Items(own["item_id"].to_numpy(), terms, k, held.value, totals)
        part = nb.search(manifest, asked, make, Items.from_arrays, k, "lexical").select(
            F.col("query_id").alias("item_id"), "rank", F.col("vec_id").alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
