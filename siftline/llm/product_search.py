"""Operator 12: exact top-k inner products of integer vectors, by buckets of like
length.

A component x becomes floor(scale * x). Vectors are grouped by length
(``norm_buckets``); a bucket keeps, beside its vectors, a list of each
coordinate's values in order. For a query with threshold t (its k-th best score
so far) a bucket's local threshold is the cosine t / (|q| * longest):

* above 1, nothing in the bucket can reach t: it is skipped;
* below ``COORD_FROM``, the bucket is pruned by length: only vectors with
  |p| >= t / |q|, the first ones, are multiplied, for many queries at once;
* else by coordinate: with unit vectors, cos >= c forces every coordinate of p
  into q_f * c -+ sqrt((1 - c^2)(1 - q_f^2)). The query's largest coordinates are
  the focus; the shortest list among them gives the candidates and the others
  filter them.

Whatever is left is verified by exact products: in single precision where
lengths show that every partial sum stays below 2^24, in double precision below
2^53, and else in Python's integers. So results are exact for any vectors.

Defined cases: a vector that is null, empty, or holds a null or a non-finite
component takes no part (also one whose scaled component is not finite), nor
does a row without vec_id. A zero vector scores 0 with all. Vectors of different
length are not compared. Rows that are repeated as a whole count once; rows of
equal id and different vectors are each a candidate, and none for a query of
their id. With fewer candidates than k, all are returned. A score beyond 64 bits
counts as the nearest 64-bit number. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as cm
from . import norm_buckets as nb

COORD_FROM = 0.8         # local cosine from which coordinates prune
FOCUS = 4
ROWS_AT_ONCE = 256       # queries multiplied with a bucket together


def whole(vectors: list, scale: float) -> np.ndarray:
    return np.floor(scale * np.stack([np.asarray(v, np.float64) for v in vectors]))


def lengths(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True, initial=1.0)       # so that no square overflows
    return big[:, 0] * np.sqrt(((x / big) ** 2).sum(axis=1))


def products(q: np.ndarray, p: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products (rows of q, rows of p); ``most`` bounds |q| * |p|."""
    if most < 1 << 24:
        return (q.astype(np.float32) @ p.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (q @ p.T).astype(np.int64)
    a, b = ([[int(v) for v in row] for row in m] for m in (q, p))
    out = np.empty((len(a), len(b)), object)
    for i, x in enumerate(a):
        out[i] = [min(max(sum(u * v for u, v in zip(x, y)), nb.LONGS[0]), nb.LONGS[1]) for y in b]
    return out


def pack(t: pa.Table, scale: float) -> tuple[dict, float]:
    """A bucket, longest vectors first, with each coordinate's values in order."""
    x, ids = whole(t.column("embedding").to_pylist(), scale), t.column("vec_id").to_numpy()
    size = lengths(x)
    order = np.argsort(-size, kind="stable")
    x, ids, size = x[order], ids[order], size[order]
    unit = (x / np.maximum(size, 1e-300)[:, None]).astype(np.float32)
    place = np.argsort(unit, axis=0).astype(np.uint16 if len(x) <= 1 << 16 else np.int32)
    small = np.abs(x).max(initial=0) < 1 << 31
    return {"ids": ids, "x": x.astype(np.int32) if small else x, "size": size, "unit": unit, "place": place,
            "value": np.take_along_axis(unit, place.astype(np.int64), 0)}, float(size.max())


class Queries:
    """A block of queries (``norm_buckets.Block``)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, theta: np.ndarray | None = None):
        self.ids, self.x, self.k, self.size = ids, x, k, lengths(x)
        self.unit = x / np.maximum(self.size, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]
        self.best = nb.Best(len(ids), k)
        if theta is not None:
            self.best.theta[:] = theta

    def arrays(self) -> dict[str, np.ndarray]:
        return {"ids": self.ids, "x": self.x, "k": np.array(self.k), "theta": self.best.theta}

    @classmethod
    def from_arrays(cls, a: dict[str, np.ndarray]) -> "Queries":
        return cls(a["ids"], a["x"], int(a["k"]), a["theta"])

    def found(self):
        return self.best.found(self.ids)

    def need(self) -> float:
        """A vector shorter than this is out of reach for every query."""
        theta = self.best.theta
        least = np.where(theta > 0, theta / np.maximum(self.size * nb.SLACK, 1e-300), 0.0)
        return float(least.min(initial=np.inf))

    def scan(self, b: dict[str, np.ndarray]) -> None:
        theta, longest = self.best.theta, float(b["size"][0])
        local = np.where(theta > 0, theta / np.maximum(self.size * longest * nb.SLACK, 1e-300), -1.0)
        coord = (local >= COORD_FROM) & (local <= 1)
        for i in np.flatnonzero(coord):
            near = self._by_coordinate(i, float(local[i]), b)
            if len(near):
                s = products(self.x[i:i + 1], b["x"][near].astype(np.float64), float(self.size[i]) * longest)[0]
                self._offer(i, b["ids"][near], s)
        rest = np.flatnonzero(~coord & (local <= 1))
        for lo in range(0, len(rest), ROWS_AT_ONCE):
            some = rest[lo:lo + ROWS_AT_ONCE]
            least = np.where(theta[some] > 0, theta[some] / np.maximum(self.size[some] * nb.SLACK, 1e-300), -1.0)
            upto = int(np.searchsorted(-b["size"], -least.min(), "right"))
            s = products(self.x[some], b["x"][:upto].astype(np.float64), float(self.size[some].max()) * longest)
            hits = s >= theta[some][:, None]
            for row, i in enumerate(some):
                near = np.flatnonzero(hits[row])
                if len(near):
                    self._offer(i, b["ids"][near], s[row][near])

    def _by_coordinate(self, i: int, c: float, b: dict[str, np.ndarray]) -> np.ndarray:
        """Places of the vectors that the focus coordinates leave."""
        f = self.focus[i]
        q = self.unit[i][f]
        half = np.sqrt(max(0.0, 1 - c * c) * np.maximum(0.0, 1 - q * q)) + 1e-5
        lo, hi = np.where(q < -c, -1.0, q * c - half), np.where(q > c, 1.0, q * c + half)   # the axis may lie in the cone
        spans = [(int(np.searchsorted(b["value"][:, g], a, "left")), int(np.searchsorted(b["value"][:, g], z, "right")))
                 for g, a, z in zip(f, lo, hi)]
        short = min(range(len(f)), key=lambda n: spans[n][1] - spans[n][0])
        near = b["place"][spans[short][0]:spans[short][1], f[short]].astype(np.int64)
        near = near[b["size"][near] * self.size[i] * nb.SLACK >= self.best.theta[i]]
        for n, g in enumerate(f):
            if n != short and len(near):
                v = b["unit"][near, g]
                near = near[(v >= lo[n]) & (v <= hi[n])]
        return near

    def _offer(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        other = ids != self.ids[i]
        self.best.offer(i, ids[other], scores[other])


def top_products(embeddings: DataFrame, divisor: int = 50, k: int = 5, scale: float = 256.0, bucket_rows: int = 2048,
                 block_rows: int = 128) -> DataFrame:
    """The ``k`` highest inner products of each row whose vec_id ``divisor``
    divides, over all rows of another vec_id."""
    usable = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(scale) * x) < float("inf"))),
                        F.lit(False)) & (F.size("embedding") > 0) & F.col("vec_id").isNotNull()
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = cm.staged(rows.where(usable).distinct().withColumn("dim", F.size("embedding")), "product-rows")
    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)         # orders only; buckets measure exactly
    manifest = nb.write_buckets(rows, length, "vec_id", lambda t: pack(t, scale), "product-buckets", bucket_rows)
    asked = rows.where(F.col("vec_id") % divisor == 0)
    n = asked.count()
    blocks = max(1, min(nb.MOST, -(-n // block_rows)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int"))

    def make(own: pd.DataFrame) -> Queries:
        return Queries(own["vec_id"].to_numpy(), whole(list(own["embedding"]), scale), k)
    return nb.search(manifest, asked, make, Queries.from_arrays, k, "product")
