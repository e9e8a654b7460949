"""Operator 5: approximate nearest neighbours by a navigable small-world graph
per shard, searched by all queries, with shard results merged.

Vectors are dealt over shards of about ``shard_rows`` by a hash. A shard's graph
has levels: every node is on level 0, and on each next level with probability
1/M. On a level, nodes are linked in a random order of insertion: a node with
up to M of the earlier nodes, picked from its nearest so that no picked one is
nearer to another than to the node (the usual diversity rule), and back; a node
with over 2M links (M above level 0) picks again. The candidates come from
exact blocks of similarities rather than from a search of the graph so far,
which a shard's bounded size allows and which only betters the links. The graph
is kept as flat arrays of neighbours, one row a shard in the index table.

A query descends greedily to level 0, searches there with a beam of ``ef``, and
scores what it found in double precision on the original vectors. Queries are
joined with shards in blocks of a bounded number; each block and shard is one
group. The best of all shards are kept by one window a query.

Equal vectors are one node with the smallest k + 1 ids of the vector: no other
of its rows can be among the k nearest. So many copies of one vector neither
cut the graph apart nor fill a beam.

Defined cases: a vector that is null, empty, zero, or holds a null or a
non-finite component takes no part, nor does a row without vec_id. Vectors of
different length are not compared. With fewer candidates than k, all found are
returned. Rows that are repeated as a whole count once; rows of equal id with
different vectors are each a candidate, and each a query whose results are
merged. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as cm

LINKS = 16            # M
NEAREST = 80          # candidates a node picks its links from
INDEX = "dim int, shard int, n long, graph binary"


# ------------------------------------------------------------------ the graph

def pick(near: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Places of up to ``most`` diverse candidates. ``near``: similarity to
    the node, falling; ``between``: among the candidates."""
    kept: list[int] = []
    closest = np.full(len(near), -2.0, between.dtype)   # similarity to the nearest one kept
    rest: list[int] = []
    for k in range(len(near)):
        if near[k] > closest[k]:
            kept.append(k)
            if len(kept) == most:
                return kept
            np.maximum(closest, between[k], out=closest)
        else:
            rest.append(k)
    return kept + rest[:most - len(kept)]


def link_level(x: np.ndarray, links: int, most: int, block: int = 512) -> np.ndarray:
    """Neighbour array (n, most), -1 where there is none, of unit vectors in
    their order of insertion."""
    n = len(x)
    to: list[list[int]] = [[] for _ in range(n)]
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        sims = x[lo:hi] @ x[:hi].T
        sims[np.arange(lo, hi)[:, None] <= np.arange(hi)[None, :]] = -3.0    # earlier nodes only
        take = min(NEAREST, hi)
        best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        for i in range(lo, hi):
            c = best[i - lo]
            s = sims[i - lo, c]
            order = np.argsort(-s, kind="stable")
            order = order[s[order] > -2.5]
            c, s = c[order], s[order]
            for j in c[pick(s, x[c] @ x[c].T, links)].tolist() if len(c) else ():
                to[i].append(j)
                to[j].append(i)
    out = np.full((n, most), -1, np.int32)
    for i, own in enumerate(to):
        if len(own) > most:
            c = np.array(own)
            s = x[c] @ x[i]
            order = np.argsort(-s, kind="stable")
            c, s = c[order], s[order]
            own = c[pick(s, x[c] @ x[c].T, most)]
        out[i, :len(own)] = own
    return out


class Graph:
    """A shard: original vectors, their ids (n, k + 1; -1: none), the nodes of
    each level in order of insertion and their neighbour arrays."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.ids, self.levels = vectors, ids, levels
        self.unit = unit(vectors).astype(np.float32)
        self.seen = np.zeros(len(vectors), np.int64)
        self.turn = 0
        self.at = []
        for nodes, _ in levels[1:]:
            at = np.full(len(vectors), -1, np.int32)
            at[nodes] = np.arange(len(nodes))
            self.at.append(at)

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, seed: int = 5) -> "Graph":
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(vectors))
        vectors, ids = vectors[order], ids[order]
        height = np.floor(-np.log(1.0 - rng.random(len(vectors))) / np.log(LINKS)).astype(int)
        x, levels = unit(vectors).astype(np.float32), []
        for k in range(int(height.max()) + 1):
            nodes = np.flatnonzero(height >= k).astype(np.int32)
            near = link_level(x[nodes], LINKS, 2 * LINKS if k == 0 else LINKS)
            levels.append((nodes, np.where(near >= 0, nodes[near], -1).astype(np.int32)))
        return cls(vectors, ids, levels)

    def to_bytes(self) -> bytes:
        arrays = [self.vectors.astype("<f8"), self.ids.astype("<i8")]
        for nodes, near in self.levels:
            arrays += [nodes.astype("<i4"), near.astype("<i4")]
        head = json.dumps([[a.dtype.str, a.shape] for a in arrays]).encode()
        return np.array([len(head)], "<i4").tobytes() + head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Graph":
        size = int(np.frombuffer(raw, "<i4", 1)[0])
        at, arrays = 4 + size, []
        for kind, shape in json.loads(raw[4:4 + size]):
            count = int(np.prod(shape))
            arrays.append(np.frombuffer(raw, kind, count, at).reshape(shape))
            at += arrays[-1].nbytes
        return cls(arrays[0], arrays[1], list(zip(arrays[2::2], arrays[3::2])))

    def _near(self, level: int, node: int) -> np.ndarray:
        row = node if level == 0 else self.at[level - 1][node]
        near = self.levels[level][1][row]
        return near[near >= 0]

    def _descend(self, q: np.ndarray) -> int:
        node = int(self.levels[-1][0][0])
        best = float(self.unit[node] @ q)
        for level in range(len(self.levels) - 1, 0, -1):
            while True:
                near = self._near(level, node)
                if not len(near):
                    break
                s = self.unit[near] @ q
                k = int(s.argmax())
                if s[k] <= best:
                    break
                node, best = int(near[k]), float(s[k])
        return node

    def search(self, q: np.ndarray, ef: int) -> np.ndarray:
        """Up to ``ef`` nodes near the unit vector ``q``."""
        start = self._descend(q)
        self.turn += 1
        turn, seen, x, near0 = self.turn, self.seen, self.unit, self.levels[0][1]
        first = float(x[start] @ q)
        seen[start] = turn
        todo, found = [(-first, start)], [(first, start)]
        while todo:
            s, node = heapq.heappop(todo)
            if len(found) >= ef and -s < found[0][0]:
                break
            near = near0[node]
            near = near[near >= 0]
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            sims = x[near] @ q
            if len(found) >= ef:
                good = sims > found[0][0]
                near, sims = near[good], sims[good]
            for s, node in zip(sims.tolist(), near.tolist()):
                if len(found) < ef:
                    heapq.heappush(found, (s, node))
                elif s > found[0][0]:
                    heapq.heapreplace(found, (s, node))
                else:
                    continue
                heapq.heappush(todo, (-s, node))
        return np.array([node for _, node in found])

    def nearest(self, query_id: int, vector: np.ndarray, k: int, ef: int) -> list[tuple[int, float]]:
        """The (vec_id, cosine) of the ``k`` nearest found, the query's own id
        left out; ties go to the smaller id."""
        nodes = self.search(unit(vector[None])[0].astype(np.float32), ef)
        a, b = scaled(vector[None])[0], scaled(self.vectors[nodes])
        score = (b @ a) / (np.sqrt((b * b).sum(axis=1)) * np.sqrt((a * a).sum()))
        rows = [(-float(s), int(i)) for s, own in zip(score, self.ids[nodes]) for i in own if i != -1 and i != query_id]
        return [(i, -s) for s, i in heapq.nsmallest(k, rows)]


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows over their largest component, so that no square over- or underflows."""
    return v / np.abs(v).max(axis=1, keepdims=True)


def unit(v: np.ndarray) -> np.ndarray:
    s = scaled(v.astype(np.float64))
    return s / np.sqrt((s * s).sum(axis=1, keepdims=True))


# ------------------------------------------------------------------- on Spark

def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(
        F.exists(vector, lambda x: x != 0), F.lit(False))


def build_index(vectors: DataFrame, k: int, shard_rows: int = 8192) -> DataFrame:
    """One row a shard. ``vectors``: vec_id long, embedding array<double>, all
    of them usable and distinct rows."""
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    nodes = (vectors.withColumn("r", first).where(F.col("r") <= k + 1)     # before the shuffle, too
             .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
             .withColumn("dim", F.size("embedding")))
    nodes = cm.staged(nodes, "hnsw-nodes")
    counts = nodes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(counts, "dim").withColumn("shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int"))

    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first")
        ids = np.full((len(rows), k + 1), -1, np.int64)
        for i, own in enumerate(rows["ids"]):
            ids[i, :len(own)] = own
        g = Graph.build(np.stack(rows["embedding"].to_numpy()).astype(np.float64), ids)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "n": [len(rows)], "graph": [g.to_bytes()]})
    dealt = dealt.select("dim", "shard", "embedding", "ids", F.col("ids")[0].alias("first"))
    return cm.staged(dealt.groupBy("dim", "shard").applyInPandas(build, INDEX), "hnsw-index")


def search_index(index: DataFrame, queries: DataFrame, k: int, ef: int = 128, block_rows: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest of each query (vec_id,
    embedding) over all shards."""
    blocks = max(1, -(-queries.count() // block_rows))
    shards = index.groupBy("dim").agg(F.max("shard").alias("last"))
    asked = (queries.withColumn("dim", F.size("embedding")).join(shards, "dim")
             .withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int"))
             .select("dim", F.explode(F.sequence(F.lit(0), "last")).alias("shard"), "block", "vec_id", "embedding"))
    held = index.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "graph")

    def look(graphs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(graphs) and len(rows):
            g = Graph.from_bytes(graphs["graph"].iloc[0])
            for q, v in zip(rows["vec_id"], rows["embedding"]):
                out += [(q, i, s) for i, s in g.nearest(int(q), np.asarray(v, np.float64), k, ef)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
    key = ["dim", "shard", "block"]
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(
        look, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_of_every(embeddings: DataFrame, divisor: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest of each row whose vec_id ``divisor`` divides, over all
    other rows."""
    rows = cm.staged(embeddings.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
                     .select(F.col("vec_id").cast("bigint").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding")).distinct(), "hnsw-rows")
    index = build_index(rows, k)
    return search_index(index, rows.where(F.col("vec_id") % divisor == 0), k)
