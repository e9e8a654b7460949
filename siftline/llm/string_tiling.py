"""Operator 6: benchmark decontamination by greedy string tiling.

Documents and benchmark items are words: lower-cased runs of letters and
digits. Windows of ``min_match`` words that a document and an item share are
found by a rolling Karp-Rabin hash and are joined by that hash; these seeds,
run together along a diagonal, are the maximal matches. Tiling then marks the
longest match, cuts the others down to what it left unmarked, and repeats while
a match of ``min_match`` words remains. The share of an item's words that tiles
cover is its coverage, whatever the order in which its parts occur, so passages
that were cut up and put in another order are found too.

Where words repeat, seeds are as many as the product of two lengths. An item that
shares more than ``MOST_PAIRS`` with a document is tiled by length instead
(``tiles_by_length``): the same tiles, found from the longest down by Karp-Rabin
values of whole windows, in memory that grows with the sum of the lengths.

Layout on Spark: the benchmark is read in blocks of at most ``block_bytes`` of
text (or one item, if a single one is larger). Each block is broadcast and all
documents run against it in one pass without a shuffle, so a benchmark of any
size is searched whole and a passage that many documents share makes no large
group. A document word outside the block's vocabulary breaks every window, so
most windows cost one array operation.

Defined cases: null or empty texts match nothing. Items of fewer than
``min_match`` words have no seed and match nothing. Items of equal text are
reported each. Null ids are reported as null. Empty tables give empty results,
and ``drop_contaminated`` keeps all rows of ``docs`` if the benchmark is empty.
Extra columns are not read by ``find_leaks`` and are kept by
``drop_contaminated``.
"""

from __future__ import annotations

import heapq
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as cm

WORDS = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)      # odd, so every power has an inverse modulo 2**64
LEAKS = "doc_id long, item_id long, n_tiles int, longest int, covered int, item_words int, coverage double"


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin value of each window of ``width`` ids, modulo 2**64."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * BASE + _mixed(ids[k:k + n])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value for each id (the splitmix64 finish)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def tiles(doc: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray,
          min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the seeds (window starts that match): rows (place in
    the document, place in the item, words), the longest first."""
    order = np.lexsort((at_item, at_doc - at_item))
    d, q = at_doc[order], at_item[order]
    same = np.all([doc[d + k] == item[q + k] for k in range(min_match)], axis=0)  # a hash is not a proof
    d, q = d[same], q[same]
    if not len(d):
        return []
    new = np.flatnonzero(np.concatenate([[True], (np.diff(d - q) != 0) | (np.diff(q) != 1)]))
    size = np.diff(np.append(new, len(d))) + min_match - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(size, d[new], q[new])]
    heapq.heapify(heap)
    free_d, free_q, out = np.ones(len(doc), bool), np.ones(len(item), bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = free_d[a:a + n] & free_q[b:b + n]
        if free.all():
            out.append((a, b, n))
            free_d[a:a + n] = free_q[b:b + n] = False
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for lo, hi in edges.reshape(-1, 2):
            if hi - lo >= min_match:
                heapq.heappush(heap, (-int(hi - lo), a + int(lo), b + int(lo)))
    return out


#: with more pairs of equal windows than this, an item is tiled by length
MOST_PAIRS = 1_000_000


class Windows:
    """Karp-Rabin values of a sequence's windows of any width, from one running
    sum: sum(x[j] * BASE**j) over a window, divided by BASE**start."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        with np.errstate(over="ignore"):
            power = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, BASE, np.uint64))])
            self.sums = np.concatenate([[np.uint64(0)], np.add.accumulate(_mixed(ids) * power[:n])])
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.back = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, inverse, np.uint64))])

    def free(self, width: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows without a marked word, and their values."""
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[width:] == taken[:len(taken) - width])
        with np.errstate(over="ignore"):
            return at, (self.sums[at + width] - self.sums[at]) * self.back[at]


def tiles_by_length(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """The tiles of ``tiles`` without its seeds: in every round the greatest
    width at which an unmarked window of the document equals one of the item is
    found by halving, and all tiles of that width are marked, in the order of
    their places. Memory grows with the two lengths, not with their product, so
    words repeated any number of times are tiled as well."""
    d, q = Windows(doc), Windows(item)
    free_d, free_q, out = doc > 0, np.ones(len(item), bool), []

    def shared(width: int) -> bool:
        a, b = d.free(width, free_d)[1], q.free(width, free_q)[1]
        return bool(len(a) and len(b) and np.isin(b, a).any())
    most = min(len(doc), len(item))
    while most >= min_match and shared(min_match):
        low, high = min_match, most
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if shared(mid) else (low, mid - 1)
        at, own = d.free(low, free_d)
        places, values = q.free(low, free_q)
        order = np.argsort(values, kind="stable")            # equal windows of the item stay in order
        places, values = places[order], values[order]
        left = np.searchsorted(values, own, "left")
        fits = (left < len(values)) & (values[np.minimum(left, len(values) - 1)] == own)
        at, left, end = at[fits], left[fits], np.searchsorted(values, own[fits], "right")
        head: dict[int, int] = {}                            # of equal windows: the first that is still free
        behind = 0
        for a, lo, hi in zip(at.tolist(), left.tolist(), end.tolist()):
            if a < behind:
                continue
            k = head.get(lo, lo)
            # tiles of this round are as long as a window, so one that meets it covers one of its ends
            while k < hi and not (free_q[places[k]] and free_q[places[k] + low - 1]):
                k += 1
            head[lo] = k
            while k < hi and not (free_q[places[k]] and free_q[places[k] + low - 1]
                                  and np.array_equal(doc[a:a + low], item[places[k]:places[k] + low])):
                k += 1                                       # a value is not a proof
            if k < hi:
                b = int(places[k])
                out.append((a, b, low))
                free_d[a:a + low] = free_q[b:b + low] = False
                behind = a + low
                if not free_q.any():
                    return out
        most = low - 1
    return out


class Block:
    """A part of the benchmark, ready to search documents for."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.min_match, self.vocab, self.items = min_match, {}, []
        hashes, owner, place = [], [], []
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], np.int64)
            h = rolling(ids, min_match)
            hashes.append(h)
            owner.append(np.full(len(h), len(self.items)))
            place.append(np.arange(len(h)))
            self.items.append((item_id, ids))
        flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.hash = flat[order]
        self.owner = np.concatenate([*owner, np.zeros(0, np.int64)])[order].astype(np.int64)
        self.place = np.concatenate([*place, np.zeros(0, np.int64)])[order].astype(np.int64)

    def search(self, text: str) -> Iterator[tuple[int | None, list[tuple[int, int, int]], int]]:
        """(item id, tiles, item words) of each item that shares a seed."""
        if not len(self.hash):
            return
        get = self.vocab.get
        ids = np.array([get(w, 0) for w in words_of(text)], np.int64)
        if len(ids) < self.min_match:
            return
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.flatnonzero(known[self.min_match:] - known[:-self.min_match] == self.min_match)
        if not len(at):
            return
        h = rolling(ids, self.min_match)[at]
        lo, hi = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        n = hi - lo
        total = int(n.sum())
        if not total:
            return
        if total <= MOST_PAIRS:
            take = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(total)
            yield from self._tiled(ids, self.owner[take], np.repeat(at, n), self.place[take])
            return
        at, lo, hi = at[n > 0], lo[n > 0], hi[n > 0]
        # the block's windows that the document has, each once, and how often it has them
        first, times = np.unique(lo, return_counts=True)
        n = np.searchsorted(self.hash, self.hash[first], "right") - first
        held = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        who = self.owner[held]
        pairs = np.bincount(who, np.repeat(times, n), minlength=0)
        many = np.flatnonzero(pairs > MOST_PAIRS)
        for item in many:
            item_id, own = self.items[item]
            yield item_id, tiles_by_length(ids, own, self.min_match), len(own)
        # the others, as many at a time as have so many pairs together
        rest = np.flatnonzero((pairs > 0) & (pairs <= MOST_PAIRS))
        by_window = np.argsort(lo, kind="stable")            # the document's places of each window
        start = np.searchsorted(lo[by_window], first)
        turn = (np.cumsum(pairs[rest]) // MOST_PAIRS).astype(np.int64)
        of = np.full(len(pairs), -1)
        of[rest] = turn
        window = np.repeat(np.arange(len(first)), n)
        for t in np.unique(turn):
            mine = of[who] == t
            w = window[mine]
            take = np.repeat(start[w] - (np.cumsum(times[w]) - times[w]), times[w]) + np.arange(int(times[w].sum()))
            yield from self._tiled(ids, np.repeat(who[mine], times[w]), at[by_window][take], np.repeat(self.place[held[mine]], times[w]))

    def _tiled(self, ids: np.ndarray, who: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray):
        """Tiles of each item from its seeds."""
        order = np.argsort(who, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(who[order])) + 1):
            item_id, item = self.items[who[part[0]]]
            yield item_id, tiles(ids, item, at_doc[part], at_item[part], self.min_match), len(item)


def _blocks(bench: DataFrame, min_match: int, block_bytes: int) -> Iterator[Block]:
    items = bench.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // (block_bytes // 2)) or 1  # hashing deals out unevenly
    items = items.withColumn("b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for k in range(n):
        yield Block([(r.item_id, r.text) for r in items.where(F.col("b") == k).collect()], min_match)


def find_leaks(docs: DataFrame, bench: DataFrame, min_match: int = 5, min_coverage: float = 0.5,
               block_bytes: int = 8 << 20) -> DataFrame:
    """A row for each document and benchmark item whose coverage is
    ``min_coverage`` or more."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for block in _blocks(bench, min_match, block_bytes):
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in cm.parts(batches, 4_000_000):
                found = [(doc_id, item_id, len(t), t[0][2], sum(x[2] for x in t), n, sum(x[2] for x in t) / n)
                         for doc_id, text in zip(b.column("doc_id").to_pylist(), cm.texts_of(b))
                         for item_id, t, n in held.value.search(text)
                         if t and sum(x[2] for x in t) >= min_coverage * n]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                names = ["doc_id", "item_id", "n_tiles", "longest", "covered", "item_words", "coverage"]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind)
                                                  for k, kind in enumerate(kinds)], names=names)
        part = rows.mapInArrow(run, LEAKS)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, bench: DataFrame, min_match: int = 5, min_coverage: float = 0.5,
                      block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    spark, schema = docs.sparkSession, docs.schema
    for block in _blocks(bench, min_match, block_bytes):
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in cm.parts(batches, 4_000_000):
                clean = [not any(t and sum(x[2] for x in t) >= min_coverage * n for _, t, n in held.value.search(text))
                         for text in cm.texts_of(b)]
                yield b.filter(pa.array(clean, pa.bool_()))
        docs = docs.mapInArrow(run, schema)
    return docs
