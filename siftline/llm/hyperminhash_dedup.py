"""Operator 7: near-duplicate documents by HyperMinHash.

A document's set is its distinct 5-word shingles. A hash deals the shingles
over 256 buckets; of the least value in each bucket a register keeps the number
of leading zeros (6 bits) and the 10 bits after the first one, so a document's
sketch is 512 bytes whatever its length. Empty buckets borrow, for banding
only, from a bucket that a fixed random order picks (so short documents band
like long ones). Bands of registers give candidates; for these, the share of
equal registers, corrected for equal registers of unequal minima, estimates the
similarity; what may reach the threshold is confirmed on the full sets.

Steps, each on Spark and each cut off by a table in the shared folder:

1. one pass over the texts: set size, digest of the word sequence, sketch;
2. documents of equal word sequence become one class (partial aggregation);
3. band keys of the classes; buckets of one class only are dropped;
4. in each bucket the least member is paired with the other members; pairs are
   estimated and confirmed on their sets, and components are formed from the
   links. So a group of copies costs one pair a member, not all pairs;
   where a bucket's members are still in several components, its pairs across
   components are compared, each pair in the first bucket that has it. Members
   come in blocks of at most ``BLOCK`` with their sets, two blocks to a
   comparison, and only links come out. So no link between different texts is
   lost that banding finds, however large a bucket;
5. each document gets its class's component, named by its smallest doc_id.

Two documents at the threshold share no band with a probability of less than
1e-4 (``bands``), and are estimated too low with one of less than 1e-6 (five
standard deviations). Nothing else is left to chance but 64-bit hashes of
shingles.

Defined cases: without words (or with null text) a document has an empty set,
is linked with nothing and kept. With fewer words than a shingle, the whole
sequence is its one shingle. Rows of equal text are one class, also rows that
are repeated as a whole: rows of the kept id are all kept. Rows with a null id
are linked like others but name no component; a component of such rows only
has a null name and keeps them all. An empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as cm
from .string_tiling import BASE, _mixed

BUCKETS = 256
MANTISSA = 10
EQUAL_BY_CHANCE = 2.0 ** -MANTISSA / 3      # same leading zeros (1/3), then the same mantissa
SIGMAS = 5.0
BLOCK = 256                                 # members of a bucket that are compared at once
BLOCK_BYTES = 16 << 20                      # and the bytes of their sets, about


def bands(threshold: float) -> int:
    """The most registers a band may have such that a pair at the threshold
    shares no band with a probability of at most 1e-4."""
    return max(r for r in range(1, 33) if (1 - threshold ** r) ** (BUCKETS // r) <= 1e-4)


def shingles(texts: list[str], words: int) -> list[tuple[np.ndarray, bytes | None]]:
    """Of each text: the sorted distinct 64-bit hashes of its shingles, and a
    digest of its word sequence (None without words)."""
    codes, number, distinct = cm.split_words(texts)
    ids = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))[codes]

    def hashes(part: np.ndarray, n: int) -> np.ndarray:
        h = np.zeros(max(len(part) - n + 1, 0), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = h * BASE + part[k:k + len(h)]
            return _mixed(h + np.uint64(n))
    every, out, end = hashes(ids, words), [], 0
    for n in number.tolist():
        start, end = end, end + n
        h = every[start:end - words + 1] if n >= words else hashes(ids[start:end], n) if n else every[:0]
        out.append((np.unique(h), hashlib.blake2b(ids[start:end].tobytes(), digest_size=16).digest() if n else None))
    return out


def sketch(sorted_set: np.ndarray) -> np.ndarray:
    """Registers of a set (0: empty bucket)."""
    at = np.searchsorted(sorted_set, np.arange(BUCKETS, dtype=np.uint64) << np.uint64(56))
    full = np.diff(np.append(at, len(sorted_set))) > 0
    out = np.zeros(BUCKETS, np.uint16)
    low = sorted_set[at[full]] << np.uint64(8)
    zeros = 53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.where(low >> np.uint64(11) == 0, 53, zeros).astype(np.uint64)
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out[full] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def _orders() -> np.ndarray:
    rng = np.random.default_rng(20)
    return np.array([rng.permutation(BUCKETS) for _ in range(BUCKETS)], np.uint16)


def band_keys(registers: np.ndarray, size: int, orders: np.ndarray) -> np.ndarray:
    """64-bit keys (documents x bands) of sketches (documents x buckets)."""
    dense = registers.copy()
    for row in dense:
        empty, full = np.flatnonzero(row == 0), np.flatnonzero(row)
        if len(empty) and len(full):
            row[empty] = row[full[np.argmin(orders[np.ix_(empty, full)], axis=1)]]
    n = BUCKETS // size
    parts = dense[:, :n * size].reshape(len(dense), n, size).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(dense), n)).copy()
        for k in range(size):
            key = _mixed(key * BASE + parts[:, :, k])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of sketches (pairs x buckets), and the number of
    buckets it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    share = ((a == b) & (a > 0)).sum(axis=1) / np.maximum(used, 1)
    return (share - EQUAL_BY_CHANCE) / (1 - EQUAL_BY_CHANCE), used


# ------------------------------------------------------------------- on Spark

def _signatures(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cm.parts(batches, 4_000_000):
            sets = shingles(cm.texts_of(b), words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h"), pa.array([len(s) for s, _ in sets], pa.int64()),
                 pa.array([k for _, k in sets], pa.binary()),
                 pa.array([sketch(s).tobytes() if k else None for s, k in sets], pa.binary())],
                names=["doc_id", "h", "n_shingles", "key", "regs"])
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
            .mapInArrow(run, "doc_id long, h long, n_shingles long, key binary, regs binary")
            .withColumn("row", F.monotonically_increasing_id()))


def _band_rows(classes: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders()
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                regs = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16).reshape(-1, BUCKETS)
                keys = band_keys(regs, size, orders)
                node = np.repeat(np.array(part.column("node").to_pylist(), np.int64), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["bucket", "node"])
    return classes.select("node", "regs").mapInArrow(run, "bucket long, node long")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""
    t = percent / 100
    side = classes.select("node", "n_shingles", "regs")
    joined = (pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
              .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4000):
                part = b.slice(lo, 4000)
                ra, rb = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                          for c in ("ra", "rb"))
                near, used = estimate(ra, rb)
                keep = near >= t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(used, 1))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("a", "b")], names=["a", "b"]).filter(pa.array(keep))
    return joined.select("a", "b", "ra", "rb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that are links on their full sets."""
    joined = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("sa"), b.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("a", "b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return joined.mapInArrow(run, "a long, b long")


def compare(nodes: np.ndarray, comps: np.ndarray, side: np.ndarray, sets: list[np.ndarray], bucket: int,
            percent: int, orders: np.ndarray) -> list[tuple[int, int]]:
    """Links across components and, where ``side`` has two values, across
    sides, among members of a bucket that share no earlier bucket."""
    t, size = percent / 100, bands(percent / 100)
    regs = np.stack([sketch(s) for s in sets])
    keys = band_keys(regs, size, orders)
    band = int(np.flatnonzero((keys == bucket).all(axis=0))[0])
    n, two, out = np.array([len(s) for s in sets]), len(set(side.tolist())) > 1, []
    for i in range(len(nodes) - 1):
        j = np.arange(i + 1, len(nodes))
        fit = (comps[j] != comps[i]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent)
        if two:
            fit &= side[j] != side[i]
        j = j[fit]
        j = j[~(keys[j, :band] == keys[i, :band]).any(axis=1)]
        if not len(j):
            continue
        near, used = estimate(regs[i][None], regs[j])
        for k in j[near >= t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(used, 1))]:
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * both >= percent * (n[i] + n[k] - both):
                out.append((int(nodes[i]), int(nodes[k])))
    return out


def _across(members: DataFrame, comp: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components in the buckets that have several. Members of a
    bucket's largest component only have to meet the others, so they are copied
    once for each block of those, and these once for each block of all: a stray
    member of a bucket with a third of all rows moves them once."""
    named = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = (named.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
             .agg(F.max(F.struct("n", "comp")).alias("x"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
             .select("bucket", F.col("x.comp").alias("main")))
    left = cm.staged(named.join(split, "bucket").join(sets, "node").withColumn("stray", F.col("comp") != F.col("main"))
                     .drop("main"), "unresolved")

    def blocks(which) -> Column:
        n = F.greatest(F.ceil(F.count_if(which) / BLOCK), F.ceil(F.sum(F.when(which, F.octet_length("set")).otherwise(0)) / BLOCK_BYTES))
        return F.greatest(n, F.lit(1)).cast("int")
    sizes = left.groupBy("bucket").agg(blocks(~F.col("stray")).alias("mains"), blocks(F.col("stray")).alias("strays"))
    own = F.when(F.col("stray"), F.col("mains") + F.pmod(F.xxhash64("node"), F.col("strays"))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("mains")))
    meets = F.sequence(F.when(F.col("stray"), F.lit(0)).otherwise(F.col("mains")), F.col("mains") + F.col("strays") - 1)
    dealt = (left.join(cm.staged(sizes, "blocks"), "bucket").withColumn("own", own.cast("int")).withColumn("other", F.explode(meets))
             .select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                     "own", "node", "comp", "set")
             .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, key, held = _orders(), None, []

        def links() -> pa.RecordBatch:
            found = compare(np.array([h[1] for h in held]), np.array([h[2] for h in held]), np.array([h[0] for h in held]),
                            [np.frombuffer(h[3], np.uint64) for h in held], key[0], percent, orders) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                               pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "lo", "hi", "own", "node", "comp", "set"))):
                if row[:3] != key:
                    if key is not None and len(held) > 1:
                        yield links()
                    key, held = row[:3], []
                held.append(row[3:])
        if key is not None:
            yield links()
    return dealt.mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Full sets of the classes in ``wanted`` (text_id, text_h, key, node): the
    id and hash of a text of the class, so that ids that are null or repeated
    join no other texts."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"), "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("text_id")) & (F.col("h") == F.col("text_h"))).select("key", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cm.parts(batches, 4_000_000):
            got = [(n, s.tobytes()) for n, k, (s, own) in zip(b.column("node").to_pylist(), b.column("key").to_pylist(),
                                                              shingles(cm.texts_of(b), words))
                   if own == k]  # a hash is no proof
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()),
                                              pa.array([g[1] for g in got], pa.binary())], names=["node", "set"])
    return rows.mapInArrow(run, "node long, set binary")


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b), comp the least node of
    its component: each round hooks nodes to the least neighbour, then halves
    the paths (large star, small star), until no edge changes. A hub's rows
    meet its minimum, a partial aggregation, in a join that can be split.
    After a given number of ``rounds``, nodes of one comp are still of one
    component, but a component may have several comps."""
    edges = cm.staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    before, done = None, 0
    while done != rounds and before != (before := _digest(edges)):
        done += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cm.staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = cm.staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .where("u <> v").distinct(), "large-star")
        least = cm.staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        edges = cm.staged(small.select("u", F.col("m").alias("v")).unionByName(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct(), "small-star")
    named = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("comp"))
    return named.unionByName(edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_anti")
                             .select(F.col("v").alias("node"), F.col("v").alias("comp")))


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 40)))).first())


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept. Documents
    are linked where 100 * intersection >= ``percent`` * union."""
    return _hashed(docs, percent, words).drop("h")


def _hashed(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """``near_duplicates`` with the hash ``h`` of each row's text."""
    rows = cm.staged(_signatures(docs, words), "sketches")
    own = rows.where(F.col("key").isNotNull())
    reps = cm.staged(own.groupBy("key").agg(F.min("doc_id").alias("rep_id"), F.min("row").alias("row")), "classes")
    # any row of the class has its sketch; the class is named by its first row
    classes = cm.staged(own.join(reps, ["key", "row"]).select(
        F.col("row").alias("node"), "key", "rep_id", F.col("doc_id").alias("text_id"), F.col("h").alias("text_h"),
        "n_shingles", "regs"), "class-sketches")
    banded = cm.staged(_band_rows(classes, bands(percent / 100)), "bands")
    shared = cm.staged(banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members"))
                       .where("members > 1"), "shared-bands")
    members = cm.staged(banded.join(shared, "bucket"), "band-members")

    touched = members.select("node").distinct()
    wanted = classes.select("node", "key", "text_id", "text_h").join(touched, "node")
    sets = cm.staged(_sets(docs, wanted, words).dropDuplicates(["node"]) if _repeats(rows)
                     else _sets(docs, wanted, words), "sets")

    pairs = cm.staged(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(),
                      "pairs")
    likely = cm.staged(_likely(pairs, classes, percent), "likely")
    links = cm.staged(_confirmed(likely, sets, percent), "links")
    nearly = cm.staged(components(links, rounds=1), "first-components")
    more = cm.staged(_across(members.select("bucket", "node"), nearly, sets, percent), "more-links")
    comp = cm.staged(components(links.unionByName(more)), "components")

    named = classes.select("node", "key", "rep_id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("rep_id").alias("component_id"))
    of_class = cm.staged(named.join(least, "comp").select("key", "component_id"), "class-components")
    out = rows.select("doc_id", "h", "n_shingles", "key").join(of_class, "key", "left")
    return out.select("doc_id", "h", "n_shingles",
                      F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
                      ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _repeats(rows: DataFrame) -> bool:
    """Whether an id is repeated or null, so that a class's text may be read
    more than once."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("d")).first()
    return r.n != r.d


def drop_near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each group. A row
    goes by its id and text: rows of one id may have texts of several groups,
    and a row with a null id goes where a document with an id is kept."""
    gone = _hashed(docs, percent, words).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone_id"), F.col("h").alias("_gone_h")).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_gone_id"))
                     & (F.xxhash64("text") == F.col("_gone_h")), "left_anti").select(*docs.columns)
