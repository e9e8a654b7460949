"""Operator 4: a Katz backoff language model over all documents.

The model is a bigram model that backs off to unigrams and from there to one
class of unknown words. Counts are discounted by Good-Turing up to a count of
``KATZ``; what the discounts free goes to unseen words:

    P(w | h) = d(r) * r / c(h)        where h w was seen r > 0 times
             = alpha(h) * P(w)        otherwise
    P(w)     = d1(c) * c / N          where w was seen c > 0 times
             = the mass the unigrams' discounts free, otherwise

with alpha(h) = (1 - sum of the seen P(w | h)) / (1 - sum of their P(w)), so
each distribution sums to 1. A history without any discounted count counts as
one larger, which frees 1 / (c(h) + 1). After an unknown word P(w) holds.

Tables grow with the corpus and none is broadcast or collected. The steps:

1. documents become chunks of about ``chunk_chars`` characters; a chunk's tokens
   are numbered by its own distinct words and written to a file in the shared
   folder, its words and their training counts to a table;
2. the words' total counts give the vocabulary; a word's id is its place when
   they are sorted by falling count, so counts follow from ids by a table of
   the distinct counts, of which there are at most sqrt(2 N);
3. chunks get the ids of their words (a join), and send each distinct pair of
   neighbouring words once to one of many buckets by the first word, packed; the
   pairs of frequent first words are dealt over all buckets;
4. a bucket adds up the counts of its pairs (the bigram table, partitioned by
   bucket), and sends each chunk the counts of its pairs and what alpha needs of
   its histories; of the frequent histories (at most ``HOT`` words, each with
   1/HOT of all tokens or more) the parts are added up on the driver;
5. each chunk scores its tokens.

Defined cases: a null text is empty, and an empty text is its end token alone.
Without training tokens all words are unknown and scores are 0. Null ids are in
the training fold. Repeated rows are counted and scored each. An empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import random
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as cm

KATZ = 5
HOT = 1 << 16
END = ""                # the end token's word; no word is empty
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


# ---------------------------------------------------------------- the numbers

def discounts(n: dict[int, int], k: int = KATZ) -> np.ndarray:
    """d(r) for r = 0 .. k by Good-Turing from the numbers ``n`` of events seen
    r times; 1 beyond. With too few events for a valid discount, the largest
    smaller k that has one, else absolute discounting."""
    top = k
    while k >= 1:
        if all(n.get(r, 0) > 0 for r in range(1, k + 2)):
            tail = (k + 1) * n[k + 1] / n[1]
            d = [1.0] + [((r + 1) * n[r + 1] / (n[r] * r) - tail) / (1 - tail) if tail < 1 else -1.0
                         for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d[1:]):
                return np.array(d + [1.0] * (top - k))
        k -= 1
    one, two = n.get(1, 0), n.get(2, 0)
    less = one / (one + 2 * two) if one else 0.0
    return np.array([1.0] + [(r - min(less, 0.999)) / r for r in range(1, top + 1)])


class Unigrams:
    """Counts and probabilities by word id, from the table of distinct counts."""

    def __init__(self, classes: list[tuple[int, int]]):
        """``classes``: (count, words with that count)."""
        classes = sorted(classes, reverse=True)
        self.count = np.array([c for c, _ in classes], np.int64)
        self.upto = np.cumsum([m for _, m in classes]).astype(np.int64)
        self.words = int(self.upto[-1]) if classes else 0                   # V
        self.tokens = int(sum(c * m for c, m in classes))                   # N
        self.d = discounts({c: m for c, m in classes if c <= KATZ + 1})
        free = sum((1 - self.d[c]) * c * m for c, m in classes if c <= KATZ)
        self.total = self.tokens if free > 0 else self.tokens + 1           # so that something is free
        self.unknown = (free if free > 0 else 1.0) / self.total

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of ids; -1 is an unknown word."""
        out = np.zeros(len(ids), np.int64)
        known = ids >= 0
        out[known] = self.count[np.searchsorted(self.upto, ids[known], "right")]
        return out

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        d = self.d[np.minimum(counts, KATZ)]
        d[counts > KATZ] = 1.0
        return np.where(counts > 0, d * counts / self.total, self.unknown)

    def hot(self, at_least: int) -> int:
        """Ids below this are frequent histories."""
        n = int(np.searchsorted(-self.count, -max(self.tokens / HOT, at_least), "right"))
        return int(self.upto[n - 1]) if n else 0


def alphas(d: np.ndarray, total: np.ndarray, seen: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, alpha) of histories: ``total`` c(h); ``seen`` (histories x
    KATZ) how many of their words were seen 1 .. KATZ times; ``mass`` the sum of
    their seen words' unigram probabilities."""
    free = (seen * ((1 - d[1:]) * np.arange(1, KATZ + 1))).sum(axis=1)
    under = np.where(free > 0, total, total + 1).astype(np.float64)
    left = np.where(free > 0, free, 1.0) / np.maximum(under, 1)
    return under, left / np.maximum(1 - mass, 1e-300)


# -------------------------------------------------------------------- packing

def squeeze(a: np.ndarray) -> bytes:
    """An array of whole numbers, byte plane by byte plane, compressed."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(a).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def unsqueeze(raw, kind) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    if not n:
        return np.zeros(0, kind)
    plain = pa.Codec("zstd").decompress(raw[16:], size, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(-1, n).T).view(kind).ravel()


def deltas(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def undeltas(raw) -> np.ndarray:
    return np.cumsum(unsqueeze(raw, np.uint64), dtype=np.uint64)


# --------------------------------------------------------------------- chunks

def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Local word numbers of the texts' tokens, tokens of each text, and the
    words by number; the end token is the last one."""
    codes, number, words = cm.split_words(texts)
    out = np.full(len(codes) + len(texts), len(words), np.int32)
    out[np.arange(len(codes)) + np.repeat(np.arange(len(texts)), number)] = codes
    return out, number + 1, words + [END]


class Chunk:
    """A chunk's file: ids and folds of its documents, and their tokens."""

    def __init__(self, doc_ids: list, held: np.ndarray, sizes: np.ndarray, tokens: np.ndarray):
        self.doc_ids, self.held, self.sizes, self.tokens = doc_ids, held, sizes, tokens

    def write(self, uri: str) -> None:
        store, path = cm.file_store(uri)
        ids = np.array([d if d is not None else 0 for d in self.doc_ids], np.int64)
        flags = np.array([d is None for d in self.doc_ids], np.uint8) + 2 * self.held.astype(np.uint8)
        with store.open_output_stream(path) as f:
            for a in (ids, flags, self.sizes.astype(np.int64), self.tokens.astype(np.int32)):
                raw = squeeze(a)
                f.write(len(raw).to_bytes(8, "little") + raw)

    @classmethod
    def read(cls, uri: str) -> "Chunk":
        store, path = cm.file_store(uri)
        with store.open_input_stream(path) as f:
            ids, flags, sizes, tokens = (unsqueeze(f.read(int.from_bytes(f.read(8), "little")), k)
                                         for k in (np.int64, np.uint8, np.int64, np.int32))
        return cls([None if z else int(d) for d, z in zip(ids, flags & 1)], flags >= 2, sizes, tokens)

    def pairs(self, ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chunk's distinct pairs (history, word) as sorted keys, their
        counts in the training fold, and which pair each token is (-1: the
        history is unknown). As a history, the id ``words`` is the start; as a
        word, it is an unknown word."""
        word = ids[self.tokens]
        history = np.empty_like(word)
        history[1:] = word[:-1]
        starts = np.cumsum(self.sizes) - self.sizes
        history[starts] = words
        known, word = history >= 0, np.where(word < 0, words, word)
        keys, which = np.unique((history[known] * (words + 1) + word[known]).astype(np.uint64), return_inverse=True)
        train = np.repeat(~self.held, self.sizes)[known]
        counts = np.bincount(which[train], minlength=len(keys))
        place = np.full(len(word), -1, np.int64)
        place[known] = which
        return keys, counts, place


def bucket_of(keys: np.ndarray, words: int, hot: int, buckets: int) -> np.ndarray:
    """By the history; the pairs of hot histories, and of the start, by both."""
    history = keys // np.uint64(words + 1)
    spread = (history < np.uint64(hot)) | (history == np.uint64(words))
    x = np.where(spread, keys, history * np.uint64(words + 1))
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def history_stats(keys: np.ndarray, counts: np.ndarray, uni: Unigrams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the histories of sorted keys: ids, words seen 1 .. KATZ times, and the
    unigram mass of all seen words."""
    base = np.uint64(uni.words + 1)
    history, word = keys // base, (keys % base).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]])) if len(keys) else np.zeros(0, int)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros((0, KATZ), np.int64), np.zeros(0)
    p = np.where(counts > 0, uni.probabilities(uni.counts(np.where(word == uni.words, -1, word))), 0.0)
    seen = np.stack([np.add.reduceat((counts == r).astype(np.int64), first) for r in range(1, KATZ + 1)], axis=1)
    return history[first].astype(np.int64), seen, np.add.reduceat(p, first)


# ------------------------------------------------------------------- on Spark

def held_out(doc_id: Column) -> Column:
    """The fold the model does not learn from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def _chunks(docs: DataFrame, folder: str, chunk_chars: int) -> DataFrame:
    """Write the chunk files; (chunk, n, words, counts) of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = cm.file_store(folder)
        store.create_dir(path, recursive=True)
        for b in cm.parts(batches, chunk_chars):
            held = np.array(b.column("held").to_pylist(), bool)
            tokens, sizes, words = tokens_of(cm.texts_of(b))
            name = random.SystemRandom().getrandbits(62)        # new in each attempt
            Chunk(b.column("doc_id").to_pylist(), held, sizes, tokens).write(f"{folder}/{name}")
            counts = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([len(tokens)], pa.int64()),
                 pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64()))],
                names=["chunk", "n", "words", "counts"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held"))
    return cm.staged(rows.mapInArrow(run, "chunk long, n long, words array<string>, counts array<long>"), "lm-chunks")


def _vocabulary(words: DataFrame) -> tuple[DataFrame, Unigrams]:
    """(word, id) of all training words, and their counts by id."""
    counted = words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0")
    ordered = cm.staged(counted.repartitionByRange(F.desc("c"), F.xxhash64("word"))
                        .sortWithinPartitions(F.desc("c"), F.xxhash64("word"))
                        .withColumn("at", F.monotonically_increasing_id()), "lm-vocabulary")
    classes = ordered.groupBy("c").agg(F.count(F.lit(1)).alias("m")).collect()      # at most sqrt(2 N) rows
    part = F.shiftright("at", 33)
    sizes = sorted((r.part, r.n) for r in ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, rows = 0, []
    for k, n in sizes:                                                              # a row a partition
        rows.append((k, before - (k << 33)))
        before += n
    offsets = ordered.sparkSession.createDataFrame(rows, "part long, off long")
    ids = ordered.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "word", (F.col("at") + F.col("off")).alias("id"))
    return ids, Unigrams([(r.c, r.m) for r in classes])


MOVED = "bucket int, chunk long, ids binary, keys binary, counts binary"
TOTAL = ("bucket int, chunk long, ids binary, counts binary, seen binary, mass binary, keys binary, "
         "hot array<struct<h long, seen array<long>, mass double>>, events array<long>")


def score(docs: DataFrame, chunk_chars: int = 12_000_000, bucket_tokens: int = 1_500_000) -> DataFrame:
    """Train on the documents outside the held-out fold, and score all."""
    spark = docs.sparkSession
    folder = cm.scratch_path(spark, "llm-lm-files")
    chunks = _chunks(docs, folder, chunk_chars)
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("j", "x")).select(
        "chunk", "j", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    ids, uni = _vocabulary(words)
    first = chunks.agg(F.sum("n").alias("n")).first()
    buckets = max(1, -(-(first.n or 0) // bucket_tokens))
    hot, v = uni.hot(bucket_tokens // 64), uni.words
    held = spark.sparkContext.broadcast(uni)        # a row for each distinct count

    def ask(group: pa.Table) -> pa.Table:
        """A chunk's pairs, by bucket."""
        name = group.column("chunk")[0].as_py()
        own = np.full(group.num_rows, -1, np.int64)
        own[group.column("j").to_numpy()] = group.column("id").fill_null(-1).to_numpy()
        keys, counts, _ = Chunk.read(f"{folder}/{name}").pairs(own, v)
        at = bucket_of(keys, v, hot, buckets)
        rows = [{"bucket": name % buckets, "chunk": name, "ids": squeeze(own), "keys": None, "counts": None}]
        order = np.argsort(at, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else ():
            rows.append({"bucket": int(at[part[0]]), "chunk": name, "ids": None, "keys": deltas(keys[part]),
                         "counts": squeeze(counts[part].astype(np.uint32))})
        return pa.Table.from_pylist(rows, schema=pa.schema([
            ("bucket", pa.int32()), ("chunk", pa.int64()), ("ids", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())]))

    def add(group: pa.Table) -> pa.Table:
        """Totals of a bucket's pairs, and what each chunk asked for."""
        table, out = held.value, []
        asked = []
        for r in group.to_pylist():
            if r["ids"] is not None:
                out.append({"bucket": r["bucket"], "chunk": r["chunk"], "ids": r["ids"]})
            else:
                asked.append((r["chunk"], undeltas(r["keys"]), unsqueeze(r["counts"], np.uint32)))
        bucket = group.column("bucket")[0].as_py()
        if asked:
            keys, which = np.unique(np.concatenate([k for _, k, _ in asked]), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, which, np.concatenate([c for _, _, c in asked]))
            history, seen, mass = history_stats(keys, total, table)
            spread = (history < hot) | (history == v)
            at = 0
            for chunk, k, _ in asked:
                mine = total[which[at:at + len(k)]]
                at += len(k)
                of = np.unique((k // np.uint64(v + 1)).astype(np.int64))
                of = np.searchsorted(history, of)
                of = of[~spread[of]]
                out.append({"bucket": bucket, "chunk": chunk, "counts": squeeze(mine.astype(np.uint32)),
                            "seen": squeeze(seen[of].astype(np.uint32).ravel()), "mass": squeeze(mass[of])})
            known = total > 0
            out.append({"bucket": bucket, "keys": deltas(keys[known]), "counts": squeeze(total[known].astype(np.uint32)),
                        "hot": [{"h": int(h), "seen": s.tolist(), "mass": float(m)}
                                for h, s, m in zip(history[spread], seen[spread], mass[spread])],
                        "events": np.bincount(np.minimum(total, KATZ + 2), minlength=KATZ + 3)[:KATZ + 2].tolist()})
        return pa.Table.from_pylist(out, schema=pa.schema([
            ("bucket", pa.int32()), ("chunk", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()),
            ("seen", pa.binary()), ("mass", pa.binary()), ("keys", pa.binary()),
            ("hot", pa.list_(pa.struct([("h", pa.int64()), ("seen", pa.list_(pa.int64())), ("mass", pa.float64())]))),
            ("events", pa.list_(pa.int64()))]))

    named = words.select("chunk", "j", "word").join(ids, "word", "left").select("chunk", "j", "id")
    moved = named.groupBy("chunk").applyInArrow(ask, MOVED)
    totals = cm.staged(moved.groupBy("bucket").applyInArrow(add, TOTAL), "lm-bigrams")

    model = totals.where("chunk IS NULL")
    events = model.select(F.posexplode("events").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()
    d = discounts({r.r: r.n for r in events if r.r > 0})
    parts = model.select(F.explode("hot").alias("x")).select("x.*").groupBy("h").agg(
        F.sum("mass").alias("mass"), *[F.sum(F.col("seen")[k]).alias(f"s{k}") for k in range(KATZ)]).collect()
    parts.sort(key=lambda r: r.h)                   # at most HOT + 1 rows
    starts = docs.where(~held_out(F.col("doc_id"))).count()
    hot_ids = np.array([r.h for r in parts], np.int64)
    hot_seen = np.array([[r[f"s{k}"] for k in range(KATZ)] for r in parts], np.int64).reshape(-1, KATZ)
    hot_total = np.where(hot_ids == v, starts, uni.counts(np.where(hot_ids == v, -1, hot_ids)))
    hot_under, hot_alpha = alphas(d, hot_total, hot_seen, np.array([r.mass for r in parts], np.float64))

    def answer(group: pa.Table) -> pa.Table:
        """Scores of a chunk's documents."""
        table, rows = held.value, group.to_pylist()
        name = rows[0]["chunk"]
        own = next(unsqueeze(r["ids"], np.int64) for r in rows if r["ids"] is not None)
        chunk = Chunk.read(f"{folder}/{name}")
        keys, _, place = chunk.pairs(own, v)
        at = bucket_of(keys, v, hot, buckets)
        seen_pairs = np.zeros(len(keys), np.int64)
        h_ids, h_seen, h_mass = [], [], []
        for r in rows:
            if r["ids"] is not None:
                continue
            mine = np.flatnonzero(at == r["bucket"])
            seen_pairs[mine] = unsqueeze(r["counts"], np.uint32)
            of = np.unique((keys[mine] // np.uint64(v + 1)).astype(np.int64))
            h_ids.append(of[(of >= hot) & (of != v)])
            h_seen.append(unsqueeze(r["seen"], np.uint32).reshape(-1, KATZ))
            h_mass.append(unsqueeze(r["mass"], np.float64))
        h = np.concatenate([*h_ids, np.zeros(0, np.int64)])
        under, alpha = alphas(d, table.counts(h), np.concatenate([*h_seen, np.zeros((0, KATZ), np.uint32)]),
                              np.concatenate([*h_mass, np.zeros(0)]))
        h, under, alpha = (np.concatenate(x) for x in ((h, hot_ids), (under, hot_under), (alpha, hot_alpha)))
        order = np.argsort(h)
        h, under, alpha = h[order], under[order], alpha[order]
        counts = table.counts(own)
        c = counts[chunk.tokens]
        p = table.probabilities(counts)[chunk.tokens]
        asks = place >= 0
        w = np.searchsorted(h, (keys // np.uint64(v + 1)).astype(np.int64))[place[asks]]
        r = seen_pairs[place[asks]]
        dr = d[np.minimum(r, KATZ)]
        dr[r > KATZ] = 1.0
        p[asks] = np.where(r > 0, dr * r / under[w], alpha[w] * p[asks])
        logs = np.log10(p)
        base = np.log10((c + 1) / (table.tokens + table.words + 1))
        ends = np.cumsum(chunk.sizes)
        cut = ends - chunk.sizes

        def per_doc(x):
            return np.add.reduceat(x, cut)
        return pa.table({"doc_id": pa.array(chunk.doc_ids, pa.int64()), "held_out": pa.array(chunk.held),
                         "n_tokens": pa.array(chunk.sizes), "n_known": pa.array(per_doc((c > 0).astype(np.int64))),
                         "train_tokens": pa.array(np.full(len(ends), table.tokens, np.int64)),
                         "base_score": pa.array(per_doc(base)), "score": pa.array(per_doc(logs))})
    return (totals.where("chunk IS NOT NULL").select("chunk", "bucket", "ids", "counts", "seen", "mass")
            .groupBy("chunk").applyInArrow(answer, RESULT))
