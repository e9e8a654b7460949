"""Operator 11: phrase collocation mining over count streams in prefix and in
suffix order, merged in lockstep.

A phrase is a run of words of one piece of a text. Tasks count the phrases of up
to ``max_words`` words in blocks of text by sorting their codes. Most phrases
are rare, so a block has nearly as many as words: its counts are packed, a run for
each part of all phrases, and travel as one row a block and part; a task adds up
the runs of a part. A phrase has one count a block, so none is a large group. The
counts of at least ``min_count`` are then a stream of rows (lang, words, f) that is
laid out twice:

* in prefix order, by first word, then second, ...: a phrase follows the
  phrases it begins with, so one pass that remembers the last row of each length
  gives it the counts of its beginnings, and gives each phrase the largest count
  among its extensions to the right;
* in suffix order, by last word, then the one before, ...: the same pass gives
  the counts of its ends and the largest count among extensions to the left.

The pass compares no words and holds no table: the order alone says which rows
belong together, and a beginning of a frequent phrase is at least as frequent, so
it is always there. A stream is cut into ranges by keys drawn from a sample of
it (which decides only where the cuts are). A row whose extensions reach over a
cut is repeated in each range that they reach, so a word that begins a third of
all phrases is spread over many tasks; its largest extension is the largest of
its copies. The number of all words of a language is a row of no words, which
sorts first.

Score: for each cut of a phrase into two parts with counts l and r,
floor(1000000 * f * f / (l * r)) in 38-digit integers; the least one counts, and
among equal ones that of the shortest first part. A phrase is dropped if a longer
candidate holds it and has ``containment`` percent of its count or more. It is
enough to look at extensions by one word: one that a longer phrase forces lies
between the two in count.

Defined cases: null or empty texts have no words; a null lang is ``und``. Rows
that are repeated count each time. Empty tables give empty results; other columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as cm
from . import text_bytes as tb

#: where a text falls apart into pieces, fixed by the query's contract
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
TABLE = tb.byte_table(spaces=b"\x20\x09", marks=PIECE_ENDS)
COUNTS = "lang string, phrase string, f long"
SPREAD = np.uint64(0x9E3779B97F4A7C15)
MOST_RANGES = 4096       # cuts and the sample for them are on the driver
SAMPLED = 16             # keys a range


# ------------------------------------------------------------ counts of phrases

def prefix_order(of: np.ndarray, codes: np.ndarray, mark: int, size: int, max_words: int) -> list[np.ndarray]:
    """For every word that begins a phrase, sorted: its language, and the
    place + 1 of its first, second, ... word (0: the piece is over)."""
    at = np.flatnonzero(codes != mark)
    cols, alive = [of[at].astype(np.int32)], np.ones(len(at), bool)
    for k in range(max_words):
        here = codes[np.minimum(at + k, len(codes) - 1)] if len(codes) else at
        alive = alive & (at + k < len(codes)) & (here != mark)
        cols.append(np.where(alive, here + 1, 0).astype(np.int32))
    bits = int(size).bit_length()
    if int(of.max(initial=0)).bit_length() + bits * max_words > 63:     # too many words for one number
        order = np.lexsort(cols[::-1])
        return [c[order] for c in cols]
    key = cols[0].astype(np.int64)
    for c in cols[1:]:
        key = (key << bits) | c
    key.sort()
    shifts = [bits * (max_words - k) for k in range(max_words + 1)]
    return [(key >> shifts[0]).astype(np.int32), *(((key >> s) & ((1 << bits) - 1)).astype(np.int32) for s in shifts[1:])]


def block_counts(texts: pa.Array, langs: pa.Array, max_words: int):
    """For each length, from that of no words, which counts all words of one
    block of texts: each row's lang (a place among the block's), a hash of its
    lang and phrase, its count, and a function that gives the phrases in an order."""
    lang = langs.dictionary_encode()
    # a mark stands alone, so it is a word of its own that ends a piece, as does the end of a text
    marked = pc.binary_join_element_wise(pc.replace_substring(tb.mapped(texts, TABLE), ".", " . "), pa.scalar(" .", texts.type),
                                         pa.scalar("", texts.type))
    codes, number, words = tb.words(marked)
    of = np.repeat(lang.indices.to_numpy(), number)
    mark = pc.index(words, pa.scalar(".", words.type)).as_py()
    of, codes = of[codes >= 0], codes[codes >= 0]
    word_hash = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    key = np.fromiter((xxhash.xxh64_intdigest(w) for w in lang.dictionary.to_pylist()), np.uint64, len(lang.dictionary))
    cols = prefix_order(of, codes, mark, len(words), max_words)
    del of, codes, marked
    key, new = key[cols[0]], np.diff(cols[0], prepend=-1) != 0
    for n in range(max_words + 1):
        if n:
            new = new | (np.diff(cols[n], prepend=-1) != 0)
            key = key * SPREAD + word_hash[cols[n] - 1]      # where there is no word, no row is made of it
        first = np.flatnonzero(new)
        f = np.diff(np.append(first, len(new)))
        if n:
            f, first = f[cols[n][first] > 0], first[cols[n][first] > 0]

        def phrases(order: np.ndarray, n=n, first=first) -> pa.Array:
            at = first[order]
            taken = [words.take(pa.array(cols[k][at] - 1)) for k in range(1, n + 1)]
            return taken[0] if n == 1 else pc.binary_join_element_wise(*taken, pa.scalar(" ", words.type)) if n else \
                pa.array([""] * len(at), words.type)
        yield lang.dictionary, cols[0][first], key[first], f, phrases


RUN = "part int, lang string, size int, phrases binary, counts binary"


def sorted_runs(batches: Iterator[pa.RecordBatch], parts: int, max_words: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, lang, size, phrases, counts): the counts of a block of texts
    that belong to a part, compressed; phrases are joined by line ends, which no
    word holds."""
    codec = pa.Codec("zstd", compression_level=5)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        for langs, lang, key, f, phrases in block_counts(t.column("text").chunk(0), t.column("lang").chunk(0), max_words):
            group = ((key ^ (key >> np.uint64(32))) % np.uint64(parts)).astype(np.int64) * len(langs) + lang
            order = np.argsort(group, kind="stable")
            if not len(order):
                continue
            start = np.flatnonzero(np.diff(group[order], prepend=-1))
            ends = np.append(start, len(order))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), phrases(order)), "\n").cast(pa.binary())
            f, owner = f[order].astype("<i4"), group[order][start]
            raw = [joined[k].as_buffer() for k in range(len(start))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner // len(langs), pa.int32()), langs.take(pa.array(owner % len(langs))).cast(pa.string()),
                 pa.array([r.size for r in raw], pa.int32()), pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary()),
                 pa.array([codec.compress(f[a:b].tobytes(), asbytes=True) for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                names=["part", "lang", "size", "phrases", "counts"])
            del joined, raw, order, group             # given back before the next length
            pa.default_memory_pool().release_unused()
    held, size = [], 0
    for b in cm.parts(batches, block_bytes):
        held.append(b)
        size += b.column("text").nbytes
        if size >= block_bytes:
            yield from packed(held)
            held, size = [], 0
    if held:
        yield from packed(held)


def added_up(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """The counts of ``min_count`` or more of each part and lang, whose runs
    follow each other."""
    codec = pa.Codec("zstd")

    def summed(lang: str, runs: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        t = pa.concat_tables(runs).group_by("phrase", use_threads=False).aggregate([("f", "sum")])
        t = t.filter(pc.or_(pc.greater_equal(t.column("f_sum"), min_count), pc.equal(t.column("phrase"), "")))
        yield from pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), t.num_rows), "phrase": t.column("phrase"),
                             "f": t.column("f_sum").cast(pa.int64())}).combine_chunks().to_batches()
        pa.default_memory_pool().release_unused()
    own, held = None, []
    for b in batches:
        for part, lang, size, phrases, counts in zip(*(b.column(c) for c in ("part", "lang", "size", "phrases", "counts"))):
            if (part.as_py(), lang.as_py()) != own and held:
                yield from summed(own[1], held)
                held = []
            own, size = (part.as_py(), lang.as_py()), size.as_py()
            raw = codec.decompress(phrases.as_buffer(), size)
            text = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, size], np.int32)), raw])
            phrase = pc.split_pattern(text, "\n").flatten()
            f = np.frombuffer(codec.decompress(counts.as_buffer(), 4 * len(phrase)), "<i4")
            held.append(pa.table({"phrase": phrase, "f": pa.array(f)}))
    if held:
        yield from summed(own[1], held)


def count_phrases(docs: DataFrame, max_words: int, min_count: int, block_bytes: int = 6 << 20,
                  part_bytes: int = 4 << 20) -> DataFrame:
    """lang, words array<string>, f of the phrases with ``min_count`` or more.
    A task adds up one part of a lang at a time: that of ``part_bytes`` of text."""
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    runs = (rows.mapInArrow(lambda b: sorted_runs(b, parts, max_words, block_bytes), RUN)
            .repartition(min(parts, 20_000), "part").sortWithinPartitions("part", "lang"))
    counts = runs.mapInArrow(lambda b: added_up(b, min_count), COUNTS)
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    return cm.staged(counts.select("lang", words.alias("words"), "f"), "phrase-counts")


# ------------------------------------------------- streams and the lockstep pass

def cut_points(counts: DataFrame, key: Column, range_rows: int) -> list[tuple]:
    """Keys (lang, words in the stream's order) that cut a stream into ranges
    of about ``range_rows`` rows."""
    total = counts.count()
    ranges = max(1, min(MOST_RANGES, -(-total // range_rows)))
    if ranges == 1:
        return []
    every = max(1, total // (ranges * SAMPLED))
    drawn = counts.where(F.pmod(F.xxhash64("lang", "words"), F.lit(every)) == 0).select("lang", key.alias("key")).collect()
    drawn = sorted({(r.lang, *r.key) for r in drawn})
    return sorted({drawn[k * len(drawn) // ranges] for k in range(1, ranges)}) if drawn else []


class _After:
    """Comes after any word."""

    def __lt__(self, other) -> bool:
        return False

    def __gt__(self, other) -> bool:
        return True


AFTER = _After()


def deal(rows: DataFrame, cuts: list[tuple], from_end: bool, max_words: int) -> DataFrame:
    """Give each row its range; a row whose extensions lie in several ranges
    goes to each of them."""
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [(lang, *(words[::-1] if from_end else words)) for lang, words in
                    zip(b.column("lang").to_pylist(), b.column("words").to_pylist())]
            lo = np.fromiter((bisect_right(cuts, k) for k in keys), np.int64, len(keys))
            hi = lo.copy()
            for i, k in enumerate(keys):
                if len(k) <= max_words and lo[i] < len(cuts) and cuts[lo[i]][:len(k)] == k:
                    hi[i] = bisect_right(cuts, (*k, AFTER), lo=int(lo[i]))
            n = hi - lo + 1
            take = np.repeat(np.arange(len(keys)), n)
            span = np.arange(len(take)) - np.repeat(np.cumsum(n) - n, n) + lo[take]
            out = b.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(span, pa.int32()), *out.columns], names=["span", *out.schema.names])
    dealt = rows.mapInArrow(run, f"span int, {_ddl(schema)}")
    order = F.reverse("words") if from_end else F.col("words")
    return dealt.repartition(len(cuts) + 1, "span").sortWithinPartitions("span", "lang", order)


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


class Lockstep:
    """Reads one stream batch by batch, in its order, and remembers of each
    length only the last row: adds ``heads`` (the counts of the row's
    beginnings of 0, 1, ... words in this order) and ``wider`` (the largest
    count of its extensions by one word)."""

    def __init__(self, max_words: int):
        self.max = max_words
        self.last = np.zeros(max_words + 1, np.int64)                 # f of the last row of each length
        self.open: dict[int, list] = {}                               # length -> [row, its heads, largest extension]

    def step(self, n: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int], np.ndarray]:
        """heads (rows, max_words), the largest extension of each row within
        the batch, for each length the row still open at the end (if any), and
        what the batch adds at its start to the rows open before, by length."""
        rows = len(n)
        heads, wider = np.zeros((rows, self.max), np.int64), np.zeros(rows, np.int64)
        before, still = np.zeros(self.max, np.int64), {}
        for j in range(self.max):
            own = np.maximum.accumulate(np.where(n == j, np.arange(rows), -1))
            heads[:, j] = np.where(own >= 0, f[np.maximum(own, 0)], self.last[j])
            if own[-1] >= 0:
                still[j] = int(own[-1])
            longer = np.flatnonzero(n == j + 1)
            if len(longer):
                owner = own[longer]
                new = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0]))
                most = np.maximum.reduceat(f[longer], new)
                for o, m in zip(owner[new[:1]].tolist(), most[:1].tolist()):
                    if o < 0:
                        before[j] = m
                known = owner[new] >= 0
                wider[owner[new][known]] = most[known]
        for j, row in still.items():
            self.last[j] = f[row]
        return heads, wider, still, before


def lockstep(stream: DataFrame, max_words: int, heads: str, wider: str) -> DataFrame:
    """The stream's rows with ``heads`` and ``wider`` of its order. Copies of a
    row in several ranges, or in a batch and the next, keep their own ``wider``."""
    rows = stream.drop("span")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pass_ = Lockstep(max_words)
        waiting: dict[int, pa.RecordBatch] = {}       # the last row of each length, until its extensions are over
        most: dict[int, int] = {}
        for b in batches:
            if not b.num_rows:
                continue
            n = pc.list_value_length(b.column("words")).to_numpy(zero_copy_only=False).astype(np.int64)
            h, w, still, before = pass_.step(n, b.column("f").to_numpy())
            for j in list(waiting):
                most[j] = max(most[j], int(before[j]))
                if j in still:
                    yield _with(waiting.pop(j), np.array([most.pop(j)]), wider)
            ends = np.concatenate([[0], np.cumsum(np.minimum(n, max_words))])
            flat = h[np.arange(max_words)[None, :] < n[:, None]]
            out = pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                                             names=[*b.schema.names, heads])
            keep = np.ones(len(n), bool)
            for j, row in still.items():
                waiting[j], most[j] = out.slice(row, 1), int(w[row])
                keep[row] = False
            yield _with(out.filter(pa.array(keep)), w[keep], wider)
        for j, row in waiting.items():
            yield _with(row, np.array([most[j]]), wider)
    return rows.mapInArrow(run, f"{_ddl(rows.schema)}, {heads} array<long>, {wider} long")


def _with(rows: pa.RecordBatch, values: np.ndarray, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(values, pa.int64())], names=[*rows.schema.names, name])


def annotated(counts: DataFrame, max_words: int, range_rows: int) -> DataFrame:
    """lang, words, f, begins (counts of the first 0, 1, ... words), ends (of
    the last 0, 1, ... words), wider (the largest count of an extension)."""
    forward = cut_points(counts, F.col("words"), range_rows)
    backward = cut_points(counts, F.reverse("words"), range_rows)
    prefix = lockstep(deal(counts, forward, False, max_words), max_words, "begins", "right")
    suffix = lockstep(deal(prefix, backward, True, max_words), max_words, "ends", "left")
    # copies of a row come from cuts; only their extensions differ
    return suffix.where(F.size("words") > 0).groupBy("lang", "words", "f", "begins", "ends").agg(
        F.max(F.greatest("left", "right")).alias("wider"))


# ------------------------------------------------------------------- the report

def cut_scores(max_words: int) -> Column:
    """The least struct (score, k, l, r) over the cuts of a phrase."""
    def exact(c) -> Column:
        return c.cast("decimal(38,0)")

    def at(k: Column) -> Column:
        left, right = F.col("begins")[k], F.col("ends")[F.size("words") - k]
        # a million times f * f has up to 38 digits where f is below 10**16; l * r likewise
        score = F.call_function("div", exact(F.lit(1_000_000)) * exact(F.col("f")) * exact(F.col("f")),
                                exact(left) * exact(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))
    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("words") - 1), at))


def mine_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, containment: int = 50, top: int = 2000,
                 range_rows: int = 50_000) -> DataFrame:
    """The ``top`` phrases of two or more words of each language: lang, rank,
    phrase, a, l, r, n, score."""
    counts = count_phrases(docs, max_words, min_count)
    rows = annotated(counts, max_words, range_rows).where(
        (F.size("words") >= 2) & (100 * F.col("wider") < containment * F.col("f")))
    best = rows.withColumn("cut", cut_scores(max_words)).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), F.col("begins")[0].alias("n"), F.col("cut.score").alias("score"))
    # the best of each of a language's parts first, so that no task ranks all of its phrases
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    best = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(32))).withColumn("rank", some).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
