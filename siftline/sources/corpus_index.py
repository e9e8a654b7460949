"""Keyword x category search over an indexed corpus.

``corpus.corpus_search`` reads every text for each query. Here texts are read
once, into postings that a search opens by need:

* a text, lower-cased, is cut at each space; its words (with whatever
  punctuation they have) and their positions are the postings. They are gathered
  where the texts are read, a block of texts at a time: a row has a word, a
  category, the block's documents that hold the word, and their positions one
  document after another. So the shuffle moves a row for each distinct word of a
  block, not for each word of a text, and a word's positions as plain integers;
* rows are dealt into buckets by a hash of the word, a folder each. A word that
  most texts hold is written by many tasks: the task that read the texts is part
  of how rows are dealt;
* the dictionary has each distinct word with its bucket.

A phrase is in a text iff its parts, cut at spaces too, lie at consecutive
positions: the first part ends a word, the last one begins a word, those between
are words, and a single part lies anywhere in a word. So the result is that of
containment in the text, character by character. A search looks its parts up in
the dictionary, reads the buckets of the words found and no others, keeps those
words' rows as they are read, and checks phrases by position in one aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ARXIV_MAX_KEYWORDS, ARXIV_MAX_RESULTS

#: the positions of document k of a row are those of ``at`` from ``upto[k - 1]`` to ``upto[k]``
POSTING = "word string, category string, doc array<bigint>, recency array<bigint>, upto array<int>, at array<int>"
BLOCK_BYTES = 16 << 20


def _postings(block_bytes: int = BLOCK_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes postings of texts (doc, recency, category, text), in blocks of
    about ``block_bytes`` of text, a longer text in one with those before it."""
    def lists_of(starts: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([starts, [len(values)]]), pa.int32()), values)

    def block(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = pc.split_pattern(b.column("text").cast(pa.large_string()), " ")
        number = np.diff(lists.offsets.to_numpy())
        words, kinds = lists.flatten().dictionary_encode(), b.column("category").dictionary_encode("encode")
        row = np.repeat(np.arange(b.num_rows), number)
        at = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        key = kinds.indices.to_numpy()[row].astype(np.int64) * len(words.dictionary) + words.indices.to_numpy()
        order = np.argsort(key, kind="stable")            # a word's texts and positions stay in order
        key, row, at = key[order], row[order], at[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        runs = np.flatnonzero(new | np.concatenate([[True], row[1:] != row[:-1]]))     # a text of a posting each
        first, rows = np.flatnonzero(new), np.flatnonzero(new[runs])
        ends = np.concatenate([runs[1:], [len(key)]])
        upto = ends - np.repeat(first, np.diff(np.concatenate([rows, [len(runs)]])))
        texts = pa.array(row[runs])
        return pa.RecordBatch.from_arrays(
            [words.dictionary.take(pa.array(key[first] % len(words.dictionary))).cast(pa.string()),
             kinds.dictionary.take(pa.array(key[first] // len(words.dictionary))),
             lists_of(rows, b.column("doc").take(texts)), lists_of(rows, b.column("recency").take(texts)),
             lists_of(rows, pa.array(upto, pa.int32())), lists_of(first, pa.array(at, pa.int32()))],
            names=["word", "category", "doc", "recency", "upto", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends, lo = np.cumsum(pc.binary_length(b.column("text")).to_numpy(), dtype=np.int64), 0
            while lo < b.num_rows:
                hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + block_bytes)) + 1
                yield block(b.slice(lo, hi - lo))
                lo = hi
    return run


@dataclass(frozen=True)
class CorpusIndex:
    """An index under ``root``, a folder every executor can reach."""
    root: str
    buckets: int = 256

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("word"), F.lit(self.buckets)).cast("int")

    def build(self, corpus: DataFrame, doc: str, text_cols: Sequence[str], category: str, recency: str,
              salts: int = 8) -> "CorpusIndex":
        """Index a corpus; ``doc`` and ``recency`` are integers, ``doc`` is unique."""
        text = F.lower(F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols]))
        rows = corpus.select(F.col(doc).cast("bigint").alias("doc"), F.col(recency).cast("bigint").alias("recency"),
                             F.col(category).cast("string").alias("category"), text.alias("text")).mapInArrow(_postings(), POSTING)
        rows = rows.withColumn("bucket", self._bucket()).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        (rows.repartition("bucket", "salt").drop("salt").sortWithinPartitions("bucket", "word")
         .write.option("compression", "zstd").partitionBy("bucket").parquet(f"{self.root}/postings"))
        (self._postings(corpus.sparkSession).select("word", "bucket").distinct()
         .sortWithinPartitions("word").write.parquet(f"{self.root}/words"))
        return self

    def _postings(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """Postings, or those of some buckets: no other folder is listed."""
        base = f"{self.root}/postings"
        paths = [base] if buckets is None else [f"{base}/bucket={b}" for b in buckets]
        return spark.read.schema(f"{POSTING}, bucket int").option("basePath", base).parquet(*paths)

    def matches(self, spark: SparkSession, keywords: Sequence[str], categories: Sequence[str]) -> DataFrame:
        """doc, category, recency, matched (keywords in order, joined by ``|``)
        of the texts in these categories that contain any keyword."""
        kws = list(dict.fromkeys(k.lower() for k in list(keywords)[:ARXIV_MAX_KEYWORDS]))
        parts = [(i, k, p, n) for i, kw in enumerate(kws) for n in [len(kw.split(" "))] for k, p in enumerate(kw.split(" "))]
        words = spark.read.schema("word string, bucket int").parquet(f"{self.root}/words")
        found = None
        for i, k, p, n in parts:      # at most ten keywords
            w = F.col("word")
            here = w.contains(p) if n == 1 else w.endswith(p) if k == 0 else w.startswith(p) if k == n - 1 else w == p
            hit = F.when(here, F.struct(F.lit(i).alias("kw"), F.lit(k).alias("part"), F.lit(n).alias("of")))
            found = [hit] if found is None else [*found, hit]
        if not parts:
            return spark.createDataFrame([], "doc bigint, category string, recency bigint, matched string")
        hit = F.explode(F.array_compact(F.array(*found))).alias("hit")
        buckets = sorted(r.bucket for r in words.select("bucket", hit).select("bucket").distinct().collect())     # at most all buckets
        if not buckets:
            return spark.createDataFrame([], "doc bigint, category string, recency bigint, matched string")
        posted = self._postings(spark, buckets).where(F.col("category").isin(*categories)).select("*", hit).select("*", "hit.*")
        keys = ["doc", "category", "recency", "kw"]
        single = (posted.where(F.col("of") == 1).select("category", "kw", F.explode(F.arrays_zip("doc", "recency")).alias("text"))
                  .select("category", "kw", "text.*").select(*keys).distinct())
        texts = F.transform(F.arrays_zip("doc", "recency", "upto"), lambda x, k: F.struct(
            x["doc"].alias("doc"), x["recency"].alias("recency"),
            F.slice("at", F.coalesce(F.get("upto", k - 1), F.lit(0)) + 1, x["upto"] - F.coalesce(F.get("upto", k - 1), F.lit(0))).alias("at")))
        longer = (posted.where(F.col("of") > 1).select("category", "kw", "part", "of", F.explode(texts).alias("text"))
                  .select("category", "kw", "part", "of", "text.doc", "text.recency", F.explode("text.at").alias("p"))
                  .groupBy(*keys, "of", (F.col("p") - F.col("part")).alias("start"))
                  .agg(F.bit_or(F.expr("shiftleft(1L, part)")).alias("parts"))
                  .where(F.col("parts") == F.expr("shiftleft(1L, of) - 1")).select(*keys).distinct())
        names = F.array(*[F.lit(k) for k in kws])
        return single.unionByName(longer).groupBy("doc", "category", "recency").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list("kw")), lambda i: F.element_at(names, i + 1)), "|").alias("matched"))

    def search(self, spark: SparkSession, keywords: Sequence[str], categories: Sequence[str],
               max_results: int = ARXIV_MAX_RESULTS, sweep_type: str = "full") -> DataFrame:
        """The newest ``max_results`` of ``matches`` (half as many on light
        sweeps)."""
        n = max_results if sweep_type == "full" else max_results // 2
        return self.matches(spark, keywords, categories).orderBy(F.col("recency").desc(), F.col("doc").desc()).limit(n)
