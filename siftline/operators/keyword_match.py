"""Many keywords at once (P8, J6, F2, F4): which keywords does a text contain?

A few keywords are literals of the plan (``functions.keywords``). Thousands would
make the plan grow with the config and test a text once for each, so here they are
data: an automaton (Aho-Corasick) over all keywords reads each text once, whatever
their number, in Arrow batches and without a shuffle. The plan has the same size
for ten keywords and for ten thousand.

The keywords are taken in blocks of at most ``block_bytes``, each broadcast and
one pass over the texts, so what a task holds is bounded however many there are.

Meaning as in ``functions.keywords``: plain containment of the lower-cased keyword
in the lower-cased text, no word boundaries; an empty keyword is in every text,
also in one that is null; equal keywords count once, at their first place.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keywords import any_keyword, matched_keywords

#: up to so many keywords are literals of the plan
LITERALS = 32


def keyword_table(spark: SparkSession, keywords: Sequence[str]) -> DataFrame:
    """ord, keyword of a config's list."""
    return spark.createDataFrame([(i, k) for i, k in enumerate(keywords)], "ord long, keyword string")


def _blocks(keywords: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """(ord, lower-cased keyword), the first of equal ones, a block at a time."""
    low = (keywords.select(F.lower(F.coalesce("keyword", F.lit(""))).alias("keyword"), F.col("ord").cast("bigint").alias("ord"))
           .groupBy("keyword").agg(F.min("ord").alias("ord")))
    total = low.agg(F.sum(F.octet_length("keyword") + 16)).first()[0] or 0
    n = -(-total // (block_bytes // 2)) or 1          # hashing deals out unevenly
    for k in range(n):
        yield sorted((r.ord, r.keyword) for r in low.where(F.pmod(F.xxhash64("keyword"), F.lit(n)) == k).collect())


def with_matches(rows: DataFrame, text: str, keywords: DataFrame, out: str = "matches",
                 block_bytes: int = 8 << 20) -> DataFrame:
    """``rows`` with the array of structs (ord, keyword) of the keywords that
    their ``text`` contains, by ord. ``keywords``: ord, keyword."""
    spark = rows.sparkSession
    found = rows.withColumn("_text", F.lower(F.coalesce(F.col(text), F.lit("")))).withColumn(
        out, F.array().cast("array<struct<ord:bigint,keyword:string>>"))
    for block in _blocks(keywords, block_bytes):
        always = [o for o, k in block if k == ""]
        held = spark.sparkContext.broadcast([(o, k) for o, k in block if k])
        schema = found.schema

        def run(batches: Iterator[pa.RecordBatch], held=held, always=always) -> Iterator[pa.RecordBatch]:
            import ahocorasick
            names = dict(held.value)
            machine = ahocorasick.Automaton()
            for o, k in held.value:
                machine.add_word(k, o)
            if len(names):
                machine.make_automaton()
            for b in batches:
                hits = []
                for t, own in zip(b.column("_text").to_pylist(), b.column(out).to_pylist()):
                    got = {o for _, o in machine.iter(t)} if names else set()
                    hits.append([*own, *({"ord": o, "keyword": names.get(o, "")} for o in [*got, *always])])
                cols = [pa.array(hits, f.type) if f.name == out else b.column(f.name) for f in b.schema]
                yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
        found = found.mapInArrow(run, schema)
    return found.withColumn(out, F.sort_array(out)).drop("_text")


def containing(rows: DataFrame, text: str, keywords: Sequence[str], matched: str | None = None) -> DataFrame:
    """The rows whose ``text`` contains any keyword, and with ``matched`` the
    keywords joined by ``|`` in that column."""
    kws = list(keywords)
    if len(kws) <= LITERALS:
        t = F.coalesce(F.col(text), F.lit(""))
        out = rows.where(any_keyword(t, kws))
        return out if matched is None else out.withColumn(matched, matched_keywords(t, kws))
    out = with_matches(rows, text, keyword_table(rows.sparkSession, kws), "_matches").where(F.size("_matches") > 0)
    if matched is not None:
        out = out.withColumn(matched, F.array_join(F.transform("_matches", lambda x: x["keyword"]), "|"))
    return out.drop("_matches")


def without(rows: DataFrame, text: str, needles: Sequence[str]) -> DataFrame:
    """The rows whose ``text`` contains none of the needles (F2)."""
    needles = list(needles)
    if len(needles) <= LITERALS:
        return rows.where(~any_keyword(F.coalesce(F.col(text), F.lit("")), needles)) if needles else rows
    return (with_matches(rows, text, keyword_table(rows.sparkSession, needles), "_matches")
            .where(F.size("_matches") == 0).drop("_matches"))
