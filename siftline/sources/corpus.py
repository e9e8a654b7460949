"""Keyword x category search over a landed corpus.

The original sends a phrase query to a paper search service: any of the
first ten keywords as a phrase in any field, AND any of the categories,
newest first, N results (N halved on light sweeps). Over a landed corpus
this is a filter and a top-N: Spark plans TakeOrderedAndProject, which
keeps N rows per partition before one small merge.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ARXIV_MAX_KEYWORDS, ARXIV_MAX_RESULTS
from ..functions.keywords import any_keyword, matched_keywords


def corpus_search(corpus: DataFrame, keywords: Sequence[str], categories: Sequence[str],
                  text_cols: Sequence[str], category_col: str, recency_col: str,
                  max_results: int = ARXIV_MAX_RESULTS, sweep_type: str = "full") -> DataFrame:
    """Rows whose text fields contain any keyword (case-insensitive phrase)
    and whose category is listed, newest ``max_results`` first."""
    n = max_results if sweep_type == "full" else max_results // 2
    kws = list(keywords)[:ARXIV_MAX_KEYWORDS]
    text = F.concat_ws("\n", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    hit = any_keyword(text, kws) & F.col(category_col).isin(*categories)
    return (corpus.where(hit).withColumn("matched", matched_keywords(text, kws))
            .orderBy(F.col(recency_col).desc()).limit(n))
