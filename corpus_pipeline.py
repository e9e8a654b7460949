"""A training-data pipeline over ``documents``: each stage is one operator of
``siftline.llm``, and works on all that the stage before it kept.

1. language ID: documents without a recognised language (null, or no letter) go;
2. near-duplicates: of each group the document with the smallest doc_id stays;
3. decontamination: documents that hold a benchmark item go;
4. mixing: documents occur as often as the target weights of domains ask;
5. token ids: what is left is written to token files and read back.

Every stage but the last returns the columns of ``documents`` it was given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siftline.llm.bigru_langid import drop_unidentified
from siftline.llm.common import staged, table
from siftline.llm.dac_tokens import encode_documents
from siftline.llm.hyperminhash_dedup import drop_near_duplicates
from siftline.llm.queries import TOKENIZER
from siftline.llm.soft_mixing import mix
from siftline.llm.string_tiling import drop_contaminated


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_unidentified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, table(spark, sf_dir, "labels"))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path(TOKENIZER), end_id=0)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix_sources", mix_sources), ("token_output", token_output)]

#: the trained network and the sketches cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
