import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from llm_paths import SMALL  # noqa: E402

#: extra columns whose names the operators use for their own
DOCS = "doc_id long, text string, lang string, source string, h long, key string, row int, rank int, shard int, node int"


def doc_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    base = " ".join(f"word{k} of" for k in range(60))
    rows = [(0, base), (1, base), (2, base + " end"), (3, None), (4, ""), (5, "   \n\t "), (6, "%%% 123 ..."),
            (7, "one two"), (7, "one two"), (None, base), (None, None), (8, "Été déjà vu naïve façon " * 30),
            (9, " ".join(f"long{k % 997}x{k}" for k in range(60_000))), (10, "a  b\n\nc \n d "), (11, base.upper())]
    return [(i, t, "fr" if i == 8 else None if i in (3, 7) else "en", f"s{(i or 0) % 3}", 1, "k", 2, 3, 4, 5)
            for i, t in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
