"""Operator 2: token counts by section, from the character spans of tokens.

A whole document is encoded once. The tokens' character spans are then joined
with the spans of its sections (both sorted by start, so the interval join is a
binary search), and a token that crosses a boundary is given to one section by
a stated rule, so the counts of a document's sections add up to the count of
the whole document, which encoding each section on its own would not give.

Rules for a token over characters [s, e):

* ``most``: the section with most of its characters; ties go to the earlier;
* ``first``: the section with its first character;
* ``last``: the section with its last character.

Characters in no section belong to section -1 ("outside"), which under ``most``
takes a token only where no section has any of its characters. Tokens of one
character (parts of a multi-byte character share its span) never cross.

Nothing is shuffled: sections come with the document's row, as lines (the
default; a line holds its line break) or as a column of spans.

Defined cases: a null or empty text gives no row by lines. Rows of equal id are
each counted on their own. An empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as cm

RULES = ("most", "first", "last")
SCHEMA = ("doc_id long, section int, char_start int, char_end int, n_tokens long, n_crossing long")


def line_starts(text: str) -> np.ndarray:
    """Character offsets at which the lines of a text begin; a line ends with
    its line break, and a last line without characters is none."""
    out, at = [0], text.find("\n")
    while at >= 0:
        out.append(at + 1)
        at = text.find("\n", at + 1)
    if out[-1] == len(text):
        out.pop()
    return np.array(out, np.int64)


def allot(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Each token's section and whether it touches more than one (or one and
    the outside). Sections are sorted and do not overlap."""
    s, e = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    if not len(starts):
        return np.full(len(s), -1), np.zeros(len(s), bool)

    def holder(at: np.ndarray) -> np.ndarray:
        k = np.searchsorted(starts, at, "right") - 1
        return np.where((k >= 0) & (at < ends[np.maximum(k, 0)]), k, -1)
    first, last = holder(s), holder(e - 1)
    crossing = (first != last) | (first < 0) & (np.searchsorted(starts, e - 1, "right") > np.searchsorted(starts, s, "right"))
    out = {"first": first, "last": last, "most": first.copy()}[rule]
    if rule == "most":
        for t in np.flatnonzero(crossing):
            lo = max(int(np.searchsorted(starts, s[t], "right")) - 1, 0)
            hi = int(np.searchsorted(starts, e[t] - 1, "right"))
            have = np.minimum(ends[lo:hi], e[t]) - np.maximum(starts[lo:hi], s[t])
            out[t] = lo + int(np.argmax(have)) if len(have) and have.max() > 0 else -1
    return out, crossing


def count_tokens(docs: DataFrame, tokenizer_path: str, rule: str = "most", spans: str | None = None) -> DataFrame:
    """Token counts a document and section. ``spans`` names a column
    array<struct<start int, end int>> of sections (sorted, not overlapping;
    anything else is an error); without it, sections are lines."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    cols = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")]
    if spans:
        cols.append(F.col(spans).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = cm.encoder(tokenizer_path, offsets=True)
        for b in cm.parts(batches, 4_000_000):
            texts, ids = cm.texts_of(b), b.column("doc_id").to_pylist()
            given = b.column("spans").to_pylist() if spans else None
            _, sizes, offsets = enc.batch(texts)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            parts = [[] for _ in range(6)]
            for k in range(len(texts)):
                own = offsets[upto[k]:upto[k + 1]]
                if given is None:
                    starts = line_starts(texts[k])
                    ends = np.append(starts[1:], len(texts[k])) if len(starts) else starts
                else:
                    starts = np.array([x["start"] for x in given[k] or []], np.int64)
                    ends = np.array([x["end"] for x in given[k] or []], np.int64)
                    if (ends < starts).any() or (starts[1:] < ends[:-1]).any():
                        raise ValueError(f"sections of document {ids[k]} overlap or are not sorted")
                at, crossing = allot(own, starts, ends, rule)
                n = np.bincount(at + 1, minlength=len(starts) + 1)
                x = np.bincount(at[crossing] + 1, minlength=len(starts) + 1)
                skip = 0 if n[0] else 1  # the outside has a row only if it has tokens
                for p, v in zip(parts, (np.full(len(n) - skip, k), np.arange(-1 + skip, len(starts)),
                                        np.append([-1] * (1 - skip), starts), np.append([-1] * (1 - skip), ends),
                                        n[skip:], x[skip:])):
                    p.append(v)
            doc, sec, a, z, n, x = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[int(k)] for k in doc], pa.int64()), pa.array(sec.astype(np.int32)),
                 pa.array(a.astype(np.int32)), pa.array(z.astype(np.int32)),
                 pa.array(n.astype(np.int64)), pa.array(x.astype(np.int64))],
                names=["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"])
    return docs.select(*cols).mapInArrow(run, SCHEMA)
