"""Operator 10 and the pipeline."""

import base64
import gzip
import hashlib
import os
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
import corpus_pipeline as cp
from llm_paths import SMALL
from siftline.llm import warc_salvage as ws


class Bytes:
    def __init__(self, raw):
        self.raw = raw

    def read_at(self, n, at):
        return self.raw[at:at + n]


def records(n, compress=True):
    parts = []
    for k in range(n):
        payload = f"<p>page {k} WARC/1.1\r\n\r\n {'x' * (k * 37 % 900)}</p>".encode()
        parts.append(ws.record_bytes(k, f"http://a/{k}\r\nX: 1", payload, ws.digest32(payload), None, compress))
    return parts


def read(raw):
    got = list(ws.salvage(Bytes(raw), len(raw)))
    return [int(x[2]["x-page-id"]) for x in got if x[0] == "record"], [x[1:] for x in got if x[0] == "gap"]


@pytest.mark.parametrize("compress", [True, False])
def test_whole_archives_have_no_gap(compress):
    assert read(b"".join(records(40, compress))) == (list(range(40)), [])


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "zeros", "insert", "head", "tail"])
def test_damage_costs_only_the_records_it_touches(compress, damage):
    parts = records(9, compress)
    starts = [sum(map(len, parts[:k])) for k in range(10)]
    raw = b"".join(parts)
    at = starts[4] + len(parts[4]) * 2 // 3
    if damage == "flip":
        raw, lost = raw[:at] + bytes([raw[at] ^ 0x55]) + raw[at + 1:], {4}
    elif damage == "cut":
        raw, lost = raw[:at] + raw[starts[5]:], {4}
    elif damage == "zeros":
        raw, lost = raw[:starts[3] + 30] + bytes(starts[5] - starts[3] - 60) + raw[starts[5] - 30:], {3, 4}
    elif damage == "insert":
        raw, lost = raw[:starts[4]] + b"\x1f\x8b\x08 no member, WARC/1.1\r\nnothing" * 5 + raw[starts[4]:], set()
    elif damage == "head":
        raw, lost = raw[20:], {0}
    else:
        raw, lost = raw[:-20], {8}
    pages, gaps = read(raw)
    assert pages == [k for k in range(9) if k not in lost]
    assert len(gaps) == 1 and 0 <= gaps[0][0] < gaps[0][1] <= len(raw) and gaps[0][2]


def test_a_huge_gap_and_an_empty_file():
    parts = records(2)
    pages, gaps = read(parts[0] + b"\0" * (3 << 20) + parts[1])
    assert pages == [0, 1] and gaps[0][:2] == (len(parts[0]), len(parts[0]) + (3 << 20))
    assert read(b"") == ([], []) and read(b"nothing here")[1][0][:2] == (0, 12)


def test_several_records_to_a_member_are_not_a_record():
    a, b = records(2, compress=False)
    assert read(gzip.compress(a + b))[0] == []


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        f = first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=repr)


def test_pages_round_trip(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted((tuple(r) for r in ws.archive_pages(pages)
                   .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == expected(rows)


def test_page_edge_cases(spark):
    rows = [(5, "http://a", "same"), (3, "http://b\r\nX-Page-Id: 99", "same"), (4, None, "same"), (9, "u", None), (8, "u", ""),
            (None, "n", "same"), (None, "n", "alone"), (None, "n", "alone"), (3, "http://b", "same"), (11, "é", "ü" * 200_000),
            (12, "x", "HTTP/1.1\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, path int")
    got = sorted((tuple(r) for r in ws.archive_pages(df).collect()), key=repr)
    assert got == expected(rows)
    assert ws.archive_pages(df.limit(0)).count() == 0


def test_salvage_on_files(spark, tmpdir_path):
    parts = records(30)
    raw = b"".join(parts)
    for k, content in enumerate([raw, raw[:500] + b"\0" * 40 + raw[540:]]):
        with open(os.path.join(tmpdir_path, f"{k}.warc.gz"), "wb") as f:
            f.write(content)
    files = spark.createDataFrame([(f"file://{tmpdir_path}/{k}.warc.gz",) for k in (0, 1)], "path string")
    got = Counter(r.path for r in ws.read_archives(files).collect())
    gaps = ws.quarantined(files).collect()
    assert got[f"file://{tmpdir_path}/0.warc.gz"] == 30 and 27 <= got[f"file://{tmpdir_path}/1.warc.gz"] <= 29
    assert len(gaps) == 1 and gaps[0].gap_start <= 500 and gaps[0].gap_end >= 540
    counted = files.withColumn("n_records", F.lit(30))
    assert ws.read_archives(counted.where("path like '%/0.%'")).count() == 30
    with pytest.raises(Exception, match="records of 30 could be read"):
        ws.read_archives(counted).count()
    text = ws.read_archives(files).where("page_id = 7").first()
    assert bytes(text.payload).startswith(b"<p>page 7 WARC/1.1\r\n\r\n")


# -------------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    assert [k for k, _ in cp.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_output"]
    assert cp.ORACLE_SQL is None and "pipeline" in se.queries() and "pipeline" not in se.oracle_sql()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    for _, stage in cp.STAGES[:-1]:
        out = cp.staged(stage(spark, docs, SMALL), "test-stage")
        assert out.columns == docs.columns
        docs = out
        counts.append(docs.count())
    assert counts[0] == counts[1] > counts[2] > counts[3] > 0
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = cp.STAGES[-1][1](spark, docs, SMALL).collect()
    want = Counter((r.doc_id, len(tok.encode(r.text, add_special_tokens=False).ids) + 1) for r in docs.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want


def test_every_operator_is_registered():
    names = set(se.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(se.__file__))
    for folder, _, files in os.walk(os.path.join(root, "siftline")):
        for f in files:
            if f.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, f)) as source:
                    assert not re.search(r"siftline\.llm|from \.+llm|import llm\b", source.read())
