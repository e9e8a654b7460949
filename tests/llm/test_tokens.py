"""Operators 1 and 2: ids, files and spans against encoding whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftline.llm import common as cm
from siftline.llm import dac_tokens as dac
from siftline.llm import token_attribution as ta

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def odd_texts(n=4000):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "'s", "don't", "é", "日本", "😀", ".", ",", "12", "\0", "\x1c",
             " ", "\xa0", "\x85", "<|endoftext|>", " foo", "bar ", "\r\n", "%%%", " \n", "\n "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("offsets", [False, True])
def test_pieces_equal_whole_texts(tok, offsets):
    texts, enc = odd_texts(), cm.PieceEncoder(PATH, offsets, max_pieces=300)
    for lo in range(0, len(texts), 200):
        part = texts[lo:lo + 200]
        ids, sizes, spans = enc.batch(part)
        at = 0
        for n, want in zip(sizes, tok.encode_batch(part, add_special_tokens=False)):
            assert ids[at:at + n].tolist() == want.ids
            if offsets:
                assert [tuple(s) for s in spans[at:at + n].tolist()] == want.offsets
            at += n


@pytest.mark.parametrize("offsets", [False, True])
def test_the_operators_encoder_equals_an_untouched_tokenizer(offsets):
    plain, enc = Tokenizer.from_file(PATH), cm.encoder(PATH, offsets)
    texts = ["end of a file.<|endoftext|> next", "<|endoftext|>", "a <|endoftext|>\nb<|endoftext|><|endoftext|> c", *odd_texts()]
    assert 50256 in plain.encode(texts[0], add_special_tokens=False).ids
    for lo in range(0, len(texts), 200):
        part, at = texts[lo:lo + 200], 0
        ids, sizes, spans = enc.batch(part)
        for n, want in zip(sizes, plain.encode_batch(part, add_special_tokens=False)):
            assert ids[at:at + n].tolist() == want.ids
            if offsets:
                assert [tuple(s) for s in spans[at:at + n].tolist()] == want.offsets
            at += n


def test_files_and_counts_of_texts_with_an_added_token(spark):
    plain, rows = Tokenizer.from_file(PATH), [(1, "end of a file.<|endoftext|> next"), (2, "one two"), (3, "x<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, start = [], 0
    for i, t in rows:
        e = plain.encode(t, add_special_tokens=False).ids
        want.append((i, start, len(e) + 1, digest(e)))
        start += len(e) + 1
    assert sorted(tuple(r) for r in dac.encode_documents(df, PATH).collect()) == want
    assert {r.doc_id: r.n_tokens for r in ta.count_tokens(df, PATH).collect()} == {i: n - 1 for i, _, n, _ in want}


@pytest.mark.parametrize("width", [1, 3, 8, 9, 13, 16, 17, 25, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_packing_round_trip(width, n):
    v = np.random.default_rng(n).integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
    raw = dac.pack(v, width)
    assert len(raw) == -(-n * width // 8)
    assert (dac.unpack(np.frombuffer(raw, np.uint8), n, width) == v).all()


class Bytes:
    def __init__(self, raw):
        self.raw = raw

    def read_at(self, n, at):
        return self.raw[at:at + n]


@pytest.mark.parametrize("top", [1, 200, 50_000, 1 << 31])
def test_any_token_without_decoding_a_block(top):
    rng = np.random.default_rng(3)
    ids = (rng.integers(0, top, 5000) >> rng.integers(0, 20, 5000)).astype(np.uint32)
    f = dac.DacFile(Bytes(dac.to_bytes([3, None], np.array([0, 1200, 5000]), ids)))
    assert [f.token(i) for i in range(0, 5000, 37)] == ids[::37].tolist()
    for lo, hi in [(0, 5000), (511, 513), (1, 1), (4999, 5000), (777, 3210)]:
        assert (f.tokens(lo, hi) == ids[lo:hi]).all()
    assert f.documents()[0] == [3, None]


def digest(ids):
    return zlib.crc32(np.array([*ids, 0], "<u4").tobytes())


def test_files_hold_all_documents_in_order(spark, documents, tok):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    want, start = [], 0
    for r, e in zip(rows, tok.encode_batch([r.text for r in rows], add_special_tokens=False)):
        want.append((r.doc_id, start, len(e.ids) + 1, digest(e.ids)))
        start += len(e.ids) + 1
    assert sorted(tuple(r) for r in dac.encode_documents(documents, PATH).collect()) == want


def test_token_files_edge_cases(spark, edge_docs, no_docs, tok):
    got = [tuple(r) for r in dac.encode_documents(edge_docs, PATH).collect()]
    want = sorted(((r.doc_id is not None, r.doc_id or 0, len(e) + 1, digest(e)) for r in edge_docs.collect()
                   for e in [tok.encode(r.text or "", add_special_tokens=False).ids]))
    assert sorted((i is not None, i or 0, n, c) for i, _, n, c in got) == want
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in by_start] == np.cumsum([0] + [r[2] for r in by_start])[:-1].tolist()
    assert [r[0] for r in by_start][:2] == [None, None]
    assert dac.encode_documents(no_docs, PATH).count() == 0


def test_small_partitions_do_not_become_small_files(spark, documents, tmpdir_path):
    want = sorted(tuple(r) for r in dac.encode_documents(documents, PATH).collect())
    conf = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        manifest = dac.write_tokens(documents, f"{tmpdir_path}/tokens", PATH)
        tasks, files = manifest.select("part").distinct().count(), len(manifest.inputFiles())
        assert tasks > 64 and files <= 3        # two, and the empty one of a first partition without rows
        got = dac.read_tokens(manifest).withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({r.p for r in got}) <= -(-sum(r[2] for r in want) // 2_000_000)
    assert sorted(tuple(r)[:4] for r in got) == want


def test_lines_get_all_tokens_once(spark, documents, tok):
    sums = {r.doc_id: r.n for r in ta.count_tokens(documents, PATH).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    for r in documents.collect():
        assert sums[r.doc_id] == len(tok.encode(r.text, add_special_tokens=False).ids)


def test_rules_for_crossing_tokens():
    spans, starts, ends = np.array([[0, 4], [4, 6], [6, 7], [7, 11]]), np.array([0, 5, 9]), np.array([5, 7, 12])
    assert ta.allot(spans, starts, ends, "most")[0].tolist() == [0, 0, 1, 2]
    assert ta.allot(spans, starts, ends, "first")[0].tolist() == [0, 0, 1, -1]
    assert ta.allot(spans, starts, ends, "last")[0].tolist() == [0, 1, 1, 2]
    assert ta.allot(spans, starts, ends, "most")[1].tolist() == [False, True, False, True]


def test_sections_from_a_column(spark, tok):
    text = "Title of it\nbody text here and more"
    df = spark.createDataFrame([(1, text, [(0, 11), (12, 20)]), (2, text, None), (3, None, [])],
                               "doc_id long, text string, fields array<struct<start:int,end:int>>")
    got = {(r.doc_id, r.section): r.n_tokens for r in ta.count_tokens(df, PATH, spans="fields").collect()}
    want = {}
    for s, e in tok.encode(text, add_special_tokens=False).offsets:
        best = max((min(e, z) - max(s, a), -k) for k, (a, z) in enumerate([(0, 11), (12, 20)]))
        k = -best[1] if best[0] > 0 else -1
        want[1, k] = want.get((1, k), 0) + 1
    want[2, -1] = sum(v for (d, _), v in want.items() if d == 1)
    assert got == want
    bad = spark.createDataFrame([(1, text, [(5, 9), (0, 6)])], df.schema)
    with pytest.raises(Exception, match="overlap"):
        ta.count_tokens(bad, PATH, spans="fields").collect()


def test_attribution_edge_cases(spark, edge_docs, no_docs, tok):
    got = {}
    for r in ta.count_tokens(edge_docs, PATH).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    want = {}
    for r in edge_docs.collect():
        if n := len(tok.encode(r.text or "", add_special_tokens=False).ids):
            want[r.doc_id] = want.get(r.doc_id, 0) + n
    assert got == want
    assert ta.count_tokens(no_docs, PATH).count() == 0
