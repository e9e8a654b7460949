"""Helpers shared by the training-data operators: staged tables and files in
the shared folder, salted ranks, and cached tokenization."""

from __future__ import annotations

import os
import re
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: a word, as the n-gram operators read it: a run without ASCII white space
WORD_RE = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new path under the shared folder and read
    it back: a lineage cut that survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of ``uri``; a bare path is a local one."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), re.sub(r"^file:", "", uri)


def utf8(col: str | Column) -> Column:
    """The text's UTF-8 bytes; a null text has none."""
    return F.encode(F.coalesce(col if isinstance(col, Column) else F.col(col), F.lit("")), "UTF-8")


def salted_rank(df: DataFrame, keys: Sequence[str], salt: Column, salts: int,
                order: Sequence[Column], rank: str) -> DataFrame:
    """0-based gapless rank of each row within ``keys``, where a key may hold
    any share of the rows. Rows of a key are spread over ``salts`` buckets by
    ``salt``; a row's rank is the number of rows in the key's lower buckets (a
    window over at most ``salts`` rows a key) plus its rank inside its bucket,
    so no window partition holds more than about 1/``salts`` of a key."""
    rows = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    counts = rows.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    lower = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_salt", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)) - 1
    return (rows.withColumn("_in", inside).join(offsets, [*keys, "_salt"])
            .withColumn(rank, (F.col("_off") + F.col("_in")).cast("bigint"))
            .drop("_salt", "_in", "_off"))


def split_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The texts' words (ASCII letters lower-cased, cut at ASCII white space):
    each word's place among the distinct ones, the number of words of each
    text, and the distinct words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    found = lists.flatten().dictionary_encode()
    codes, words, number = found.indices.to_numpy(), found.dictionary.to_pylist(), np.diff(lists.offsets.to_numpy())
    if "" in words:                                    # white space at a text's ends
        at = words.index("")
        real = codes != at
        number = np.diff(np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], np.cumsum(number)])])
        codes = codes[real]
        codes = codes - (codes > at)
        words.pop(at)
    return codes, number, words


def parts(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in parts whose texts have about ``size`` bytes, a longer text in
    a part with those before it. Arrow's unused memory is given back after each
    part, so a worker holds one part's intermediates at a time."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(), dtype=np.int64)
        lo = 0
        while lo < b.num_rows:
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size)) + 1
            yield b.slice(lo, hi - lo)
            lo = hi
            pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as Python strings, null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


class PieceEncoder:
    """Encodes whole texts with the tokenizers library, each distinct piece
    once.

    Byte-level BPE first cuts a text by a pattern that begins a new part at a
    single space or line break between two characters that are not white
    space. So the ids of a text are the ids of its pieces (cut there, each
    keeping its leading space or break) in order, and repeated pieces are
    looked up instead of encoded again: Arrow cuts the texts and finds the
    distinct pieces of a batch. A text with other white space is encoded as a
    whole, and so is one that holds an added token, unless ``special_as_text``
    has the library encode special tokens like other text. ``tests/llm`` holds
    this against encoding whole texts. New pieces
    are encoded many to a string and fall apart again by the byte lengths of
    their tokens. Beyond ``max_pieces``, pieces used once are forgotten, or all
    if too many are left.
    """

    _HEAD = "\0"      # marks a text's first piece, which has nothing before it

    def __init__(self, path: str, offsets: bool = False, max_pieces: int = 1_200_000, special_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        self.added = [] if special_as_text else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.offsets, self.max_pieces = offsets, max_pieces
        size = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1
        # a byte-level token's string has one character for each byte
        self.bytes_of = np.array([len(self.tok.id_to_token(k) or "") for k in range(size)], np.int64)
        self._keep(np.zeros(0, np.int64))

    def _keep(self, keep: np.ndarray) -> None:
        """Forget all pieces but those at the places ``keep``."""
        if not len(keep):
            self.known = pa.array([], pa.large_string())    # pieces, and where each one's ids are (-1: not to be cut)
            self.places = np.zeros(0, np.int64)
            self.ids, self.start = np.zeros(0, np.int32), np.zeros(0, np.int64)
            self.length = self.chars = self.uses = np.zeros(0, np.int32)
            self.spans = np.zeros((0, 2), np.int32)
            return
        n = self.length[keep].astype(np.int64)
        take = np.repeat(self.start[keep] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        place = np.full(len(self.uses), -1)
        place[keep] = np.arange(len(keep))
        still = (self.places >= 0) & (place[np.maximum(self.places, 0)] >= 0)
        self.known, self.places = self.known.filter(pa.array(still)), place[self.places[still]]
        self.ids, self.length, self.start = self.ids[take], self.length[keep], np.cumsum(n) - n
        self.uses = np.zeros(len(keep), np.int32)
        if self.offsets:
            self.spans, self.chars = self.spans[take], self.chars[keep]

    def _text(self, piece: str) -> str | None:
        """What a piece stands for, or None where the text must stay whole."""
        head = piece[:1] == self._HEAD
        inner = piece[1:] if head or piece[:1] == "\n" else piece
        if inner[-1:].isspace() or not head and (not inner or inner[0].isspace()):
            return None
        if any(t in piece for t in self.added):
            return None
        return inner if head else piece if piece[0] == "\n" else " " + piece

    def _learn(self, texts: list[str], joined: bool) -> int:
        """Add the ids of ``texts``; ``joined`` ones may follow each other in
        one string. Returns the place of the first."""
        first = len(self.start)
        if not texts:
            return first
        if self.offsets:
            found = self.tok.encode_batch(texts, add_special_tokens=False)
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for e in found for i in e.ids), np.int32, int(n.sum()))
            self.spans = np.concatenate([self.spans, np.array([s for e in found for s in e.offsets], np.int32).reshape(-1, 2)])
            self.chars = np.concatenate([self.chars, np.fromiter(map(len, texts), np.int32, len(texts))])
        else:
            step = 500 if joined else 1
            found = self.tok.encode_batch_fast(["".join(texts[lo:lo + step]) for lo in range(0, len(texts), step)],
                                               add_special_tokens=False)
            flat = np.concatenate([np.array(e.ids, np.int32) for e in found])
            sizes = np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts))
            upto = np.searchsorted(np.cumsum(self.bytes_of[flat]), np.cumsum(sizes), "left") + 1
            upto = np.where(np.cumsum(sizes) == 0, 0, upto)         # empty texts have no token
            n = np.diff(np.concatenate([[0], upto]))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(n) - n])
        self.ids = np.concatenate([self.ids, flat])
        self.length = np.concatenate([self.length, n.astype(np.int32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(n), np.int32)])
        return first

    def _places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The place of each piece of the texts, and the number of pieces of
        each text."""
        whole = pa.array(texts, pa.large_string())
        marked = pc.binary_join_element_wise(pa.scalar(self._HEAD, pa.large_string()),
                                             pc.replace_substring(whole, "\n", " \n"), pa.scalar("", pa.large_string()))
        lists = pc.split_pattern(marked, " ")
        pieces = lists.flatten().dictionary_encode()
        codes, number = pieces.indices.to_numpy(), np.diff(lists.offsets.to_numpy())
        found = pc.index_in(pieces.dictionary, self.known)
        at = np.full(len(found), -1, np.int64)
        old = found.is_valid().to_numpy(zero_copy_only=False)
        at[old] = self.places[found.drop_null().to_numpy()]
        fresh = np.flatnonzero(~old)
        unknown = pieces.dictionary.take(pa.array(fresh))
        heads, rest = [], []
        for k, piece in zip(fresh.tolist(), unknown.to_pylist()):
            if (text := self._text(piece)) is not None:
                (heads if piece[:1] == self._HEAD else rest).append((k, text))
        for new, joined in ((heads, False), (rest, True)):
            first = self._learn([t for _, t in new], joined)
            at[[k for k, _ in new]] = np.arange(first, first + len(new))
        if len(fresh):
            self.known = pa.concat_arrays([self.known, unknown])
            self.places = np.concatenate([self.places, at[fresh]])
        places = at[codes]
        bounds = np.concatenate([[0], np.cumsum(number)])
        uncut = np.searchsorted(bounds, np.flatnonzero(places < 0), "right") - 1
        uncut = np.union1d(uncut, np.flatnonzero(pc.match_substring(whole, self._HEAD).to_numpy(zero_copy_only=False)))
        if len(uncut):
            first = self._learn([texts[k] for k in uncut], False)
            parts = [places[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for place, k in enumerate(uncut, first):
                parts[k] = np.array([place])
            places, number = np.concatenate(parts), np.array(list(map(len, parts)), np.int64)
        return places, number

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """All ids of the texts one after another, the number of ids of each
        text, and with ``offsets`` each token's (start, end) in characters."""
        if len(self.known) > self.max_pieces or len(self.ids) > 8 * self.max_pieces:
            keep = np.flatnonzero(self.uses > 1)
            keep = keep[self.length[keep] < 64]         # no whole texts
            self._keep(keep if len(keep) <= self.max_pieces // 2 else keep[:0])
        at, number = self._places(texts)
        self.uses += np.bincount(at, minlength=len(self.uses)).astype(np.int32)
        n = self.length[at]
        ends = np.cumsum(n, dtype=np.int64)
        take = np.repeat((self.start[at] - (ends - n)).astype(np.int32), n)
        take += np.arange(len(take), dtype=np.int32)
        cuts = np.concatenate([[0], np.cumsum(number)])
        sizes = np.diff(np.concatenate([[0], ends])[cuts])
        if not self.offsets:
            return self.ids[take], sizes, None
        before = np.concatenate([[0], np.cumsum(self.chars[at], dtype=np.int64)])
        place = before[:-1] - np.repeat(before[cuts[:-1]], number)     # each piece's place in its text
        return self.ids[take], sizes, self.spans[take] + np.repeat(place, n)[:, None]


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, offsets: bool = False) -> PieceEncoder:
    """One encoder a worker process, so later tasks find its pieces. Added
    tokens get their own ids, as the library gives them by default."""
    if (path, offsets) not in _ENCODERS:
        _ENCODERS[path, offsets] = PieceEncoder(path, offsets, special_as_text=False)
    return _ENCODERS[path, offsets]
