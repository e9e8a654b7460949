"""Whole texts to words by one table over their bytes, for operators that
count: the table lowers A-Z and turns separators into spaces (or into the mark
``.``), Arrow cuts at the spaces, and the words come back as places among the
distinct ones. UTF-8 bytes from 0x80 on are never changed, so texts stay valid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE, MARK = 0x20, ord(".")


def byte_table(spaces: bytes = b"", marks: bytes = b"") -> np.ndarray:
    """256 bytes: A-Z in lower case, ``spaces`` a space, ``marks`` the mark,
    and the others as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    table[list(spaces)] = SPACE
    table[list(marks)] = MARK
    return table


def mapped(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """The texts with each byte replaced by its entry in ``table``; null is the
    empty text."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    new = table[np.frombuffer(data, np.uint8, int(ends[-1] - ends[0]), int(ends[0]))]
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer((ends - ends[0]).astype(kind)), pa.py_buffer(new)])


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The space-separated words of the texts: each one's place among the
    distinct ones (-1: none, an empty string at a text's end), the number of
    entries of each text, and the distinct words."""
    lists = pc.ascii_split_whitespace(texts)
    found = lists.flatten().dictionary_encode()
    codes = found.indices.to_numpy().astype(np.int64)
    empty = pc.index(found.dictionary, pa.scalar("", found.dictionary.type)).as_py()
    if empty >= 0:
        codes[codes == empty] = -1
    return codes, np.diff(lists.offsets.to_numpy()).astype(np.int64), found.dictionary
