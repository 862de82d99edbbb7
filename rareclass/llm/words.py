"""Vectorised words of whole texts: byte buffers in, one 64-bit hash per word out.

A word is a longest run of bytes other than space and \\x09-\\x0D. Texts arrive as Arrow
columns and are handled in pieces of about ``PIECE`` bytes, so a task holds a small multiple
of that, or of its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a base modulo 2**64, kept and grown as needed."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), 1 << 64))
            self.table = np.concatenate([self.table, self.table * step])
        return self.table[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def powers(n: int, down: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base of all sequence hashes, or of its inverse, modulo 2**64."""
    return (_DOWN if down else _UP).upto(n)


class RangeHash:
    """Hash of any range of a sequence in constant time, equal for equal contents."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values.astype(np.uint64) * _UP.upto(n), out=self.sums[1:])
        self.down = _DOWN.upto(n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(value ^ ((end - start).astype(np.uint64) * _LENGTH))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (a view) and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    parts = column.buffers()
    kind = np.dtype(np.int64 if pa.types.is_large_string(column.type) else np.int32)
    offsets = np.frombuffer(parts[1], dtype=kind, count=len(column) + 1, offset=kind.itemsize * column.offset)
    offsets = offsets.astype(np.int64)
    if parts[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(parts[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = buffers(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def kept_and_text(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """(rows with the columns in ``keep`` under names of their own and ``text``, those names).

    A kept text column of strings is not sent twice: it is ``text`` itself.
    """
    same = dict(docs.dtypes).get("text") == "string"
    own = ["text" if c == "text" and same else f"k_{i}" for i, c in enumerate(keep)]
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(keep, own) if n != "text"]
    return docs.select(*columns, F.col("text").cast("string").alias("text")), own


@dataclass
class Words:
    """Words of some texts: byte range, hash, and for each text its range of words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # text i has the words first[i]:first[i + 1]
    doc: np.ndarray  # text of each word


def words(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = buffers(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    fresh[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:-1]
    ends[:-1] &= ~inside[1:] | fresh[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = RangeHash(data.astype(np.uint64) + np.uint64(1))(start, end)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, hashes, first, doc)
