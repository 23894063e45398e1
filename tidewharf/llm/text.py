"""Words of many texts at once, as arrays.

Tasks receive Arrow batches; the texts of a slice lie one behind the other in a byte buffer, so words, their
hashes and their statistics are found with a few array operations for all texts together. Two words count as
equal when their 64-bit hashes are equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags of the 256 byte values, set in the inclusive ranges."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


WHITE = byte_set((0x09, 0x0D), (0x20, 0x20))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def crc_class(key: str | Column, n: int) -> Column:
    """crc32 of the key as text modulo ``n``; null for a null key."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key) % n


def white_words(text: Column) -> Column:
    """Words between white space, as a SQL array; empty for null and for blank texts."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t\n\x0B\f\r]+")
    )


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores behind it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices whose ``text`` holds about ``limit`` bytes, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column("text").cast(pa.large_string())
        _, offsets, _ = Texts.buffers(lengths)
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit values, one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs that begin at ``first``; none of them is empty."""
    return np.add.reduceat(values, first) if len(first) else values[:0]


@dataclass
class Texts:
    """``data`` holds the texts' bytes, text ``i`` from ``offsets[i]`` to ``offsets[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray

    @staticmethod
    def buffers(column: pa.Array) -> tuple[pa.Buffer, np.ndarray, int]:
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        return data, ends, int(ends[0]) if len(ends) else 0

    @classmethod
    def of(cls, column: pa.Array, fold: bool = False) -> Texts:
        """``fold`` lower-cases A to Z. Null texts are empty."""
        column = column.cast(pa.large_string())
        if column.null_count:
            column = column.fill_null("")
        data, ends, first = cls.buffers(column)
        raw = np.frombuffer(data, np.uint8)[first : int(ends[-1])] if data is not None else np.zeros(0, np.uint8)
        return cls(FOLD[raw] if fold else raw, (ends - first).astype(np.int64))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, separators: np.ndarray) -> Words:
        inside = ~separators[self.data]
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        owner = np.searchsorted(self.offsets, start, side="right") - 1
        count = np.bincount(owner, minlength=len(self)) if len(owner) else np.zeros(len(self), np.int64)
        first = np.concatenate(([0], np.cumsum(count)))
        return Words(self, inside, start, end, owner, first)


@dataclass
class Words:
    """All words in order; those of text ``i`` are ``first[i]`` to ``first[i + 1]``."""

    texts: Texts
    inside: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint64)
        begin = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(begin, length)
        values = (self.texts.data[self.inside].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[place]
        return mix(sums(values, begin) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words that lie in one text, and the place of their first word."""
    if len(h) < n:
        return h[:0], np.zeros(0, np.int64)
    base = powers(n, 0xA0761D6478BD642F)
    total = h[: len(h) - n + 1] * base[0]
    for i in range(1, n):
        total = total + h[i : len(h) - n + 1 + i] * base[i]
    at = np.flatnonzero(owner[: len(h) - n + 1] == owner[n - 1 :])
    return mix(total[at] + np.uint64(n)), at
