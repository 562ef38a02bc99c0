"""Words of whole texts as 64-bit numbers, computed on Arrow buffers without a Python object per word.

A word is a run of bytes other than space and U+0009 to U+000D. All hashes are polynomial sums over random byte
values with a final mix, taken from prefix sums, so a batch costs a handful of array passes whatever its words are.
Working memory follows ``STEP`` bytes of text (or the longest single word), not the length of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words(NamedTuple):
    """Words of consecutive rows: byte spans in ``data``; row r owns words ``first[r]`` to ``first[r + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), at


def lower_text(column: pa.Array) -> pa.Array:
    """Texts in lower case, letters of all scripts."""
    return pc.utf8_lower(column)


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row that is longer."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high
        low = high


def letter_table() -> np.ndarray:
    """Marks ASCII letters and digits and every byte of other characters."""
    table = np.zeros(256, bool)
    table[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return table


def split_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = None) -> Words:
    """Words of the rows whose bytes lie between consecutive ``offsets``; ``table`` marks other bytes as word bytes."""
    base = offsets[0]
    data, offsets = data[base: offsets[-1]], offsets - base
    solid = (data != 32) & ((data < 9) | (data > 13)) if table is None else table[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, solid
    before[offsets] = False
    start = np.flatnonzero(solid & ~before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[:-1], after[-1] = solid, False
    after[offsets] = False
    end = np.flatnonzero(solid & ~after[1:]) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


class Hasher:
    """One family of hashes; another ``seed`` gives an independent family."""

    def __init__(self, seed: int = 0):
        random = np.random.Generator(np.random.PCG64(seed + 1))
        self.table = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(0, 1 << 60)) * 8 + 5
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) <= n:
            size = 1 << max(10, int(n).bit_length())
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def words(self, w: Words, limit: int = STEP) -> np.ndarray:
        """Hash of every word."""
        out = np.empty(len(w.start), np.uint64)
        low = 0
        while low < len(out):
            high = max(low + 1, int(np.searchsorted(w.end, w.start[low] + limit, "right")))
            base = w.start[low]
            span = w.data[base: w.end[high - 1]]
            self._reach(len(span))
            total = np.zeros(len(span) + 1, np.uint64)
            np.cumsum(self.table[span] * self.powers[: len(span)], out=total[1:])
            s, e = w.start[low:high] - base, w.end[low:high] - base
            out[low:high] = mix((total[e] - total[s]) * self.inverse[s] + (e - s).astype(np.uint64))
            low = high
        return out

    def windows(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of ``size`` hashes, by start; a run may cross rows, see ``inside``."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        self._reach(len(hashes))
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.powers[: len(hashes)], out=total[1:])
        return mix((total[size:] - total[:-size]) * self.inverse[:n] + np.uint64(size))


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of all runs of ``size`` words that lie in one row."""
    n = first[-1] - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    last = np.repeat(first[1:], np.diff(first))[:n]
    return np.flatnonzero(np.arange(n) + size <= last)


def signed(h: np.ndarray) -> pa.Array:
    """Hashes as a column of longs."""
    return pa.array(h.view(np.int64))
