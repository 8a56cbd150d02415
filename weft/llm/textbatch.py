"""Byte-level views of Arrow string columns: words, lines and rolling hashes without Python strings.

A text is its UTF-8 bytes. Hashes are polynomials over a random byte table modulo 2**64, taken from
one prefix sum for each slice and finished by a 64-bit mixer, so the hash of any span costs a few
array operations. Equal spans always have equal hashes, on every executor.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cached_property, wraps

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
SLICE_BYTES = 512 << 10

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORDY = np.zeros(256, bool)
WORDY[128:] = True
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    WORDY[_lo:_hi] = True


def lean(run: Callable) -> Callable:
    """``run`` over Arrow batches, giving freed memory back to the system when a task ends.

    Python workers outlive their tasks; else the allocators of idle ones keep the most that a task ever held.
    """

    @wraps(run)
    def task(batches):
        tight_heap()
        try:
            yield from run(batches)
        finally:
            trim()

    return task


def tight_heap() -> None:
    """From now on arrays of 8 MB or more are maps of their own, which go back to the system as soon as they are freed."""
    if set_option := getattr(ctypes.CDLL(None), "mallopt", None):  # glibc has it; -3 is its M_MMAP_THRESHOLD
        set_option(-3, 8 << 20)


def trim() -> None:
    """Gives the freed memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        give_back(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=U) * BASE)
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}
_INVERSE = U(pow(int(BASE), -1, 1 << 64))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), BASE if kind == "up" else _INVERSE, U)
        steps[0] = U(1)
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind]


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, "Texts"]]:
    """Row ranges of about ``most`` bytes each; one longer text makes a slice of its own."""
    data, offs = strings(column)
    row, rows = 0, len(offs) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offs, offs[row] + most, side="right")) - 1)
        yield row, to, Texts(data[offs[row] : offs[to]], offs[row : to + 1] - offs[row])
        row = to


class Texts:
    """Some texts side by side. ``lower`` folds A-Z; ``cuts`` says which bytes end a word."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = False):
        self.raw, self.offs, self.n = data, offs, len(offs) - 1
        self.data = LOWER[data] if lower else data

    def lowered(self) -> "Texts":
        return Texts(self.raw, self.offs, True)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offs])

    @cached_property
    def prefix(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, U)
        np.cumsum(BYTE_CODE[self.data] * _power("up", len(self.data))[: len(self.data)], out=out[1:])
        return out

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * _power("down", len(self.data) + 1)[start]
        return mix(h + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of flagged bytes within one text: starts, ends, and the index of each text's first run."""
        n = len(inside)
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        first = self.offs[:-1][self.offs[:-1] < n]
        begins[first] = inside[first]
        last = self.offs[1:][self.offs[1:] > 0] - 1
        ends[last] = inside[last]
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(start, self.offs)

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of bytes other than blank, \\t, \\n, \\v, \\f and \\r."""
        return self.runs(~SPACE[self.data])

    @cached_property
    def word_hash(self) -> np.ndarray:
        start, end, _ = self.words
        return self.span_hash(start, end)

    def owner(self, first: np.ndarray) -> np.ndarray:
        """The text of each run, from the index of each text's first run."""
        return np.repeat(np.arange(self.n), np.diff(first))

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines split at \\n that hold a word: starts, ends, text."""
        if not len(self.data):
            return (np.zeros(0, np.int64),) * 3
        breaks = np.flatnonzero(self.data == 10)
        start = np.union1d(self.offs[:-1], breaks + 1)
        start = start[start < len(self.data)]
        end = np.append(start[1:], len(self.data))
        end = end - (self.data[end - 1] == 10)
        seen = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(~SPACE[self.data], out=seen[1:])
        wordy = seen[end] > seen[start]
        start, end = start[wordy], end[wordy]
        return start, end, np.searchsorted(self.offs, start, side="right") - 1


def windows(word_hash: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive words of one text: hash, index of the first word."""
    n = len(word_hash)
    if n < width:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = np.zeros(n - width + 1, U)
    for j in range(width):
        total = (total + word_hash[j : n - width + 1 + j]) * U(0xD1342543DE82EF95)
        total ^= total >> U(32)
    inside = np.ones(n - width + 1, bool)
    for j in range(1, width):
        bad = first[1:-1] - j
        inside[bad[(bad >= 0) & (bad <= n - width)]] = False
    at = np.flatnonzero(inside)
    return mix(total[at]), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    spot = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[spot] == keys
