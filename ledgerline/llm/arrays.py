"""Texts of Arrow batches as numpy arrays: words, shingles and hashes.

Texts are worked on in slices of about ``SLICE`` bytes, so that memory does not
depend on the batch size; a longer text is a slice of its own. Hashes are 64
bits with multipliers from a fixed seed, the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
U64 = np.uint64


KEPT: dict[tuple[int, int], np.ndarray] = {}


def multipliers(size: int, seed: int = 7) -> np.ndarray:
    """At least ``size`` fixed odd 64-bit numbers."""
    key = (1 << max(8, int(size).bit_length()), seed)
    if key not in KEPT:
        KEPT[key] = np.random.default_rng(seed).integers(0, 2**64, key[0], U64) | U64(1)
    return KEPT[key]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Texts(NamedTuple):
    """Rows ``first`` .. of a batch: their UTF-8 bytes and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray  # one more than rows

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, target: int = SLICE) -> Iterator[Texts]:
    """Consecutive rows of a text column; null counts as the empty text."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + target, "right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first : last + 1].astype(np.int64)
        yield Texts(first, data[part[0] : part[-1]], part - part[0])
        first = last


class Words(NamedTuple):
    start: np.ndarray  # byte positions in the slice
    end: np.ndarray
    offsets: np.ndarray  # words before each row; one more than rows


def words(t: Texts) -> Words:
    """Runs of other bytes than ASCII white space; none spans two rows."""
    inside = ~SPACES[t.data]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[t.offsets[:-1][t.offsets[:-1] < len(inside)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    ends = t.offsets[1:]
    after[ends[ends > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, t.offsets).astype(np.int64))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lowered."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))


def within(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """A hash of each word: a sum of its bytes by position, spread."""
    lengths = w.end - w.start
    if not len(lengths):
        return np.empty(0, U64)
    place = within(lengths)
    symbols = data[np.repeat(w.start, lengths) + place].astype(U64) + U64(1)
    sums = np.add.reduceat(
        symbols * multipliers(int(lengths.max()))[place], np.cumsum(lengths) - lengths
    )
    return mix(sums + U64(0x9E3779B97F4A7C15) * lengths.astype(U64))


def shingle_sets(t: Texts, size: int) -> Iterator[np.ndarray]:
    """Of each row, its distinct shingles of ``size`` lowered words, in order of hash.

    A row with fewer words has its whole sequence as one shingle, one without
    words has none.
    """
    data = lowered(t.data)
    w = words(t)
    h = word_hashes(data, w)
    factor = multipliers(size, 11)
    for a, b in zip(w.offsets, w.offsets[1:], strict=False):
        n = int(b - a)
        if not n:
            yield np.empty(0, U64)
            continue
        k = min(size, n)
        total = np.full(n - k + 1, U64(k))
        for j in range(k):
            total += h[a + j : b - k + 1 + j] * factor[j]
        yield np.unique(mix(total))


class Powers:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    def __init__(self, seed: int) -> None:
        base = int(multipliers(256, seed)[5])
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            n = 1 << int(size).bit_length()
            self.up = np.cumprod(np.r_[U64(1), np.full(n - 1, U64(self.base))], dtype=U64)
            self.down = np.cumprod(np.r_[U64(1), np.full(n - 1, U64(self.inverse))], dtype=U64)
        return self.up[:size], self.down[:size]

    def sums(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the symbols before each place, each by its power, and the inverse powers."""
        up, down = self.of(len(symbols))
        sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * up, out=sums[1:])
        return sums, down


def sum_hashes(sums: np.ndarray, down: np.ndarray, size: int) -> np.ndarray:
    """``run_hashes`` from what ``Powers.sums`` gives."""
    return mix((sums[size:] - sums[:-size]) * down[: len(sums) - size])


def run_hashes(symbols: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Hashes of all runs of ``size`` 64-bit symbols; equal runs have equal hashes."""
    n = len(symbols) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    return sum_hashes(*powers.sums(symbols), size)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches sorted by ``key``.

    Holds a batch and the group that is not complete yet.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(values[1:] != values[:-1])
        if held and held[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each group of equal neighbours begins, and its size."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return start, np.diff(np.r_[start, len(values)])


def in_parts(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes of a text or binary column."""
    data = batch.column(column)
    sizes = np.cumsum(
        np.nan_to_num(pa.compute.binary_length(data).to_numpy(zero_copy_only=False)) + 64
    )
    first = 0
    while first < batch.num_rows:
        base = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield batch.slice(first, last - first)
        first = last
