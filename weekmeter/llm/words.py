"""Words of whole texts as NumPy arrays, taken from Arrow buffers without making Python strings.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Words and n-grams are told apart by 64-bit hashes; two given different ones share a hash
with a chance of about 2**-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C13 | 3
_BYTES = np.random.Generator(np.random.PCG64(20240101)).integers(1, 2**64, 256, dtype=np.uint64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_tables: dict[str, np.ndarray] = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits; one to one."""
    values = (values ^ (values >> np.uint64(33))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("up", _BASE), ("down", inverse)):
            powers = np.full(PIECE + 1, base, np.uint64)
            powers[0] = 1
            _tables[name] = np.multiply.accumulate(powers)
    return _tables["up"], _tables["down"]


class Texts(NamedTuple):
    """Some rows of a batch: their bytes end to end, and where each row begins (one more at the end)."""

    rows: range
    data: np.ndarray
    offsets: np.ndarray


def texts(column: pa.Array, most: int = 1 << 20) -> Iterator[Texts]:
    """Cut a text column into runs of rows of about ``most`` bytes; a longer text comes alone. NULL: empty."""
    if not len(column):
        return
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width = np.int32
    elif pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield Texts(range(first, last), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


class Words(NamedTuple):
    """Words of several rows: byte ranges, and the first word of each row (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.firsts) - 1), self.counts)


def words(part: Texts) -> Words:
    inside = np.zeros(len(part.data) + 2, bool)
    inside[1:-1] = ~SPACE[part.data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = part.offsets[(part.offsets > 0) & (part.offsets < len(part.data))]
    starts[edges] |= inside[edges + 1]
    ends[edges - 1] |= inside[edges]
    starts = np.flatnonzero(starts)
    return Words(starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, part.offsets))


def word_hashes(data: np.ndarray, found: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; ``lower`` takes A-Z as a-z. Works in pieces, so long texts fit."""
    up, down = _powers()
    table = _BYTES[_LOWER] if lower else _BYTES
    starts, ends = found.starts, found.ends
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        origin = starts[at]
        stop = int(np.searchsorted(ends, origin + PIECE, "right"))
        if stop <= at:  # one word longer than a piece
            word = data[origin : ends[at]]
            word = _LOWER[word] if lower else word
            hashes[at] = int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        piece = data[origin : ends[stop - 1]]
        sums = np.empty(len(piece) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[piece] * up[: len(piece)], out=sums[1:])
        own = starts[at:stop] - origin
        hashes[at:stop] = (sums[ends[at:stop] - origin] - sums[own]) * down[own]
        at = stop
    return mixed(hashes)


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of n words, by its first word. Runs over row ends are included: mask them."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += hashes[k : k + count] * np.uint64(pow(_BASE, k + 1, 2**64))
    return mixed(total)


def runs_in_rows(found: Words, n: int) -> np.ndarray:
    """Number of runs of n words in each row."""
    return np.maximum(found.counts - n + 1, 0)


def segments(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of each of several ranges, end to end."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(before, lengths) + np.repeat(starts, lengths)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """An Arrow list column of longs from values laid end to end."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
