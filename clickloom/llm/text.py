"""Words, lines and windows of whole Arrow text columns as numpy arrays.

A text column is one byte buffer with offsets.  Everything here works on that
buffer at once, so no Python loop runs over words.  Words are the runs of
``[^\\x20\\x09-\\x0D]``: UTF-8 never uses those bytes inside a character.
Hashes have 64 bits and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = 10
U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of the public splitmix64 generator)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def salted(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed, well spread 64-bit values."""
    step = U64(0x9E3779B97F4A7C15)
    return mix64((np.arange(1, n + 1, dtype=U64) + U64(salt << 20)) * step)


_OF_BYTE = salted(256, 1)
_BASE = 0xD6E8FEB86659FD93
_POWERS = np.ones(1, dtype=U64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 256)
        steps = np.full(size, U64(_BASE), dtype=U64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; null counts as empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if starts is not None and len(column) else np.zeros(len(column) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row comes alone, whole."""
    _, offsets = buffers(column)
    at, n = 0, len(column)
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def span_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each of the consecutive spans of ``data``; an empty span hashes to 0."""
    out = np.zeros(len(lengths), dtype=U64)
    full = lengths > 0
    if not full.any():
        return out
    sizes = lengths[full]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(len(data), dtype=np.int64) - np.repeat(starts, sizes)
    parts = _OF_BYTE[data] * _powers(int(sizes.max()))[place]
    out[full] = mix64(np.add.reduceat(parts, starts) + sizes.astype(U64))
    return out


class Words(NamedTuple):
    data: np.ndarray      # bytes of all words, without white space
    lengths: np.ndarray   # bytes of each word
    starts: np.ndarray    # place of each word in the text buffer
    doc: np.ndarray       # row of each word
    first: np.ndarray     # first word of each row, and the number of words


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case; nothing else changes."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE) -> Words:
    """Runs of the bytes that ``between`` does not mark; a run ends with its row."""
    n, rows = len(data), len(offsets) - 1
    solid = ~between[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    before = np.concatenate(([False], solid[:-1])) if n else solid
    after = np.concatenate((solid[1:], [False])) if n else solid
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(rows), np.diff(first))
    return Words(data[solid], ends - starts, starts, doc, first)


def word_hashes(w: Words) -> np.ndarray:
    return span_hashes(w.data, w.lengths)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive values from each place (``len - k + 1`` places)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= U64(0x9E3779B97F4A7C15)
        out += hashes[j:j + n]
    return mix64(out)


def shingles(w: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of every ``k``-word window; a row with 1 to ``k - 1`` words has one, its whole text."""
    sizes = np.diff(w.first)
    made = windows(hashes, k)
    inside = w.doc[:len(made)] == w.doc[k - 1:] if len(made) else np.zeros(0, dtype=bool)
    place = np.flatnonzero(inside)
    value, row = made[place], w.doc[place]
    for length in range(1, k):
        rows = np.flatnonzero(sizes == length)
        if len(rows):
            at = w.first[rows]
            total = hashes[at].copy()
            for j in range(1, length):
                total = total * U64(0x9E3779B97F4A7C15) + hashes[at + j]
            value = np.concatenate((value, mix64(total + U64(length))))
            row, place = np.concatenate((row, rows)), np.concatenate((place, at))
    if (sizes[sizes > 0] < k).any():
        order = np.argsort(place, kind="stable")
        value, row, place = value[order], row[order], place[order]
    return value, row, place


def shingle_sets(w: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, as one array with row offsets."""
    value, row, _ = shingles(w, hashes, k)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, np.searchsorted(row, np.arange(len(w.first)))


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` inside each row."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]
