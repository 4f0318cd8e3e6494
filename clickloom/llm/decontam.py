"""Benchmark decontamination: SimHash of item-sized windows, then exact weighted shingle similarity.

A window that shares no shingle with an item has similarity 0 to it, so fingerprints are taken only of
windows that reach a word where a shingle of some item begins: this leaves out nothing.  Every
such window of the size of an item is fingerprinted, and a multi-index over blocks of the
fingerprint names the items within the Hamming radius: at least one of the blocks differs in no more bits than its
limit.  The similarity of each candidate is then computed exactly on the shingles with their numbers of occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.text import U64, buffers, mix64, shingles, slices, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
BITS, RADIUS = 128, 36
#: Bits in which a fingerprint may differ from an item's in each block of 32, for one block to count: with more in all of them
#: the distance is 10 + 9 + 9 + 9 at least, beyond the radius.
LIMITS = (9, 8, 8, 8)
ITEMS_AT_ONCE = 20_000
PAIRS_AT_ONCE = 1 << 20
STEP = 1 << 14          # shingles whose bits are laid out at once
AT_ONCE = 1 << 20       # bytes of texts searched at once


def bits_of(value: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 128 bits of each shingle."""
    both = np.stack((value, mix64(value ^ U64(0x9E3779B97F4A7C15))), axis=1)
    raw = both.astype("<u8").view(np.uint8).reshape(-1, BITS // 8)
    return np.unpackbits(raw, axis=1).astype(np.int8) * 2 - 1


def fingerprints(value: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start, as four blocks of 32 bits: each occurrence votes with its bits.

    Votes are summed between the places where some window begins or ends, a bounded number of shingles at a time and only where a
    window lies, so windows far apart in a long text cost what they hold.
    """
    marks = np.unique(np.concatenate((starts, starts + size)))
    first, last = np.searchsorted(marks, starts), np.searchsorted(marks, starts + size)
    inside = np.cumsum(np.bincount(first, minlength=len(marks)) - np.bincount(last, minlength=len(marks))) > 0
    sums = np.zeros((len(marks) + 1, BITS), dtype=np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    for begin, end in zip(edge[::2], edge[1::2]):         # marks of a stretch without a gap
        for lo in range(int(marks[begin]), int(marks[end]), STEP):
            hi = min(lo + STEP, int(marks[end]))
            at = np.arange(np.searchsorted(marks, lo, "right") - 1, np.searchsorted(marks, hi, "left"))
            sums[at + 1] += np.add.reduceat(bits_of(value[lo:hi]), np.maximum(marks[at] - lo, 0), axis=0, dtype=np.int64)
    np.cumsum(sums, axis=0, out=sums)
    votes = sums[last] - sums[first]
    return np.packbits(votes > 0, axis=1).view("<u4")


class MultiIndex:
    """Fingerprints by block; a pair is a candidate if one block differs in no more bits than its limit, which every pair within
    the radius does (of random fingerprints one in fifty)."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints

    def candidates(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, fingerprint) lists, a bounded number of queries at a time."""
        step = max(1, PAIRS_AT_ONCE // max(1, len(self.prints)))
        for lo in range(0, len(prints), step):
            some = prints[lo:lo + step]
            found = np.zeros((len(some), len(self.prints)), dtype=bool)
            for b, limit in enumerate(LIMITS):
                found |= np.bitwise_count(some[:, b, None] ^ self.prints[None, :, b]) <= limit
            query, at = np.nonzero(found)
            yield query + lo, at

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, fingerprint, distance) of all pairs within the radius."""
        out = []
        for query, at in self.candidates(prints):
            distance = np.bitwise_count(prints[query] ^ self.prints[at]).sum(axis=1)
            ok = distance <= RADIUS
            out.append((query[ok], at[ok], distance[ok]))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, dtype=int),) * 3


class Items:
    """Items of a benchmark by their number of words."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        column = pa.array(texts, type=pa.large_string())
        data, offsets = buffers(column)
        w = words(data, offsets)
        value, row, _ = shingles(w, word_hashes(w), SHINGLE)
        self.words = np.diff(w.first)
        self.value = [value[row == i] for i in range(len(ids))] if len(ids) < 64 else np.split(
            value, np.searchsorted(row, np.arange(1, len(ids))))
        self.counts = [np.unique(v, return_counts=True) for v in self.value]
        order = np.argsort(value, kind="stable")
        self.known, self.owner = value[order], row[order]
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[value & np.uint64((1 << 20) - 1)] = True
        self.by_size: dict[int, tuple[np.ndarray, MultiIndex]] = {}
        for size in np.unique(self.words[self.words > 0]).tolist():
            at = np.flatnonzero(self.words == size)
            prints = np.concatenate([fingerprints(self.value[i], np.zeros(1, dtype=int), len(self.value[i])) for i in at])
            self.by_size[size] = at, MultiIndex(prints)

    def hits(self, value: np.ndarray) -> np.ndarray:
        """Places of the values that are shingles of some item."""
        at = np.flatnonzero(self.filter[value & np.uint64((1 << 20) - 1)])
        if not len(at) or not len(self.known):
            return at[:0]
        place = np.minimum(np.searchsorted(self.known, value[at]), len(self.known) - 1)
        return at[self.known[place] == value[at]]

    def owners(self, value: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.known, value, "left"), np.searchsorted(self.known, value, "right")
        return np.unique(np.concatenate([self.owner[a:b] for a, b in zip(lo, hi)]))

    def similarity(self, value: np.ndarray, item: int) -> float:
        """Sum of the lesser over sum of the greater numbers of occurrences."""
        mine, n = np.unique(value, return_counts=True)
        theirs, m = self.counts[item]
        _, a, b = np.intersect1d(mine, theirs, assume_unique=True, return_indices=True)
        common = int(np.minimum(n[a], m[b]).sum())
        return common / (len(value) + len(self.value[item]) - common)

    def matches(self, value: np.ndarray, hits: np.ndarray, least: float) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, first shingle, shingles) of each item in one document's shingles; the earliest of equals."""
        best: dict[int, tuple[float, int, int]] = {}
        owned = self.owners(np.unique(value[hits]))
        for size in np.unique(self.words[owned]).tolist():
            items, index = self.by_size[size]
            m = min(max(1, size - SHINGLE + 1), len(value))
            reach = np.zeros(len(value) + 1, dtype=np.int64)
            np.add.at(reach, np.maximum(hits - m + 1, 0), 1)
            np.add.at(reach, hits + 1, -1)
            starts = np.flatnonzero(np.cumsum(reach[:-1])[:len(value) - m + 1] > 0)
            if not len(starts):
                continue
            for lo in range(0, len(starts), 1 << 13):
                some = starts[lo:lo + (1 << 13)]
                query, at, _ = index.within(fingerprints(value, some, m))
                for q, i in zip(query.tolist(), items[at].tolist()):
                    if i in best and best[i][0] == 1.0:
                        continue
                    found = self.similarity(value[some[q]:some[q] + m], i)
                    if found >= least - 1e-12 and (i not in best or found > best[i][0]):
                        best[i] = (found, int(some[q]), m)
        return best

    def leaks(self, column: pa.Array, least: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(row, item, similarity, first word, words) of the best match of each item in each text."""
        data, offsets = buffers(column)
        w = words(data, offsets)
        hashes = word_hashes(w)
        value, row, place = shingles(w, hashes, SHINGLE)
        hit = self.hits(value)
        rows, at = np.unique(row[hit], return_index=True)
        bounds = np.searchsorted(row, np.stack((rows, rows + 1)))
        for r, first, lo, hi in zip(rows.tolist(), at.tolist(), *(b.tolist() for b in bounds)):
            mine = hit[first:first + np.searchsorted(row[hit[first:]], r, "right")] - lo
            for item, (found, start, m) in sorted(self.matches(value[lo:hi], mine, least).items()):
                n = int(min(self.words[item], w.first[r + 1] - w.first[r]))
                yield r, item, found, int(place[lo + start] - w.first[r]), n
        # items of one to four words are one shingle: it is there or not
        for size in [s for s in self.by_size if s < SHINGLE]:
            items, _ = self.by_size[size]
            total = windows_sum(hashes, size)
            n = len(total)
            inside = np.flatnonzero(w.doc[:n] == w.doc[size - 1:size - 1 + n]) if n else np.zeros(0, dtype=int)
            seen: set[tuple[int, int]] = set()
            for i in items.tolist():
                for p in inside[total[inside] == self.value[i][0]].tolist():
                    r = int(w.doc[p])
                    more = w.first[r + 1] - w.first[r] > size
                    if more and (r, i) not in seen:     # texts of as many words were compared above
                        seen.add((r, i))
                        yield r, i, 1.0, int(p - w.first[r]), size


def windows_sum(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash that ``shingles`` gives a text of ``size`` words, at each place."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for j in range(1, size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    return mix64(total + np.uint64(size))


def item_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The items, by hash in blocks of about ``ITEMS_AT_ONCE``, each small enough for every machine.

    Null and empty texts cannot leak; equal rows count once.
    """
    rows = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text")).filter(F.length("text") > 0).distinct()
    size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-size[0] // ITEMS_AT_ONCE), -(-(size[1] or 0) // (16 << 20)))
    for block in range(blocks):
        found = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        if found:
            yield Items([r.item_id for r in found], [r.text for r in found])


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) for each document and item that is in it.

    A window has the item's number of words, or the whole text if that is shorter.  Repeated rows are reported one by one; a null id is kept;
    null and empty texts have no leaks.  Whole texts are searched, whatever their length.
    """
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)     # a block of bounded size

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in slices(batch.column(1), AT_ONCE):
                    found = list(held.value.leaks(batch.column(1).slice(lo, hi - lo), similarity))
                    if found:
                        row, item, near, first, n = zip(*found)
                        yield pa.RecordBatch.from_arrays([
                            batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                            pa.array([held.value.ids[i] for i in item], type=pa.int64()), pa.array(near, type=pa.float64()),
                            pa.array(first, type=pa.int64()), pa.array(n, type=pa.int64())],
                            names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item was found."""
    at = docs.columns.index(text)
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in slices(batch.column(at), AT_ONCE):
                    part = batch.slice(lo, hi - lo)
                    bad = {r for r, *_ in held.value.leaks(part.column(at), similarity)}
                    yield part.filter(pa.array([r not in bad for r in range(part.num_rows)], type=pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
