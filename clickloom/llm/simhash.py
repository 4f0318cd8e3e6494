"""SimHash near duplicates: fingerprints of whole texts, linked through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.groups import components
from clickloom.llm.text import buffers, lower_ascii, mix64, salted, slices, words
from clickloom.session import pin

SHINGLE, SEED, RADIUS = 3, 42, 2
U64 = np.uint64

#: Fingerprints of one bucket that are compared with each other; larger buckets are divided further.
MOST = 256

#: Of four parts two are left alone by two changed bits.
PAIRS = list(combinations(range(4), 2))


# --- fingerprints ------------------------------------------------------------------------------------------

def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of the words in lower case (A-Z only), repeats included, and the row of each."""
    w = words(lower_ascii(data), offsets)
    n = len(w.lengths)
    ends = np.cumsum(w.lengths + 1)
    spaced = np.full(int(ends[-1]) if n else 0, 32, dtype=np.uint8)
    blank = np.zeros(len(spaced), dtype=bool)
    blank[ends - 1] = True
    spaced[~blank] = w.data
    sizes = np.diff(w.first)
    begin = np.flatnonzero(w.doc[:max(n - SHINGLE + 1, 0)] == w.doc[SHINGLE - 1:])
    row, last = w.doc[begin], begin + SHINGLE - 1
    few = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(few):
        begin = np.concatenate((begin, w.first[few]))
        last = np.concatenate((last, w.first[few] + sizes[few] - 1))
        row = np.concatenate((row, few))
        order = np.argsort(row, kind="stable")
        begin, last, row = begin[order], last[order], row[order]
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    starts, stops = ends - w.lengths - 1, ends - 1
    found = [digest(raw[a:b], SEED) for a, b in zip(starts[begin].tolist(), stops[last].tolist())]
    return np.array(found, dtype=U64), row


def majority(hashes: np.ndarray, row: np.ndarray, rows: int, block: int = 1 << 15) -> np.ndarray:
    """Fingerprint of each row: a bit is 1 if it is set in over half of the row's hashes; none: 0."""
    ones, total = np.zeros((rows, 64), dtype=np.int64), np.bincount(row, minlength=rows)
    for lo in range(0, len(hashes), block):
        part, of = hashes[lo:lo + block], row[lo:lo + block]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1))
        ones[of[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(U64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row, over the whole text; the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                prints = majority(*shingle_hashes(*buffers(batch.column(1).slice(lo, hi - lo))), hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(prints.view(np.int64))],
                                                 names=["doc_id", "fingerprint"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, fingerprint long"))


# --- reference fingerprints and their distance tables ------------------------------------------------------

@cache
def parts(free: int) -> list[list[int]]:
    """The free bit places (those set in ``free``) in four parts of equal width."""
    places = [i for i in range(64) if free >> i & 1]
    width = len(places) // 4
    return [places[i * width:(i + 1) * width] for i in range(4)]


@cache
def references(free: int = (1 << 64) - 1) -> tuple[np.ndarray, np.ndarray]:
    """Reference fingerprints for the free bits: (first twins, second twins), each as [part, pattern].

    For each part there is a pair of twins for each of as many patterns as the part has bits.  Twins show the pattern on the
    part and are opposite everywhere else, where the first is random.  So what the distances to both twins add up
    to depends on the part alone; the patterns are those of a Hadamard matrix, so the sums determine the part.
    """
    of_part, width = parts(free), len(parts(free)[0])
    noise = salted(4 * width, 12).reshape(4, width)
    first, second = np.zeros((4, width), dtype=U64), np.zeros((4, width), dtype=U64)
    for p, places in enumerate(of_part):
        own = U64(sum(1 << i for i in places))
        for j in range(width):
            shown = U64(sum(1 << place for i, place in enumerate(places) if (i & j).bit_count() & 1))
            first[p, j] = shown | (noise[p, j] & ~own)
            second[p, j] = shown | (~noise[p, j] & ~own)
    return first, second


def distance_table(prints: np.ndarray, free: int = (1 << 64) - 1) -> np.ndarray:
    """Distances of each fingerprint to all references, as [fingerprint, twin, part, pattern]."""
    return np.bitwise_count(prints[:, None, None, None] ^ np.stack(references(free))[None])


def bucket_keys(prints: np.ndarray, outer: np.ndarray, free: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each two of the four parts: a key of the sums of the twins' distances over both, and the bits still free.

    Fingerprints that differ in at most two of the free bits, and in no other, share a key of at least one pair of parts.
    """
    table = distance_table(prints, free)
    width = table.shape[3]
    sums = (table[:, 0].astype(U64) + table[:, 1]) * salted(4 * width, 13).reshape(1, 4, width)
    of_part = mix64(sums.sum(axis=2))
    for i, (a, b) in enumerate(PAIRS):
        key = mix64(outer * U64(0x9E3779B97F4A7C15) + of_part[:, a] + U64(i + 1)) + of_part[:, b]
        rest = sum(1 << place for p in range(4) if p not in (a, b) for place in parts(free)[p])
        yield mix64(key), rest


def divide(rows: DataFrame) -> DataFrame:
    """The buckets of each row (bucket, free, fingerprint) one level further down: six rows for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outer, free, prints = (c.to_numpy(zero_copy_only=False).view(U64) for c in batch.columns)
            for state in np.unique(free):
                of = free == state
                for key, rest in bucket_keys(prints[of], outer[of], int(state)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(key), rest, dtype=U64).view(np.int64)),
                         pa.array(prints[of].view(np.int64))], names=["bucket", "free", "fingerprint"])

    return rows.mapInArrow(run, "bucket long, free long, fingerprint long")


# --- links -------------------------------------------------------------------------------------------------

def within(prints: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 16) -> np.ndarray:
    """Which pairs (a, b) link: first no distance to a reference may differ by more than the radius, then the pair is compared."""
    alive = np.arange(len(a))
    for lo in range(0, table.shape[1], step):
        apart = np.abs(table[a[alive], lo:lo + step] - table[b[alive], lo:lo + step]).max(axis=1)
        alive = alive[apart <= RADIUS]
    return alive[np.bitwise_count(prints[a[alive]] ^ prints[b[alive]]) <= RADIUS]


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it reaches) for the nodes that reach a smaller one: same classes as all links, fewer rows."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            node = np.flatnonzero(label != np.arange(n))
            return node, label[node]
        label = least


def linked(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets (runs of equal keys), as a spanning star of each class."""
    again = np.flatnonzero(keys[1:] == keys[:-1])
    if not len(again):
        return prints[:0], prints[:0]
    some = np.zeros(len(keys), dtype=bool)
    some[again] = some[again + 1] = True
    keys, prints = keys[some], prints[some]
    table = distance_table(prints).reshape(len(prints), -1).astype(np.int8)
    one, two, at, step = [], [], np.arange(len(keys) - 1), 1
    while True:
        at = at[at + step < len(keys)]
        at = at[keys[at + step] == keys[at]]
        if not len(at):
            break
        good = at[within(prints, table, at, at + step)]
        one.append(good)
        two.append(good + step)
        step += 1
    node, least = spanning(len(prints), np.concatenate(one), np.concatenate(two))
    return prints[node], prints[least]


def links(buckets: DataFrame) -> DataFrame:
    """Edges (a, b) of fingerprints that share a bucket and link; buckets have at most ``MOST`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)

        def done(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            a, b = linked(keys, prints)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            prints = np.concatenate((prints, batch.column(1).to_numpy().view(U64)))
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0          # the last bucket may go on
            yield done(keys[:last], prints[:last])
            keys, prints = keys[last:], prints[last:]
        yield done(keys, prints)

    return (buckets.select("bucket", "fingerprint").repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "a long, b long"))


def edges(prints: DataFrame) -> DataFrame:
    """Written edges (a, b) that connect what links within two bits, for a written table of distinct ``fingerprint``.

    Two changed bits leave two of four parts alone, so a fingerprint goes into one bucket for each pair of parts, named by the
    sums of its distances to the twins of these parts.  Buckets over ``MOST`` fingerprints (many variants of one
    text, or documents that share their bits for another reason) are divided in the same way by the 32 bits that are still
    free, then by 16; with 8 left a bucket holds at most 256 fingerprints.  No pair is lost, and none is listed that is not a link.
    """
    rows = prints.select(F.lit(0).cast("long").alias("bucket"), F.lit(-1).cast("long").alias("free"), "fingerprint")
    found = []
    for level in range(3):
        buckets = pin(divide(rows), "simhash-buckets")
        if level < 2:
            large = pin(buckets.groupBy("bucket").count().filter(F.col("count") > MOST).select("bucket"), "simhash-large")
            if not large.isEmpty():
                found.append(pin(links(buckets.join(large, "bucket", "left_anti")), "simhash-links"))
                rows = buckets.join(large, "bucket", "left_semi").select("bucket", "free", "fingerprint")
                continue
        found.append(pin(links(buckets), "simhash-links"))
        break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: 16 hexadecimal digits, and the least id that links reach.

    Texts without a word (null, empty, white space) have fingerprint 0 and link like any other; texts of one or two words have
    one shingle, the whole.  Rows with equal fingerprints are one node, whatever their number; repeated rows stay.  Null ids
    count in no minimum; a component of null ids only has a null id.  Only ``key`` and ``text`` are read; an empty table stays empty.
    """
    of_doc = pin(fingerprints(docs, key, text), "simhash")
    nodes = pin(of_doc.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    labels = components(edges(nodes), "simhash").select(F.col("node").alias("fingerprint"), "label")
    of_class = nodes.join(labels, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("label", "fingerprint").alias("label"))
    least = of_class.groupBy("label").agg(F.min("least").alias("component_id"))
    found = pin(of_class.join(least, "label").select("fingerprint", "component_id"), "simhash-classes")
    return of_doc.join(found, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
