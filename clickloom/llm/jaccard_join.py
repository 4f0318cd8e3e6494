"""N-gram Jaccard self-join by chosen paths.

Every distinct text is a set of five-word shingles.  A run puts each set under one of its
shingles, the one that comes first under the run's hash; two sets share it with a
probability equal to their similarity.  Buckets that are still large are split again by several further
shingles each, chosen by the hash of the path; small buckets, and large ones whose sets are alike
anyway, are compared by brute force.  The number of runs follows from the recall asked for, all splits and the sketches' filter counted.

A pair that meets in several buckets is counted in the one with the least number: each
row carries the numbers of all its buckets, so no list of pairs is ever made.

Very large buckets of sets that are alike are not compared pair by pair where they need not be.  The shingles that most of their members
have are their middle.  One minus the similarity is a metric, so two members whose distances to the middle add up to no more than the
distance of a link are linked: these links are counted from the numbers of members at each distance.  Only pairs
for which the middle does not tell meet in tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.columns import shield
from clickloom.llm.groups import components, sorted_groups
from clickloom.llm.text import buffers, mix64, salted, shingle_sets, shingles, slices, word_hashes, words
from clickloom.operators.ordered import with_row_index
from clickloom.session import pin, small_batches

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99999
SKETCH = 48           # minima kept per text
SLACK = 0.3           # a pair is compared exactly if its sketches agree in similarity - SLACK of the places
SMALL = 256           # buckets up to this size are compared at once
BRANCHES = 2          # further shingles under which a large bucket is split
DEPTH = 5
ALIKE = 0.5           # mean similarity from which splitting a bucket is in vain
TILE_ROWS = 384
TILE_SHINGLES = 1 << 20
LONG = np.uint64(0x7FFFFFFFFFFFFFFF)
CROWD = 4096          # members from which a bucket that stays alike is compared about a middle
DRAWN = 512           # members, about, whose shingles make a middle; links are exact about any middle
GRAIN = 1000          # steps of a distance to the middle, rounded up


def missed(runs: int, similarity: float) -> float:
    """Probability that a pair of that similarity is not compared exactly after so many runs, with ``DEPTH`` splits on its way.

    Each of the ``SKETCH`` places agrees with that probability.  Too few fail the filter of ``pairs``; else a
    run keeps the pair together if its own place agrees and, split by split, the place of some branch.
    """
    need = (similarity - SLACK) * SKETCH
    out = 0.0
    for agree in range(SKETCH + 1):
        of = math.comb(SKETCH, agree) * similarity ** agree * (1 - similarity) ** (SKETCH - agree)
        together = 1.0
        for _ in range(DEPTH):
            together = 1 - (1 - agree / SKETCH * together) ** BRANCHES
        lost = sum(math.comb(agree, r) * math.comb(SKETCH - agree, runs - r) * (1 - together) ** r
                   for r in range(runs + 1)) / math.comb(SKETCH, runs)
        out += of * (lost if agree >= need else 1)
    return out


def runs_for(recall: float, similarity: float) -> int:
    """Runs after which a pair of that similarity has been compared exactly with probability ``recall``."""
    for runs in range(1, SKETCH + 1):
        if missed(runs, similarity) <= 1 - recall:
            return runs
    raise ValueError(f"a recall of {recall} at similarity {similarity} is not reached with {SKETCH} places and a slack of {SLACK}")


def sketch(value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Least hash of each row under each of ``SKETCH`` hash functions (32 bits)."""
    out = np.zeros((rows, SKETCH), dtype=np.uint32)
    if len(value):
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        for c, salt in enumerate(salted(SKETCH, 7)):
            least = np.minimum.reduceat(((value ^ salt) * (salt | np.uint64(1))) >> np.uint64(32), starts)
            out[row[starts], c] = least
    return out


def sketches(docs: DataFrame, runs: int) -> DataFrame:
    """(doc_id, key, shingles, sketch, roots) of (doc_id, key, text): roots are the buckets of the first level, none without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2), 2 << 20):
                data, offsets = buffers(batch.column(2).slice(lo, hi - lo))
                w = words(data, offsets)
                value, row, _ = shingles(w, word_hashes(w), SHINGLE)
                found = sketch(value, row, hi - lo)
                many = np.bincount(row, minlength=hi - lo) if len(row) else np.zeros(hi - lo, dtype=np.int64)
                roots = mix64(found[:, :runs].astype(np.uint64) + (np.arange(1, runs + 1, dtype=np.uint64) << np.uint64(32))) & LONG
                has = many > 0
                ends = np.concatenate(([0], np.cumsum(has * runs))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(many, type=pa.int64()),
                    pa.array([bytes(x) for x in found], type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(roots[has].ravel().astype(np.int64)))],
                    names=["doc_id", "key", "shingles", "sketch", "roots"])

    return docs.mapInArrow(run, "doc_id long, key string, shingles long, sketch binary, roots array<long>")


def split(members: DataFrame) -> DataFrame:
    """(bucket, branch, child, node) of (bucket, node, sketch): the bucket's number chooses the places, their minima the child."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column(0).to_numpy().astype(np.uint64)
            data, _ = buffers(batch.column(2))
            found = data.view(np.uint32).reshape(-1, SKETCH)
            for branch in range(BRANCHES):
                place = (mix64(bucket + np.uint64(branch)) % np.uint64(SKETCH)).astype(np.int64)
                minima = found[np.arange(len(found)), place].astype(np.uint64)
                child = mix64(bucket ^ mix64(minima + (np.uint64(branch + 1) << np.uint64(40)))) & LONG
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(np.full(len(found), branch), type=pa.int32()),
                    pa.array(child.astype(np.int64)), batch.column(1)], names=["bucket", "branch", "child", "node"])

    return members.mapInArrow(run, "bucket long, branch int, child long, node long")


def _shared(buckets: DataFrame) -> DataFrame:
    """Sizes of the buckets with at least two members."""
    return buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def leaves(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Written table (bucket, node): the buckets to be compared, from (node, sketch, roots); and those of large buckets that stay alike,
    None without any."""
    members = pin(nodes.select("node", F.explode("roots").alias("bucket")).distinct(), "join-roots")
    sizes = pin(_shared(members), "join-sizes")
    done, crowded = [], []
    for depth in range(DEPTH + 1):
        of = members.join(sizes, "bucket")
        last = depth == DEPTH
        done.append(of if last else of.filter(F.col("n") <= SMALL))
        large = of.filter(F.col("n") > SMALL)
        if last or sizes.filter(F.col("n") > SMALL).isEmpty():
            break
        found = nodes.select("node", "sketch")
        children = pin(split(large.join(found, "node").select("bucket", "node", "sketch")), "join-split")
        counted = pin(children.groupBy("bucket", "branch", "child").agg(F.count("*").alias("n")), "join-children")
        # share of pairs that agree in a place: the mean similarity inside the bucket
        alike = pin(counted.groupBy("bucket").agg(
            (F.sum(F.col("n") * F.col("n")) * BRANCHES / (F.sum("n") * F.sum("n"))).alias("_alike"))
            .filter(F.col("_alike") >= ALIKE).select("bucket"), "join-alike")
        done.append(large.join(alike, "bucket", "left_semi"))
        crowded.append(done[-1].filter(F.col("n") >= CROWD))
        members = pin(children.join(alike, "bucket", "left_anti").select(F.col("child").alias("bucket"), "node"), "join-members")
        sizes = pin(_shared(members), "join-sizes")
    def written(parts: list[DataFrame], name: str) -> DataFrame:
        return pin(reduce(DataFrame.union, parts).select("bucket", "node"), name)

    alike_ones = written(crowded, "join-crowded") if crowded else None
    return written(done, "join-leaves"), None if alike_ones is None or alike_ones.isEmpty() else alike_ones


# --- members about a middle ------------------------------------------------------------------

def _shingles_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges with the distinct shingles of their texts (the last column)."""
    texts = batch.column(batch.num_columns - 1)
    for lo, hi in slices(texts, 2 << 20):
        w = words(*buffers(texts.slice(lo, hi - lo)))
        yield lo, hi, *shingle_sets(w, word_hashes(w), SHINGLE)


def about_middles(crowded: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Written table (node, ring, off) of members near the middle of their ring, from (bucket, node) and (node, text).

    A node belongs to the ring of its least bucket.  The middle of a ring are the shingles that over half of ``DRAWN`` of its members
    have, drawn by hash (any set would do as a middle, so nothing depends on the draw but the number of pairs it tells); ``off`` is the
    distance to it in steps, rounded up, at most that of a link.
    """
    ring = pin(crowded.groupBy("node").agg(F.min("bucket").alias("ring")), "join-rings")
    rows = pin(ring.join(texts, "node").select("ring", "node", "text"), "join-ring-texts")
    sizes = ring.groupBy("ring").agg(F.count("*").alias("n"))
    drawn = rows.join(pin(sizes, "join-ring-sizes"), "ring").filter(F.pmod(F.xxhash64("node"), F.col("n")) < DRAWN).select("ring", "node", "text")
    of_drawn = pin(drawn.select("ring", "node"), "join-drawn").groupBy("ring").agg(F.count("*").alias("n"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, value, ends in _shingles_of(batch):
                of = np.repeat(batch.column(0).slice(lo, hi - lo).to_numpy(), np.diff(ends))
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(value.view(np.int64))], names=["ring", "shingle"])

    often = drawn.mapInArrow(listed, "ring long, shingle long").groupBy("ring", "shingle").agg(F.count("*").alias("_n"))
    middles = pin(often.join(of_drawn, "ring").filter(2 * F.col("_n") > F.col("n")).groupBy("ring")
                  .agg(F.collect_list("shingle").alias("middle")), "join-middles")
    most = round((1 - similarity) * GRAIN)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, middle = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for lo, hi, value, ends in _shingles_of(batch):
                rings, heads = (batch.column(c).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for c in (0, 1))
                offs = np.full(hi - lo, most + 1, dtype=np.int64)
                for i in range(hi - lo):
                    if heads[i]:
                        of, middle = rings[i], np.sort(batch.column(3)[lo + i].values.to_numpy().view(np.uint64))
                    elif of == rings[i]:
                        mine = value[ends[i]:ends[i + 1]]
                        at = np.minimum(np.searchsorted(middle, mine), len(middle) - 1)
                        common = int(np.count_nonzero(middle[at] == mine))
                        union = len(mine) + len(middle) - common
                        offs[i] = -(-(union - common) * GRAIN // union)
                near = offs <= most
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(lo, hi - lo).filter(pa.array(near)), pa.array(rings[near]),
                                                  pa.array(offs[near].astype(np.int32))], names=["node", "ring", "off"])

    # a middle goes ahead of each thousand of its members, not with every one of them
    parts = pin(sizes.select("ring", F.ceil(F.col("n") / 1024).cast("int").alias("parts")), "join-ring-parts")
    members = rows.join(parts, "ring").select("ring", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("head"),
                                              "node", "text")
    heads = middles.join(parts, "ring").select("ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("head"),
                                               "middle")
    both = (heads.unionByName(members, allowMissingColumns=True).repartition("ring", "part")
            .sortWithinPartitions("ring", "part", F.desc("head")).select("ring", "head", "node", "middle", "text"))
    return pin(both.mapInArrow(measured, "node long, ring long, off int"), "join-near")


def told_links(near: DataFrame, copies: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Links that the middles tell: (node, links) and star edges (a, b), from ``about_middles`` and (node, copies).

    A member at ``off`` is linked to all whose distance is at most that of a link less its own.  Members are counted by ring and
    distance, at most a few hundred numbers a ring.
    """
    most = round((1 - similarity) * GRAIN)
    of = near.join(copies, "node")
    at = of.groupBy("ring", "off").agg(F.sum("copies").alias("_here"), F.min("node").alias("_first"))
    upto = Window.partitionBy("ring").orderBy("off")
    at = pin(at.withColumns({"_upto": F.sum("_here").over(upto)}), "join-counted")
    whole = at.groupBy("ring").agg(F.map_from_entries(F.collect_list(F.struct("off", "_upto"))).alias("_counts"),
                                   F.min(F.struct("off", "_first")).alias("_best"))
    joined = of.join(pin(whole, "join-whole"), "ring")
    reach = F.lit(most) - F.col("off")
    steps = F.filter(F.map_keys("_counts"), lambda k: k <= reach)
    found = F.when(F.size(steps) > 0, F.element_at("_counts", F.array_max(steps))).otherwise(0)
    own = F.when(2 * F.col("off") <= most, F.col("copies")).otherwise(0)
    links = joined.select("node", (found - own).alias("links")).filter(F.col("links") > 0)
    star = joined.filter((F.col("off") + F.col("_best.off") <= most) & (F.col("node") != F.col("_best._first")))
    return pin(links, "join-told"), pin(star.select(F.col("node").alias("a"), F.col("_best._first").alias("b")), "join-stars")


# --- comparing the members of a tile --------------------------------------------------------

def pairs(bucket: int, lists: list[list[int]], found: np.ndarray, side: np.ndarray, across: bool,
          similarity: float, ring: np.ndarray | None = None, off: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Members (first, second) that meet here for the first time, whose sketches agree enough and whose ring does not tell them linked.

    In a tile ``across`` two chunks only pairs with one member in each are looked at.  ``ring`` is -1 for members of none.
    """
    n = len(lists)
    need = (similarity - SLACK) * SKETCH
    told = round((1 - similarity) * GRAIN)
    if ring is None:
        ring, off = np.full(n, -1), np.zeros(n, dtype=int)
    if n == 2:
        if across and side[0] == side[1] or ring[0] >= 0 and ring[0] == ring[1] and off[0] + off[1] <= told:
            return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
        early = any(x < bucket for x in set(lists[0]).intersection(lists[1]))
        ok = not early and np.count_nonzero(found[0] == found[1]) >= need
        return (np.array([0]), np.array([1])) if ok else (np.zeros(0, dtype=int), np.zeros(0, dtype=int))
    agree = np.zeros((n, n), dtype=np.int16)
    for c in range(SKETCH):
        agree += found[:, c][:, None] == found[:, c][None, :]
    ok = np.triu(agree >= need, 1)
    if across:
        ok &= side[:, None] != side[None, :]
    if (ring >= 0).any():
        ok &= ~((ring[:, None] == ring[None, :]) & (ring[:, None] >= 0) & (off[:, None] + off[None, :] <= told))
    if ok.any():
        ids = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists])
        who = np.repeat(np.arange(n), [len(x) for x in lists])
        who, ids = who[ids < bucket], ids[ids < bucket]
        if len(ids):
            _, place, many = np.unique(ids, return_inverse=True, return_counts=True)
            often = many > 1
            where = np.cumsum(often) - 1
            use = often[place]
            met = np.zeros((n, int(often.sum())), dtype=np.float32)
            met[who[use], where[place[use]]] = 1
            ok &= ~((met @ met.T) > 0)
    return np.nonzero(ok)


def overlaps(value: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Common shingles of the rows ``first[i]`` and ``second[i]``; each row's values are distinct and sorted."""
    n = len(offsets) - 1
    if len(first) <= 2 * n or n < 6:
        out = np.zeros(len(first), dtype=np.int64)
        for i, (a, b) in enumerate(zip(first.tolist(), second.tolist())):
            x, y = value[offsets[a]:offsets[a + 1]], value[offsets[b]:offsets[b + 1]]
            if len(y) < len(x):
                x, y = y, x
            at = np.searchsorted(y, x)
            out[i] = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x) if len(y) else 0
        return out
    who = np.repeat(np.arange(n), np.diff(offsets))
    order = np.argsort(value, kind="stable")
    value, who = value[order], who[order]
    fresh = np.concatenate(([True], value[1:] != value[:-1]))
    place = np.cumsum(fresh) - 1
    often = np.bincount(place) > 1
    where = np.cumsum(often) - 1
    use = often[place]
    who, column = who[use], where[place[use]]
    common = np.zeros((n, n), dtype=np.float32)
    step = max(1, (4 << 20) // n)
    bounds = np.searchsorted(column, np.arange(0, int(often.sum()) + step, step))
    for lo, hi, base in zip(bounds[:-1], bounds[1:], range(0, int(often.sum()) + step, step)):
        held = np.zeros((n, step), dtype=np.float32)
        held[who[lo:hi], column[lo:hi] - base] = 1
        common += held @ held.T
    return common[first, second].astype(np.int64)


def least_reached(n: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Least member each member is linked to, directly or through others."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, first, label[second])
        np.minimum.at(label, second, label[first])
        label = label[label]
        if (label == before).all():
            return label


def _columns(table: pa.Table) -> tuple:
    found = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint32).reshape(-1, SKETCH)
    return (table.column("leaves").to_pylist(), found, table.column("chunk").to_numpy(), table.column("ring").to_numpy(),
            table.column("off").to_numpy())


TILE = ["bucket", "tile_a", "tile_b"]


def tiled(members: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Rows of (bucket, node) placed in the tiles of their bucket, with what comparing needs.

    A bucket is cut into chunks of a bounded number of rows and shingles; each two chunks make a tile.  The core of a bucket are the members
    of one ring, that with the most, within half the distance of a link of its middle: all their pairs are told, so chunks of the
    core meet the other chunks only, and a bucket that is all core has no tiles.
    """
    half = round((1 - similarity) * GRAIN) // 2
    of = members.join(nodes.select("node", "shingles", "ring", "off"), "node")
    inner = F.when((F.col("ring") >= 0) & (F.col("off") <= half), F.col("ring"))
    cores = (of.select("bucket", inner.alias("_core")).filter(F.col("_core").isNotNull()).groupBy("bucket", "_core")
             .agg(F.count("*").alias("_n")).groupBy("bucket").agg(F.max_by("_core", F.struct("_n", "_core")).alias("_core")))
    cores = pin(cores, "join-cores")
    if not cores.isEmpty():
        of = of.join(cores, "bucket", "left")
    else:
        of = of.withColumn("_core", F.lit(None).cast("long"))
    of = of.withColumn("_inside", F.coalesce((F.col("ring") == F.col("_core")) & (F.col("off") <= half), F.lit(False)))
    of = of.select("bucket", "node", "shingles", "_inside")

    def chunks(inside: bool) -> Column:
        mine = F.col("_inside") == inside
        return F.greatest(F.when(F.count_if(mine) > 0, 1).otherwise(0), F.ceil(F.count_if(mine) / F.lit(TILE_ROWS)),
                          F.ceil(F.coalesce(F.sum(F.when(mine, F.col("shingles"))), F.lit(0)) / F.lit(TILE_SHINGLES))).cast("int")

    sizes = pin(of.groupBy("bucket").agg(chunks(False).alias("_others"), chunks(True).alias("_cored"), F.count("*").alias("n"))
                .filter((F.col("n") > 1) & (F.col("_others") > 0)), "join-chunks")
    of = of.join(sizes.select("bucket", "_others", "_cored"), "bucket")
    place = F.xxhash64("node")
    chunk = F.when(F.col("_inside"), F.col("_others") + F.pmod(place, F.greatest(F.col("_cored"), F.lit(1)))).otherwise(
        F.pmod(place, F.greatest(F.col("_others"), F.lit(1))))
    last = F.when(F.col("_inside"), F.col("_others")).otherwise(F.col("_others") + F.col("_cored")) - 1
    of = of.withColumn("chunk", chunk.cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), last)))
    return of.select("bucket", "node", "chunk", F.least("chunk", "_other").alias("tile_a"),
                     F.greatest("chunk", "_other").alias("tile_b"))


def candidates(placed: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Written table of the tile members that have a pair to be compared exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        for table in sorted_groups(batches, TILE):
            if table.num_rows < 2:
                continue
            lists, found, chunk, ring, off = _columns(table)
            bucket, a, b = (table.column(c)[0].as_py() for c in TILE)
            first, second = pairs(bucket, lists, found, chunk, a != b, similarity, ring, off)
            if len(first):
                node = table.column("node").to_numpy()
                out += [(bucket, a, b, int(chunk[i]), int(node[i])) for i in np.union1d(first, second)]
            if len(out) > 20_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    def _rows(out: list) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)],
                                          names=[*TILE, "chunk", "node"])

    rows = placed.join(nodes.select("node", "sketch", "leaves", "ring", "off"), "node").select(
        *TILE, "chunk", "node", "sketch", "leaves", "ring", "off")
    rows = rows.repartition(*TILE).sortWithinPartitions(*TILE, "node")
    return pin(rows.mapInArrow(run, "bucket long, tile_a int, tile_b int, chunk int, node long"), "join-candidates")


def compared(chosen: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Written table (node, links, least): documents linked in a tile, and the least node reached there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, TILE):
            if table.num_rows < 2:
                continue
            table = table.combine_chunks()
            lists, found, chunk, ring, off = _columns(table)
            bucket, a, b = (table.column(c)[0].as_py() for c in TILE)
            first, second = pairs(bucket, lists, found, chunk, a != b, similarity, ring, off)
            if not len(first):
                continue
            data, offsets = buffers(table.column("text").combine_chunks()
                                    if isinstance(table.column("text"), pa.ChunkedArray) else table.column("text"))
            w = words(data, offsets)
            value, ends = shingle_sets(w, word_hashes(w), SHINGLE)
            size = np.diff(ends)
            common = overlaps(value, ends, first, second)
            linked = common >= similarity * (size[first] + size[second] - common) - 1e-9
            first, second = first[linked], second[linked]
            if not len(first):
                continue
            node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
            n = len(node)
            links = (np.bincount(first, weights=copies[second], minlength=n)
                     + np.bincount(second, weights=copies[first], minlength=n)).astype(np.int64)
            least = node[least_reached(n, first, second)]     # rows are in the order of nodes
            has = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(links[has]), pa.array(least[has])],
                                             names=["node", "links", "least"])

    rows = (chosen.join(nodes.select("node", "sketch", "leaves", "copies", "ring", "off"), "node").join(texts, "node")
            .select(*TILE, "chunk", "node", "sketch", "leaves", "copies", "ring", "off", "text"))
    rows = rows.repartition(*TILE).sortWithinPartitions(*TILE, "node")
    return pin(rows.mapInArrow(run, "node long, links long, least long"), "join-links")


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate classes: (members, classes).

    members: a row for each row of ``docs``: doc_id, text_key (md5), node, links (documents with an equal text or a similarity of
    at least ``similarity``).  classes: node, label (the class), class_id (least document id of the class; null only if all are null).

    Equal texts are one node, so copies are never compared.  Null counts as the empty text; texts without
    words are linked to equal texts only; a text of one to four words is one shingle.
    Other columns of ``docs`` are ignored; rows that repeat an id count one by one.
    """
    runs = runs_for(recall, similarity)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.md5(body).alias("key"), body.alias("text"))
    with small_batches(docs.sparkSession):
        found = pin(sketches(rows, runs), "join-sketches")
    one = found.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id"),
                                   F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"),
                                   F.first("roots").alias("roots"))
    nodes = pin(with_row_index(one, ["key"], "node"), "join-nodes")
    members, crowded = leaves(nodes)

    def texts_of(some: DataFrame) -> DataFrame:
        """One row of each text, found by its least id: copies of a text do not meet in one task.  The number of texts wanted follows the
        input, so they are never broadcast."""
        wanted = pin(some.select("node").distinct().join(nodes.select("node", "key", "least_id"), "node"), "join-wanted")
        return (rows.join(wanted.hint("merge"), (rows["key"] == wanted["key"]) & rows["doc_id"].eqNullSafe(wanted["least_id"]))
                .dropDuplicates(["node"]).select("node", "text"))

    with small_batches(docs.sparkSession):
        near = None if crowded is None else about_middles(crowded, texts_of(crowded), similarity)
    lists = members.groupBy("node").agg(F.array_sort(F.collect_set("bucket")).alias("leaves"))
    shared = nodes.select("node", "key", "copies", "shingles", "sketch").join(lists, "node")
    if near is None:
        shared = shared.withColumns({"ring": F.lit(-1).cast("long"), "off": F.lit(0)})
    else:
        shared = shared.join(near, "node", "left").fillna({"ring": -1, "off": 0})
    shared = pin(shared, "join-shared")
    chosen = candidates(tiled(members, shared, similarity), shared, similarity)
    with small_batches(docs.sparkSession):
        links = compared(chosen, shared, texts_of(chosen), similarity)
    edges = links.select(F.col("node").alias("a"), F.col("least").alias("b"))
    links = links.select("node", "links")
    if near is not None:
        told, stars = told_links(near, nodes.select("node", "copies"), similarity)
        links, edges = links.union(told), edges.union(stars)
    of_node = components(edges, "join")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.select("node", "least_id").join(of_node, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = classes.groupBy("label").agg(F.min("least_id").alias("class_id"))
    classes = pin(classes.join(least, "label").select("node", "label", "class_id"), "join-classes")
    per_node = nodes.select("key", "node", "copies").join(counts, "node", "left").select(
        F.col("key").alias("text_key"), "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    members = found.select("doc_id", F.col("key").alias("text_key")).join(pin(per_node, "join-counts"), "text_key")
    return members.select("doc_id", "text_key", "node", "links"), classes


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, class_id, links."""
    members, classes = jaccard_classes(docs, **settings)
    return members.join(classes, "node").select("doc_id", "class_id", "links")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with one document left of each class: that with the least id (null ids last), and of several rows with that
    id the first by text key; exactly repeated rows leave one."""
    members, classes = jaccard_classes(docs, key, text, **settings)
    node_class = pin(members.join(classes, "node").select("doc_id", "text_key", "label"), "join-kept")
    first = node_class.groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("_first"))
    best = pin(first.select("_first.doc_id", "_first.text_key").distinct(), "join-best")
    again = pin(node_class.groupBy("doc_id", "text_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
                .join(best.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")),
                      F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left_semi")
                .select("doc_id", "text_key"), "join-again")
    docs, back = shield(docs, [key, text])
    tagged = docs.withColumn("_key", F.md5(F.coalesce(F.col(text), F.lit(""))))
    best = best.select(F.col("doc_id").alias("_best"), F.col("text_key").alias("_best_key"))
    kept = tagged.join(best, F.col(key).eqNullSafe(F.col("_best")) & (F.col("_key") == F.col("_best_key")), "left_semi")
    if again.isEmpty():
        return back(kept.drop("_key"))
    same = F.col(key).eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_t"))
    again = again.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"))
    once = kept.join(again, same, "left_anti")
    repeated = kept.join(again, same, "left_semi").dropDuplicates([key, "_key"])
    return back(once.unionByName(repeated).drop("_key"))
