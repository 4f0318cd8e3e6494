"""Centroid clustering of integer vectors: nearest centroids by a tournament of bisecting planes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import pin

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1

#: Components are integers up to this size, so that every squared distance and sign test fits 64 bits.
LARGEST = 1 << 27


class Bisectors:
    """Integer normals and thresholds of the planes between all pairs of centroids.

    ``b`` is nearer to x than ``a`` exactly if normal . x > threshold, with normal = 2 (b - a) and threshold =
    |b|^2 - |a|^2.  Zero keeps ``a``, the smaller number.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        square = (centroids * centroids).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])         # [a, b, component]
        self.thresholds = square[None, :] - square[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row of ``x``: each challenger meets the winner so far, k - 1 tests a row."""
        winner = np.zeros(len(x), dtype=np.int64)
        for b in range(1, len(self.centroids)):
            over = np.einsum("ij,ij->i", self.normals[winner, b], x) - self.thresholds[winner, b]
            winner[over > 0] = b
        return winner

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[winner]
        return np.einsum("ij,ij->i", apart, apart)


def whole_vectors(df: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors with all components there and finite."""
    x = F.col(vector)
    within = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) * scale <= LARGEST, F.lit(False)))
    return (df.filter(x.isNotNull() & (F.size(x) == dimensions) & within)
            .select(F.col(key).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v")))


def as_matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def sums(vectors: DataFrame, bisectors: Bisectors, dimensions: int) -> list:
    """(cluster, place, total) rows: the sums of the components of each cluster, and at place -1 the number of its vectors.

    A task hands on one row for each cluster and place, whatever the number of vectors; the driver gets as many.
    """
    k = len(bisectors.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), dtype=np.int64)
        for batch in batches:
            x = as_matrix(batch.column(0), dimensions)
            winner = bisectors.nearest(x)
            for c in range(k):
                of_c = x[winner == c]
                total[c, 0] += len(of_c)
                total[c, 1:] += of_c.sum(axis=0)
        cluster, place = np.nonzero(np.repeat(total[:, :1] > 0, dimensions + 1, axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.astype(np.int32)), pa.array((place - 1).astype(np.int32)), pa.array(total[cluster, place])],
            names=["cluster", "place", "total"])

    return (vectors.select("v").mapInArrow(run, "cluster int, place int, total long")
            .groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect())


def moved(centroids: np.ndarray, found: list) -> np.ndarray:
    """Each centroid with vectors at the exact floor of their mean; the others stay."""
    total = {(r.cluster, r.place): int(r.total) for r in found}
    out = centroids.copy()
    for c in range(len(centroids)):
        if (c, -1) in total:
            out[c] = [total[c, i] // total[c, -1] for i in range(centroids.shape[1])]
    return out


def first_order(key: Column, seed: int = SEED) -> Column:
    """SHA-256 of ``seed:key`` in hexadecimal; a null key hashes as the empty text."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS,
            dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector.

    Kept are vectors of exactly ``dimensions`` components, none null, NaN or infinite; each component becomes
    floor(scale * x).  (Components beyond 2 ** 27 after scaling count as not finite: their squared distances fit no long.)
    Centroids start at the vectors with the least hashes of their ids, equal ids by their vectors; with fewer vectors than
    ``centroids`` there are as many centroids as vectors.  Repeated rows are clustered one by one; other columns are not read; without a
    kept vector the result is empty.  A sum of distances that fits no long is null.

    The vectors are written once as integers and read once a round; centroids, sums and digests (k times the dimensions)
    are all that reaches the driver.
    """
    spark = df.sparkSession
    vectors = pin(whole_vectors(df, key, vector, dimensions, scale), "vectors")
    first = vectors.orderBy(first_order(F.col("vec_id"), seed), "v").limit(centroids).select("v").collect()
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if not first:
        return spark.createDataFrame([], schema)
    at = np.array([r.v for r in first], dtype=np.int64)
    for _ in range(rounds):
        at = moved(at, sums(vectors, Bisectors(at), dimensions))
    final = Bisectors(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(1), dimensions)
            winner = final.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(winner.astype(np.int32)), pa.array(final.distances(x, winner))],
                names=["vec_id", "cluster", "distance"])

    placed = pin(vectors.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    found = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()

    def as_long(total: int) -> int | None:
        return total if total < 1 << 63 else None

    everything = as_long(sum(int(r.total) for r in found))
    about = spark.createDataFrame([(r.cluster, as_long(int(r.total)), everything, centroid_digest(at[r.cluster])) for r in found],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select(*[c.split()[0] for c in schema.split(", ")])   # one row a centroid
