"""Centroid clustering against plain integers, and its plan."""

import hashlib
import random

import numpy as np

from clickloom.llm import bisector, queries


def brute(rows, centroids=16, rounds=3, dims=64):
    import math

    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in first[:centroids]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        at = [[sum(col) // len(col) for col in zip(*[v for (_, v), m in zip(kept, of) if m == n])] or at[n] for n in range(len(at))]
    last = [(i, *nearest(v)) for i, v in kept]
    out = []
    for i, d, n in last:
        out.append((i, n, d, sum(e for _, e, m in last if m == n), sum(e for _, e, _ in last),
                    hashlib.sha256(",".join(map(str, at[n])).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, v int").repartition(3)


def test_against_plain_integers(spark):
    draw = random.Random(4)
    rows = [(i, [float(np.float32(draw.gauss(i % 5, 0.4))) for _ in range(64)]) for i in range(150)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, rows[8][1])]          # repeated and null ids
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [1.0] * 63 + [None]),
             (905, [1.0] * 63 + [float("nan")]), (906, [float("inf")] * 64), (907, [-0.0] * 64), (908, [-1e-9] * 64)]
    got = bisector.cluster(frame(spark, rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows_of(got) == brute(rows)


def test_few_and_equal_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(40)]              # all centroids equal: the smallest number wins
    assert rows_of(bisector.cluster(frame(spark, same))) == brute(same)
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert rows_of(bisector.cluster(frame(spark, few))) == brute(few)
    assert bisector.cluster(frame(spark, few).limit(0)).count() == 0
    assert bisector.cluster(frame(spark, [(1, None), (2, [1.0])])).count() == 0


def test_tournament_ties_and_large_components():
    draw = np.random.default_rng(1)
    for top in (3, 1 << 27):
        centroids = draw.integers(-top, top, (16, 64))
        centroids[7] = centroids[2]
        x = np.concatenate((draw.integers(-top, top, (500, 64)), centroids))
        found = bisector.Bisectors(centroids)
        apart = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids] for v in x], dtype=object)
        want = [min(range(16), key=lambda n, row=row: (row[n], n)) for row in apart]
        assert found.nearest(x).tolist() == want
        assert found.distances(x, np.array(want)).tolist() == [row[n] for row, n in zip(apart, want)]


def test_query_against_sql(spark, sf):
    from check import compare, connect

    good, note = compare(queries.op13_bisector(spark, sf), connect(sf), queries.ORACLES["op13_bisector"])
    assert good, note
