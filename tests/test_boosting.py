"""Boosted trees against a plain version, and staged predictions against separate fits."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import encode, modelling
from clickloom.operators.boosting import GradientBoosting, soft


def plain(rows, names, trees, depth, rate, l1, l2, min_gain, min_rows, base=0.5):
    """Predictions and leaf values by trying every cut at every value."""
    def strength(g, h):
        return soft(g, l1) ** 2 / (h + l2)

    pred, leaves = [base] * len(rows), []

    def sums(at):
        return sum(pred[i] - rows[i]["label"] for i in at), len(at)

    def grow(at, level):
        g, h = sums(at)
        best = None
        for f, name in enumerate(names):
            known = sorted({rows[i][name] for i in at if rows[i][name] is not None})
            for cut in sorted({r[name] for r in rows if r[name] is not None})[1:]:
                if not any(v < cut for v in known):
                    continue
                for missing_left in (False, True):
                    left = [i for i in at if (missing_left if rows[i][name] is None else rows[i][name] < cut)]
                    right = [i for i in at if i not in set(left)]
                    if len(left) < min_rows or len(right) < min_rows:
                        continue
                    gain = strength(*sums(left)) + strength(*sums(right)) - strength(g, h)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, left, right)
        if level == depth or best is None:
            return ("leaf", at, g, h)
        kids = [grow(side, level + 1) for side in best[1:]]
        if best[0] < min_gain and all(k[0] == "leaf" for k in kids):
            return ("leaf", at, g, h)
        return ("cut", *kids)

    for _ in range(trees):
        todo, made = [grow(list(range(len(rows))), 0)], []
        while todo:
            node = todo.pop()
            if node[0] == "cut":
                todo += node[1:]
                continue
            value = -soft(node[2], l1) / (node[3] + l2) * rate
            made.append(round(value, 6))
            for i in node[1]:
                pred[i] += value
        leaves.append(sorted(made))
    return pred, leaves


def table(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = draw.randint(0, 12), draw.choice([None, 1.0, 2.5, 4.0, float("nan")]), round(draw.uniform(-2, 2), 1)
        b = None if b != b else b
        out.append({"id": i, "a": a, "b": b, "c": c, "label": a * 0.7 + (3.0 if b is None else b) * c + draw.gauss(0, 0.3)})
    return out


@pytest.mark.parametrize("l1,min_gain,min_rows", [(0.0, 0.0, 1), (5.0, 0.0, 1), (0.8, 4.0, 6)])
def test_trees_equal_a_plain_version(spark, l1, min_gain, min_rows):
    rows = table(90, 3)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id int, a int, b double, c double, label double").repartition(3)
    names = ["a", "b", "c"]
    model = GradientBoosting(trees=3, depth=3, rate=0.3, l1=l1, min_gain=min_gain, min_rows=min_rows, features=names).fit(df)
    want, leaves = plain(rows, names, 3, 3, 0.3, l1, 1.0, min_gain, min_rows)
    got = {r.id: r.prediction for r in model.transform(df).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(want, abs=1e-6)
    found = model.describe(df).filter("feature is null").collect()
    assert [sorted(round(r.value, 6) for r in found if r.tree == t) for t in (1, 2, 3)] == leaves


def test_l1_shrinks_leaves_as_by_hand(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0), (1.0, 9.0), (1.0, 8.0)], "x double, label double")
    for l1 in (0.0, 1.0, 20.0):
        model = GradientBoosting(trees=1, depth=1, rate=1.0, l1=l1, l2=1.0, base=0.0, features=["x"]).fit(df)
        leaves = {r.node: r.value for r in model.describe(df).collect() if r.feature is None}
        if l1 < 20:      # sums of the labels: 3 and 17, two rows and the penalty 1 below
            assert leaves == pytest.approx({2: max(3 - l1, 0) / 3, 3: (17 - l1) / 3})
        else:            # 20 is the whole sum: no cut gains, and the one leaf is 0
            assert leaves == {1: 0.0}


def test_empty_constant_and_vector_input(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (1.0, None, 5.0), (1.0, None, None)], "x double, z double, label double")
    model = GradientBoosting(trees=2, features=["x", "z"], rate=1.0, l2=0.0).fit(df)
    assert {r.prediction for r in model.transform(df).collect()} == {4.0}
    none = GradientBoosting(trees=1, features=["x"]).fit(df.limit(0))
    assert {r.prediction for r in none.transform(df).collect()} == {0.5}
    rows = spark.createDataFrame([(float(i % 7), float(i % 3), float(i % 7) * 2) for i in range(60)], "x double, z double, label double")
    listed = GradientBoosting(trees=3, features=["x", "z"]).fit(rows).transform(rows)
    vector = encode.concatenate(rows, ["x", "z"])
    packed = GradientBoosting(trees=3).fit(vector).transform(vector)
    assert sorted(r.prediction for r in listed.collect()) == pytest.approx(sorted(r.prediction for r in packed.collect()))


def test_sampled_rows_and_features_repeat(spark):
    rows = table(200, 5)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id int, a int, b double, c double, label double")
    make = GradientBoosting(trees=4, subsample=0.6, feature_share=0.7, features=["a", "b", "c"])
    one, two = (make.fit(df.repartition(n)).describe(df).collect() for n in (2, 5))
    assert [(r.tree, r.node, r.feature, r.threshold) for r in one] == [(r.tree, r.node, r.feature, r.threshold) for r in two]
    assert make.fit(df).trees != GradientBoosting(trees=4, features=["a", "b", "c"]).fit(df).trees


@pytest.mark.parametrize("kind", ["own", "library"])
def test_staged_curve_equals_separate_fits(spark, kind):
    rows = table(160, 8)
    df = spark.createDataFrame([(r["id"], float(r["a"]), r["c"], r["label"] + 20) for r in rows], "id int, a double, c double, label double")
    samples = modelling.in_blocks(encode.concatenate(df, ["a", "c"]), ["id"], 2)

    def make(n):
        return (GradientBoosting(trees=int(n), subsample=0.6) if kind == "own" else modelling.boosted_trees(trees=int(n), subsample=0.6))

    staged = modelling.staged_curve(samples, make, [1, 3, 6], 2, modelling.mape_measure)
    apart = modelling.validation_curve(samples, make, [1, 3, 6], 2, modelling.mape_measure)
    key = lambda r: (r.param, r.fold)
    got, want = sorted(staged.collect(), key=key), sorted(apart.collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in want]
    assert [x for r in got for x in r[2:]] == pytest.approx([x for r in want for x in r[2:]], abs=1e-9)


def test_a_level_is_one_aggregate(spark, monkeypatch):
    """One job a level and tree, whatever the number of rows and features, and nothing else but bins and rewritten predictions."""
    df = spark.range(1000).select(*[(F.col("id") % n).cast("double").alias(f"x{n}") for n in (5, 7, 10)], F.col("id").cast("double").alias("label"))
    make = GradientBoosting(trees=5, l2=0.0, features=["x5", "x7", "x10"])
    calls, inner = [], GradientBoosting._best_cuts
    monkeypatch.setattr(GradientBoosting, "_best_cuts", lambda self, *a: calls.append(1) or inner(self, *a))
    make.fit(df)
    assert len(calls) == make.trees * make.depth


def test_targets_side_by_side_equal_separate_fits(spark):
    rows = table(120, 11)
    df = spark.createDataFrame([(*r.values(), r["c"] * 2 if i % 4 else None) for i, r in enumerate(rows)],
                               "id int, a int, b double, c double, first double, second double")
    make = GradientBoosting(trees=3, features=["a", "b", "c"], min_rows=3)
    models = modelling.fit_targets(df, lambda: make, ["first", "second"])
    both = modelling.predict_targets(models, df).collect()
    for name in ("first", "second"):
        alone = {r.id: r.prediction for r in make.setLabelCol(name).fit(df).transform(df).collect()}
        seen = [r for r in both if r[name] is not None]      # cuts fall between the same rows, at other rows' values maybe
        assert [r[f"pred_{name}"] for r in seen] == pytest.approx([alone[r.id] for r in seen], abs=1e-9)
