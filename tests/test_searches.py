"""Searches in shared scans against separate fits, closed forms and plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import encode, modelling, moments, passes


def linear_rows(n, seed=3):
    draw = random.Random(seed)
    return [(i, draw.gauss(0, 1), draw.gauss(5, 2), draw.gauss(0, 1)) for i in range(n)]


@pytest.fixture(scope="module")
def lines(spark):
    df = spark.createDataFrame(linear_rows(300), "id int, a double, b double, e double")
    df = df.withColumn("label", 10 + 3 * F.col("a") - F.col("b") + F.col("e") * 0.3)
    return encode.concatenate(df, ["a", "b"]).select("id", "label", "features")


def matrix(df):
    rows = df.orderBy("id").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])


def test_moments_of_blocks(spark, lines):
    samples = modelling.in_blocks(lines, ["id"], 2)
    found = moments.moments(samples)
    for block, sums in found.items():
        x, y = matrix(samples.filter(F.col("block") == block))
        z = np.column_stack((np.ones(len(y)), x, y))
        assert sums == pytest.approx(z.T @ z)
    assert moments.moments(samples.limit(0)) == {}


def test_ridge_lasso_and_elastic_net_meet_their_conditions(lines):
    x, y = matrix(lines)
    z = np.column_stack((np.ones(len(y)), x, y))
    sums, n = z.T @ z, len(y)
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = moments.solve(sums, 7.0)
    assert ridge.weights == pytest.approx(np.linalg.solve(xc.T @ xc + 7 * np.eye(2), xc.T @ yc))
    assert moments.squared_error(sums, ridge) == pytest.approx(np.mean((y - ridge.intercept - x @ ridge.weights) ** 2))
    for share in (1.0, 0.4):
        for penalty in (0.05, 0.8, 50.0):
            line = moments.solve(sums, penalty, share)
            pull = xc.T @ (yc - xc @ line.weights) / n - penalty * (1 - share) * line.weights
            for g, w in zip(pull, line.weights):       # the subgradient of the sizes
                assert g == pytest.approx(penalty * share * np.sign(w), abs=1e-6) if w else abs(g) <= penalty * share + 1e-6
    scaled = moments.solve(sums, 0.01, 1.0, normalise=True)
    unit = xc / np.sqrt((xc * xc).sum(0))
    zz = np.column_stack((np.ones(n), unit, y))
    assert scaled.weights * np.sqrt((xc * xc).sum(0)) == pytest.approx(moments.solve(zz.T @ zz, 0.01, 1.0).weights)


@pytest.mark.parametrize("scheme", ["expanding", "blocked"])
def test_hundred_penalties_from_one_scan(spark, lines, scheme, monkeypatch):
    samples = modelling.in_blocks(lines, ["id"], 3, scheme)
    scans, inner = [], moments.moments
    monkeypatch.setattr(moments, "moments", lambda *a, **k: scans.append(1) or inner(*a, **k))
    penalties = np.logspace(-3, 4, 100).tolist()
    curve = moments.penalty_curve(samples, penalties, 3, scheme=scheme)
    ranked = modelling.rank_params(curve)
    assert scans == [1] and ranked.count() == 100
    some = [0.0, penalties[60]]
    got = {(r.param, r.fold): r[2:] for r in moments.penalty_curve(samples, some, 3, scheme=scheme).collect()}
    for (p, fold), pair in got.items():
        parts = []
        for block in (F.col("block") < fold if scheme == "expanding" else (F.col("block") != fold) & (F.col("block") <= 3), F.col("block") == fold):
            parts.append(matrix(samples.filter(block)))
        (x, y), (u, v) = parts
        w = np.linalg.solve((x - x.mean(0)).T @ (x - x.mean(0)) + p * np.eye(2), (x - x.mean(0)).T @ (y - y.mean()))
        a = y.mean() - x.mean(0) @ w
        assert pair == pytest.approx((np.mean((y - a - x @ w) ** 2), np.mean((v - a - u @ w) ** 2)))
    relative = {(r.param, r.fold): r[2:] for r in moments.penalty_curve(samples, [0.0], 3, scheme=scheme, measure="relative").collect()}
    apart = modelling.validation_curve(samples, lambda _: modelling.linear(), [0.0], 3, modelling.mape_measure, scheme=scheme)
    assert {k: v for k, v in relative.items()} == {(r.param, r.fold): pytest.approx(r[2:], rel=1e-6) for r in apart.collect()}


@pytest.mark.parametrize("scheme", ["expanding", "blocked"])
def test_sizes_from_one_scan(lines, scheme):
    samples = modelling.positioned(lines, ["id"])
    sizes = [60, 150, 300] if scheme == "expanding" else [60, 150]
    got = {(r.param, r.fold): r[2:] for r in moments.size_curve(samples, sizes, 3, scheme=scheme).collect()}
    want = modelling.learning_curve(samples, modelling.linear, sizes, 3, modelling.squared_measure, scheme=scheme)
    assert got == {(r.param, r.fold): pytest.approx(r[2:], rel=1e-6) for r in want.collect()}


# --- the package in the tasks ----------------------------------------------------------------------------

def test_package_is_sent_once_whoever_asks(spark):
    """Two archives of one name would fail the second call and every task after it."""
    import importlib

    from clickloom import session
    from clickloom.llm.deploy import ready

    ready(spark)
    session.ship_package(spark)
    session.together(spark, *[lambda: session.ship_package(spark)] * 4)
    again = importlib.util.module_from_spec(session.__spec__)        # the module loaded anew in the same application
    session.__spec__.loader.exec_module(again)
    again.ship_package(spark)
    assert sum("clickloom" in path.rsplit("/", 1)[-1] for path in spark.sparkContext.listFiles) == 1
    assert spark.range(3).count() == 3


# --- logistic --------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def clicks(spark):
    draw = random.Random(9)
    rows = []
    for i in range(400):
        a, b = draw.randint(0, 5), draw.randint(0, 3)
        rows.append((i, a, b, int(draw.random() < 1 / (1 + np.exp(1.0 - 0.5 * a + 0.7 * b)))))
    df = spark.createDataFrame(rows, "id int, a int, b int, label int")
    return encode.encode_rows(df, encode.dictionary(df, ["a", "b"]), ["a", "b"], keep=["id", "label"])


@pytest.mark.parametrize("scheme", ["expanding", "blocked"])
def test_shared_search_equals_separate_fits(clicks, scheme):
    samples, penalties = modelling.in_blocks(clicks, ["id"], 2, scheme, share=0.9), [0.001, 0.01, 0.1]
    shared = passes.shared_curve(samples, penalties, 2, scheme=scheme, tolerance=1e-10)
    apart = modelling.validation_curve(samples, lambda p: modelling.logistic(p, 200, 1e-10), penalties, 2, scheme=scheme)
    assert {(r.param, r.fold): pytest.approx(r[2:], abs=1e-5) for r in apart.collect()} == {(r.param, r.fold): tuple(r[2:]) for r in shared.collect()}
    rank = [[(r.param, r.rank_val_loss) for r in modelling.rank_params(c).orderBy("param").collect()] for c in (shared, apart)]
    assert rank[0] == rank[1]


def test_scans_do_not_grow_with_the_penalties(clicks, monkeypatch):
    samples, inner, scans = modelling.in_blocks(clicks, ["id"], 2), passes.gradients, []
    monkeypatch.setattr(passes, "gradients", lambda *a: scans.append(len(a[1])) or inner(*a))
    passes.shared_curve(samples, [0.05], 2)
    one = len(scans)
    scans.clear()
    passes.shared_curve(samples, [0.05, 0.051, 0.052, 0.053, 0.054, 0.055], 2)
    assert scans[0] == 12 and len(scans) <= one + 5


def sequential(rows, size, penalty, n, shard):
    """Plain loops over dense rows, shard by shard; the mean of the shards' weights after each pass."""
    weights, out = np.zeros(size + 1), []
    for number in range(n):
        total = np.zeros(size + 1)
        for lo in range(0, len(rows), shard):
            w, part = weights.copy(), rows[lo:lo + shard]
            for i, r in enumerate(part):
                x = r.features.toArray()
                p = 1 / (1 + np.exp(-(w[:-1] @ x + w[-1])))
                typical = np.sqrt(1 / np.sqrt(penalty))
                start = 1 / (typical / max(1, 1 / (1 + np.exp(-typical))) * penalty)
                rate = 1 / (penalty * (start + number * len(part) + i))
                w[:-1] -= rate * ((p - r.label) * x + penalty * w[:-1])
                w[-1] -= rate * (p - r.label)
            total += w * len(part)
        weights = total / len(rows)
        out.append(weights)
    return out


@pytest.mark.parametrize("shard", [1000, 130])
def test_losses_after_each_of_fourteen_passes(clicks, shard):
    samples = modelling.positioned(clicks, ["id"]).withColumn("block", F.lit(0))
    got = passes.passes(samples, 0.01, 14, shard)
    rows = samples.orderBy("position").collect()
    want = sequential(rows, len(rows[0].features), 0.01, 14, shard)
    assert got == pytest.approx(np.stack(want), abs=1e-8)
    loss = passes.losses(samples, got, [np.ones((14, 1), dtype=bool)])[0]
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])
    for w, found in zip(want, loss):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        assert found == pytest.approx(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def test_shards_side_by_side_equal_one_after_the_other(clicks, monkeypatch):
    """Shards of any lengths, rows without entries, a scale that starts anew; a batch takes as many steps as its longest shard has rows."""
    draw = np.random.default_rng(4)
    many = np.array([3, 0, 40, 1, 40, 17])
    lengths = draw.integers(0, 5, many.sum())
    starts = np.concatenate(([0], np.cumsum(lengths)))
    index = np.concatenate([draw.choice(6, n, replace=False) for n in lengths]).astype(int)
    value, label, weights = draw.normal(size=len(index)), draw.integers(0, 2, many.sum()).astype(float), draw.normal(size=7)
    ends = np.cumsum(many)
    for penalty in (1e-4, 0.01, 30.0):
        for number in (0, 3):
            got = passes.descend_together(weights, many, label, starts, index, value, penalty, number)
            want = [passes.descend(weights, label[e - n:e], starts[e - n:e + 1] if n else starts[:1], index, value, penalty, number * n)
                    for n, e in zip(many, ends)]
            assert got == pytest.approx(np.stack(want), abs=1e-9)
    calls = []
    monkeypatch.setattr(passes.np, "exp", lambda x, inner=np.exp: calls.append(1) or inner(x))
    passes.descend_together(weights, many, label, starts, index, value, 0.01, 0)
    assert len(calls) <= many.max() + 2


def test_pass_curve_over_folds(clicks):
    samples = modelling.positioned(modelling.in_blocks(clicks, ["id"], 2), ["id"])
    curve = {(r.param, r.fold): r[2:] for r in passes.pass_curve(samples, 0.01, [2, 5], 2, shard_rows=50).collect()}
    for fold in (1, 2):
        train = samples.filter(F.col("block") < fold)
        weights = passes.passes(train, 0.01, 5, 50)
        for n in (2, 5):
            one = np.zeros((1, 4), dtype=bool)
            one[0, :fold] = True
            other = np.zeros((1, 4), dtype=bool)
            other[0, fold] = True
            assert curve[(n, fold)] == pytest.approx([float(v[0]) for v in passes.losses(samples, weights[n - 1:n], [one, other])])
