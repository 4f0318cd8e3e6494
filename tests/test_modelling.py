"""Splits, folds, searches and quality bounds."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.operators import modelling as m
from clickloom.operators.encode import concatenate


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1])))
    y = (rng.random(300) < p).astype(int)
    rows = [(i, int(t), Vectors.dense(v)) for i, (t, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, ["id", "label", "features"])


@pytest.fixture(scope="module")
def samples(rows):
    return m.positioned(rows, ["id"])


@pytest.mark.parametrize("n, folds", [(10, 3), (103, 5), (60, 5), (11, 10)])
def test_expanding_folds(spark, n, folds):
    df = spark.range(n).select((F.lit(n) - F.col("id")).alias("t"))
    got = sorted((r.t, r.block) for r in m.expanding_folds(df, ["t"], folds).collect())
    size = n // (folds + 1)
    first = n - folds * size
    assert [b for _, b in got] == [0] * first + [i for i in range(1, folds + 1) for _ in range(size)]


def test_too_few_rows_for_the_folds():
    with pytest.raises(ValueError):
        m.fold_starts(3, 5)


def test_ordered_split_is_by_position(spark):
    df = spark.range(11).select((F.col("id") % 3).alias("t"), "id")
    split = m.ordered_split(df, ["t", "id"], 0.8).orderBy("t", "id").collect()
    assert [r.is_train for r in split] == [True] * 8 + [False] * 3


def test_search_beats_the_base_rate_and_repeats(rows):
    samples = m.in_blocks(rows, ["id"], 3)
    model, best, ranking = m.grid_search(samples, lambda a: m.logistic(a, 50), [0.001, 1.0], 3)
    again = m.grid_search(samples, lambda a: m.logistic(a, 50), [0.001, 1.0], 3)[2]
    assert sorted(map(tuple, ranking.collect())) == sorted(map(tuple, again.collect()))
    assert best == 0.001
    assert [r.rank_val_loss for r in ranking.orderBy("param").collect()] == [1, 2]
    loss = m.mean_log_loss(m.score(model, samples)).first().log_loss
    rate = samples.agg(F.avg("label")).first()[0]
    assert loss < 0.8 * -(rate * np.log(rate) + (1 - rate) * np.log(1 - rate))


def test_learning_curve_uses_prefixes(samples):
    curve = m.learning_curve(samples, lambda: m.logistic(0.001, 20), [100, 300], 2).collect()
    assert sorted((r.param, r.fold) for r in curve) == [(100.0, 1), (100.0, 2), (300.0, 1), (300.0, 2)]
    assert all(0 < r.train_loss < 1.5 and 0 < r.valid_loss < 1.5 for r in curve)


def test_regressors_learn(samples):
    rows = samples.withColumn("label", F.col("position") * 2.0 + 1)
    data = concatenate(rows.select("label", "position"), ["position"])
    for estimator in (m.linear(), m.linear(0.01, 1.0), m.boosted_trees(trees=10, subsample=1.0), m.random_forest(5)):
        model = estimator.fit(data)
        assert m.mape(model.transform(data), "label", "prediction").first().mape < 2.0
    fitted = m.least_squares(rows.withColumn("x", F.col("position").cast("double")), "x", "label").first()
    assert (fitted.slope, fitted.intercept) == (pytest.approx(2), pytest.approx(1))


def test_targets_are_independent(spark):
    df = concatenate(spark.range(50).select("id", (F.col("id") * 2.0).alias("a"), (F.col("id") * -1.0).alias("b")), ["id"])
    models = m.fit_targets(df, m.linear, ["a", "b"])
    row = m.predict_targets(models, df).filter("id = 10").first()
    assert (row.pred_a, row.pred_b) == (pytest.approx(20), pytest.approx(-10))
    assert m.mape_of_targets(m.predict_targets(models, df).filter("id > 0"), ["a", "b"], ["pred_a", "pred_b"]).first().mape < 1e-6


def test_installed_pairs_get_zero(spark):
    scored = spark.createDataFrame([(1, 1, 1, 0.5), (2, 1, 2, 0.5)], "instanceID int, userID int, appID int, prob double")
    pairs = spark.createDataFrame([(1, 2)], "userID int, appID int")
    got = {r.instanceID: r.prob for r in m.zero_installed(scored, pairs).collect()}
    assert got == {1: 0.5, 2: 0.0}


@pytest.mark.parametrize("n, folds", [(10, 3), (12, 4), (7, 7)])
def test_contiguous_folds(n, folds):
    want = [list(part) for part in np.array_split(np.arange(n), folds)]
    starts = m.kfold_starts(n, folds)
    assert [list(range(a, b)) for a, b in zip(starts, [*starts[1:], n])] == want


class _Seen:
    """Estimator that records the positions it was fitted on."""

    def __init__(self, log):
        self.log = log

    def fit(self, df):
        self.log.append(sorted(r.position for r in df.select("position").collect()))
        return self

    def transform(self, df):
        return df.withColumn("loss", F.col("position").cast("double"))


def test_curves_train_outside_the_fold(spark):
    rows = spark.range(10).select(F.col("id").alias("position"))
    log = []

    def run(curve, *args, **kwargs):
        log.clear()
        return curve(*args, measure=lambda: F.col("loss"), parallel=1, **kwargs)

    blocked = m.in_blocks(rows, ["position"], 2, "blocked")
    curve = run(m.validation_curve, blocked, lambda _: _Seen(log), [0.0], 2, scheme="blocked")
    assert log == [[5, 6, 7, 8, 9], [0, 1, 2, 3, 4]]
    assert sorted((r.fold, r.train_loss, r.valid_loss) for r in curve.collect()) == [(1, 7.0, 2.0), (2, 2.0, 7.0)]
    run(m.validation_curve, m.in_blocks(rows, ["position"], 3), lambda _: _Seen(log), [0.0], 3)
    assert log == [[0, 1, 2, 3], [0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5, 6, 7]]
    run(m.learning_curve, rows, lambda: _Seen(log), [2, 4], 2, scheme="blocked")
    assert log == [[5, 6], [0, 1], [5, 6, 7, 8], [0, 1, 2, 3]]
    run(m.learning_curve, rows, lambda: _Seen(log), [6], 2)
    assert log == [[0, 1], [0, 1, 2, 3]]
    with pytest.raises(ValueError):
        m.in_blocks(rows, ["position"], 2, "other")


def test_hold_out_is_not_trained_on(spark):
    rows = spark.range(10).select(F.col("id").alias("position"))
    samples = m.in_blocks(rows, ["position"], 3, share=0.8)
    got = {r.position: r.block for r in samples.collect()}
    assert [got[i] for i in range(10)] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    log = []
    m.grid_search(samples, lambda _: _Seen(log), [1.0], 3, lambda: F.col("loss"), parallel=1)
    assert log[-1] == list(range(8))


def test_six_target_measure(spark):
    df = spark.createDataFrame([(2.0, 1.0, 0.0, 5.0)], "a double, pred_a double, b double, pred_b double")
    assert df.select(m.mape_of_targets_measure(["a", "b"])).first()[0] == 0.5


@pytest.mark.parametrize("make", [lambda: m.boosted_trees(trees=2), lambda: m.random_forest(trees=2, depth=2)])
def test_tree_fits_hold_bounded_rows_a_task(spark, monkeypatch, make):
    """A table in one file is fitted in tasks of bounded rows; a small one is left as it is."""
    monkeypatch.setattr(m, "FIT_ROWS", 100)
    seen, inner = [], type(make()).__mro__[1]._fit
    monkeypatch.setattr(type(make()).__mro__[1], "_fit", lambda self, df: seen.append(df) or inner(self, df))
    for n in (1000, 100):
        rows = spark.range(0, n, 1, 1).select("id", F.col("id").cast("double").alias("label"), (F.col("id") % 9).cast("double").alias("x"))
        model = make().fit(concatenate(rows, ["x"]))
        assert model.transform(concatenate(rows, ["x"])).count() == n
    sizes = [seen[0].groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0], seen[1].rdd.getNumPartitions()]
    assert sizes[0] <= 110 and sizes[1] == 1
