"""Encoding: worked examples, unseen values, crosses, scaling."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickloom.operators import encode
from clickloom.plans import training


def arrays(df, column="features"):
    return [list(r[0]) for r in df.select(vector_to_array(column)).collect()]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(5, 20, 1), (8, 10, 4), (5, 30, 2), (8, 20, 7)], "a int, b int, c int")


def test_worked_one_hot_example(spark, small):
    model = encode.one_hot(small, ["a", "b", "c"])
    row = spark.createDataFrame([(8, 30, 2)], "a int, b int, c int")
    assert arrays(encode.apply_encoding(model, row)) == [[0, 1, 0, 0, 1, 0, 1, 0, 0]]


def test_unseen_values_give_a_zero_block_or_an_error(spark, small):
    row = spark.createDataFrame([(6, 20, None)], "a int, b int, c int")
    kept = encode.one_hot(small, ["a", "b", "c"], "keep")
    assert arrays(encode.apply_encoding(kept, row)) == [[0, 0, 0, 1, 0, 0, 0, 0, 0]]
    strict = encode.one_hot(small, ["a", "b", "c"], "error")
    assert arrays(encode.apply_encoding(strict, small))[0] == [1, 0, 0, 1, 0, 1, 0, 0, 0]
    with pytest.raises(Exception, match="Unseen label|NULL value"):
        encode.apply_encoding(strict, row).collect()


def test_dictionary_orders_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10, "x"), (9, "y"), (2, "x"), (None, "x")], "n int, t string")
    got = [(r.feature, r.value, r["index"], r.n) for r in encode.dictionary(df, ["n", "t"]).orderBy("index").collect()]
    assert got == [("n", "2", 0, 1), ("n", "9", 1, 1), ("n", "10", 2, 1), ("t", "x", 3, 3), ("t", "y", 4, 1)]


def test_dictionary_does_not_depend_on_scored_rows(spark, small):
    words = encode.dictionary(small, ["a", "b"])
    other = spark.createDataFrame([(5, 9), (6, 30)], "a int, b int")
    got = {(r.a, r.b): (r.a_index, r.b_index) for r in encode.encode_indices(other, words, ["a", "b"]).collect()}
    assert got == {(5, 9): (0, None), (6, 30): (None, 4)}
    with pytest.raises(Exception, match="unseen value of a"):
        encode.encode_indices(other, words, ["a"], unseen="error").collect()


def test_booleans_and_ratios(spark):
    df = spark.createDataFrame([(True, 0.25, 1), (False, 1.0, 0)], "flag boolean, hour_conversion_ratio double, label int")
    got = training.encode(df).train
    assert sorted(arrays(got)) == [[0, 1, 0.25, 0], [1, 0, 1.0, 0]]
    whole = training.encode(df, compat_int=True).train
    assert sorted(arrays(whole)) == [[0, 1, 1, 0], [1, 0, 0, 1]]


def test_worked_cross_example(spark):
    a = np.array([[1, 2], [0, 0], [4, 0]])
    b = np.array([[1, 2, 0], [0, 0, 3], [4, 0, 5]])
    names = ["a0", "a1", "b0", "b1", "b2"]
    rows = spark.createDataFrame([tuple(map(float, r)) for r in np.hstack([a, b])], names)
    rows = encode.concatenate(encode.concatenate(rows, names[:2], "a"), names[2:], "b")
    got = arrays(encode.cross_vectors(rows, "a", "b", "ab"), "ab")
    want = np.hstack([b * a[:, [i]] for i in range(2)])
    assert got == want.tolist()


def test_crosses_are_the_non_zero_products(spark, small):
    counted = encode.cross_counts(small, ["a"], ["b", "c"])
    got = {(r.left, r.left_value, r.right, r.right_value): r.n for r in counted.collect()}
    rows = [(r.a, r.b, r.c) for r in small.collect()]
    want = {}
    for a, b, c in rows:
        for name, value in (("b", b), ("c", c)):
            key = ("a", str(a), name, str(value))
            want[key] = want.get(key, 0) + 1
    assert got == want
    assert encode.cross_counts(small, ["a"], ["b"], min_rows=2).count() == 0
    three = encode.cross_counts_pairwise(small, ["a"], ["b"], ["c"])
    assert three.select("left", "right").distinct().count() == 3


def test_crossed_columns_encode(spark, small):
    rows, made = encode.add_crosses(small, ["a"], ["b"])
    model = encode.one_hot(rows, ["a", *made])
    assert arrays(encode.apply_encoding(model, rows))[0] == [1, 0, 1, 0, 0, 0]


def test_grouped_encoding_and_concatenation(small):
    models = encode.one_hot_groups(small, {"left": ["a"], "right": ["b", "c"]})
    rows = encode.apply_encoding(models["right"], encode.apply_encoding(models["left"], small))
    both = encode.concatenate(rows, ["left", "right"])
    assert arrays(both) == arrays(encode.apply_encoding(encode.one_hot(small, ["a", "b", "c"]), small))


def test_standard_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    got = sorted(tuple(r) for r in encode.standardise(df, ["x", "y"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_polynomial_terms(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "x double, y double")
    rows, terms = encode.polynomial(df, ["x", "y"], 2)
    assert terms == ["1", "x", "y", "x*x", "x*y", "y*y"]
    assert [rows.first()[t] for t in terms] == [1, 2, 3, 4, 6, 9]
    _, only = encode.polynomial(df, ["x", "y"], 2, interaction_only=True, constant=False)
    assert only == ["x", "y", "x*y"]


def test_selection(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 3))
    y = 3 * x[:, 1] + 0.5 * x[:, 2] + rng.normal(size=80) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    r = np.corrcoef(x[:, 1], y)[0, 1]
    got = {row.feature: row.f_score for row in encode.f_scores(df, ["a", "b", "c"], "y").collect()}
    assert got["b"] == pytest.approx(r ** 2 * 78 / (1 - r ** 2))
    assert encode.k_best(df, ["a", "b", "c"], "y", 2) == ["b", "c"]
    assert df.select(F.count("*")).first()[0] == 80


def test_encoded_rows_equal_the_fitted_encoding(spark):
    df = spark.createDataFrame([(1, 1, "x", 0.5), (2, 10, "y", 0.0), (3, 9, None, None), (4, None, "x", 2.0)],
                               "id int, a int, b string, r double")
    words = encode.dictionary(df, ["a", "b"])
    rows = encode.encode_rows(df, words, ["a", "b"], keep=["id"])
    fitted = encode.apply_encoding(encode.one_hot(df, ["a", "b"]), df)
    want = [[1, 0, 0, 1, 0], [0, 0, 1, 0, 1], [0, 1, 0, 0, 0], [0, 0, 0, 1, 0]]
    assert arrays(rows.orderBy("id")) == arrays(fitted.orderBy("id")) == want
    # features in another order than the dictionary; a missing number is 0 and marked
    other = encode.encode_rows(df, words, ["b", "a"], ["r"], ["id"])
    assert arrays(other.orderBy("id")) == [[*w, r, m] for w, r, m in zip(want, [0.5, 0, 0, 2], [0, 0, 1, 0])]
    other = spark.createDataFrame([(9, 7, "y", 1.0)], "id int, a int, b string, r double")
    assert arrays(encode.encode_rows(other, words, ["a", "b"], ["r"])) == [[0, 0, 0, 0, 1, 1.0, 0]]
    with pytest.raises(Exception, match="unseen value of a"):
        encode.encode_rows(other, words, ["a", "b"], unseen="error")


def test_one_large_feature_does_not_move_the_rows_for_small_ones(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    monkeypatch.setattr(encode, "HELD_BYTES", 1000)
    names = [f"s{i}" for i in range(10)]
    df = spark.range(2000).select(F.col("id").alias("big"), *[(F.col("id") % (i + 2)).alias(n) for i, n in enumerate(names)])
    words = encode.dictionary(df, ["big", *names])
    plan = encode.encode_indices(df, words, ["big", *names])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 10


def shuffles_of_rows(df, words, features):
    plan = encode.vector_parts(df, words, features, [], [], "keep", "features")._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Join")


@pytest.mark.parametrize("threshold,joins", [("-1", "SortMergeJoin"), ("100m", "BroadcastHashJoin")])
def test_the_plan_does_not_grow_with_the_features(spark, conf, threshold, joins):
    """One join with the whole dictionary and one aggregate by row: the rows are shuffled twice at most."""
    conf(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__adaptive__enabled="false")
    found = []
    for n in (20, 147):
        names = [f"f{i}" for i in range(n)]
        df = spark.range(50).select(*[(F.col("id") % (i + 2)).alias(name) for i, name in enumerate(names)])
        words = encode.dictionary(df, names)
        found.append(shuffles_of_rows(df, words, names))
        # the join's two sides (rows and dictionary) and the aggregate, or the aggregate alone
        assert found[-1] == ((3, 1) if threshold == "-1" else (1, 1))
    rows = encode.encode_rows(df, words, names)
    sums = np.array(arrays(rows)).sum(axis=0)
    counts = {r["index"]: r.n for r in words.collect()}
    assert sums.tolist() == [counts[i] for i in range(len(counts))]


def test_matrix_equals_a_long_form_twin(spark):
    draw = np.random.default_rng(4)
    rows = [(i, *[None if draw.random() < 0.2 else int(draw.integers(0, 5)) for _ in range(6)]) for i in range(80)]
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} int" for n in names)).repartition(5)
    words = encode.dictionary(df, names)
    at = {(r.feature, r.value): r["index"] for r in words.collect()}
    got = {r.id: r.features for r in encode.encode_rows(df, words, names, keep=["id"]).collect()}
    for r in rows:
        want = sorted(at[(n, str(v))] for n, v in zip(names, r[1:]) if v is not None)
        assert got[r[0]].indices.tolist() == want and got[r[0]].values.tolist() == [1.0] * len(want)


def test_crosses_of_different_values_stay_apart(spark):
    df = spark.createDataFrame([("a×b", "c"), ("a", "b×c"), ("a\\", "×c"), ("a\\×", "c")], "x string, y string")
    rows, (name,) = encode.add_crosses(df, ["x"], ["y"])
    assert rows.select(name).distinct().count() == 4


def test_a_saved_model_holds_a_bounded_number_of_values(spark, small, monkeypatch):
    monkeypatch.setattr(encode, "MOST_LABELS", 5)
    with pytest.raises(ValueError, match="use encode_rows"):
        encode.one_hot(small, ["a", "b", "c"])


def test_small_features_are_held_up_to_a_sum(spark, monkeypatch):
    monkeypatch.setattr(encode, "HELD_TOGETHER", 400)
    df = spark.range(8).select(F.col("id").alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") % 3).alias("c"))
    assert encode.small_features(encode.dictionary(df, ["a", "b", "c"])) == {"b", "c"}


def test_rows_of_one_file_are_unpivoted_in_many_tasks(spark, monkeypatch):
    """Wide rows are dealt to tasks of bounded values; what is kept comes with the first value, also where it is null or there is none."""
    monkeypatch.setattr(encode, "TASK_VALUES", 300)
    monkeypatch.setattr(encode, "WIDE", 2)
    seen, inner = [], type(spark.range(1)).repartition
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda self, n, *a: seen.append(n) or inner(self, n, *a))
    rows = spark.range(0, 400, 1, 1).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), F.col("id").alias("key"))
    words = encode.dictionary(rows, ["a", "b"])
    parts = encode.vector_parts(rows, words, ["a", "b"], ["key"], ["key"], "keep", "features")
    assert seen == [3] and parts.count() == 400
    first = {r.key: list(r.features.indices) for r in encode.encode_rows(rows, words, ["a", "b"], keep=["key"]).collect()}
    assert first == {i: ([] if i % 7 == 0 else [i % 7 - 1]) + [6 + i % 5] for i in range(400)}
    none = encode.encode_rows(rows, words.limit(0), [], ["b"], ["key"]).collect()
    assert sorted(r.key for r in none) == list(range(400))


def test_crossed_rows_are_dealt_to_tasks(spark, monkeypatch):
    """All crosses of a narrow table in one file are made in many tasks."""
    from clickloom import schemas

    monkeypatch.setattr(encode, "TASK_VALUES", 1000)
    features = [*schemas.AD_FEATURES, *schemas.CONTEXT_FEATURES, *schemas.USER_FEATURES]
    rows = spark.range(0, 50, 1, 1).select(*[(F.col("id") % (i + 2)).alias(f) for i, f in enumerate(features)], F.col("id").alias("label"))
    seen, inner = [], training.dictionary
    monkeypatch.setattr(training, "dictionary", lambda df, columns: seen.append((df, columns)) or inner(df, columns))
    encoded = training.linear_terms(rows, crosses=True, keep=["label"])[1]
    (df, columns), = seen
    assert df.rdd.getNumPartitions() == -(-50 * len(columns) // 1000) > 1
    assert {len(r.features.indices) for r in encoded.collect()} == {len(columns)}


def test_entries_of_ones_are_those_of_the_general_way(spark):
    """Rows of ones only are written without a function for each entry; every other row as before."""
    from pyspark.ml.linalg import SparseVector

    from clickloom.workload.registry import encoded_rows

    vectors = [SparseVector(9, at, values) for at, values in (
        ([1, 4], [1.0, 1.0]), ([1, 4], [1.0, 0.25]), ([], []), ([3], [1.0]), ([0, 2, 8], [0.0, 1.0, -2.0]))]
    found = encoded_rows(spark.createDataFrame([(v,) for v in vectors * 2], ["v"]), "v")
    assert {(r.entries, r.n) for r in found.collect()} == {(e, 2) for e in (
        "1:1000000 4:1000000", "1:1000000 4:250000", "", "3:1000000", "0:0 2:1000000 8:-2000000")}
    assert "array_min" in found._jdf.queryExecution().optimizedPlan().toString()
