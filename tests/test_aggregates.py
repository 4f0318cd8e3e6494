"""Aggregations, sets and joins on hand-made rows: nulls, ties, empty groups."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import aggregates as agg
from clickloom.operators import joins, rows, sets


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_value_counts_with_and_without_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert rows_of(agg.value_counts(df, "k")) == [(1, 2), (2, 1)]
    assert rows_of(agg.value_counts(df, "k", keep_null=True)) == [(None, 1), (1, 2), (2, 1)]
    assert rows_of(agg.count_of_counts(df, "k")) == [(1, 1), (2, 1)]


def test_ratio_without_positives_is_null(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)], "k int, label int")
    assert rows_of(agg.conversion_ratio(df, "k")) == [(1, 2, 1, 0.5), (2, 1, None, None), (3, 1, 1, 1.0)]
    assert rows_of(agg.normalised_ratio(df, "k", "r")) == [(1, 0.0), (2, None), (3, 1.0)]


def test_equal_ratios_scale_to_null(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "k int, label int")
    assert rows_of(agg.normalised_ratio(df, "k", "r")) == [(1, None), (2, None)]


def test_scaling_uses_the_fitted_bounds(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    other = spark.createDataFrame([(5.0,), (20.0,)], "x double")
    assert rows_of(agg.scale_min_max(other, "x", train)) == [(0.5,), (2.0,)]


def test_top_category_ties_and_unknown(spark):
    df = spark.createDataFrame(
        [("a", 2)] * 5 + [("a", 1)] * 5 + [("a", 0)] * 9 + [("b", 0)] * 3 + [("c", 7), ("c", None)], "userID string, appCategory int")
    assert rows_of(agg.top_category(df)) == [("a", 1), ("c", 7)]


def test_click_profile_bins(spark):
    df = spark.createDataFrame([(1, 1)] + [(2, 0)] * 28 + [(3, 0)] * 29 + [(4, 0)] * 121, "userID int, label int")
    got = {r.userID: (r.click_count, r.conversion_count, r.click_count_group, r.conversion_ratio_click)
           for r in agg.click_profile(df).collect()}
    assert got == {1: (1, 1, 0, 1.0), 2: (28, 0, 0, 0.0), 3: (29, 0, 1, 0.0), 4: (121, 0, None, 0.0)}


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(5).normal(size=500).round(3)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    want, _ = np.histogram(values, bins=20)
    assert [n for _, n in rows_of(agg.histogram(df, "x"), "bin")] == list(want)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    got = dict(rows_of(agg.histogram(df, "x"), "bin"))
    assert got[10] == 4 and sum(got.values()) == 4 and len(got) == 20


def test_describe_and_sizes(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (3, None)], "a int, b double")
    got = {r["column"]: r for r in agg.describe(df, "a", "b").collect()}
    assert (got["b"].n, got["b"].min, got["b"].max, got["b"]["mean"]) == (2, 2.0, 4.0, 3.0)
    assert got["b"]["std"] == pytest.approx(math.sqrt(2))
    assert rows_of(agg.sizes(df, "a", "b")) == [(3, 2, 2)]
    assert rows_of(agg.sizes(df, "a", approximate=True)) == [(3, 2)]


def test_class_balance_and_single_clicks(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (4, 0), (5, 0)], "userID int, label int")
    assert rows_of(agg.class_balance(df)) == [(2, 4, 2)]
    assert rows_of(agg.single_click_users(df)) == [(4, 1)]


def test_top_values_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 1, 1, 9]], "v int")
    assert [tuple(r) for r in agg.top_values(df, "v", 2).collect()] == [(1, 2), (5, 2)]


def test_fold_summary_is_population_deviation(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 3.0)], "param double, loss double")
    assert rows_of(agg.fold_summary(df, "param", "loss")) == [(0.1, 2.0, 1.0)]


def test_flag_and_anti_join(spark):
    clicks = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (2, 2)], "userID int, appID int")
    installed = spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "userID int, appID int")
    flagged = joins.flag_members(clicks, installed, ["userID", "appID"], "hit")
    assert rows_of(flagged) == [(None, 1, False), (1, 1, False), (1, 2, True), (2, 2, False)]
    assert joins.non_members(clicks, installed, ["userID", "appID"]).count() == 3


def test_semi_join_of_two_independent_sets(spark):
    df = spark.createDataFrame([(1, 1), (1, 9), (2, 1), (9, 1)], "u int, a int")
    users = spark.createDataFrame([(1,), (2,), (2,)], "u int")
    apps = spark.createDataFrame([(1,), (5,)], "a int")
    assert rows_of(joins.members_of_both(df, users, apps, "u", "a")) == [(1, 1), (2, 1)]


def test_lookup_keeps_the_row_count(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "x")], "k int, v string")
    assert joins.lookup(left, right, "k").count() == 4


def test_aligned_is_null_where_a_side_is_missing(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, value double")
    b = spark.createDataFrame([(2, 6.0), (3, 1.0)], "k int, value double")
    assert rows_of(joins.aligned(a, b, "k", lambda x, y: F.try_divide(x, y))) == [(1, None), (2, 0.5), (3, None)]


def test_set_operators(spark):
    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "k int")

    a, b, c = keys(1, 2, 3, 3), keys(3, 4), keys(1, 3, 4, 5)
    assert rows_of(sets.union_keys(a, b)) == [(1,), (2,), (3,), (4,)]
    assert rows_of(sets.common_keys(a, b)) == [(3,)]
    assert rows_of(sets.only_in_first(a, b)) == [(1,), (2,)]
    assert rows_of(sets.containment({"b in c": (b, c), "a in c": (a, c)})) == [("a in c", 1, False), ("b in c", 0, True)]
    assert rows_of(sets.venn({"a": a, "b": b, "c": c})) == [
        (False, False, True, 1), (False, True, True, 1), (True, False, False, 1), (True, False, True, 1), (True, True, True, 1)]


def test_checked_append(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y")], "k int, v string")
    assert sets.append_checked("k", a, b).count() == 2
    with pytest.raises(Exception, match="duplicate values of k"):
        sets.append_checked("k", a, a).collect()


def test_row_operators(spark):
    df = spark.createDataFrame([(250000, 0), (260000, 0), (260000, 1), (None, 0)], "clickTime int, label int")
    assert rows.settled_clicks(df).count() == 2
    assert rows.move_last(df, "clickTime").columns == ["label", "clickTime"]
    assert rows_of(rows.replace_where(df, "label", F.col("clickTime") > 255000, 9)) == [
        (None, 0), (250000, 0), (260000, 9), (260000, 9)]
    filled = rows.fill_with_truncated_mean(df.select("clickTime"), "clickTime")
    assert filled.filter("clickTime = 256666").count() == 1
    with pytest.raises(ValueError):
        rows.choose_samples(df, "clickTime", "other")
