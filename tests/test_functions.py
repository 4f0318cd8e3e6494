"""Column functions on hand-made rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import calendar as cal
from clickloom.functions import codes, errors
from clickloom.functions import packed_time as pt


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_packed_time(spark):
    assert column(spark, [172359, 10005, 300000], "int", pt.hour_of) == [23, 0, 0]
    assert column(spark, [172359, 10005, 300000], "int", pt.day_of) == [17, 1, 30]


def test_delay_crosses_day_and_hour(spark):
    df = spark.createDataFrame([(172359, 180005), (100110, 100210), (100110, None)], "a int, b int")
    true = [r[0] for r in df.select(pt.delay_minutes(F.col("a"), F.col("b"))).collect()]
    assert true == [6, 60, None]
    coded = [r[0] for r in df.select(pt.delay_minutes_compat(F.col("a"), F.col("b"))).collect()]
    gap = np.array([180005 - 172359, 100])
    by_hand = np.floor(gap / 10000) * 1440 + np.floor(gap / 100 % 100) * 24 + np.floor(gap % 100)
    assert coded == [*by_hand, None]


def test_right_closed_bins(spark):
    values = [0.0, 1.0, 28.0, 29.0, 44.0, 120.0, 121.0, None]
    got = column(spark, values, "double", lambda v: codes.cut(v, [1, 28, 44, 120]))
    assert got == [None, 0, 0, 1, 1, 2, None, None]


def test_left_closed_bins(spark):
    values = [0.0, 1.0, 3.5, 83.0, 84.0, 90.0, -1.0, None]
    got = column(spark, values, "double", lambda v: codes.cut(v, schemas.AGE_EDGES, right=False))
    assert got == [0, 1, 1, 7, None, None, None, None]


@pytest.mark.parametrize("right", [True, False])
@pytest.mark.parametrize("edges", [schemas.USER_ACTIVITY_EDGES, schemas.AGE_EDGES, schemas.CONVERSION_DELAY_EDGES])
def test_bins_agree_with_pandas(spark, edges, right):
    rng = np.random.default_rng(3)
    values = [*map(float, edges), *rng.uniform(edges[0] - 5, edges[-1] + 5, 200)]
    want = pd.cut(pd.Series(values), edges, right=right, include_lowest=True, labels=False)
    got = column(spark, [float(v) for v in values], "double", lambda v: codes.cut(v, edges, right=right))
    assert [None if np.isnan(w) else int(w) for w in want] == got


def test_cut_refuses_unordered_edges():
    with pytest.raises(ValueError):
        codes.cut(None, [1, 1, 2])


def test_log_spaced_edges():
    assert codes.log_spaced(0, 7, 8) == [10.0 ** i for i in range(8)]
    assert codes.log_spaced(0, 3, 6, ceil=True) == [1, 4, 16, 64, 252, 1000]


def test_pair_number_example(spark):
    df = spark.createDataFrame(list(zip([9, 7, 5, 3, 1], [2, 4, 6, 8, 10])), "a int, b int")
    assert [r[0] for r in df.select(codes.pair_number(F.col("a"), F.col("b"))).collect()] == [92, 60, 41, 67, 101]


@settings(max_examples=5, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2 ** 31 - 2), st.integers(0, 2 ** 31 - 2)), min_size=2, max_size=60))
def test_pair_number_is_injective(spark, pairs):
    df = spark.createDataFrame(list(pairs), "a long, b long")
    assert df.select(codes.pair_number(F.col("a"), F.col("b"))).distinct().count() == len(pairs)


def test_region_and_category(spark):
    assert column(spark, [1305, 99, 0], "int", codes.province) == [13, 0, 0]
    assert column(spark, [210, 0], "int", codes.category_level1) == [2, 0]
    assert column(spark, [210, 0], "int", codes.category_level2) == [10, 0]


def test_equal_codes_with_unknown_and_null(spark):
    df = spark.createDataFrame([(0, 0), (1, None), (None, None), (2, 2), (2, 3)], "a int, b int")
    got = [r[0] for r in df.select(codes.same_known_or_unknown(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, True, False]


def test_calendar(spark):
    when = dt.datetime(2016, 10, 17, 9, 59, 59, 500000)  # a Monday
    df = spark.createDataFrame([(when,)], "v timestamp_ntz")
    row = df.select(cal.bin_start(F.col("v"), 1200).alias("bin"), cal.slot_of_day(F.col("v")).alias("slot"),
                    cal.monday_first(F.col("v")).alias("day"), cal.epoch(F.col("v")).alias("epoch"),
                    cal.plus_seconds(F.col("v"), F.lit(6000)).alias("later"),
                    cal.hour_in(F.col("v"), (8, 10), (17, 19)).alias("rush"),
                    cal.in_days(F.col("v"), "2016-10-16", "2016-10-17").alias("days")).first()
    assert row.bin == dt.datetime(2016, 10, 17, 9, 40)
    assert (row.slot, row.day, row.rush, row.days) == (29, 0, True, True)
    assert row.epoch == int((when - dt.datetime(1970, 1, 1)).total_seconds())
    assert row.later == when + dt.timedelta(minutes=100)


def test_time_zone_does_not_matter(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Shanghai")
    df = spark.createDataFrame([("2016-07-19 00:07:00",)], "t string").select(cal.parse(F.col("t")).alias("v"))
    row = df.select(cal.bin_start(F.col("v"), 1200).cast("string").alias("b"),
                    cal.at_hour(F.to_date("v"), F.lit(5)).cast("string").alias("h")).first()
    assert (row.b, row.h) == ("2016-07-19 00:00:00", "2016-07-19 05:00:00")


def test_error_terms(spark):
    df = spark.createDataFrame([(1, 0.25), (0, 0.25), (1, 0.0), (0, 1.0)], "y int, p double")
    got = [r[0] for r in df.select(errors.log_loss_term(F.col("y"), F.col("p"))).collect()]
    assert got[:2] == pytest.approx([-np.log(0.25), -np.log(0.75)])
    assert all(np.isfinite(got)) and min(got[2:]) > 30
    df = spark.createDataFrame([(2.0, 1.0), (0.0, 1.0), (-4.0, 1.0)], "y double, f double")
    assert [r[0] for r in df.select(errors.ape(F.col("y"), F.col("f"))).collect()] == [0.5, None, 1.25]
