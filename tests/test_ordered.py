"""Ordered operators against brute force, with hot keys and ties."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.operators import ordered, series

START = dt.datetime(2024, 1, 1)


def events(spark, seed=1, n=600):
    """Random rows; a third of them belong to key 0."""
    rng = np.random.default_rng(seed)
    seconds = rng.choice(10 * 86400, size=n, replace=False)
    keys = np.where(rng.random(n) < 0.33, 0, rng.integers(1, 9, n))
    values = [None if rng.random() < 0.6 else float(v) for v in rng.integers(0, 100, n)]
    pdf = pd.DataFrame({"id": range(n), "k": keys, "ts": [START + dt.timedelta(seconds=int(s)) for s in seconds], "v": values})
    rows = [(int(r.id), int(r.k), r.ts.to_pydatetime(), None if pd.isna(r.v) else r.v) for r in pdf.itertuples()]
    return spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz, v double"), pdf


def values(df, column="v"):
    return {r.id: r[column] for r in df.collect()}


def expected(series_):
    return {i: (None if pd.isna(v) else v) for i, v in series_.items()}


@pytest.mark.parametrize("chunk", [1, 3600, 86400, None])
def test_carry_forward_any_chunk(spark, chunk):
    df, pdf = events(spark)
    want = pdf.sort_values("ts").groupby("k")["v"].ffill()
    assert values(ordered.carry_forward(df, ["k"], "ts", ["v"], chunk)) == expected(want)


@pytest.mark.parametrize("chunk", [600, 86400, None])
def test_carry_backward(spark, chunk):
    df, pdf = events(spark, 2)
    want = pdf.sort_values("ts").groupby("k")["v"].bfill()
    assert values(ordered.carry_backward(df, ["k"], "ts", ["v"], chunk)) == expected(want)


def test_carry_without_key(spark):
    df, pdf = events(spark, 3, 200)
    want = pdf.sort_values("ts")["v"].ffill()
    assert values(ordered.carry_forward(df, [], "ts", ["v"], 7200)) == expected(want)


def test_chunk_is_picked_by_the_hottest_key(spark):
    df, _ = events(spark)
    assert ordered.pick_chunk(df, ["k"], "ts", limit=10_000) == 30 * 86400
    assert ordered.pick_chunk(df, ["k"], "ts", limit=40) == 86400
    assert ordered.pick_chunk(df, ["k"], "ts", limit=1) in (60, 1)


@pytest.mark.parametrize("chunk, small", [(3600, 0), (None, 0), (None, ordered.SMALL_RIGHT)])
def test_as_of_matches_pandas(spark, chunk, small):
    left, lp = events(spark, 4)
    right, rp = events(spark, 5, 150)
    right = right.select("k", "ts", F.col("id").alias("rid"))
    rp = rp.rename(columns={"id": "rid"})[["k", "ts", "rid"]]
    want = pd.merge_asof(lp.sort_values("ts"), rp.sort_values("ts"), on="ts", by="k").set_index("id")["rid"]
    got = ordered.as_of(left, right, "ts", ["rid"], ["k"], chunk, small)
    assert values(got, "rid") == expected(want)


@pytest.mark.parametrize("small", [0, ordered.SMALL_RIGHT])
def test_as_of_includes_the_same_time_and_repeats_for_ties(spark, small):
    t = [START + dt.timedelta(hours=h) for h in range(4)]
    left = spark.createDataFrame([(0, t[0]), (1, t[1]), (2, t[1]), (3, t[3])], "id int, ts timestamp_ntz")
    right = spark.createDataFrame([(t[1], "a"), (t[2], None)], "ts timestamp_ntz, w string")
    # the later report has no value: the last report counts, not the last known value
    assert values(ordered.as_of(left, right, "ts", ["w"], small=small), "w") == {0: None, 1: "a", 2: "a", 3: None}
    assert set(values(ordered.as_of(left, right.limit(0), "ts", ["w"], small=small), "w").values()) == {None}


def test_as_of_against_a_small_side_does_not_move_the_left(spark):
    left, _ = events(spark, 4)
    right, _ = events(spark, 5, 150)
    got = ordered.as_of(left, right.select("k", "ts", F.col("id").alias("rid")), "ts", ["rid"], ["k"])
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("small", [0, ordered.SMALL_RIGHT])
def test_as_of_refuses_repeated_right_rows_at_every_size(spark, small):
    left, _ = events(spark, 4)
    right, _ = events(spark, 5, 150)
    once = right.select("k", "ts", F.col("id").alias("rid"))
    with pytest.raises(ValueError, match="repeat"):
        ordered.as_of(left, once.union(once), "ts", ["rid"], ["k"], small=small)
    # null keys and times are found by no row, so they may repeat
    none = spark.createDataFrame([(None, START, 1), (None, START, 2), (1, None, 3), (1, None, 4)], once.schema)
    got = ordered.as_of(left, once.union(none), "ts", ["rid"], ["k"], small=small)
    assert values(got, "rid") == values(ordered.as_of(left, once, "ts", ["rid"], ["k"], small=small), "rid")


def test_as_of_with_a_crowded_bucket_takes_the_general_way(spark):
    """All right rows but one lie within two minutes of a long time."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    right = spark.range(121).select((start + F.make_dt_interval(secs=F.when(F.col("id") == 0, 9_000_000).otherwise(F.col("id"))
                                     .cast("decimal(18,6)"))).alias("ts"), F.col("id").alias("rid"))
    left = spark.range(200).select("id", (start + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ts"))
    got = values(ordered.as_of(left, right, "ts", ["rid"]), "rid")
    assert got == {i: None if i == 0 else min(i, 120) for i in range(200)}


def test_row_index_and_positions(spark):
    df, pdf = events(spark, 6)
    want = {int(i): n for n, i in enumerate(pdf.sort_values(["k", "ts"])["id"])}
    got = {r.id: r.row_index for r in ordered.with_row_index(df, ["k", "ts"]).collect()}
    assert got == want
    first = ordered.first_rows(df, ["k", "ts"], 37)
    assert {r.id for r in first.collect()} == {i for i, n in want.items() if n < 37}
    nth = ordered.every_nth(df, ["k", "ts"], 7)
    assert {r.id for r in nth.collect()} == {i for i, n in want.items() if n % 7 == 0}


def test_row_index_spreads_one_leading_value(spark):
    df = spark.range(0, 4000, numPartitions=4).select(F.lit(1).alias("k"), F.col("id"))
    got = ordered.with_row_index(df, ["k", "id"])
    assert got.filter("row_index <> id").count() == 0


def test_a_tie_where_a_block_begins_is_an_error(spark):
    df = spark.range(10).select((F.col("id") >= 3).cast("int").alias("t"))
    with pytest.raises(ValueError):
        ordered.tag_blocks(df, ["t"], lambda n: [5], "b")
    assert ordered.tag_blocks(df, ["t"], lambda n: [3], "b").filter("b = 1").count() == 7


def test_blocks(spark):
    df, pdf = events(spark, 7, 103)
    order = {int(i): n for n, i in enumerate(pdf.sort_values(["ts"])["id"])}
    got = {r.id: r.b for r in ordered.tag_blocks(df, ["ts"], lambda n: [10, 50], "b").collect()}
    assert got == {i: (0 if n < 10 else 1 if n < 50 else 2) for i, n in order.items()}


def test_imputation_matches_the_ordered_form(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"userID": rng.integers(0, 120, 600), "telecomsOperator": rng.integers(0, 4, 600)})
    df = spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), "userID int, telecomsOperator int")
    distinct = pdf.groupby("userID")["telecomsOperator"].nunique()
    has_gap = pdf[pdf.telecomsOperator == 0].userID.unique()
    chosen = pdf.userID.isin(set(distinct[distinct == 2].index) & set(has_gap))
    work = pdf.assign(telecomsOperator=pdf.telecomsOperator.replace(0, np.nan)).sort_values(
        ["userID", "telecomsOperator"])
    filled = work.loc[chosen.loc[work.index], "telecomsOperator"].ffill()
    work.loc[filled.index, "telecomsOperator"] = filled
    want = work.fillna(0).astype(int).groupby(["userID", "telecomsOperator"]).size().to_dict()
    got = {(r.userID, r.telecomsOperator): r["count"] for r in
           ordered.impute_operator(df).groupBy("userID", "telecomsOperator").count().collect()}
    assert got == want


def regular(spark, values_, key="a"):
    rows = [(key, START + dt.timedelta(minutes=20 * i), v) for i, v in enumerate(values_)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")


def in_order(df, column):
    return [r[column] for r in df.orderBy("ts").collect()]


def test_rolling_mean(spark):
    df = ordered.rolling_mean(regular(spark, [1.0, 2.0, 3.0, 4.0]), ["k"], "ts", "value")
    assert in_order(df, "rolling_mean") == [None, None, 2.0, 3.0]


def test_outliers_become_the_last_value(spark):
    values_ = [1.0, 2.0, 1.5] * 10 + [500.0, 2.0]
    got = in_order(ordered.clean_series(regular(spark, values_), ["k"], "ts", "value"), "value")
    assert got == [*values_[:30], 1.5, 2.0]
    raw = ordered.drop_outliers(regular(spark, values_), "value", ["k"])
    assert raw.filter("value IS NULL").count() == 1
    assert ordered.drop_outliers(regular(spark, values_), "value").filter("value IS NULL").count() == 1


@pytest.mark.parametrize("period", [6, 7])
def test_decomposition_matches_numpy(spark, period):
    rng = np.random.default_rng(9)
    x = rng.normal(size=50) + np.arange(50) * 0.1 + np.sin(np.arange(50) * 2 * np.pi / period)
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period if period % 2 == 0 else np.ones(period) / period
    half = len(weights) // 2
    trend = np.full(50, np.nan)
    trend[half:50 - half] = np.convolve(x, weights, "valid")
    phase = np.array([np.nanmean((x - trend)[i::period]) for i in range(period)])
    seasonal = np.resize(phase - phase.mean(), 50)
    residual = x - trend - seasonal
    level = seasonal + np.nanmean(trend) + np.nanmean(residual)
    got = ordered.decompose(regular(spark, [float(v) for v in x]), ["k"], "ts", "value", 1200, period)
    for name, want in {"trend": trend, "seasonal": seasonal, "residual": residual, "seasonal_level": level}.items():
        have = [np.nan if v is None else v for v in in_order(got, name)]
        np.testing.assert_allclose(have, want, atol=1e-9)


def test_resample_matches_pandas(spark):
    rng = np.random.default_rng(10)
    times = sorted(START + dt.timedelta(seconds=int(s)) for s in rng.choice(86400, 60, replace=False))
    pdf = pd.Series(rng.normal(size=60), index=pd.DatetimeIndex(times))
    pdf.iloc[5] = np.nan
    want = pdf.resample("20min").mean().ffill()
    rows = [("a", t.to_pydatetime(), None if np.isnan(v) else float(v)) for t, v in pdf.items()]
    got = series.resample(spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double"), ["k"])
    assert [t for t in in_order(got, "ts")] == [t.to_pydatetime() for t in want.index]
    np.testing.assert_allclose(in_order(got, "value"), want.values)


def test_resample_with_null_first_and_last_bins(spark):
    rows = [("a", START, None), ("a", START + dt.timedelta(minutes=40), 5.0), ("a", START + dt.timedelta(minutes=100), None)]
    got = series.resample(spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double"), ["k"])
    assert in_order(got, "value") == [None, None, 5.0, 5.0, 5.0, 5.0]


def test_grid_and_head(spark):
    short = regular(spark, [1.0, 2.0]).withColumn("ts", F.col("ts") + F.expr("INTERVAL '1' HOUR"))
    laid = series.on_grid(short, ["k"], "2024-01-01 00:00:00", "2024-01-01 02:00:00", fill="backward")
    assert in_order(laid, "value") == [1.0, 1.0, 1.0, 1.0, 2.0, None, None]
    assert in_order(series.on_grid(short, ["k"], "2024-01-01 00:40:00", "2024-01-01 01:40:00"), "value") == [
        None, 1.0, 2.0, None]
    assert in_order(series.with_head(short, ["k"], "2024-01-01 00:00:00"), "value") == [1.0, 1.0, 2.0]


def test_previous_block_matches_a_row_loop(spark):
    x = [float(i) for i in range(30)]
    df = series.with_previous_block(regular(spark, x), ["k"])
    for row in df.collect():
        now = (row.ts - START).seconds // 60
        first = now - (now % 120 + 120)
        want = [x[(first + 20 * i) // 20] if first >= 0 else None for i in range(6)]
        assert [row[f"prev_tt_{i}"] for i in range(6)] == want


def test_first_block_is_seeded_from_the_season(spark):
    x = [float(i) for i in range(48)]
    df = regular(spark, x)
    seeded = series.with_previous_block(df, ["k"], df, period=24)
    first = seeded.orderBy("ts").first()
    # the block before the first, one period (24 slots) later
    assert [first[f"prev_tt_{i}"] for i in range(6)] == x[18:24]


def test_twelve_slots_and_unpivot(spark):
    x = [float(i) for i in range(18)]
    wide = series.twelve_slots(regular(spark, x), ["k"]).orderBy("ts").collect()
    assert len(wide) == 2
    assert [wide[0][f"prev_tt_{i}"] for i in range(6)] + [wide[0][f"tt_{i}"] for i in range(6)] == x[:12]
    assert wide[1].ts == START + dt.timedelta(hours=2)
    long = series.unpivot_targets(series.twelve_slots(regular(spark, x), ["k"]), ["k"], [f"tt_{i}" for i in range(6)], 7200)
    assert in_order(long, "prediction") == x[6:18]
    assert in_order(long, "ts")[0] == START + dt.timedelta(hours=2)


def test_shifted_cycle(spark):
    x = [float(i) for i in range(72 * 3)]
    moved = ordered.shift_cycle(regular(spark, x), "ts", "2024-01-02", "2024-01-02", 7)
    assert in_order(moved, "value") == x[72:144]
    assert in_order(moved, "ts")[0] == START + dt.timedelta(days=8)


@pytest.mark.parametrize("start, end", [("2024-01-01 00:00:00", "2024-01-01 12:00:00"),
                                        ("2024-01-01 04:00:00", "2024-01-01 06:00:00"),
                                        ("2023-12-31 20:00:00", "2024-01-01 05:00:00")])
def test_resampling_onto_a_grid_equals_the_join_form(spark, start, end):
    rng = np.random.default_rng(11)
    rows = [(k, START + dt.timedelta(seconds=int(s)), None if rng.random() < 0.3 else float(s))
            for k in ("a", "b") for s in rng.choice(36000, 25, replace=False) + 3000]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")
    want = series.on_grid(series.resample(df, ["k"]), ["k"], start, end, fill="backward")
    got = series.resample_onto(df, ["k"], start, end)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
