"""What the plans look like: splits of hot keys, pushed filters, no gathering."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import joins, modelling, ordered
from clickloom.operators.aggregates import normalised_ratio
from clickloom.plans import features, travel_time
from clickloom.session import pin
from clickloom.workload.catalog import QUERIES
from clickloom.workload.roles import Roles

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().toString()


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_clicks(spark, conf):
    """User 7 holds a third of the clicks; thresholds are scaled down to this size."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
         spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5")
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return spark.range(0, 60000, numPartitions=8).select(
        user.alias("userID"), (F.col("id") % 2).cast("int").alias("telecomsOperator"), F.rand(1).alias("x"))


def test_hot_user_is_split_in_a_lookup(spark, hot_clicks):
    users = spark.range(5000).select(F.col("id").alias("userID"), F.rand(2).alias("y"))
    wide = joins.lookup(hot_clicks, users, "userID")
    assert "skew=true" in executed(wide)
    assert wide.count() == 60000


@pytest.mark.parametrize("operator", [
    ordered.impute_operator,
    lambda df: joins.members(df, df.filter("x < 0.5"), "userID"),
    lambda df: joins.flag_members(df, df.filter("x < 0.5"), ["userID"], "hit"),
    lambda df: ordered.drop_outliers(df, "x", ["userID"]),
])
def test_hot_user_is_split_by_operators_that_join_back(hot_clicks, operator):
    assert "skew=true" in executed(operator(hot_clicks))


def test_written_statistics_are_broadcast_by_size(spark, sf):
    r = Roles(spark, sf)
    context = features.context_group(r.train, features.context_statistics(r.train), r.ad,
                                     pin(r.user_app.distinct()), r.pos, "train")
    text = executed(context)
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_context_shuffles_the_clicks_twice_at_most(spark, sf, conf):
    """With nothing small enough to broadcast, user statistics and user group share one placement."""
    r = Roles(spark, sf)
    statistics = features.context_statistics(r.train)
    pairs, users = pin(r.user_app.distinct()), pin(r.user)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rows = joins.flag_members(r.train.withColumn("appID", F.col("creativeID")), pairs, ["userID", "appID"], "hit")
    rows = joins.matching(joins.lookup(rows, statistics["user"], "userID"), users, "userID")
    text = rows._jdf.queryExecution().executedPlan().toString()
    left = [line for line in text.splitlines() if "Exchange" in line and "userID" in line]
    # clicks by (user, app), pairs twice at most, clicks by user, statistics, users
    assert len(left) <= 6


def test_no_global_window_over_rows(spark, sf):
    r = Roles(spark, sf)
    series = travel_time.regular_series(r.trips, "2024-01-01 00:00:00", "2024-01-30 23:40:00")
    for df in (ordered.impute_operator(r.train), normalised_ratio(r.train, "userID", "x"),
               ordered.carry_forward(r.table("events"), ["user_id"], "ts", ["value"]),
               ordered.decompose(series, travel_time.KEYS, "ts", "value", 1200, 72)):
        text = df._jdf.queryExecution().executedPlan().toString()
        for line in re.findall(r"Exchange SinglePartition.*", text):
            assert "plan_id" in line
        assert not re.search(r"Window .*\n.*\n.*Exchange SinglePartition", text)


def test_decomposition_needs_one_shuffle_after_the_series(spark, sf):
    r = Roles(spark, sf)
    series = pin(travel_time.regular_series(r.trips, "2024-01-01 00:00:00", "2024-01-30 23:40:00"))
    text = ordered.decompose(series, travel_time.KEYS, "ts", "value", 1200, 72)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["a02_table_scan"](spark, sf))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text


def test_hot_time_stays_split(spark):
    """Two keys hold all rows: every chunk is its own window group."""
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id)")
                                  .alias("ts"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    assert ordered.pick_chunk(df, ["k"], "ts", limit=100) == 3600
    got = ordered.carry_forward(df, ["k"], "ts", ["v"], 3600)
    assert got.filter("v IS NULL").count() == 3  # before the first value of key 1
    text = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"windowspecdefinition\(k#\d+L, _chunk#\d+L", text)


def test_folds_move_only_the_sort_key(spark, sf):
    r = Roles(spark, sf)
    tagged = modelling.expanding_folds(r.clicks_with_id, ["clickTime", "event_id"], 5)
    assert "Exchange" not in tagged._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("word", [r"\.crossJoin\(", "localCheckpoint", r"\.toPandas\(", r"F\.udf", "pandas_udf", r"coalesce\(1\)",
                                  r"\.rdd\b"])
def test_library_avoids(word):
    for path in glob.glob(f"{ROOT}/clickloom/**/*.py", recursive=True):
        assert not re.search(word, open(path).read()), path


def test_temporary_tables_are_released(spark):
    import glob

    from clickloom.session import pin, shared_dir, temporary, together

    def files():
        return {f for f in glob.glob(f"{shared_dir(spark).removeprefix('file:')}/clickloom/**/*.parquet", recursive=True)}

    kept = pin(spark.range(5))
    with temporary(spark):
        one = pin(spark.range(7))
        with temporary(spark):
            counts = together(spark, *[lambda n=n: pin(spark.range(n)).count() for n in (3, 4)])
        assert counts == [3, 4] and one.count() == 7
    assert kept.count() == 5 and not any("scope-" in f for f in files())
