"""Profile reports: one long table (metric, key, n) per source table.

A report has as many rows as there are distinct values, never one per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.codes import province
from clickloom.functions.packed_time import day_of, hour_of
from clickloom.operators.aggregates import count_of_counts
from clickloom.operators.joins import flag_members
from clickloom.operators.sets import duplicate_keys


def _counts(df: DataFrame, **values: Column) -> DataFrame:
    """Rows per non-null value of several expressions, and of the whole table, in one scan.

    Rows are unpivoted in the map task and collapse there.
    """
    pairs = [F.struct(F.lit("rows").alias("metric"), F.lit("all").alias("key"))]
    pairs += [F.struct(F.lit(name).alias("metric"), value.cast("string").alias("key"))
              for name, value in values.items()]
    return (df.select(F.inline(F.array(*pairs))).dropna(subset=["key"])
            .groupBy("metric", "key").agg(F.count("*").alias("n")))


def _occurrences(df: DataFrame, metric: str, key: str) -> DataFrame:
    counts = count_of_counts(df, key)
    return counts.select(F.lit(metric).alias("metric"), F.col("occurs").cast("string").alias("key"), "n")


def _repeated(df: DataFrame, metric: str, key: str) -> DataFrame:
    return duplicate_keys(df, key).agg(F.count("*").alias("n")).select(
        F.lit(metric).alias("metric"), F.lit("all").alias("key"), "n")


def click_report(train: DataFrame) -> DataFrame:
    """Labels, hours, days, connections, operators, and how often users click."""
    hour = hour_of(F.col("clickTime"))
    converted = F.col("label") == 1
    return _counts(
        train, label=F.col("label"), hour=hour, converted_hour=F.when(converted, hour),
        day=day_of(F.col("clickTime")), conversion_day=F.when(converted, day_of(F.col("conversionTime"))),
        connectionType=F.col("connectionType"),
        converted_connectionType=F.when(converted, F.col("connectionType")),
        telecomsOperator=F.col("telecomsOperator"),
    ).unionByName(_occurrences(train, "clicks_per_user", "userID"))


def ad_report(ad: DataFrame) -> DataFrame:
    return (_counts(ad, advertiserID=F.col("advertiserID"), appPlatform=F.col("appPlatform"))
            .unionByName(_occurrences(ad, "creatives_per_app", "appID"))
            .unionByName(_repeated(ad, "duplicate_creatives", "creativeID")))


def user_report(user: DataFrame) -> DataFrame:
    names = ["age", "gender", "education", "marriageStatus", "haveBaby"]
    return _counts(user, **{c: F.col(c) for c in names}, hometown_province=province(F.col("hometown")),
                   residence_province=province(F.col("residence"))
                   ).unionByName(_repeated(user, "duplicate_users", "userID"))


def install_report(user_app: DataFrame) -> DataFrame:
    """How many apps users have and how many users apps have."""
    return (_counts(user_app).unionByName(_occurrences(user_app, "apps_per_user", "userID"))
            .unionByName(_occurrences(user_app, "users_per_app", "appID")))


def position_report(pos: DataFrame) -> DataFrame:
    return _counts(pos, sitesetID=F.col("sitesetID"), positionType=F.col("positionType")
                   ).unionByName(_repeated(pos, "duplicate_positions", "positionID"))


def category_report(app_cat: DataFrame) -> DataFrame:
    return _counts(app_cat, appCategory=F.col("appCategory")
                   ).unionByName(_repeated(app_cat, "duplicate_apps", "appID"))


def action_report(action: DataFrame) -> DataFrame:
    time = F.col("installTime")
    return _counts(action, day=day_of(time), hour=hour_of(time)
                   ).unionByName(_occurrences(action, "installs_per_user", "userID"))


def scoring_report(scoring: DataFrame, ad: DataFrame, pairs: DataFrame) -> DataFrame:
    """Connections, operators and clicks per user of a log to score, and how many of its rows name an installed (user, app) pair.

    Repeated ``pairs`` (userID, appID) count once; a creative without an ad names no app.
    """
    apps = scoring.select("userID", "creativeID").join(ad.select("creativeID", "appID"), "creativeID")
    installed = flag_members(apps, pairs, ["userID", "appID"], "_installed").agg(F.count_if("_installed").alias("n"))
    return (_counts(scoring, connectionType=F.col("connectionType"), telecomsOperator=F.col("telecomsOperator"))
            .unionByName(_occurrences(scoring, "clicks_per_user", "userID"))
            .unionByName(installed.select(F.lit("installed").alias("metric"), F.lit("all").alias("key"), "n")))
