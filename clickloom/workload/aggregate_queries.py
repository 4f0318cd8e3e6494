"""E and G: aggregations, sorts and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.packed_time import day_of, delay_minutes_compat
from clickloom.operators import aggregates as agg
from clickloom.operators.encode import feature_values
from clickloom.operators.joins import matching
from clickloom.operators.modelling import rank_params
from clickloom.operators.sets import duplicate_keys
from clickloom.workload.registry import query, rounded
from clickloom.workload.roles import Roles


@query("e01_value_counts", "SELECT conversionTime, count(*) AS n FROM train WHERE conversionTime IS NOT NULL GROUP BY 1")
def value_counts(r: Roles) -> DataFrame:
    return agg.value_counts(r.train, "conversionTime")


@query("e02_value_counts_with_null", """
    SELECT nullif(telecomsOperator, 0) AS telecomsOperator, count(*) AS n FROM train GROUP BY 1""")
def value_counts_with_null(r: Roles) -> DataFrame:
    known = r.train.select(F.nullif("telecomsOperator", F.lit(0)).alias("telecomsOperator"))
    return agg.value_counts(known, "telecomsOperator", keep_null=True)


@query("e03_sorted_distribution", "SELECT clickTime, count(*) AS n FROM train GROUP BY 1 ORDER BY 1")
def sorted_distribution(r: Roles) -> DataFrame:
    return agg.value_counts(r.train, "clickTime").orderBy("clickTime")


@query("e04_count_of_counts", """
    SELECT occurs, count(*) AS n FROM (SELECT userID, count(*) AS occurs FROM wide GROUP BY 1) GROUP BY 1""")
def count_of_counts(r: Roles) -> DataFrame:
    return agg.count_of_counts(r.wide, "userID")


@query("e05_count_per_key", "SELECT userID, count(appID) AS user_activity FROM user_app GROUP BY 1")
def count_per_key(r: Roles) -> DataFrame:
    return agg.count_per_key(r.user_app, "userID", "appID", "user_activity")


@query("e06_multi_key_count", "SELECT userID, appCategory, n FROM category_counts")
def multi_key_count(r: Roles) -> DataFrame:
    return agg.value_counts(matching(r.user_app, r.app_cat, "appID"), "userID", "appCategory")


@query("e07_distinct_per_key", """
    SELECT userID, count(DISTINCT telecomsOperator) AS n_distinct FROM wide GROUP BY 1""")
def distinct_per_key(r: Roles) -> DataFrame:
    return agg.distinct_per_key(r.wide, "userID", "telecomsOperator")


def _ratio_sql(base: str, key: str) -> str:
    return f"""
    SELECT {key}, count(*) AS clicks, nullif(count(*) FILTER (label = 1), 0) AS conversions,
           round(nullif(count(*) FILTER (label = 1), 0) / count(*), 6) AS ratio
    FROM {base} GROUP BY 1"""


@query("e08_conversion_ratio", _ratio_sql("wide", "positionID"))
def conversion_ratio(r: Roles) -> DataFrame:
    return rounded(agg.conversion_ratio(r.wide, "positionID"), "ratio")


@query("e08b_conversion_ratio_by_day", _ratio_sql(
    "(SELECT (clickTime // 10000)::INTEGER AS day, label FROM train)", "day"))
def conversion_ratio_by_day(r: Roles) -> DataFrame:
    days = r.train.select(day_of(F.col("clickTime")).alias("day"), "label")
    return rounded(agg.conversion_ratio(days, "day"), "ratio")


@query("e09_normalised_ratio", """
    SELECT creativeID, round((ratio - (SELECT min(p / n) FROM c)) / nullif((SELECT max(p / n) - min(p / n) FROM c), 0), 6)
               AS ratio
    FROM (SELECT creativeID, p / n AS ratio FROM c)""".replace(" FROM c", """ FROM (
        SELECT creativeID, nullif(count(*) FILTER (label = 1), 0) AS p, count(*) AS n FROM train GROUP BY 1)"""))
def normalised_ratio(r: Roles) -> DataFrame:
    return rounded(agg.normalised_ratio(r.train, "creativeID", "ratio"), "ratio")


@query("e10_positive_weight", """
    SELECT (clickTime // 100 % 100)::INTEGER AS hour, count(*) AS hour_weight FROM wide WHERE label = 1 GROUP BY 1""")
def positive_weight(r: Roles) -> DataFrame:
    return agg.weight_by_hour(r.wide.filter(F.col("label") == 1), "clickTime")


@query("e11_duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicates(r: Roles) -> DataFrame:
    return duplicate_keys(r.table("lineitem"), "l_orderkey", "l_linenumber")


@query("e12_preferred_category", "SELECT userID, cat_pref FROM preferred")
def preferred_category(r: Roles) -> DataFrame:
    return agg.top_category(r.user_app.join(r.app_cat, "appID", "left"))


@query("e13_click_profile", """
    SELECT userID, count(*) AS click_count, count(*) FILTER (label = 1) AS conversion_count,
           (CASE WHEN count(*) < 1 THEN NULL WHEN count(*) <= 28 THEN 0 WHEN count(*) <= 44 THEN 1
                 WHEN count(*) <= 120 THEN 2 END)::INTEGER AS click_count_group,
           round(count(*) FILTER (label = 1) / count(*), 6) AS conversion_ratio_click
    FROM wide GROUP BY 1""")
def click_profile(r: Roles) -> DataFrame:
    return rounded(agg.click_profile(r.wide), "conversion_ratio_click")


@query("e14_ratio_distribution", """
    SELECT ratio, count(*) AS n
    FROM (SELECT round(count(*) FILTER (label = 1) / count(*), 6) AS ratio FROM wide GROUP BY userID) GROUP BY 1""")
def ratio_distribution(r: Roles) -> DataFrame:
    profile = agg.click_profile(r.wide).select(F.col("conversion_ratio_click").alias("ratio"))
    return agg.value_distribution(profile, "ratio")


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("e15_describe", "\nUNION ALL\n".join(f"""
    SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean,
           round(stddev_samp({c}), 6) AS std FROM lineitem""" for c in _DESCRIBED))
def describe(r: Roles) -> DataFrame:
    return rounded(agg.describe(r.table("lineitem"), *_DESCRIBED), "mean", "std")


@query("e16_sizes", """
    SELECT count(*) AS rows, count(DISTINCT userID) AS "distinct_userID", count(DISTINCT appID) AS "distinct_appID"
    FROM user_app""")
def sizes(r: Roles) -> DataFrame:
    return agg.sizes(r.user_app, "userID", "appID")


@query("e17_class_balance", """
    SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
           floor(count(*) FILTER (label = 0) / count(*) FILTER (label = 1))::BIGINT AS negatives_per_positive
    FROM wide""")
def class_balance(r: Roles) -> DataFrame:
    return agg.class_balance(r.wide)


@query("e18_histogram", """
    WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
         h AS (SELECT least(floor((l_extendedprice - (SELECT lo FROM b)) * 20
                                  / nullif((SELECT hi - lo FROM b), 0)), 19)::INTEGER AS bin, count(*) AS n
               FROM lineitem GROUP BY 1)
    SELECT i::INTEGER AS bin, coalesce(n, 0) AS n FROM range(20) t(i) LEFT JOIN h ON bin = i""")
def histogram(r: Roles) -> DataFrame:
    return agg.histogram(r.table("lineitem"), "l_extendedprice")


@query("e19_conditional_distribution", """
    SELECT advertiserID, count(*) AS n
    FROM (SELECT *, (conversionTime - clickTime)::DOUBLE AS d FROM train) JOIN ad USING (creativeID)
    WHERE floor(d / 10000) * 1440 + floor(d / 100 - 100 * floor(d / 10000)) * 24 + floor(d - 100 * floor(d / 100))
          BETWEEN 0 AND 999
    GROUP BY 1""")
def conditional_distribution(r: Roles) -> DataFrame:
    """Advertisers of the conversions within one delay band."""
    delay = delay_minutes_compat(F.col("clickTime"), F.col("conversionTime"))
    band = matching(r.train.withColumn("delay", delay), r.ad, "creativeID").filter(
        (F.col("delay") >= 0) & (F.col("delay") < 1000))
    return agg.value_counts(band, "advertiserID")


@query("e20_paired_counts", """
    SELECT click_count, conversion_count, count(*) AS n
    FROM (SELECT count(*) AS click_count, count(*) FILTER (label = 1) AS conversion_count FROM wide GROUP BY userID)
    GROUP BY ALL""")
def paired_counts(r: Roles) -> DataFrame:
    return agg.paired_counts(agg.click_profile(r.wide), "click_count", "conversion_count")


@query("e21_single_click_users", """
    SELECT count(*) AS users, count(*) FILTER (m = 1) AS converted
    FROM (SELECT o_custkey, max((o_orderstatus = 'F')::INTEGER) AS m FROM orders GROUP BY 1 HAVING count(*) = 1)""")
def single_click_users(r: Roles) -> DataFrame:
    """Orders as clicks: customers with one order, and how many of those are finished."""
    clicks = r.table("orders").select(F.col("o_custkey").alias("userID"),
                                      (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return agg.single_click_users(clicks)


@query("e22_non_zero_counts", "\nUNION ALL\n".join(f"""
    SELECT '{c}' AS feature, {c}::VARCHAR AS value, count(*) AS n FROM wide GROUP BY {c}"""
                                                    for c in ("positionID", "connectionType", "telecomsOperator")))
def non_zero_counts(r: Roles) -> DataFrame:
    return feature_values(r.wide, ["positionID", "connectionType", "telecomsOperator"]).drop("feature_no")


@query("e23_fold_summary", """
    SELECT positionID, round(avg(m), 6) AS mean_loss, round(stddev_pop(m), 6) AS std_loss
    FROM (SELECT positionID, connectionType, avg(label) AS m FROM wide GROUP BY ALL) GROUP BY 1""")
def fold_summary(r: Roles) -> DataFrame:
    """Connection types as folds, positions as parameters, conversion rate as loss."""
    scores = r.wide.groupBy("positionID", "connectionType").agg(F.avg("label").alias("loss"))
    return rounded(agg.fold_summary(scores, "positionID", "loss"), "mean_loss", "std_loss")


# --- sorts and top-k ------------------------------------------------------------------------

@query("g01_sort_by_key", """
    SELECT hour, hour_weight FROM (
        SELECT (installTime // 100 % 100)::INTEGER AS hour, count(*) AS hour_weight FROM installs_seen GROUP BY 1)
    ORDER BY hour""")
def sort_by_key(r: Roles) -> DataFrame:
    return agg.weight_by_hour(r.action, "installTime").orderBy("hour")


@query("g02_sort_nulls_last", """
    SELECT event_id, userID, nullif(telecomsOperator, 0) AS telecomsOperator FROM clicks_with_id
    ORDER BY userID, telecomsOperator NULLS LAST, event_id""")
def sort_nulls_last(r: Roles) -> DataFrame:
    rows = r.clicks_with_id.select("event_id", "userID", F.nullif("telecomsOperator", F.lit(0)).alias("telecomsOperator"))
    return rows.orderBy("userID", F.col("telecomsOperator").asc_nulls_last(), "event_id")


@query("g03_top_values", "SELECT appID, count(*) AS n FROM user_app GROUP BY 1 ORDER BY n DESC, appID LIMIT 20")
def top_values(r: Roles) -> DataFrame:
    return agg.top_values(r.user_app, "appID", 20)


@query("g04_head_and_tail", """
    SELECT 'head' AS part, * FROM (SELECT event_id, user_id, value FROM events ORDER BY ts LIMIT 6)
    UNION ALL
    SELECT 'tail', * FROM (SELECT event_id, user_id, value FROM events ORDER BY ts DESC LIMIT 6)""")
def head_and_tail(r: Roles) -> DataFrame:
    events = r.table("events")
    columns = ["event_id", "user_id", "value"]
    head = events.orderBy("ts").limit(6).select(F.lit("head").alias("part"), *columns)
    return head.unionByName(events.orderBy(F.desc("ts")).limit(6).select(F.lit("tail").alias("part"), *columns))


@query("g05_rank", """
    SELECT param, round(mean_train_loss, 6) AS mean_train_loss, round(mean_val_loss, 6) AS mean_val_loss,
           rank() OVER (ORDER BY mean_val_loss)::INTEGER AS rank_val_loss
    FROM (SELECT connectionType::DOUBLE AS param, avg(label) AS mean_train_loss, avg(conversion) AS mean_val_loss
          FROM (SELECT connectionType, positionID, avg(label) AS label, max(label) - avg(label) AS conversion
                FROM wide GROUP BY ALL) GROUP BY 1)""")
def rank(r: Roles) -> DataFrame:
    """Ranking of a result table: one row per parameter."""
    folds = r.wide.groupBy(F.col("connectionType").cast("double").alias("param"), "positionID").agg(
        F.avg("label").alias("train_loss"), (F.max("label") - F.avg("label")).alias("valid_loss"))
    return rounded(rank_params(folds), "mean_train_loss", "mean_val_loss")
