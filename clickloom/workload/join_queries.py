"""C and D: joins and set operators."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import joins, sets
from clickloom.operators.aggregates import top_category, value_counts
from clickloom.operators.encode import concatenate
from clickloom.operators.ordered import as_of
from clickloom.operators.series import bin_means, extract_series, on_grid
from clickloom.plans.features import app_popularity
from clickloom.plans.travel_time import KEYS, ready_weather, seasonal_curve
from clickloom.session import pin
from clickloom.workload.registry import query, rounded, with_time_text
from clickloom.workload.roles import Roles
from clickloom.workload.series_queries import grid_ends, regular

_WEATHER = ", ".join(f"round({c}, 6) AS {c}" for c in schemas.WEATHER_COLUMNS)


@query("c01_left_join", "SELECT creativeID, appID, app_popularity FROM ad LEFT JOIN popularity USING (appID)")
def left_join(r: Roles) -> DataFrame:
    return joins.lookup(r.ad, app_popularity(r.user_app), "appID").select("creativeID", "appID", "app_popularity")


@query("c02_inner_join", """
    SELECT event_id, creativeID, userID, label, advertiserID, appID FROM clicks_with_id JOIN ad USING (creativeID)""")
def inner_join(r: Roles) -> DataFrame:
    return joins.matching(r.clicks_with_id, r.ad, "creativeID").select(
        "event_id", "creativeID", "userID", "label", "advertiserID", "appID")


@query("c03_star_join", """
    SELECT l_orderkey, l_linenumber, label, w.userID, w.creativeID, age, gender, advertiserID, appCategory, cat_pref,
           coalesce(appCategory = cat_pref, FALSE) AS is_pref_cat
    FROM wide_with_id w JOIN (SELECT * FROM users LEFT JOIN preferred USING (userID)) u USING (userID)
         JOIN (SELECT * FROM ad JOIN app_cat USING (appID)) a USING (creativeID)""")
def star_join(r: Roles) -> DataFrame:
    preferred = top_category(r.user_app.join(r.app_cat, "appID", "left"))
    user = pin(joins.lookup(r.user, preferred, "userID"), "users")
    ad = pin(joins.matching(r.ad, r.app_cat, "appID"), "ads")
    return joins.star(r.wide_with_id, user, ad).select(
        "l_orderkey", "l_linenumber", "label", "userID", "creativeID", "age", "gender", "advertiserID", "appCategory",
        "cat_pref", "is_pref_cat")


@query("c04_semi_join_two_sets", """
    SELECT * FROM user_app WHERE userID IN (SELECT userID FROM train) AND appID IN (SELECT creativeID FROM train)""")
def semi_join_two_sets(r: Roles) -> DataFrame:
    apps = r.train.select(F.col("creativeID").alias("appID"))
    return joins.members_of_both(r.user_app, r.train, apps, "userID", "appID")


@query("c05_existence_flag", """
    SELECT event_id, userID, appID,
           EXISTS (SELECT 1 FROM user_app u WHERE u.userID = c.userID AND u.appID = c.appID) AS is_installed
    FROM (SELECT * FROM clicks_with_id JOIN ad USING (creativeID)) c""")
def existence_flag(r: Roles) -> DataFrame:
    clicks = joins.matching(r.clicks_with_id, r.ad, "creativeID").select("event_id", "userID", "appID")
    return joins.flag_members(clicks, r.user_app, ["userID", "appID"], "is_installed")


@query("c06_anti_join", """
    SELECT event_id, userID, appID FROM clicks_with_id JOIN ad USING (creativeID)
    WHERE NOT EXISTS (SELECT 1 FROM user_app u WHERE u.userID = clicks_with_id.userID AND u.appID = ad.appID)""")
def anti_join(r: Roles) -> DataFrame:
    clicks = joins.matching(r.clicks_with_id, r.ad, "creativeID").select("event_id", "userID", "appID")
    return joins.non_members(clicks, r.user_app, ["userID", "appID"])


@query("c07_as_of_join", f"""
    SELECT event_id, {_WEATHER} FROM events ASOF LEFT JOIN weather_clean w ON events.ts >= w.ts""")
def as_of_join(r: Roles) -> DataFrame:
    """The weather at the time of every event."""
    events = r.table("events").select("event_id", "ts")
    found = as_of(events, ready_weather(r.weather), "ts", schemas.WEATHER_COLUMNS)
    return rounded(found.drop("ts"), *schemas.WEATHER_COLUMNS)


@query("c07b_as_of_join_by_key", """
    SELECT e.event_id, e.user_id, p.value AS last_purchase
    FROM events e ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase') p
         ON e.user_id = p.user_id AND e.ts >= p.ts""")
def as_of_join_by_key(r: Roles) -> DataFrame:
    """The last purchase of the same user at or before every event."""
    events = r.table("events")
    bought = events.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", F.col("value").alias("last_purchase"))
    return as_of(events.select("event_id", "user_id", "ts"), bought, "ts", ["last_purchase"], ["user_id"]).drop("ts")


@query("c08_aligned_arithmetic", """
    SELECT creativeID, p.n / a.n AS value
    FROM (SELECT creativeID, count(*) AS n FROM train WHERE label = 1 GROUP BY 1) p
         FULL JOIN (SELECT creativeID, count(*) AS n FROM train GROUP BY 1) a USING (creativeID)""")
def aligned_arithmetic(r: Roles) -> DataFrame:
    positive = value_counts(r.train.filter(F.col("label") == 1), "creativeID", name="value")
    every = value_counts(r.train, "creativeID", name="value")
    return joins.aligned(positive, every, "creativeID", lambda a, b: F.try_divide(a, b))


@query("c09_exact_reindex", """
    SELECT intersection_id, tollgate_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(value, 6) AS value
    FROM grid LEFT JOIN bins USING (intersection_id, tollgate_id, ts)""")
def exact_reindex(r: Roles) -> DataFrame:
    bins = bin_means(extract_series(r.trips, KEYS, "starting_time", "travel_time"), KEYS)
    return rounded(with_time_text(on_grid(bins, KEYS, *grid_ends(r)), "ts"), "value")


@query("c10_index_join", """
    SELECT intersection_id, tollgate_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(s.value, 6) AS value,
           round(seasonal_level, 6) AS seasonal_tt
    FROM series s LEFT JOIN decomposed d USING (intersection_id, tollgate_id, ts)""")
def index_join(r: Roles) -> DataFrame:
    series = regular(r)
    curve = seasonal_curve(series, 72).withColumnRenamed("value", "seasonal_tt")
    joined = joins.lookup(series, curve, [*KEYS, "ts"])
    return rounded(with_time_text(joined, "ts"), "value", "seasonal_tt")


@query("c11_concatenate_columns", """
    SELECT vec_id, len(embedding) + 2 AS size,
           round(list_sum(embedding::DOUBLE[]) + label + vec_id, 4) AS total
    FROM embeddings""")
def concatenate_columns(r: Roles) -> DataFrame:
    parts = r.table("embeddings").withColumn("left", array_to_vector("embedding"))
    whole = vector_to_array("whole")
    total = F.aggregate(whole, F.lit(0.0), lambda a, x: a + x)
    return concatenate(parts, ["left", "label", "vec_id"], "whole").select(
        "vec_id", F.size(whole).cast("long").alias("size"), F.round(total, 4).alias("total"))


# --- sets -------------------------------------------------------------------------------

@query("d01_distinct_keys", "SELECT DISTINCT userID FROM user_app")
def distinct_keys(r: Roles) -> DataFrame:
    return sets.keys_of(r.user_app, "userID")


@query("d02_union_distinct", "SELECT userID FROM train UNION SELECT userID FROM user_app")
def union_distinct(r: Roles) -> DataFrame:
    return sets.union_keys(r.train.select("userID"), r.user_app.select("userID"))


@query("d03_intersection", "SELECT userID FROM train INTERSECT SELECT userID FROM user_app")
def intersection(r: Roles) -> DataFrame:
    return sets.common_keys(r.train.select("userID"), r.user_app.select("userID"))


_RELATIONS = [("train.creativeID", "train", "creativeID", "ad"), ("train.userID", "train", "userID", "users"),
              ("train.positionID", "train", "positionID", "pos"), ("test_ol.userID", "test_ol", "userID", "users"),
              ("ad.appID", "ad", "appID", "user_app"), ("users.userID", "users", "userID", "user_app")]


@query("d04_containment", "\nUNION ALL\n".join(f"""
    SELECT '{name}' AS relation, count(*) AS missing, count(*) = 0 AS contained
    FROM (SELECT DISTINCT {key} FROM {inner} WHERE {key} NOT IN (SELECT {key} FROM {outer}))"""
                                               for name, inner, key, outer in _RELATIONS))
def containment(r: Roles) -> DataFrame:
    source = {"train": r.train, "test_ol": r.test_ol, "ad": r.ad, "users": r.user, "pos": r.pos, "user_app": r.user_app}
    return sets.containment({name: (source[inner].select(key), source[outer].select(key))
                             for name, inner, key, outer in _RELATIONS})


@query("d05_venn_regions", """
    SELECT clicked, installed, acted, count(*) AS n
    FROM (SELECT userID, bool_or(s = 1) AS clicked, bool_or(s = 2) AS installed, bool_or(s = 3) AS acted
          FROM (SELECT userID, 1 AS s FROM train UNION ALL SELECT userID, 2 FROM user_app
                UNION ALL SELECT userID, 3 FROM installs_seen) GROUP BY userID)
    GROUP BY ALL""")
def venn_regions(r: Roles) -> DataFrame:
    return sets.venn({"clicked": r.train.select("userID"), "installed": r.user_app.select("userID"),
                      "acted": r.action.select("userID")})


@query("d05b_venn_two_sets", """
    SELECT in_train, in_test, count(*) AS n
    FROM (SELECT userID, bool_or(s = 1) AS in_train, bool_or(s = 2) AS in_test
          FROM (SELECT userID, 1 AS s FROM train UNION ALL SELECT userID, 2 FROM test_ol) GROUP BY userID)
    GROUP BY ALL""")
def venn_two_sets(r: Roles) -> DataFrame:
    return sets.venn({"in_train": r.train.select("userID"), "in_test": r.test_ol.select("userID")})


@query("d06_append", "SELECT * FROM user_app UNION ALL SELECT userID, appID FROM installs_seen")
def append(r: Roles) -> DataFrame:
    return sets.append(r.user_app, r.action.select("userID", "appID"))


@query("d07_append_checked", """
    SELECT event_id, value, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS part FROM events""")
def append_checked(r: Roles) -> DataFrame:
    """Morning and afternoon forecasts put together; a repeated id would fail."""
    events = r.table("events")
    am = events.filter(F.hour("ts") < 12).select("event_id", "value", F.lit("am").alias("part"))
    pm = events.filter(F.hour("ts") >= 12).select("event_id", "value", F.lit("pm").alias("part"))
    return sets.append_checked("event_id", am, pm)


@query("d08_difference", "SELECT appID FROM ad EXCEPT SELECT appID FROM user_app")
def difference(r: Roles) -> DataFrame:
    return sets.only_in_first(r.ad.select("appID"), r.user_app.select("appID"))
