"""B and H: projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import calendar as cal
from clickloom.functions import codes, errors
from clickloom.functions import packed_time as pt
from clickloom.operators import rows
from clickloom.operators.aggregates import top_category
from clickloom.operators.joins import members
from clickloom.plans.features import app_popularity
from clickloom.session import pin
from clickloom.workload.registry import query, rounded, time_text, with_time_text
from clickloom.workload.roles import Roles


@query("b01_projection", "SELECT creativeID, appID FROM ad")
def projection(r: Roles) -> DataFrame:
    return r.ad.select("creativeID", "appID")


@query("b02_rename", "SELECT userID AS user_key, appID AS app_key FROM user_app")
def rename(r: Roles) -> DataFrame:
    return rows.rename_all(r.user_app, ["user_key", "app_key"])


@query("b03_drop", "SELECT * EXCLUDE (camgaignID, adID) FROM ad")
def drop(r: Roles) -> DataFrame:
    return r.ad.drop("camgaignID", "adID")


@query("b04_reorder", "SELECT * EXCLUDE (label), label FROM train")
def reorder(r: Roles) -> DataFrame:
    return rows.move_last(r.train, "label")


@query("b05_derived_column", "SELECT *, (clickTime // 100 % 100)::INTEGER AS hour FROM clicks_with_id")
def derived_column(r: Roles) -> DataFrame:
    return r.clicks_with_id.withColumn("hour", pt.hour_of(F.col("clickTime")))


@query("b06_filter", "SELECT * FROM clicks_with_id WHERE label = 1")
def filter_rows(r: Roles) -> DataFrame:
    return r.clicks_with_id.filter(F.col("label") == 1)


@query("b07_settled_clicks", "SELECT * FROM clicks_with_id WHERE clickTime < 260000 OR label <> 0")
def settled(r: Roles) -> DataFrame:
    return rows.settled_clicks(r.clicks_with_id)


@query("b08_half_open_range", "SELECT * FROM clicks_with_id WHERE clickTime >= 100000 AND clickTime < 200000")
def half_open(r: Roles) -> DataFrame:
    return rows.half_open(r.clicks_with_id, "clickTime", 100000, 200000)


@query("b09_hour_slice", """
    SELECT event_id, value FROM events WHERE hour(ts) BETWEEN 8 AND 9 OR hour(ts) BETWEEN 17 AND 18""")
def hour_slice(r: Roles) -> DataFrame:
    return r.table("events").filter(cal.hour_in(F.col("ts"), (8, 10), (17, 19))).select("event_id", "value")


@query("b10_day_slice", """
    SELECT event_id, value FROM events WHERE ts::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-17'""")
def day_slice(r: Roles) -> DataFrame:
    return r.table("events").filter(cal.in_days(F.col("ts"), "2024-01-10", "2024-01-17")).select("event_id", "value")


@query("b11_point_lookup", "SELECT * FROM clicks_with_id WHERE userID = 7")
def point_lookup(r: Roles) -> DataFrame:
    return r.clicks_with_id.filter(F.col("userID") == 7)


@query("b12_conditional_update", """
    SELECT * REPLACE (nullif(telecomsOperator, 0) AS telecomsOperator) FROM clicks_with_id""")
def conditional_update(r: Roles) -> DataFrame:
    return rows.replace_where(r.clicks_with_id, "telecomsOperator", F.col("telecomsOperator") == 0, None)


@query("b13_drop_nulls", "SELECT * FROM clicks_with_id WHERE conversionTime IS NOT NULL")
def drop_nulls(r: Roles) -> DataFrame:
    return r.clicks_with_id.dropna(subset=["conversionTime"])


@query("b14_null_count", "SELECT count(*) AS n FROM train WHERE conversionTime IS NULL AND connectionType <> 1")
def null_count(r: Roles) -> DataFrame:
    return r.train.filter(F.col("conversionTime").isNull() & (F.col("connectionType") != 1)).agg(
        F.count("*").alias("n"))


@query("b15_membership", """
    SELECT * FROM user_app WHERE userID IN (SELECT userID FROM train)""")
def membership(r: Roles) -> DataFrame:
    return members(r.user_app, r.train.select("userID"), "userID")


@query("b16_equality_flag", """
    SELECT userID, appID, appCategory, cat_pref, coalesce(appCategory = cat_pref, FALSE) AS is_pref_cat
    FROM user_app JOIN app_cat USING (appID) LEFT JOIN preferred USING (userID)""")
def equality_flag(r: Roles) -> DataFrame:
    wide = r.user_app.join(r.app_cat, "appID")
    wide = wide.join(pin(top_category(wide), "preferred"), "userID", "left")
    flag = codes.same_known_or_unknown(F.col("appCategory"), F.col("cat_pref"))
    return wide.select("userID", "appID", "appCategory", "cat_pref", flag.alias("is_pref_cat"))


@query("b17_sample_modes", """
    SELECT 'all' AS samples, NULL AS part, count(*) AS n, round(sum(travel_time), 4) AS total FROM trips
    UNION ALL
    SELECT 'rush', NULL, count(*), round(sum(travel_time), 4) FROM trips
    WHERE hour(starting_time) IN (8, 9, 17, 18)
    UNION ALL
    SELECT 'split', CASE WHEN hour(starting_time) < 12 THEN 'am' ELSE 'pm' END, count(*), round(sum(travel_time), 4)
    FROM trips WHERE hour(starting_time) IN (8, 9, 17, 18) GROUP BY 2""")
def sample_modes(r: Roles) -> DataFrame:
    measures = [F.count("*").alias("n"), F.round(F.sum("travel_time"), 4).alias("total")]
    none = F.lit(None).cast("string").alias("part")
    every = rows.choose_samples(r.trips, "starting_time", "all").agg(*measures)
    rush = rows.choose_samples(r.trips, "starting_time", "rush").agg(*measures)
    split = rows.choose_samples(r.trips, "starting_time", "split").groupBy("part").agg(*measures)
    return (every.select(F.lit("all").alias("samples"), none, "n", "total")
            .unionByName(rush.select(F.lit("rush").alias("samples"), none, "n", "total"))
            .unionByName(split.select(F.lit("split").alias("samples"), "part", "n", "total")))


@query("b18_label_separation", "SELECT label, creativeID, userID, positionID FROM train")
def label_separation(r: Roles) -> DataFrame:
    features, label = rows.separate_label(r.train.select("label", "creativeID", "userID", "positionID"))
    return r.train.select(label, *features)


# --- scalar functions ------------------------------------------------------------------

_TIMES = "event_id, clickTime"


@query("h01_hour_of_packed", f"SELECT {_TIMES}, (clickTime // 100 % 100)::INTEGER AS hour FROM clicks_with_id")
def hour_of_packed(r: Roles) -> DataFrame:
    return r.clicks_with_id.select("event_id", "clickTime", pt.hour_of(F.col("clickTime")).alias("hour"))


@query("h02_day_of_packed", f"SELECT {_TIMES}, (clickTime // 10000)::INTEGER AS day FROM clicks_with_id")
def day_of_packed(r: Roles) -> DataFrame:
    return r.clicks_with_id.select("event_id", "clickTime", pt.day_of(F.col("clickTime")).alias("day"))


@query("h03_delay_as_coded", """
    SELECT event_id, floor(d / 10000) * 1440 + floor(d / 100 - 100 * floor(d / 10000)) * 24
                     + floor(d - 100 * floor(d / 100)) AS delay
    FROM (SELECT event_id, (conversionTime - clickTime)::DOUBLE AS d FROM clicks_with_id)""")
def delay_as_coded(r: Roles) -> DataFrame:
    return r.clicks_with_id.select(
        "event_id", pt.delay_minutes_compat(F.col("clickTime"), F.col("conversionTime")).alias("delay"))


@query("h04_delay_minutes", """
    SELECT event_id, ((conversionTime // 10000 - clickTime // 10000) * 1440
                      + (conversionTime // 100 % 100 - clickTime // 100 % 100) * 60
                      + conversionTime % 100 - clickTime % 100)::BIGINT AS delay
    FROM clicks_with_id""")
def delay_minutes(r: Roles) -> DataFrame:
    return r.clicks_with_id.select(
        "event_id", pt.delay_minutes(F.col("clickTime"), F.col("conversionTime")).alias("delay"))


@query("h05_province", "SELECT userID, hometown, (hometown // 100)::INTEGER AS province FROM users")
def province(r: Roles) -> DataFrame:
    return r.user.select("userID", "hometown", codes.province(F.col("hometown")).alias("province"))


@query("h06_category_levels", """
    SELECT appID, (appCategory // 100)::INTEGER AS level1, (appCategory % 100)::INTEGER AS level2 FROM app_cat""")
def category_levels(r: Roles) -> DataFrame:
    c = F.col("appCategory")
    return r.app_cat.select("appID", codes.category_level1(c).alias("level1"), codes.category_level2(c).alias("level2"))


@query("h07_pair_number", """
    SELECT userID, appID, CASE WHEN userID >= appID THEN userID * userID + userID + appID
                               ELSE userID + appID * appID END AS pair
    FROM user_app""")
def pair_number(r: Roles) -> DataFrame:
    return r.user_app.withColumn("pair", codes.pair_number(F.col("userID"), F.col("appID")))


@query("h08_pair_text", "SELECT userID::VARCHAR || '-' || appID::VARCHAR AS pair, count(*) AS n FROM user_app GROUP BY 1")
def pair_text(r: Roles) -> DataFrame:
    return r.user_app.groupBy(codes.pair_text(F.col("userID"), F.col("appID")).alias("pair")).agg(
        F.count("*").alias("n"))


@query("h09_cut_right_closed", """
    SELECT event_id, (CASE WHEN value < 1 THEN NULL WHEN value <= 28 THEN 0 WHEN value <= 44 THEN 1
                           WHEN value <= 120 THEN 2 END)::INTEGER AS bin
    FROM events""")
def cut_right(r: Roles) -> DataFrame:
    return r.table("events").select("event_id", codes.cut(F.col("value"), schemas.CLICK_COUNT_EDGES).alias("bin"))


@query("h10_cut_left_closed", """
    SELECT userID, (CASE WHEN age < 0 THEN NULL WHEN age < 1 THEN 0 WHEN age < 4 THEN 1 WHEN age < 14 THEN 2
                         WHEN age < 29 THEN 3 WHEN age < 44 THEN 4 WHEN age < 59 THEN 5 WHEN age < 74 THEN 6
                         WHEN age < 84 THEN 7 END)::INTEGER AS bin
    FROM users""")
def cut_left(r: Roles) -> DataFrame:
    return r.user.select("userID", codes.cut(F.col("age"), schemas.AGE_EDGES, right=False).alias("bin"))


@query("h11_log_spaced_bins", """
    SELECT l_orderkey, sum(l_extendedprice) AS total,
           (CASE WHEN sum(l_extendedprice) < 1 THEN NULL WHEN sum(l_extendedprice) <= 10 THEN 0
                 WHEN sum(l_extendedprice) <= 100 THEN 1 WHEN sum(l_extendedprice) <= 1000 THEN 2
                 WHEN sum(l_extendedprice) <= 10000 THEN 3 WHEN sum(l_extendedprice) <= 100000 THEN 4
                 WHEN sum(l_extendedprice) <= 1000000 THEN 5 WHEN sum(l_extendedprice) <= 10000000 THEN 6
            END)::INTEGER AS bin
    FROM lineitem GROUP BY l_orderkey""".replace("sum(l_extendedprice) AS total", "round(sum(l_extendedprice), 2) AS total"))
def log_spaced_bins(r: Roles) -> DataFrame:
    spent = F.sum("l_extendedprice")
    return r.table("lineitem").groupBy("l_orderkey").agg(
        F.round(spent, 2).alias("total"), codes.cut(spent, codes.log_spaced(0, 7, 8)).alias("bin"))


@query("h12_bin_tables", """
    SELECT event_id,
           (CASE WHEN v < 1 THEN NULL WHEN v <= 4 THEN 0 WHEN v <= 16 THEN 1 WHEN v <= 64 THEN 2 WHEN v <= 252 THEN 3
                 WHEN v <= 1000 THEN 4 END)::INTEGER AS activity,
           (CASE WHEN d < 0 THEN NULL WHEN d <= 1000 THEN 0 WHEN d <= 2500 THEN 1 WHEN d <= 4000 THEN 2
                 WHEN d <= 5500 THEN 3 WHEN d <= 7000 THEN 4 END)::INTEGER AS delay
    FROM (SELECT event_id, value AS v, value * 20 AS d FROM events)""")
def bin_tables(r: Roles) -> DataFrame:
    return r.table("events").select(
        "event_id", codes.cut(F.col("value"), schemas.USER_ACTIVITY_EDGES).alias("activity"),
        codes.cut(F.col("value") * 20, schemas.CONVERSION_DELAY_EDGES).alias("delay"))


@query("h13_constant_fill", """
    SELECT creativeID, coalesce(app_popularity, 6)::BIGINT AS app_popularity
    FROM ad LEFT JOIN popularity USING (appID)""")
def constant_fill(r: Roles) -> DataFrame:
    wide = r.ad.join(app_popularity(r.user_app), "appID", "left")
    return wide.fillna({"app_popularity": schemas.POPULARITY_WHEN_MISSING}).select("creativeID", "app_popularity")


@query("h14_mean_fill", """
    SELECT creativeID, coalesce(app_popularity, (SELECT floor(avg(app_popularity)) FROM popularity))::BIGINT
               AS app_popularity
    FROM ad LEFT JOIN popularity USING (appID)""")
def mean_fill(r: Roles) -> DataFrame:
    wide = r.ad.join(app_popularity(r.user_app), "appID", "left")
    return rows.fill_with_truncated_mean(wide, "app_popularity").select("creativeID", "app_popularity")


@query("h15_cast", """
    SELECT event_id, trunc(value)::INTEGER AS whole, event_id::VARCHAR AS as_text, user_id::DOUBLE AS as_real FROM events""")
def cast(r: Roles) -> DataFrame:
    return r.table("events").select(
        "event_id", F.col("value").cast("int").alias("whole"), F.col("event_id").cast("string").alias("as_text"),
        F.col("user_id").cast("double").alias("as_real"))


@query("h16_arithmetic", """
    SELECT event_id, floor(value)::BIGINT AS lower, ceil(value)::BIGINT AS upper, abs(value - 100) AS distance,
           round(value * value, 4) AS square
    FROM events""")
def arithmetic(r: Roles) -> DataFrame:
    v = F.col("value")
    return r.table("events").select(
        "event_id", F.floor(v).alias("lower"), F.ceil(v).alias("upper"), F.abs(v - 100).alias("distance"),
        F.round(F.pow(v, 2), 4).alias("square"))


@query("h17_parse_time", """
    SELECT event_id, strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')
               AS parsed
    FROM events""")
def parse_time(r: Roles) -> DataFrame:
    text = r.table("events").select("event_id", time_text("ts").alias("text"))
    return text.select("event_id", time_text(cal.parse(F.col("text"))).alias("parsed"))


@query("h18_date_and_hour", """
    SELECT strftime(date + to_hours(hour), '%Y-%m-%d %H:%M:%S') AS ts, round(pressure, 6) AS pressure FROM weather""")
def date_and_hour(r: Roles) -> DataFrame:
    placed = r.weather.select(cal.at_hour(F.col("date"), F.col("hour")).alias("ts"), "pressure")
    return rounded(with_time_text(placed, "ts"), "pressure")


@query("h19_time_arithmetic", """
    SELECT event_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS two_hours,
           strftime(ts + INTERVAL 100 MINUTE, '%Y-%m-%d %H:%M:%S') AS hundred_minutes,
           strftime(ts + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS one_week
    FROM events""")
def time_arithmetic(r: Roles) -> DataFrame:
    ts = F.col("ts")
    return r.table("events").select(
        "event_id", time_text(cal.plus_seconds(ts, F.lit(7200))).alias("two_hours"),
        time_text(cal.plus_seconds(ts, F.lit(6000))).alias("hundred_minutes"),
        time_text(cal.plus_seconds(ts, F.lit(7 * 86400))).alias("one_week"))


@query("h20_calendar_parts", """
    SELECT event_id, hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute, (isodow(ts) - 1)::INTEGER AS day_of_week,
           year(ts)::INTEGER AS year
    FROM events""")
def calendar_parts(r: Roles) -> DataFrame:
    ts = F.col("ts")
    return r.table("events").select("event_id", F.hour(ts).alias("hour"), F.minute(ts).alias("minute"),
                                    cal.monday_first(ts).alias("day_of_week"), F.year(ts).alias("year"))


@query("h21_slot_of_day", """
    SELECT event_id, ((hour(ts) * 60 + minute(ts)) // 20)::INTEGER AS slot FROM events""")
def slot_of_day(r: Roles) -> DataFrame:
    return r.table("events").select("event_id", cal.slot_of_day(F.col("ts")).alias("slot"))


@query("h22_absolute_percentage_error", """
    SELECT l_orderkey, l_linenumber, round(abs((l_discount - l_tax) / nullif(l_discount, 0)), 6) AS ape FROM lineitem""")
def absolute_percentage_error(r: Roles) -> DataFrame:
    error = errors.ape(F.col("l_discount"), F.col("l_tax"))
    return r.table("lineitem").select("l_orderkey", "l_linenumber", F.round(error, 6).alias("ape"))


@query("h23_log_loss_term", """
    SELECT event_id, round(-(label * ln(p) + (1 - label) * ln(1 - p)), 6) + 0.0 AS loss
    FROM (SELECT event_id, label, least(greatest(creativeID / 99.0, 1e-15), 1 - 1e-15)::DOUBLE AS p
          FROM clicks_with_id)""")
def log_loss_term(r: Roles) -> DataFrame:
    loss = errors.log_loss_term(F.col("label"), F.col("creativeID") / F.lit(99.0))
    return rounded(r.clicks_with_id.select("event_id", loss.alias("loss")), "loss")
