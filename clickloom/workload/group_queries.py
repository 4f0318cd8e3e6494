"""K: composed feature groups, data sets and reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.plans import features, prepare, reports
from clickloom.session import pin, scratch_path, together
from clickloom.sources.store import FeatureStore
from clickloom.workload.registry import contents, contents_sql, query, rounded
from clickloom.workload.roles import Roles

RATIOS = ["conversion_ratio_connectionType", "conversion_ratio_telecomsOperator", "hour_conversion_ratio",
          "conversion_ratio_click"]
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in RATIOS)


@query("k01_clean_clicks", """
    SELECT label, clickTime, conversionTime, creativeID, userID, positionID, connectionType, telecomsOperator FROM clean""")
def clean_clicks(r: Roles) -> DataFrame:
    return prepare.clean_clicks(r.train)


@query("k02_clean_users", "SELECT * FROM clean_users")
def clean_users(r: Roles) -> DataFrame:
    return prepare.clean_users(r.user)


@query("k02b_clean_users_compat", """
    SELECT * REPLACE ((hometown // 100)::INTEGER AS hometown, (hometown // 10000)::INTEGER AS residence) FROM users""")
def clean_users_compat(r: Roles) -> DataFrame:
    return prepare.clean_users(r.user, compat=True)


@query("k03_installs_with_category", "SELECT userID, appID, appCategory FROM user_app LEFT JOIN app_cat USING (appID)")
def installs_with_category(r: Roles) -> DataFrame:
    return prepare.installs_with_category(r.user_app, r.app_cat)


def _pairs(r: Roles, clicks: DataFrame) -> DataFrame:
    return prepare.installed_pairs(clicks, r.test_ol, r.ad, r.user_app, r.action)


@query("k04_installed_pairs", """
    SELECT userID, appID, CASE WHEN userID >= appID THEN userID * userID + userID + appID
                               ELSE userID + appID * appID END AS pair
    FROM installed""")
def installed_pairs(r: Roles) -> DataFrame:
    return prepare.with_pair_number(_pairs(r, r.train))


def _source_tables(r: Roles) -> dict[str, DataFrame]:
    return {"ad": r.ad, "app_cat": r.app_cat, "pos": r.pos, "test_ol": r.test_ol, "train": r.train,
            "action": r.action, "user": r.user, "user_app": r.user_app}


PREPARED = {
    "installed_pairs": ("installed", ["userID", "appID"]),
    "train": ("clean", ["label", "clickTime", "conversionTime", "creativeID", "userID", "positionID", "connectionType",
                        "telecomsOperator"]),
    "user": ("clean_users", ["userID", "age", "gender", "education", "marriageStatus", "haveBaby", "hometown", "residence"]),
    "user_app_cat": ("(SELECT * FROM user_app LEFT JOIN app_cat USING (appID))", ["userID", "appID", "appCategory"]),
}


@query("k05_prepare_all", "\nUNION ALL\n".join(
    contents_sql(name, source, columns, "userID") for name, (source, columns) in PREPARED.items()))
def prepare_all(r: Roles) -> DataFrame:
    """Contents of the prepared tables, column by column."""
    ready = prepare.prepare_all(_source_tables(r), FeatureStore(r.spark, scratch_path(r.spark, "prepared")))
    return reduce(DataFrame.unionByName, [contents(name, ready[name], columns, "userID")
                                          for name, (_, columns) in PREPARED.items()])


@query("k06_app_popularity", "SELECT appID, app_popularity FROM popularity")
def app_popularity(r: Roles) -> DataFrame:
    return features.app_popularity(r.user_app)


def _ads(r: Roles) -> DataFrame:
    return features.ad_group(r.ad, r.app_cat, features.app_popularity(r.user_app))


@query("k07_ad_group", "SELECT * FROM ad_group")
def ad_group(r: Roles) -> DataFrame:
    return _ads(r)


@query("k07b_ad_group_scaled", """
    SELECT creativeID, advertiserID, appPlatform, appCategory,
           round((p - min(p) OVER ()) / nullif(max(p) OVER () - min(p) OVER (), 0), 6) AS app_popularity
    FROM (SELECT *, coalesce(app_popularity, floor(avg(app_popularity) OVER ())) AS p
          FROM ad LEFT JOIN app_cat USING (appID) LEFT JOIN popularity USING (appID))""")
def ad_group_scaled(r: Roles) -> DataFrame:
    return rounded(features.ad_group_scaled(r.ad, r.app_cat, features.app_popularity(r.user_app)), "app_popularity")


@query("k08_user_activity", "SELECT userID, user_activity FROM activity")
def user_activity(r: Roles) -> DataFrame:
    return features.user_activity(r.user_app)


@query("k09_preferred_category", "SELECT userID, cat_pref FROM preferred")
def preferred_category(r: Roles) -> DataFrame:
    return features.preferred_category(prepare.installs_with_category(r.user_app, r.app_cat))


def _users(r: Roles) -> DataFrame:
    return features.user_group(prepare.clean_users(r.user), features.user_activity(r.user_app), preferred_category(r))


@query("k10_user_group", "SELECT * FROM user_group")
def user_group(r: Roles) -> DataFrame:
    return _users(r)


@query("k11_install_hour_weight", """
    SELECT (installTime // 100 % 100)::INTEGER AS hour, count(*) AS hour_weight FROM installs_seen GROUP BY 1""")
def install_hour_weight(r: Roles) -> DataFrame:
    return features.install_hour_weight(r.action)


@query("k12_hour_features", """
    SELECT hour, hour_weight, round(hour_conversion_ratio, 6) AS hour_conversion_ratio FROM hour_features_wide""")
def hour_features(r: Roles) -> DataFrame:
    return rounded(features.hour_features(r.wide), "hour_conversion_ratio")


@query("k13_user_click_features", """
    SELECT userID, conversion_count, click_count_group, round(conversion_ratio_click, 6) AS conversion_ratio_click
    FROM user_clicks_wide""")
def user_click_features(r: Roles) -> DataFrame:
    return rounded(features.user_click_features(r.wide), "conversion_ratio_click")


@query("k14_connection_ratio", """
    SELECT connectionType, round(conversion_ratio_connectionType, 6) AS conversion_ratio_connectionType
    FROM connection_ratio""")
def connection_ratio(r: Roles) -> DataFrame:
    return rounded(features.connection_ratio(r.train), "conversion_ratio_connectionType")


@query("k15_operator_ratio", """
    SELECT telecomsOperator, round(conversion_ratio_telecomsOperator, 6) AS conversion_ratio_telecomsOperator
    FROM operator_ratio""")
def operator_ratio(r: Roles) -> DataFrame:
    return rounded(features.operator_ratio(prepare.clean_clicks(r.train)), "conversion_ratio_telecomsOperator")


@dataclass
class ClickParts:
    """What the context group joins, written once as the feature store does."""

    clicks: DataFrame
    statistics: dict[str, DataFrame]
    pairs: DataFrame


def click_parts(r: Roles, raw: DataFrame) -> ClickParts:
    clicks = pin(prepare.clean_clicks(raw), "clean-clicks")
    statistics, pairs = together(
        r.spark, lambda: features.context_statistics(clicks), lambda: pin(_pairs(r, clicks), "installed-pairs"))
    return ClickParts(clicks, statistics, pairs)


def context(r: Roles, raw: DataFrame, mode: str = "train", scoring: DataFrame | None = None) -> DataFrame:
    parts = click_parts(r, raw)
    clicks = parts.clicks if scoring is None else scoring
    return features.context_group(clicks, parts.statistics, r.ad, parts.pairs, r.pos, mode)


def user_and_ad_groups(r: Roles) -> list[DataFrame]:
    return together(r.spark, lambda: pin(_users(r), "user-group"), lambda: pin(_ads(r), "ad-group"))


@query("k16_context_group", f"SELECT * REPLACE ({_ROUND}) FROM context")
def context_group(r: Roles) -> DataFrame:
    return rounded(context(r, r.train), *RATIOS)


@query("k16b_context_group_scoring", f"SELECT * REPLACE ({_ROUND}) FROM context_test")
def context_group_scoring(r: Roles) -> DataFrame:
    return rounded(context(r, r.train, "score", r.test_ol), *RATIOS)


@query("k16c_context_group_wide", f"SELECT * REPLACE ({_ROUND}) FROM context_wide")
def context_group_wide(r: Roles) -> DataFrame:
    return rounded(context(r, r.wide), *RATIOS)


def assembled(r: Roles, raw: DataFrame) -> DataFrame:
    r.store("user_app")
    rows, (users, ads) = together(r.spark, lambda: context(r, raw), lambda: user_and_ad_groups(r))
    return features.dataset(rows, users, ads)


@query("k17_dataset", f"SELECT * REPLACE ({_ROUND}) FROM dataset")
def dataset(r: Roles) -> DataFrame:
    return rounded(assembled(r, r.train), *RATIOS)


@query("k17b_dataset_wide", f"SELECT * REPLACE ({_ROUND}) FROM dataset_wide")
def dataset_wide(r: Roles) -> DataFrame:
    # the clicks, the installs and the installed apps all come from it
    r.store("sales", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag",
            "l_linestatus", "l_shipdate", "o_custkey", "o_orderpriority")
    return rounded(assembled(r, r.wide), *RATIOS)


_TEST = "(SELECT * FROM context_test JOIN user_group USING (userID) JOIN ad_group USING (creativeID))"
_USERS = ["age", "gender", "education", "marriageStatus", "haveBaby", "hometown", "residence", "user_activity", "cat_pref"]
_ADS = ["advertiserID", "appPlatform", "appCategory", "app_popularity"]
_CONTEXT = ["connectionType", "telecomsOperator", "hour", "is_installed", *RATIOS, "hour_weight", "sitesetID", "positionType",
            "conversion_count", "click_count_group"]
CONSTRUCTED = {
    "dataset": ("dataset", ["label", *_CONTEXT, *_USERS, *_ADS, "is_pref_cat"], "advertiserID"),
    "fg_ad": ("ad_group", ["creativeID", *_ADS], "creativeID"),
    "fg_user": ("user_group", ["userID", *_USERS], "userID"),
    "f_context_users": ("user_clicks", ["userID", "conversion_count", "click_count_group", "conversion_ratio_click"], "userID"),
    "testset_ol": (_TEST, ["instanceID", *_CONTEXT, *_USERS, *_ADS], "instanceID"),
}


@query("k18_construct_all", "\nUNION ALL\n".join(
    contents_sql(name, source, columns, key, ["is_installed", "is_pref_cat"]) for name, (source, columns, key) in CONSTRUCTED.items()))
def construct_all(r: Roles) -> DataFrame:
    """Contents of the constructed tables, column by column."""
    store = FeatureStore(r.spark, scratch_path(r.spark, "constructed"))
    made = features.construct_all(prepare.prepare_all(_source_tables(r), store), store)
    return reduce(DataFrame.unionByName, [contents(name, made[name], columns, key)
                                          for name, (_, columns, key) in CONSTRUCTED.items()])


_DELAY = """floor(d / 10000) * 1440 + floor(d / 100 - 100 * floor(d / 10000)) * 24 + floor(d - 100 * floor(d / 100))"""


@query("k24_conversion_delay", f"""
    SELECT label, creativeID, userID, sitesetID, positionType, connectionType, telecomsOperator,
           (CASE WHEN m < 0 THEN 5 WHEN m <= 1000 THEN 0 WHEN m <= 2500 THEN 1 WHEN m <= 4000 THEN 2
                 WHEN m <= 5500 THEN 3 WHEN m <= 7000 THEN 4 ELSE 5 END)::INTEGER AS "deltaTime_cat",
           (clickTime // 100 % 100)::INTEGER AS hour
    FROM (SELECT *, {_DELAY} AS m FROM (SELECT *, (conversionTime - clickTime)::DOUBLE AS d FROM wide))
         JOIN (SELECT creativeID FROM ad) USING (creativeID) JOIN pos USING (positionID)""")
def conversion_delay(r: Roles) -> DataFrame:
    return features.conversion_delay_group(r.wide, r.ad, r.pos)


@query("k25_click_time_weight", """
    SELECT t.*, h.hour, hour_weight FROM (SELECT *, (clickTime // 100 % 100)::INTEGER AS hour FROM clicks_with_id) t
    LEFT JOIN (SELECT (installTime // 100 % 100)::INTEGER AS hour, count(*) AS hour_weight FROM installs_seen GROUP BY 1) h
    USING (hour)""".replace("t.*, h.hour", "t.*"))
def click_time_weight(r: Roles) -> DataFrame:
    return features.click_time_weight(r.clicks_with_id, r.action)


def _section(metric: str, source: str, key: str) -> str:
    return (f"SELECT '{metric}' AS metric, ({key})::VARCHAR AS key, count(*) AS n FROM {source} "
            f"WHERE ({key}) IS NOT NULL GROUP BY 2")


def _total(metric: str, source: str) -> str:
    return f"SELECT '{metric}' AS metric, 'all' AS key, count(*) AS n FROM {source}"


def _stack(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _repeats(source: str, key: str) -> str:
    return f"(SELECT {key} FROM {source} GROUP BY 1 HAVING count(*) > 1)"


def _occurs(source: str, key: str) -> str:
    return f"(SELECT count(*) AS occurs FROM {source} GROUP BY {key})"


_HIT = "(SELECT * FROM train WHERE label = 1)"


@query("k26_click_report", _stack(
    _total("rows", "train"), _section("label", "train", "label"), _section("hour", "train", "clickTime // 100 % 100"),
    _section("converted_hour", _HIT, "clickTime // 100 % 100"), _section("day", "train", "clickTime // 10000"),
    _section("conversion_day", _HIT, "conversionTime // 10000"), _section("connectionType", "train", "connectionType"),
    _section("converted_connectionType", _HIT, "connectionType"),
    _section("telecomsOperator", "train", "telecomsOperator"),
    _section("clicks_per_user", _occurs("train", "userID"), "occurs")))
def click_report(r: Roles) -> DataFrame:
    return reports.click_report(r.train)


@query("k26b_ad_report", _stack(
    _total("rows", "ad"), _section("advertiserID", "ad", "advertiserID"), _section("appPlatform", "ad", "appPlatform"),
    _section("creatives_per_app", _occurs("ad", "appID"), "occurs"),
    _total("duplicate_creatives", _repeats("ad", "creativeID"))))
def ad_report(r: Roles) -> DataFrame:
    return reports.ad_report(r.ad)


@query("k26c_user_report", _stack(
    _total("rows", "users"), *[_section(c, "users", c) for c in ("age", "gender", "education", "marriageStatus", "haveBaby")],
    _section("hometown_province", "users", "hometown // 100"), _section("residence_province", "users", "residence // 100"),
    _total("duplicate_users", _repeats("users", "userID"))))
def user_report(r: Roles) -> DataFrame:
    return reports.user_report(r.user)


@query("k26d_install_report", _stack(
    _total("rows", "user_app"), _section("apps_per_user", _occurs("user_app", "userID"), "occurs"),
    _section("users_per_app", _occurs("user_app", "appID"), "occurs")))
def install_report(r: Roles) -> DataFrame:
    return reports.install_report(r.user_app)


@query("k26e_position_report", _stack(
    _total("rows", "pos"), _section("sitesetID", "pos", "sitesetID"), _section("positionType", "pos", "positionType"),
    _total("duplicate_positions", _repeats("pos", "positionID"))))
def position_report(r: Roles) -> DataFrame:
    return reports.position_report(r.pos)


@query("k26f_category_report", _stack(
    _total("rows", "app_cat"), _section("appCategory", "app_cat", "appCategory"),
    _total("duplicate_apps", _repeats("app_cat", "appID"))))
def category_report(r: Roles) -> DataFrame:
    return reports.category_report(r.app_cat)


@query("k26g_action_report", _stack(
    _total("rows", "installs_seen"), _section("day", "installs_seen", "installTime // 10000"),
    _section("hour", "installs_seen", "installTime // 100 % 100"),
    _section("installs_per_user", _occurs("installs_seen", "userID"), "occurs")))
def action_report(r: Roles) -> DataFrame:
    return reports.action_report(r.action)


@query("k26h_scoring_report", _stack(
    _total("rows", "test_ol"), _section("connectionType", "test_ol", "connectionType"),
    _section("telecomsOperator", "test_ol", "telecomsOperator"),
    _section("clicks_per_user", _occurs("test_ol", "userID"), "occurs"),
    _total("installed", """(SELECT * FROM test_ol JOIN ad USING (creativeID)
                            WHERE (userID, appID) IN (SELECT (userID, appID) FROM user_app))""")))
def scoring_report(r: Roles) -> DataFrame:
    return reports.scoring_report(r.test_ol, r.ad, r.user_app)
