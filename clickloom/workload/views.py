"""Intermediate SQL views shared by several twins."""

from __future__ import annotations

_USER_COLUMNS = "age, gender, education, marriageStatus, haveBaby, hometown, residence, user_activity, cat_pref"


def _ratio(base: str, key: str, name: str) -> str:
    return f"""
        SELECT {key}, (ratio - min(ratio) OVER ()) / nullif(max(ratio) OVER () - min(ratio) OVER (), 0) AS {name}
        FROM (SELECT {key}, nullif(count(*) FILTER (label = 1), 0) / count(*) AS ratio FROM {base} GROUP BY {key})"""


def _cut(value: str, edges: list[int]) -> str:
    cases = " ".join(f"WHEN {value} <= {e} THEN {i}" for i, e in enumerate(edges[1:]))
    return f"(CASE WHEN {value} < {edges[0]} THEN NULL {cases} END)::INTEGER"


def click_views(base: str, suffix: str) -> dict[str, str]:
    """Feature views of one click log."""
    s = suffix
    return {
        f"clean{s}": f"""
            SELECT label, clickTime, conversionTime, creativeID, b.userID, positionID, connectionType,
                   (CASE WHEN telecomsOperator = 0 THEN coalesce(known, 0) ELSE telecomsOperator END)::INTEGER
                       AS telecomsOperator
            FROM {base} b LEFT JOIN (
                SELECT userID, max(telecomsOperator) AS known FROM {base} GROUP BY userID
                HAVING count(DISTINCT telecomsOperator) = 2 AND min(telecomsOperator) = 0) f ON b.userID = f.userID""",
        f"connection_ratio{s}": _ratio(f"clean{s}", "connectionType", "conversion_ratio_connectionType"),
        f"operator_ratio{s}": _ratio(f"clean{s}", "telecomsOperator", "conversion_ratio_telecomsOperator"),
        f"hour_features{s}": f"""
            SELECT hour, hour_weight,
                   (ratio - min(ratio) OVER ()) / nullif(max(ratio) OVER () - min(ratio) OVER (), 0)
                       AS hour_conversion_ratio
            FROM (SELECT (clickTime // 100 % 100)::INTEGER AS hour, count(*) FILTER (label = 1) AS hour_weight,
                         count(*) FILTER (label = 1) / count(*) AS ratio
                  FROM clean{s} GROUP BY 1 HAVING count(*) FILTER (label = 1) > 0)""",
        f"user_clicks{s}": f"""
            SELECT userID, count(*) FILTER (label = 1) AS conversion_count,
                   {_cut('count(*)', [1, 28, 44, 120])} AS click_count_group,
                   count(*) FILTER (label = 1) / count(*) AS conversion_ratio_click
            FROM clean{s} GROUP BY userID""",
        f"installed{s}": f"""
            SELECT DISTINCT userID, appID
            FROM (SELECT * FROM user_app UNION ALL SELECT userID, appID FROM installs_seen)
            WHERE userID IN (SELECT userID FROM {base} JOIN ad USING (creativeID)
                             UNION SELECT userID FROM test_ol JOIN ad USING (creativeID))
              AND appID IN (SELECT appID FROM {base} JOIN ad USING (creativeID)
                            UNION SELECT appID FROM test_ol JOIN ad USING (creativeID))""",
        f"context{s}": f"""
            SELECT c.label, c.creativeID, c.userID, c.connectionType, c.telecomsOperator,
                   conversion_ratio_connectionType, conversion_ratio_telecomsOperator,
                   (clickTime // 100 % 100)::INTEGER AS hour, hour_weight, hour_conversion_ratio,
                   conversion_count, click_count_group, conversion_ratio_click,
                   i.userID IS NOT NULL AS is_installed, sitesetID, positionType
            FROM clean{s} c
            LEFT JOIN connection_ratio{s} USING (connectionType)
            LEFT JOIN operator_ratio{s} USING (telecomsOperator)
            LEFT JOIN hour_features{s} h ON h.hour = clickTime // 100 % 100
            LEFT JOIN user_clicks{s} u ON u.userID = c.userID
            LEFT JOIN ad a ON a.creativeID = c.creativeID
            LEFT JOIN installed{s} i ON i.userID = c.userID AND i.appID = a.appID
            LEFT JOIN pos p ON p.positionID = c.positionID
            WHERE clickTime < 260000 OR label <> 0""",
        f"dataset{s}": f"""
            SELECT c.* EXCLUDE (userID, creativeID), {_USER_COLUMNS},
                   advertiserID, appPlatform, appCategory, app_popularity,
                   coalesce(appCategory = cat_pref, FALSE) AS is_pref_cat
            FROM context{s} c JOIN user_group USING (userID) JOIN ad_group USING (creativeID)""",
    }


VIEWS = {
    **click_views("train", ""),
    **click_views("wide", "_wide"),
    "context_test": """
        SELECT c.instanceID, c.creativeID, c.userID, c.connectionType, c.telecomsOperator,
               conversion_ratio_connectionType, conversion_ratio_telecomsOperator,
               (clickTime // 100 % 100)::INTEGER AS hour, hour_weight, hour_conversion_ratio,
               coalesce(conversion_count, 0) AS conversion_count,
               coalesce(click_count_group, 0)::INTEGER AS click_count_group,
               coalesce(conversion_ratio_click, 0) AS conversion_ratio_click,
               i.userID IS NOT NULL AS is_installed, sitesetID, positionType
        FROM test_ol c
        LEFT JOIN connection_ratio USING (connectionType)
        LEFT JOIN operator_ratio USING (telecomsOperator)
        LEFT JOIN hour_features h ON h.hour = clickTime // 100 % 100
        LEFT JOIN user_clicks u ON u.userID = c.userID
        LEFT JOIN ad a ON a.creativeID = c.creativeID
        LEFT JOIN installed i ON i.userID = c.userID AND i.appID = a.appID
        LEFT JOIN pos p ON p.positionID = c.positionID""",
    "popularity": "SELECT appID, count(userID) AS app_popularity FROM user_app GROUP BY appID",
    "activity": f"""
        SELECT userID, {_cut('count(appID)', [1, 4, 16, 64, 252, 1000])} AS user_activity
        FROM user_app GROUP BY userID""",
    "category_counts": """
        SELECT userID, appCategory, count(*) AS n FROM user_app JOIN app_cat USING (appID) GROUP BY ALL""",
    "preferred": """
        SELECT userID, appCategory AS cat_pref FROM category_counts WHERE appCategory <> 0
        QUALIFY row_number() OVER (PARTITION BY userID ORDER BY n DESC, appCategory) = 1""",
    "ad_group": f"""
        SELECT creativeID, advertiserID, appPlatform, appCategory,
               coalesce({_cut('app_popularity', [10 ** i for i in range(8)])}, 6)::INTEGER AS app_popularity
        FROM ad JOIN app_cat USING (appID) LEFT JOIN popularity USING (appID)""",
    "clean_users": """
        SELECT * REPLACE ((hometown // 100)::INTEGER AS hometown, (residence // 100)::INTEGER AS residence)
        FROM users""",
    "user_group": """
        SELECT userID, (CASE WHEN age < 0 THEN NULL WHEN age < 1 THEN 0 WHEN age < 4 THEN 1 WHEN age < 14 THEN 2
                             WHEN age < 29 THEN 3 WHEN age < 44 THEN 4 WHEN age < 59 THEN 5 WHEN age < 74 THEN 6
                             WHEN age < 84 THEN 7 END)::INTEGER AS age,
               gender, education, marriageStatus, haveBaby, hometown, residence,
               coalesce(user_activity, 5)::INTEGER AS user_activity, coalesce(cat_pref, 0)::INTEGER AS cat_pref
        FROM clean_users LEFT JOIN activity USING (userID) LEFT JOIN preferred USING (userID)""",
    # --- travel times ---------------------------------------------------------------
    "bins": """
        SELECT intersection_id, tollgate_id, time_bucket(INTERVAL 20 MINUTE, starting_time) AS ts,
               avg(travel_time) AS value
        FROM trips GROUP BY ALL""",
    "resampled": """
        SELECT intersection_id, tollgate_id, ts, last_value(value IGNORE NULLS) OVER (
                   PARTITION BY intersection_id, tollgate_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value
        FROM (SELECT intersection_id, tollgate_id,
                     unnest(generate_series(min(ts), max(ts), INTERVAL 20 MINUTE)) AS ts
              FROM bins GROUP BY intersection_id, tollgate_id)
        LEFT JOIN bins USING (intersection_id, tollgate_id, ts)""",
    "grid": """
        SELECT intersection_id, tollgate_id, unnest(generate_series(
                   first_day::TIMESTAMP, last_day + INTERVAL '23 hours 40 minutes', INTERVAL 20 MINUTE)) AS ts
        FROM (SELECT DISTINCT intersection_id, tollgate_id FROM trips),
             (SELECT min(starting_time)::DATE AS first_day, max(starting_time)::DATE AS last_day FROM trips)""",
    "laid": """
        SELECT intersection_id, tollgate_id, ts, first_value(value IGNORE NULLS) OVER (
                   PARTITION BY intersection_id, tollgate_id ORDER BY ts
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
        FROM grid LEFT JOIN resampled USING (intersection_id, tollgate_id, ts)""",
    "series": """
        SELECT intersection_id, tollgate_id, ts, last_value(kept IGNORE NULLS) OVER (
                   PARTITION BY intersection_id, tollgate_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS value
        FROM (SELECT *, CASE WHEN abs(value - avg(value) OVER k) > 3 * stddev_samp(value) OVER k THEN NULL
                             ELSE value END AS kept
              FROM laid WINDOW k AS (PARTITION BY intersection_id, tollgate_id))""",
    "trended": """
        SELECT *, CASE WHEN count(value) OVER (k ROWS BETWEEN 36 PRECEDING AND 36 FOLLOWING) = 73 THEN
                   (avg(value) OVER (k ROWS BETWEEN 36 PRECEDING AND 35 FOLLOWING)
                    + avg(value) OVER (k ROWS BETWEEN 35 PRECEDING AND 36 FOLLOWING)) / 2 END AS trend,
               (epoch(ts)::BIGINT // 1200) % 72 AS phase
        FROM series WINDOW k AS (PARTITION BY intersection_id, tollgate_id ORDER BY ts)""",
    "phases": """
        SELECT intersection_id, tollgate_id, phase, m - avg(m) OVER (PARTITION BY intersection_id, tollgate_id) AS seasonal
        FROM (SELECT intersection_id, tollgate_id, phase, avg(value - trend) AS m FROM trended GROUP BY ALL)""",
    "decomposed": """
        SELECT intersection_id, tollgate_id, ts, value, trend, seasonal, value - trend - seasonal AS residual,
               seasonal + avg(trend) OVER k + avg(value - trend - seasonal) OVER k AS seasonal_level
        FROM trended JOIN phases USING (intersection_id, tollgate_id, phase)
        WINDOW k AS (PARTITION BY intersection_id, tollgate_id)""",
    "slots": """
        SELECT intersection_id, tollgate_id, epoch(ts)::BIGINT // 7200 AS block,
               epoch(ts)::BIGINT % 7200 // 1200 AS slot, ts, value
        FROM series""",
    "blocks": """
        SELECT intersection_id, tollgate_id, block,
               max(value) FILTER (slot = 0) AS v0, max(value) FILTER (slot = 1) AS v1,
               max(value) FILTER (slot = 2) AS v2, max(value) FILTER (slot = 3) AS v3,
               max(value) FILTER (slot = 4) AS v4, max(value) FILTER (slot = 5) AS v5
        FROM slots GROUP BY ALL""",
    "weather_placed": """
        SELECT date + to_hours(hour) AS ts, * EXCLUDE (date, hour) FROM weather""",
    "weather_clean": """
        SELECT * REPLACE (last_value(wind_direction IGNORE NULLS) OVER (
                              ORDER BY ts ROWS UNBOUNDED PRECEDING) AS wind_direction)
        FROM (SELECT * REPLACE (CASE WHEN abs(wind_direction - avg(wind_direction) OVER ())
                                          > 3 * stddev_samp(wind_direction) OVER () THEN NULL
                                     ELSE wind_direction END AS wind_direction) FROM weather_placed)""",
}
