"""The given tables in the roles of the click and travel-time sources.

``Roles`` builds them with DataFrames; ``ROLE_SQL`` states the same views for the
SQL side.  Every view reads its whole table.
"""

from __future__ import annotations

import re
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.packed_time import pack, whole
from clickloom.operators.series import first_last_day
from clickloom.session import pin


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def store(self, name: str, *columns: str) -> None:
        """Write a view (or its ``columns``) that several steps read; the sources it stands for are tables, not joins."""
        view = getattr(self, name)
        self.__dict__[name] = pin(view.select(*columns) if columns else view, name)

    @cached_property
    def clicks_with_id(self) -> DataFrame:
        """Click log from the events: a purchase is a conversion."""
        e = self.table("events")
        k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
        ts = F.col("ts")
        converted = F.timestamp_add("MINUTE", F.floor("value").cast("int"), ts)
        own = (F.lit(1) + F.col("user_id") % 3).cast("int")
        other = (F.lit(1) + (F.col("user_id") + 1) % 3).cast("int")
        operator = (F.when(k < 30, F.lit(0))
                    .when((k == 99) & (F.col("event_type") != "view"), other).otherwise(own))
        return e.select(
            F.col("event_id"), (F.col("event_type") == "purchase").cast("int").alias("label"),
            pack(ts).alias("clickTime"),
            F.when(F.col("event_type") == "purchase", pack(converted)).alias("conversionTime"),
            k.alias("creativeID"), F.col("user_id").alias("userID"), (k % 7).alias("positionID"),
            (k % 5).cast("int").alias("connectionType"), operator.alias("telecomsOperator"))

    @cached_property
    def train(self) -> DataFrame:
        return self.clicks_with_id.drop("event_id")

    @cached_property
    def test_ol(self) -> DataFrame:
        """Clicks to score: those from day 27 on, with a placeholder label."""
        late = self.clicks_with_id.filter(F.col("clickTime") >= 270000)
        return late.select(F.col("event_id").alias("instanceID"), F.lit(-1).alias("label"), "clickTime",
                           "creativeID", "userID", "positionID", "connectionType", "telecomsOperator")

    @cached_property
    def ad(self) -> DataFrame:
        p = self.table("part")
        return p.select(F.col("p_partkey").alias("creativeID"), whole(F.col("p_partkey"), 2).alias("adID"),
                        whole(F.col("p_partkey"), 10).alias("camgaignID"),
                        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("long").alias("advertiserID"),
                        F.col("p_partkey").alias("appID"), (F.col("p_size") % 2 + 1).cast("int").alias("appPlatform"))

    @cached_property
    def app_cat(self) -> DataFrame:
        # the first listed type plays the unknown category
        codes = {"ECONOMY": 0, "SMALL": 101, "MEDIUM": 102, "LARGE": 203, "PROMO": 210, "STANDARD": 305}
        category = F.lit(None).cast("int")
        for kind, code in codes.items():
            category = F.when(F.col("p_type") == kind, F.lit(code)).otherwise(category)
        return self.table("part").select(F.col("p_partkey").alias("appID"), category.alias("appCategory"))

    @cached_property
    def pos(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("positionID"), (F.col("s_nationkey") % 3).cast("int").alias("sitesetID"),
            (F.col("s_nationkey") % 6).cast("int").alias("positionType"))

    @cached_property
    def user(self) -> DataFrame:
        c, key, nation = self.table("customer"), F.col("c_custkey"), F.col("c_nationkey")
        return c.select(
            key.alias("userID"), F.floor(F.abs("c_acctbal") / 100).cast("int").alias("age"),
            (key % 3).cast("int").alias("gender"), (nation % 8).cast("int").alias("education"),
            (key % 4).cast("int").alias("marriageStatus"), (key % 7).cast("int").alias("haveBaby"),
            (nation * 100 + key % 100).cast("int").alias("hometown"),
            (nation * 7 % 25 * 100 + key % 97).cast("int").alias("residence"))

    @cached_property
    def sales(self) -> DataFrame:
        lines, orders = self.table("lineitem"), self.table("orders")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey)

    @cached_property
    def user_app(self) -> DataFrame:
        """Installed apps: returned and closed lines (users and apps without any remain)."""
        kept = self.sales.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
        return kept.select(F.col("o_custkey").alias("userID"), F.col("l_partkey").alias("appID"))

    @cached_property
    def action(self) -> DataFrame:
        """Install events: open lines; hour and minute come from price and quantity."""
        hour = F.floor("l_extendedprice").cast("long") % 24
        time = F.dayofmonth("l_shipdate") * 10000 + hour * 100 + F.floor("l_quantity")
        return self.sales.filter(F.col("l_linestatus") == "O").select(
            F.col("o_custkey").alias("userID"), time.cast("int").alias("installTime"), F.col("l_partkey").alias("appID"))

    @cached_property
    def wide_with_id(self) -> DataFrame:
        """Second, larger click log from the order lines."""
        hour = F.floor("l_extendedprice").cast("long") % 24
        time = F.dayofmonth("l_shipdate") * 10000 + hour * 100 + F.floor("l_quantity")
        converted = F.when(F.col("l_returnflag") == "R", time + 10 * F.col("l_linenumber"))
        own, other = (F.col("o_custkey") % 3 + 1), ((F.col("o_custkey") + 1) % 3 + 1)
        operator = (F.when(F.col("l_tax") < 0.03, F.lit(0))
                    .when((F.col("o_orderpriority") == "1-URGENT") & (F.col("l_linenumber") == 7), other)
                    .otherwise(own))
        return self.sales.select(
            "l_orderkey", "l_linenumber",
            (F.col("l_returnflag") == "R").cast("int").alias("label"), time.cast("int").alias("clickTime"),
            converted.cast("int").alias("conversionTime"), F.col("l_partkey").alias("creativeID"),
            F.col("o_custkey").alias("userID"), F.col("l_suppkey").alias("positionID"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("connectionType"),
            operator.cast("int").alias("telecomsOperator"))

    @cached_property
    def wide(self) -> DataFrame:
        return self.wide_with_id.drop("l_orderkey", "l_linenumber")

    @cached_property
    def trips(self) -> DataFrame:
        """Travel times: ten series, one per event type and user parity."""
        return self.table("events").select(
            F.col("event_type").alias("intersection_id"), (F.col("user_id") % 2).cast("int").alias("tollgate_id"),
            F.col("ts").alias("starting_time"), F.col("value").alias("travel_time"))

    @cached_property
    def days(self) -> tuple[date, date]:
        """First and last day with a trip."""
        return first_last_day(self.trips, "starting_time")

    @cached_property
    def weather(self) -> DataFrame:
        """Reports every third hour, from the values seen in that hour."""
        seen = self.table("events").filter(F.col("event_type") == "view").filter(F.hour("ts") % 3 == 0)
        # the mean in whole cents: the same number whatever the order of addition
        mean = F.call_function("div", F.round(F.sum("value") * 100).cast("long"), F.count("*")) / 100
        return seen.groupBy(F.to_date("ts").alias("date"), F.hour("ts").alias("hour")).agg(
            (mean + 1000).alias("pressure"), (mean + 1005).alias("sea_pressure"),
            F.max("value").alias("wind_direction"), F.min("value").alias("wind_speed"),
            (mean / 10).alias("temperature"), (F.count("*") * 10.0).alias("rel_humidity"),
            (F.sum("value") / 100).alias("precipitation"))


_PACK = "(day({0}) * 10000 + hour({0}) * 100 + minute({0}))::INTEGER"
_LINE_TIME = ("(day(l_shipdate) * 10000 + floor(l_extendedprice)::BIGINT % 24 * 100 "
              "+ floor(l_quantity)::BIGINT)::INTEGER")

ROLE_SQL = {
    "clicks_with_id": f"""
        SELECT event_id, (event_type = 'purchase')::INTEGER AS label, {_PACK.format('ts')} AS clickTime,
               CASE WHEN event_type = 'purchase'
                    THEN {_PACK.format('(ts + to_minutes(floor(value)::BIGINT))')} END AS conversionTime,
               k AS creativeID, user_id AS userID, k % 7 AS positionID, (k % 5)::INTEGER AS connectionType,
               (CASE WHEN k < 30 THEN 0
                     WHEN k = 99 AND event_type <> 'view' THEN 1 + (user_id + 1) % 3
                     ELSE 1 + user_id % 3 END)::INTEGER AS telecomsOperator
        FROM (SELECT *, regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events)""",
    "train": "SELECT * EXCLUDE (event_id) FROM clicks_with_id",
    "test_ol": """
        SELECT event_id AS instanceID, -1 AS label, clickTime, creativeID, userID, positionID, connectionType,
               telecomsOperator
        FROM clicks_with_id WHERE clickTime >= 270000""",
    "ad": """
        SELECT p_partkey AS creativeID, p_partkey // 2 AS adID, p_partkey // 10 AS camgaignID,
               regexp_extract(p_brand, '[0-9]+')::BIGINT AS advertiserID, p_partkey AS appID,
               (p_size % 2 + 1)::INTEGER AS appPlatform
        FROM part""",
    "app_cat": """
        SELECT p_partkey AS appID, (CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 101 WHEN 'MEDIUM' THEN 102
               WHEN 'LARGE' THEN 203 WHEN 'PROMO' THEN 210 WHEN 'STANDARD' THEN 305 END)::INTEGER AS appCategory
        FROM part""",
    "pos": """
        SELECT s_suppkey AS positionID, (s_nationkey % 3)::INTEGER AS sitesetID,
               (s_nationkey % 6)::INTEGER AS positionType
        FROM supplier""",
    "users": """
        SELECT c_custkey AS userID, floor(abs(c_acctbal) / 100)::INTEGER AS age, (c_custkey % 3)::INTEGER AS gender,
               (c_nationkey % 8)::INTEGER AS education, (c_custkey % 4)::INTEGER AS marriageStatus,
               (c_custkey % 7)::INTEGER AS haveBaby, (c_nationkey * 100 + c_custkey % 100)::INTEGER AS hometown,
               (c_nationkey * 7 % 25 * 100 + c_custkey % 97)::INTEGER AS residence
        FROM customer""",
    "sales": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "user_app": """
        SELECT o_custkey AS userID, l_partkey AS appID FROM sales
        WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
    "installs_seen": f"""
        SELECT o_custkey AS userID, {_LINE_TIME} AS installTime, l_partkey AS appID
        FROM sales WHERE l_linestatus = 'O'""",
    "wide_with_id": f"""
        SELECT l_orderkey, l_linenumber, (l_returnflag = 'R')::INTEGER AS label, {_LINE_TIME} AS clickTime,
               CASE WHEN l_returnflag = 'R' THEN {_LINE_TIME} + 10 * l_linenumber END AS conversionTime,
               l_partkey AS creativeID, o_custkey AS userID, l_suppkey AS positionID,
               substring(o_orderpriority, 1, 1)::INTEGER AS connectionType,
               (CASE WHEN l_tax < 0.03 THEN 0
                     WHEN o_orderpriority = '1-URGENT' AND l_linenumber = 7 THEN (o_custkey + 1) % 3 + 1
                     ELSE o_custkey % 3 + 1 END)::INTEGER AS telecomsOperator
        FROM sales""",
    "wide": "SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM wide_with_id",
    "trips": """
        SELECT event_type AS intersection_id, (user_id % 2)::INTEGER AS tollgate_id, ts AS starting_time,
               value AS travel_time
        FROM events""",
    "weather": """
        SELECT ts::DATE AS date, hour(ts)::INTEGER AS hour, round(sum(value) * 100)::BIGINT // count(*) / 100 + 1000 AS pressure,
               round(sum(value) * 100)::BIGINT // count(*) / 100 + 1005 AS sea_pressure, max(value) AS wind_direction,
               min(value) AS wind_speed, round(sum(value) * 100)::BIGINT // count(*) / 100 / 10 AS temperature,
               count(*) * 10.0::DOUBLE AS rel_humidity,
               sum(value) / 100 AS precipitation
        FROM events WHERE event_type = 'view' AND hour(ts) % 3 = 0
        GROUP BY ts::DATE, hour(ts)""",
}


def with_roles(sql: str, shared: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the views it names, in dependency order."""
    views = {**ROLE_SQL, **(shared or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in views.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in needed)
    return f"{head},\n{sql[5:]}" if sql.startswith("WITH ") else f"{head}\n{sql}"
