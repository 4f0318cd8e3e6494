"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import tune
from clickloom.workload.roles import Roles, with_roles
from clickloom.workload.views import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(roles) -> DataFrame`` under ``name``; ``sql`` is its twin, if it has one."""

    def register(fn: Callable[[Roles], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Roles(tune(spark), sf_dir))
        if sql is not None:
            ORACLES[name] = with_roles(sql.strip(), VIEWS)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles for comparison (adding 0.0 turns -0.0 into 0.0)."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def time_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def with_time_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: time_text(c) for c in columns})


def contents(name: str, df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Per column of a table of numbers: values, their sum, and their sum weighted by the key of their row."""
    def parts(c: str) -> Column:
        value = F.col(c).cast("int" if dict(df.dtypes)[c] == "boolean" else dict(df.dtypes)[c]).cast("double")
        return F.struct(F.lit(c).alias("column"), F.count(value).alias("n"), F.round(F.sum(value), 3).alias("total"),
                        F.round(F.sum(value * (F.col(key) % 1009)), 3).alias("weighted"))

    summed = df.agg(F.array(*[parts(c) for c in columns]).alias("parts"))
    return summed.select(F.lit(name).alias("name"), F.inline("parts"))


def contents_sql(name: str, source: str, columns: Sequence[str], key: str, flags: Sequence[str] = ()) -> str:
    def part(c: str) -> str:
        value = f"{c}::INTEGER::DOUBLE" if c in flags else f"{c}::DOUBLE"
        return (f"SELECT '{name}' AS name, '{c}' AS \"column\", count({c}) AS n, round(sum({value}), 3) AS total, "
                f"round(sum({value} * ({key} % 1009)), 3) AS weighted FROM {source}")

    return "\nUNION ALL\n".join(part(c) for c in columns)


def encoded_rows(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Whole contents of encoded rows: their places and values (in millionths), with the number of equal rows."""
    stored = F.unwrap_udt(F.col(vector))
    places, values = stored["indices"], stored["values"]
    ones = F.concat(F.array_join(places.cast("array<string>"), ":1000000 "), F.lit(":1000000"))       # most rows; the general way is dear
    pairs = F.transform(F.arrays_zip(places, values), lambda e: F.concat_ws(
        ":", e["indices"].cast("string"), F.round(e["values"] * 1_000_000).cast("long").cast("string")))
    entries = F.when((F.array_min(values) == 1.0) & (F.array_max(values) == 1.0), ones).otherwise(F.array_join(pairs, " "))
    return df.groupBy(*keys, entries.alias("entries")).agg(F.count("*").alias("n"))


def encoded_sql(source: str, features: Sequence[str], keys: Sequence[str] = (), flags: Sequence[str] = (),
                numeric: Sequence[str] = ()) -> str:
    """The twin of ``encoded_rows``: numbers the values of each feature in order and lists those of each row."""
    texts = ", ".join(f"({c})::INTEGER::VARCHAR" if c in flags else f"({c})::VARCHAR" for c in features)
    numbers = "".join(f", ((SELECT count(*) FROM d) + {i}) || ':' || round(coalesce({c}, 0) * 1000000)::BIGINT" for i, c in enumerate(numeric))
    marks = "".join(f", CASE WHEN {c} IS NULL THEN ((SELECT count(*) FROM d) + {len(numeric) + i}) || ':1000000' END"
                    for i, c in enumerate(numeric))
    named = "".join(f"{k}, " for k in keys)
    return f"""
    WITH r AS (SELECT row_number() OVER () AS rn, * FROM {source}),
    l AS (SELECT rn, unnest({list(range(len(features)))}) AS no, unnest([{texts}]) AS value FROM r),
    d AS (SELECT no, value, row_number() OVER (ORDER BY no, try_cast(value AS DOUBLE) NULLS FIRST, value) - 1 AS i
          FROM (SELECT DISTINCT no, value FROM l WHERE value IS NOT NULL)),
    e AS (SELECT rn, string_agg(i || ':1000000', ' ' ORDER BY i) AS hot FROM l JOIN d USING (no, value) GROUP BY rn)
    SELECT {named}concat_ws(' ', hot{numbers}{marks}) AS entries, count(*) AS n FROM r LEFT JOIN e USING (rn) GROUP BY ALL"""
