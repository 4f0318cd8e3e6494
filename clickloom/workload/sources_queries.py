"""A: sources, sinks, materialisation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators.encode import apply_encoding, dictionary, encode_rows, one_hot
from clickloom.operators.joins import lookup_placed
from clickloom.operators.modelling import logistic, score
from clickloom.operators.series import bin_means, extract_series
from clickloom.plans.features import app_popularity
from clickloom.plans.travel_time import KEYS
from clickloom.session import scratch_path
from clickloom.sources import sinks, store, tables
from clickloom.workload.registry import contents, contents_sql, encoded_rows, encoded_sql, query, rounded, with_time_text
from clickloom.workload.roles import Roles

CODES = ["positionID", "connectionType", "telecomsOperator"]
BUCKETS = 16


@query("a01_csv_scan", "SELECT * FROM train")
def csv_scan(r: Roles) -> DataFrame:
    path = scratch_path(r.spark, "train-csv")
    store.save(r.train, path, "csv")
    return tables.read_csv(r.spark, path, schemas.TRAIN)


_DAMAGE = "CASE WHEN event_id % 97 = 0 THEN 1 WHEN event_id % 89 = 0 THEN 2 WHEN event_id % 83 = 0 THEN 3 ELSE 0 END"


@query("a01b_csv_rejects", f"""
    SELECT damage = 0 AS good, count(*) AS lines, sum(creativeID)::BIGINT AS total
    FROM (SELECT *, {_DAMAGE} AS damage FROM clicks_with_id) GROUP BY ALL""")
def csv_rejects(r: Roles) -> DataFrame:
    """A click log in which some lines have a word for a number, a field too many or one too few: what is kept and what is set aside."""
    path, names = scratch_path(r.spark, "damaged-csv"), schemas.TRAIN.names
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    damage = F.expr(_DAMAGE)
    fields[1] = F.when(damage == 1, F.lit("noon")).otherwise(fields[1])
    whole = F.concat_ws(",", *fields)
    line = F.when(damage == 2, F.concat(whole, F.lit(",7"))).when(damage == 3, F.concat_ws(",", *fields[:-1])).otherwise(whole)
    r.clicks_with_id.select(line.alias("value")).write.text(path)
    rows, rejects = tables.ingest_checked(r.spark, path, schemas.TRAIN, scratch_path(r.spark, "checked"), header=False)
    kept = rows.select(F.lit(True).alias("good"), "creativeID")
    aside = rejects.select(F.lit(False).alias("good"), F.split(tables.REJECTED, ",")[3].cast("long").alias("creativeID"))
    return kept.unionByName(aside).groupBy("good").agg(F.count("*").alias("lines"), F.sum("creativeID").alias("total"))


@query("a02_table_scan", "SELECT event_id, user_id, value FROM events WHERE value > 100")
def table_scan(r: Roles) -> DataFrame:
    return tables.read_table(r.spark, f"{r.sf_dir}/events.parquet").filter(
        F.col("value") > 100).select("event_id", "user_id", "value")


@query("a03_ingest", "SELECT * FROM ad")
def ingest(r: Roles) -> DataFrame:
    csv = scratch_path(r.spark, "ad-csv")
    store.save(r.ad, csv, "csv")
    return tables.ingest_csv(r.spark, csv, schemas.AD, scratch_path(r.spark, "ad"))


@query("a04_typed_save", """
    SELECT kind, userID, appID, count(*) AS n
    FROM user_app, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) k(kind) GROUP BY ALL""")
def typed_save(r: Roles) -> DataFrame:
    parts = []
    for kind in ("parquet", "orc", "json", "csv"):
        path = scratch_path(r.spark, f"user-app-{kind}")
        store.save(r.user_app, path, kind)
        reader = r.spark.read.schema(schemas.USER_APP).option("header", kind == "csv")
        saved = reader.format(kind).load(path)
        parts.append(saved.groupBy(F.lit(kind).alias("kind"), "userID", "appID").agg(F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query("a05_feature_store", "SELECT appID, app_popularity FROM popularity")
def feature_store(r: Roles) -> DataFrame:
    kept = store.FeatureStore(r.spark, scratch_path(r.spark, "store"))
    kept.get("f_app_popularity", lambda: app_popularity(r.user_app))

    def again():
        raise AssertionError("a stored table must not be computed again")

    return kept.get("f_app_popularity", again)


@query("a05b_store_of_changed_inputs", """
    SELECT 'whole' AS input, creativeID, count(*) AS n FROM train GROUP BY ALL
    UNION ALL SELECT 'filtered', creativeID, count(*) FROM train WHERE label = 1 GROUP BY ALL
    UNION ALL SELECT 'overwritten', creativeID, count(*) FROM train WHERE connectionType = 1 GROUP BY ALL""")
def store_of_changed_inputs(r: Roles) -> DataFrame:
    """One store, one table name: a filtered input and an input whose files were written anew are built again, the same one is not."""
    kept, path = store.FeatureStore(r.spark, scratch_path(r.spark, "store")), scratch_path(r.spark, "clicks")
    built = []

    def counts(clicks: DataFrame) -> DataFrame:
        def build() -> DataFrame:
            built.append(1)
            return clicks.groupBy("creativeID").agg(F.count("*").alias("n"))

        return kept.get("clicks_by_creative", build, [clicks])

    r.train.write.parquet(path)
    found = {"whole": counts(r.spark.read.parquet(path))}
    found["filtered"] = counts(r.spark.read.parquet(path).filter(F.col("label") == 1))
    counts(r.spark.read.parquet(path))
    if len(built) != 2:
        raise AssertionError(f"built {len(built)} times, not twice")
    r.train.filter(F.col("connectionType") == 1).write.mode("overwrite").parquet(path)
    r.spark.catalog.refreshByPath(path)
    found["overwritten"] = counts(r.spark.read.parquet(path))
    return reduce(DataFrame.unionByName, [df.withColumn("input", F.lit(name)) for name, df in found.items()])


@query("c03b_placed_lookup", """
    SELECT label, clickTime, c.creativeID, c.userID, u.age, u.education, p.n AS pair_clicks
    FROM train c LEFT JOIN users u USING (userID)
    LEFT JOIN (SELECT userID, creativeID, count(*) AS n FROM wide GROUP BY ALL) p ON p.userID = c.userID AND p.creativeID = c.creativeID""")
def placed_lookup(r: Roles) -> DataFrame:
    """Clicks with user and pair tables that are kept in buckets: these are never shuffled."""
    kept = store.FeatureStore(r.spark, scratch_path(r.spark, "store"))
    users = kept.get_placed("users", lambda: r.user, ["userID"], BUCKETS)
    pairs = kept.get_placed("pairs", lambda: r.wide.groupBy("userID", "creativeID").agg(F.count("*").alias("pair_clicks")),
                            ["userID", "creativeID"], BUCKETS)
    clicks = r.train.select("label", "clickTime", "creativeID", "userID")
    found = lookup_placed(clicks, users.select("userID", "age", "education"), ["userID"])
    return lookup_placed(found, pairs, ["userID", "creativeID"])


KEY = ["userID", "creativeID", "clickTime"]


def _design(r: Roles) -> DataFrame:
    path = scratch_path(r.spark, "design")
    sinks.write_design(encode_rows(r.train, dictionary(r.train, CODES), CODES, keep=[*KEY, "label"]), path, "features", "label", *KEY)
    return sinks.read_design(r.spark, path)


@query("a06_design_matrix", encoded_sql("train", CODES, ["label"]))
def design_matrix(r: Roles) -> DataFrame:
    """Rows of the matrix as they are read back."""
    return encoded_rows(_design(r), "features", "label")


@query("a07_label_column", "SELECT userID, creativeID, clickTime, label::DOUBLE AS label, count(*) AS n FROM train GROUP BY ALL")
def label_column(r: Roles) -> DataFrame:
    """Labels as they are read back, with the keys of their rows."""
    return _design(r).select(*KEY, F.col("label").cast("double").alias("label")).groupBy(*KEY, "label").agg(F.count("*").alias("n"))


@query("a08_model_file", """
    SELECT instanceID, round(p, 5) AS prob
    FROM test_ol JOIN (SELECT connectionType, avg(label) AS p FROM train GROUP BY 1) USING (connectionType)""")
def model_file(r: Roles) -> DataFrame:
    """Probabilities of a model that was saved and loaded again (conversion rates: one feature, no penalty)."""
    encoding = one_hot(r.train, ["connectionType"])
    model = logistic(0.0, 200, 1e-12).fit(apply_encoding(encoding, r.train))
    path = scratch_path(r.spark, "model")
    sinks.write_model(PipelineModel(stages=[*encoding.stages, model]), path)
    scored = score(sinks.read_model(path), r.test_ol.drop("label"))
    return rounded(scored.select("instanceID", "prob"), "prob", digits=5)


@query("a09_submission", """
    SELECT instanceID, round((creativeID + 1) / 101.0, 6) AS prob FROM test_ol""")
def submission(r: Roles) -> DataFrame:
    scored = r.test_ol.withColumn("prob", F.round((F.col("creativeID") + 1) / F.lit(101.0), 6))
    path = scratch_path(r.spark, "submission")
    sinks.write_submission(scored, path)
    return r.spark.read.schema("instanceID long, prob double").csv(path, header=True)


@query("a10_forecast_files", """
    SELECT intersection_id, tollgate_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_window_start,
           round(value, 6) AS prediction
    FROM bins""")
def forecast_files(r: Roles) -> DataFrame:
    means = bin_means(extract_series(r.trips, KEYS, "starting_time", "travel_time"), KEYS)
    path = scratch_path(r.spark, "forecast")
    sinks.write_forecast(means.select(*KEYS, F.col("ts").alias("time_window_start"), F.col("value").alias("prediction")), path)
    saved = r.spark.read.schema(
        "time_window_start timestamp_ntz, prediction double, intersection_id string, tollgate_id int").csv(path, header=True)
    return rounded(with_time_text(saved, "time_window_start"), "prediction")


SOURCES = {
    "ad": ("ad", ["creativeID", "adID", "camgaignID", "advertiserID", "appID", "appPlatform"], "creativeID"),
    "app_cat": ("app_cat", ["appID", "appCategory"], "appID"),
    "pos": ("pos", ["positionID", "sitesetID", "positionType"], "positionID"),
    "user": ("users", ["userID", "age", "gender", "education", "marriageStatus", "haveBaby", "hometown", "residence"], "userID"),
}


@query("a11_catalogue", "\nUNION ALL\n".join(
    contents_sql(name, source, columns, key) for name, (source, columns, key) in SOURCES.items()))
def catalogue(r: Roles) -> DataFrame:
    """Sources found by logical name through the catalogue of files and schemas."""
    folder = scratch_path(r.spark, "sources")
    given = {"ad": r.ad, "app_cat": r.app_cat, "pos": r.pos, "user": r.user}
    for name, df in given.items():
        store.save(df, f"{folder}/{tables.CATALOG[name].file_name}", "csv")
    return reduce(DataFrame.unionByName, [contents(name, tables.read_source(r.spark, folder, name), columns, key)
                                          for name, (_, columns, key) in SOURCES.items()])
