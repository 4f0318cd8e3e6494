"""Readers, store and sinks."""

import glob
import gzip

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.session import pin, scratch_path, shared_dir
from clickloom.sources import sinks, store, tables


def test_empty_csv_fields_are_null(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("label,clickTime,conversionTime,creativeID,userID,positionID,connectionType,telecomsOperator\n"
                    "1,170000,180000,1,2,3,1,0\n0,170001,,1,2,3,1,0\n")
    rows = tables.read_source(spark, str(tmp_path), "train").orderBy("clickTime").collect()
    assert [r.conversionTime for r in rows] == [180000, None]


def test_catalogue_is_complete():
    assert set(tables.CATALOG) >= {"ad", "app_cat", "pos", "test_ol", "train", "action", "user", "user_app",
                                   "trajectories", "weather"}
    names = [f.name for f in schemas.AD.fields]
    assert names == ["creativeID", "adID", "camgaignID", "advertiserID", "appID", "appPlatform"]


def test_travel_time_sources(spark, tmp_path):
    (tmp_path / "trajectories(table 5)_training.csv").write_text(
        "intersection_id,tollgate_id,starting_time,travel_time\nB,3,2016-07-19 00:14:24,70.85\n")
    (tmp_path / "weather (table 7)_training.csv").write_text(
        "date,hour,pressure,sea_pressure,wind_direction,wind_speed,temperature,rel_humidity,precipitation\n"
        "2016-07-19,3,1000.4,1005.3,225,2.1,26.4,94,0\n")
    trip = tables.read_source(spark, str(tmp_path), "trajectories").first()
    assert trip.travel_time == 70.85 and trip.starting_time.minute == 14
    assert tables.read_source(spark, str(tmp_path), "weather").first().pressure == 1000.4


def test_ingest_sources_skips_what_is_there(spark, tmp_path):
    (tmp_path / "position.csv").write_text("positionID,sitesetID,positionType\n1,0,3\n")
    kept = store.FeatureStore(spark, str(tmp_path / "store"))
    tables.ingest_sources(spark, str(tmp_path), kept, ["pos"])
    (tmp_path / "position.csv").unlink()
    tables.ingest_sources(spark, str(tmp_path), kept, ["pos"])
    assert kept.get("pos", None).count() == 1


def test_store_computes_once_and_forgets(spark, tmp_path):
    kept, calls = store.FeatureStore(spark, str(tmp_path)), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert kept.get("t", build).count() == 3 and kept.get("t", build).count() == 3
    assert len(calls) == 1
    assert kept.drop("t") and not kept.has("t") and not kept.drop("t")
    kept.get("t", build)
    assert len(calls) == 2


def test_unfinished_tables_are_redone(spark, tmp_path):
    kept = store.FeatureStore(spark, str(tmp_path))
    kept.put("t", spark.range(3))
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert kept.get("t", lambda: spark.range(5)).count() == 5


def test_unknown_kind_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        store.save(spark.range(1), str(tmp_path / "x"), "h5")


def test_submission_is_sorted_and_compressed(spark, tmp_path):
    scored = spark.range(100).select((F.lit(100) - F.col("id")).alias("instanceID"), F.lit(0.5).alias("prob"))
    sinks.write_submission(scored, str(tmp_path / "s"))
    lines = []
    for part in sorted(glob.glob(str(tmp_path / "s" / "*.csv.gz"))):
        with gzip.open(part, "rt") as f:
            rows = f.read().splitlines()
        assert rows[0] == "instanceID,prob"
        lines += [int(r.split(",")[0]) for r in rows[1:]]
    assert lines == list(range(1, 101))


def test_pin_reads_back_the_same_rows_from_the_shared_folder(spark):
    df = pin(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert "LocalTableScan" not in df._jdf.queryExecution().toString()


class _Context:
    folder, master = None, "local[4]"

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, configured):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = _Context()


def test_shared_folder_is_the_configured_one():
    session = _Session("hdfs://shared/checkpoints")
    assert shared_dir(session) == "hdfs://shared/checkpoints"
    assert session.sparkContext.folder is None


def test_shared_folder_is_made_only_where_none_is_set():
    session = _Session(None)
    first = shared_dir(session)
    assert first == shared_dir(session) == session.sparkContext.folder


def test_a_cluster_must_name_its_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        session = _Session(None)
        session.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session)


def test_store_notices_filtered_and_overwritten_inputs(spark, tmp_path):
    kept, path, built = store.FeatureStore(spark, str(tmp_path / "store")), str(tmp_path / "in"), []
    spark.range(100).withColumn("v", F.col("id") % 7).write.parquet(path)

    def get(df):
        return kept.get("t", lambda: built.append(1) or df.select("id"), [df]).count()

    read = lambda: spark.read.parquet(path)
    assert get(read()) == 100 and get(read().filter("id < 10")) == 10 and get(read().filter("id < 11")) == 11
    assert get(read()) == 100 and get(read().filter("id < 10")) == 10 and len(built) == 3
    assert get(read().select("id", (F.col("v") + 1).alias("v"))) == 100 and len(built) == 4
    spark.range(5).withColumn("v", F.col("id")).write.mode("overwrite").parquet(path)
    assert get(read()) == 5 and len(built) == 5
    listed = kept.inputs("t", [read()])["inputs"][0]["files"]
    assert all(len(f) == 3 and f[1] > 0 for f in listed) and kept.inputs("absent", [read()]) is None


def test_marks_do_not_depend_on_the_session(spark, tmp_path):
    """Only tables read from files are found again by another session; rows of the driver carry a mark of their own."""
    path = str(tmp_path / "in")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path).filter("id > 3").groupBy("id").count()
    assert "#" not in store.plan_text(df).replace("none#", "").replace("#0", "") or store.plan_text(df) == store.plan_text(
        spark.newSession().read.parquet(path).filter("id > 3").groupBy("id").count())
    one, two = (spark.createDataFrame([(i,)], "a int") for i in (1, 2))
    assert store.variant("t", [one]) != store.variant("t", [two])


def test_placed_tables_are_not_shuffled(spark, conf, tmp_path):
    """Clicks meet stored user and pair tables in their buckets: no exchange on their side, also after another session registered them."""
    from clickloom.operators.joins import lookup_placed

    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="8")
    kept = store.FeatureStore(spark, str(tmp_path / "store"))
    users = spark.range(500).select(F.col("id").alias("user"), (F.col("id") * 2).alias("age"))
    first = kept.get_placed("users", lambda: users, ["user"], 8)
    spark.sql(f"DROP TABLE {store._table_of(kept.path(store.variant('users', placed=[['user'], 8])))}")
    again = kept.get_placed("users", lambda: None, ["user"], 8)          # stored: not built again, registered again
    assert again.count() == 500 and first.columns == again.columns
    clicks = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 600).when(F.col("id") % 2 > 0, 77).alias("user"), "id")
    got = lookup_placed(clicks, again, ["user"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "Bucketed: true" in plan
    want = {r.id: r.user * 2 if r.user is not None and r.user < 500 else None for r in clicks.collect()}
    assert {r.id: r.age for r in got.collect()} == want and got.count() == 3000
    other = kept.get_placed("pairs", lambda: users.withColumn("n", F.lit(1)).drop("age"), ["user"], 8)
    both = again.join(other, "user")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in both


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    schema = schemas.AD
    header = ",".join(schema.names)
    lines = ["1,2,3,4,5,1", "x,2,3,4,5,1", "1,2,3", "1,2,3,4,5,1,9", "2,,,,,", '3,"4",5,6,7,2']
    (tmp_path / "ad.csv").write_text("\n".join([header, *lines]) + "\n")
    good, bad = tables.read_checked(spark, str(tmp_path / "ad.csv"), schema)
    assert sorted(r.creativeID for r in good.collect()) == [1, 2, 3] and good.schema == schema
    assert sorted(r.rejected_line for r in bad.collect()) == sorted(lines[1:4]) and {r.rejected_in for r in bad.collect()} == {"ad.csv"}
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_checked(spark, str(tmp_path / "other.csv"), schema)
    (tmp_path / "empty.csv").write_text(header + "\n")
    good, bad = tables.read_checked(spark, str(tmp_path / "empty.csv"), schema)
    assert good.count() == bad.count() == 0
