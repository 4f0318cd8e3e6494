"""Windowed aggregates over a growing folder."""

import datetime as dt

from pyspark.sql import functions as F

from clickloom.streaming.windows import WindowedStream


def at(minutes):
    return dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minutes)


def stream_over(spark, tmp_path, schema):
    return WindowedStream(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "state"), ["k"],
                          [F.sum("v").alias("total"), F.count("*").alias("n")], lambda df: df, "20 minutes", "30 minutes", files_at_once=1)


def rows_of(df):
    return sorted((r.k, r.ts.hour * 60 + r.ts.minute, r.total, r.n) for r in df.collect())


def test_windows_close_behind_the_watermark_and_state_outlives_a_run(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.createDataFrame([], "k string, time timestamp, v long").schema
    stream = stream_over(spark, tmp_path, schema)

    def add(*rows):
        spark.createDataFrame([(k, at(m), v) for k, m, v in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    add(("a", 1, 1), ("a", 19, 2), ("b", 25, 3))
    stream.run()
    assert rows_of(stream.written()) == []                     # the watermark stands at minute -5
    add(("a", 5, 10), ("a", 61, 4))                            # the first is late, but not too late
    stream.run()
    assert rows_of(stream.written()) == [("a", 0, 13, 3)]      # minute 31: the first window is closed, those of b and later are not
    add(("a", 2, 100), ("b", 70, 5))                           # too late: its window is written
    stream.run()
    closed = stream.close(spark.createDataFrame([(None, at(10_000), 0)], schema))
    assert rows_of(closed) == [("a", 0, 13, 3), ("a", 60, 4, 1), ("b", 20, 3, 1), ("b", 60, 5, 1)]
    stream.run()                                               # nothing new: nothing is written twice
    assert stream.written().count() == 4
