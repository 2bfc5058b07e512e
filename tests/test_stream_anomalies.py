"""Anomalies inside the stream against the table of windows, over batches, restarts, late rows and silent keys."""

import datetime as dt

from pyspark.sql import functions as F

from rowsmith.streaming import anomalies as AN, events as EV

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2024, 3, 1)
SCHEMA = "ts timestamp, k string, value double"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, previous=3, bound=2.0, idle=None):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    found = AN.anomaly_stream(stream, "ts", "k", "value", "1 hour", "10 minutes", previous=previous, bound=bound, idle=idle)
    AN.append_anomalies(found, str(tmp_path / "out"), str(tmp_path / "check"))
    rows = spark.read.schema("start timestamp, end timestamp, k string, n bigint, mean double, z double").parquet(str(tmp_path / "out")).collect()
    return sorted(((r["start"], r["k"], r["n"], round(r["z"], 9)) for r in rows), key=repr)


def events(counts, key, start=START):
    """So many events in each hour."""
    return [(start + h * HOUR + dt.timedelta(seconds=10 * i), key, float(i)) for h, n in enumerate(counts) for i in range(n)]


def batch(spark, rows, previous, bound, until):
    df = spark.createDataFrame(rows, SCHEMA)
    windows = df.groupBy(F.window("ts", "1 hour").alias("w"), "k").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    windows = windows.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "k", "n", "mean").where(F.col("end") <= F.lit(until))
    out = EV.window_anomalies(windows, "k", "n", previous, bound).collect()
    return sorted(((r["start"], r["k"], r["n"], round(r["z"], 9)) for r in out), key=repr)


def test_two_batches_and_a_restart_as_one_table(spark, tmp_path):
    a = events([5, 6, 5, 30, 6, 5, 7, 1, 40, 5, 6, 5, 5, 60], "a") + events([9, 9, 9, 50, 9, 8, 7, 9, 9, 30, 1, 9, 9, 9], None)
    cut = START + 6 * HOUR + dt.timedelta(minutes=5)
    first, second = [r for r in a if r[0] < cut], [r for r in a if r[0] >= cut]
    arrive(spark, tmp_path / "in", first)
    early = run(spark, tmp_path)
    latest = max(r[0] for r in first) - dt.timedelta(minutes=10)
    assert early == batch(spark, first, 3, 2.0, latest) and early
    arrive(spark, tmp_path / "in", second)
    done = run(spark, tmp_path)
    assert done == batch(spark, a, 3, 2.0, max(r[0] for r in a) - dt.timedelta(minutes=10)) and len(done) > len(early) + 1
    assert run(spark, tmp_path) == done  # nothing new, nothing twice


def test_late_rows_and_silent_keys(spark, tmp_path):
    calm = events([5, 6, 5, 6], "a") + events([5, 6, 5, 6], "b")
    arrive(spark, tmp_path / "in", calm + events([1], "clock", START + 5 * HOUR))
    assert run(spark, tmp_path, idle=dt.timedelta(hours=20)) == []
    # Rows for windows that have ended come too late; they would make an anomaly of the first hours.
    arrive(spark, tmp_path / "in", events([90], "a", START + HOUR) + events([1], "clock", START + 8 * HOUR))
    assert run(spark, tmp_path, idle=dt.timedelta(hours=20)) == []
    # b speaks again before it is forgotten, a after: only b is judged by the windows of the past.
    arrive(spark, tmp_path / "in", events([40], "b", START + 10 * HOUR) + events([1], "clock", START + 40 * HOUR))
    got = run(spark, tmp_path, idle=dt.timedelta(hours=20))
    assert [x[:3] for x in got] == [(START + 10 * HOUR, "b", 40)]
    arrive(spark, tmp_path / "in", events([40], "a", START + 42 * HOUR) + events([1], "clock", START + 60 * HOUR))
    assert run(spark, tmp_path, idle=dt.timedelta(hours=20)) == got
