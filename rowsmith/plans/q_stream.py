"""The event table read as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.models.linear import least_squares
from rowsmith.plans.registry import query
from rowsmith.session import scratch_path
from rowsmith.sources.tables import table
from rowsmith.streaming import anomalies as AN, events as EV

WINDOWS = """w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, avg(value) AS mean FROM events GROUP BY ALL
    HAVING time_bucket(INTERVAL 1 HOUR, any_value(ts)) + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 10 MINUTE)"""


def finished_windows(spark, sf):
    stream = EV.event_stream(spark, sf)
    out, check = scratch_path(spark, "windows"), scratch_path(spark, "check")
    EV.append_available(EV.window_stats(stream, "ts", "event_type", "value", "1 hour", "10 minutes"), out, check)
    return spark.read.parquet(out)


@query("stream_windows", f"WITH {WINDOWS} SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, n, round(mean, 9) AS mean FROM w")
def stream_windows(spark, sf):
    out = finished_windows(spark, sf)
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("mean", 9).alias("mean"))


ANOMALIES = f"""
    WITH {WINDOWS}, z AS (SELECT *, count(n) OVER p AS c, avg(n) OVER p AS m, stddev_pop(n) OVER p AS s FROM w
      WINDOW p AS (PARTITION BY event_type ORDER BY start ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, n, round((n - m) / s, 5) AS z FROM z WHERE c = 7 AND s > 0 AND abs((n - m) / s) > 2"""


@query("stream_anomalies", ANOMALIES)
def stream_anomalies(spark, sf):
    out = EV.window_anomalies(finished_windows(spark, sf), "event_type", "n", 7, 2.0)
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("z", 5).alias("z"))


@query("stream_state_anomalies", ANOMALIES)
def stream_state_anomalies(spark, sf):
    """The same anomalies found inside the stream, from the last seven windows in the state of each key."""
    out, check = scratch_path(spark, "anomalies"), scratch_path(spark, "check")
    found = AN.anomaly_stream(EV.event_stream(spark, sf), "ts", "event_type", "value", "1 hour", "10 minutes", previous=7, bound=2.0)
    AN.append_anomalies(found, out, check)
    return spark.read.parquet(out).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("z", 5).alias("z"))


@query("stream_scores", """
    SELECT event_id, round(regr.a + regr.b * user_id, 5) AS prediction FROM events,
      (SELECT regr_slope(value, user_id) AS b, regr_intercept(value, user_id) AS a FROM events) regr""")
def stream_scores(spark, sf):
    """Every event of the stream scored by a model fitted on the stored table."""
    model = least_squares(["user_id"], "value").fit(table(spark, sf, "events"))
    out, check = scratch_path(spark, "scores"), scratch_path(spark, "check")
    EV.score_stream(model, EV.event_stream(spark, sf), ["event_id"], out, check)
    return spark.read.parquet(out).select("event_id", F.round("prediction", 5).alias("prediction"))
