"""Scoring and window statistics of an event stream.

Both run with ``availableNow``: they work off what has arrived and stop, and a
later call continues from the checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def event_stream(spark: SparkSession, folder: str, name: str = "events", time_col: str = "ts") -> DataFrame:
    """Files of one table as a stream, be it one file or a folder of files; the event time becomes a zoned timestamp."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp"))


def append_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that has arrived to a parquet folder, exactly once."""
    query = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def score_stream(model: Transformer, stream: DataFrame, keys, path: str, checkpoint: str) -> None:
    """Score new rows with a fitted chain of row-wise steps."""
    append_available(model.transform(stream).select(*keys, "prediction"), path, checkpoint)


def window_stats(stream: DataFrame, time_col: str, key: str, value: str, width: str, delay: str) -> DataFrame:
    """Count and mean per key and tumbling window; rows later than ``delay`` are dropped."""
    return (
        stream.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, width).alias("w"), key)
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "mean")
    )


def window_anomalies(windows: DataFrame, key: str, value: str, previous: int = 7, bound: float = 3.0) -> DataFrame:
    """Windows whose value lies more than ``bound`` deviations from the ``previous`` windows of the key.

    Works on finished windows, of which a key has one per interval.
    """
    w = Window.partitionBy(key).orderBy("start").rowsBetween(-previous, -1)
    full = F.count(value).over(w) == previous
    z = F.when(full, F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_pop(value).over(w)))
    return windows.withColumn("z", z).where(F.abs("z") > bound)
