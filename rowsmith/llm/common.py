"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A word is a run of characters other than blank and the five ASCII line and tab controls.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_bytes(text: Column) -> Column:
    """UTF-8 length; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def running_before(df: DataFrame, key: str, value: str, name: str, width: int = 4096) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all smaller ``key``s (unique integers from 0).

    Two levels: inside stretches of ``width`` keys, then over the stretch totals, so no task sorts the whole table.
    """
    stretch = F.floor(F.col(key) / width)
    df = df.withColumn("_stretch", stretch)
    totals = df.groupBy("_stretch").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_stretch", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_stretch").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "_stretch")
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_stretch", "_start")
    )


def unit_hash(*parts: Column) -> Column:
    """Number in [0, 1) from a keyed hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
