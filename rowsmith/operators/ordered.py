"""Operators that need an explicit order: sorts, positions, cumulative curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rowsmith.operators.ranks import percent_rank_average, running_sum, value_positions

__all__ = ["cumulative_share", "elbow", "factorize", "first_reaching", "last_rows_split",
           "percent_rank_average", "sort_rank", "top_n"]

def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sort_rank(df: DataFrame, col: str, out: str = "pos", descending: bool = False) -> DataFrame:
    """Sort position made visible: rank of the row's value, ties sharing the lowest."""
    pos = value_positions(df, col)
    rank = (F.col("total") - F.col("below") - F.col("n") + 1) if descending else (F.col("below") + 1)
    return df.join(pos.select(col, rank.alias(out)), col, "left")


def cumulative_share(curve: DataFrame, value: str, order, out: str = "cumulative") -> DataFrame:
    """Running share of the total along an ordered curve of any length."""
    whole = curve.agg(F.sum(value)).first()[0]
    return running_sum(curve, value, order, out).withColumn(out, F.try_divide(F.col(out), F.lit(whole)))


def first_reaching(curve: DataFrame, cumulative: str, position: str, threshold: float, zero_based: bool = False) -> DataFrame:
    """Smallest number of points whose cumulative value reaches the threshold.

    ``zero_based`` returns the index of that point instead of the count.
    ``position`` counts from 1.
    """
    hit = F.min(F.when(F.col(cumulative) >= threshold, F.col(position)))
    return curve.agg((hit - 1 if zero_based else hit).alias("components"))


def last_rows_split(df: DataFrame, order: str, n: int, series: str = "series") -> DataFrame:
    """Mark the last ``n`` rows per series (by a bounded daily index) as the test part."""
    w = Window.partitionBy(series).orderBy(F.col(order).desc())
    return df.withColumn("part", F.when(F.row_number().over(w) <= n, "test").otherwise("train"))


def factorize(df: DataFrame, col: str, order_by: str, out: str = "code") -> DataFrame:
    """Integer codes in order of first appearance; a missing value gets -1."""
    first = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(order_by).alias("__first"))
    codes = first.join(value_positions(first, "__first").select("__first", "below"), "__first")
    codes = codes.select(col, F.col("below").alias(out))
    return df.join(codes, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)))


def elbow(curve: DataFrame, x: str, y: str) -> DataFrame:
    """Knee of a convex decreasing curve (one row per tried x): the x of the largest gap below the chord.

    Both axes are scaled to [0, 1], the falling curve is turned upside down, and
    the first local maximum of its distance from the diagonal is returned.
    """
    whole = Window.partitionBy()
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    nx = F.try_divide(xs - F.min(xs).over(whole), F.max(xs).over(whole) - F.min(xs).over(whole))
    ny = F.try_divide(F.max(ys).over(whole) - ys, F.max(ys).over(whole) - F.min(ys).over(whole))
    gap = curve.select(x, y, (ny - nx).alias("gap"))
    w = Window.orderBy(x)
    peaks = gap.withColumn("prev", F.lag("gap").over(w)).withColumn("next", F.lead("gap").over(w))
    peak = (F.col("gap") >= F.col("prev")) & (F.col("gap") >= F.col("next"))
    return peaks.where(peak).agg(F.min(x).alias("elbow"))
