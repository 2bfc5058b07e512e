"""Joins and set operations.

No broadcast hints: lookups may be as large as the number of distinct keys, so
the planner decides from measured sizes and splits hot keys at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def lookup(df: DataFrame, table: DataFrame, keys) -> DataFrame:
    """Left join to a lookup with at most one row per key; unseen keys give NULL."""
    return df.join(table.dropDuplicates(list(keys)), list(keys), "left")


def aligned(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Put columns of two frames side by side by row key."""
    return left.join(right, key, "inner")


def without(df: DataFrame, gone: DataFrame, key) -> DataFrame:
    """Rows whose key is not in ``gone``."""
    return df.join(gone, key, "left_anti")


def only_in(df: DataFrame, wanted: DataFrame, key) -> DataFrame:
    """Rows whose key is in ``wanted``."""
    return df.join(wanted, key, "left_semi")


def stack_rows(*frames: DataFrame, label: str | None = None, names=None) -> DataFrame:
    """Union by column name, optionally with a column telling the frame of origin."""
    if label:
        frames = tuple(f.withColumn(label, F.lit(n)) for f, n in zip(frames, names or range(len(frames))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are absent from ``b``."""
    return a.subtract(b)


def distinct_rows(df: DataFrame, subset=None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()
