"""Projection, predicates and row cleaning."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowsmith.functions.scalar import truth

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def columns_by_dtype(df: DataFrame, kind: str) -> list[str]:
    """Column names of one kind: 'numeric', 'string' or 'time'."""
    wanted = {
        "numeric": NUMERIC,
        "string": (T.StringType,),
        "time": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def select_by_dtype(df: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    keep = columns_by_dtype(df, include) if include else df.columns
    if exclude:
        gone = set(columns_by_dtype(df, exclude))
        keep = [c for c in keep if c not in gone]
    return df.select(*keep)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*cols)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def as_category(df: DataFrame, *cols: str) -> DataFrame:
    """Turn numeric codes into text so that type-driven steps treat them as categories."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def null_shares(df: DataFrame, cols=None) -> dict[str, float]:
    """Share of missing cells per column; one pass for all columns."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]).first()
    return {c: (row[c] or 0.0) for c in cols}


def drop_sparse_columns(df: DataFrame, max_null: float = 0.35) -> DataFrame:
    """Keep the columns whose share of missing cells is below ``max_null``."""
    shares = null_shares(df)
    return df.select(*[c for c in df.columns if shares[c] < max_null])


def dropna(df: DataFrame, subset=None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def population_stats(df: DataFrame, cols) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column, all columns in one aggregation."""
    cols = list(cols)
    exprs = []
    for c in cols:
        exprs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*exprs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def z_of(col: str, stats: tuple[float | None, float | None]) -> Column:
    mean, dev = stats
    if mean is None or not dev:
        return F.lit(None).cast("double")
    return (F.col(col) - F.lit(mean)) / F.lit(dev)


def keep_within_z(df: DataFrame, col: str, bound: float) -> DataFrame:
    """Rows with ``abs(z) < bound``; z uses the population deviation."""
    return df.where(truth(F.abs(z_of(col, population_stats(df, [col])[col])) < bound))


def remove_outliers(df: DataFrame, cols, bound: float = 3.0) -> DataFrame:
    """Rows in which no listed column has ``abs(z) > bound``."""
    stats = population_stats(df, cols)
    return df.where(reduce(and_, [~truth(F.abs(z_of(c, stats[c])) > bound) for c in cols]))


def drop_row_outliers(df: DataFrame, cols, bound: float = 3.0, share: float = 0.2) -> DataFrame:
    """Drop rows in which more than ``share`` of the columns have ``abs(z) >= bound``."""
    cols = list(cols)
    stats = population_stats(df, cols)
    hits = reduce(add, [truth(F.abs(z_of(c, stats[c])) >= bound).cast("int") for c in cols])
    return df.where(~(hits / F.lit(float(len(cols))) > share))


def clip_to_fitted(df: DataFrame, fitted_on: DataFrame, source: str, target: str, out: str) -> DataFrame:
    """Clip ``source`` to the range that ``target`` has in the training frame."""
    from rowsmith.functions.scalar import clip

    low, high = fitted_on.agg(F.min(target), F.max(target)).first()
    return df.withColumn(out, clip(source, low, high))


def where_true(df: DataFrame, cond: Column) -> DataFrame:
    """Boolean-mask selection: unknown comparisons do not select the row."""
    return df.where(truth(cond))


def melt(df: DataFrame, ids, values, var_name: str = "variable", value_name: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), var_name, value_name)
