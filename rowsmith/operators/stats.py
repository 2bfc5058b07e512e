"""Aggregation, profiling and reshaping."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.operators.clean import columns_by_dtype
from rowsmith.operators.ranks import exact_quantiles
from rowsmith.session import materialise

FUNCS = {
    "count": F.count, "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max,
    "std": F.stddev_samp, "nunique": F.count_distinct,
}


def present(df: DataFrame, keys) -> DataFrame:
    """Groups with a missing key are left out."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def long_agg(df: DataFrame, cols, stats: dict, by=()) -> DataFrame:
    """One aggregation over all columns, one output row per (group, column)."""
    cols, by = list(cols), list(by)
    exprs = [f(c).alias(f"{name}__{i}") for i, c in enumerate(cols) for name, f in stats.items()]
    wide = present(df, by).groupBy(*by).agg(*exprs)
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}__{i}").alias(name) for name in stats])
        for i, c in enumerate(cols)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def total(df: DataFrame, col: str, *stats: str) -> DataFrame:
    return df.agg(*[FUNCS[s](col).alias(s) for s in stats])


def group_agg(df: DataFrame, keys, spec: dict[str, str | list[str]]) -> DataFrame:
    """``{column: function or list of functions}`` per group, named ``column_function``.

    The median is exact; every other function combines on the map side.
    """
    keys = list(keys)
    pairs = [(c, f) for c, fs in spec.items() for f in ([fs] if isinstance(fs, str) else fs)]
    plain = [FUNCS[f](c).alias(f"{c}_{f}") for c, f in pairs if f != "median"]
    medians = [c for c, f in pairs if f == "median"]
    out = present(df, keys).groupBy(*keys).agg(*plain) if plain else None
    if medians:
        med = group_median(df, keys, medians)
        out = med if out is None else out.join(med, keys)
    return out.select(*keys, *[f"{c}_{f}" for c, f in pairs])


def group_median(df: DataFrame, keys, cols=None, suffix: str = "_median") -> DataFrame:
    """Exact median of every numeric column per group."""
    keys = list(keys)
    cols = list(cols or [c for c in columns_by_dtype(df, "numeric") if c not in keys])
    q = exact_quantiles(df, cols, [0.5], keys)
    return q.groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == c, F.get("q", 0))).alias(f"{c}{suffix}") for c in cols]
    )


def describe(df: DataFrame, cols, by=()) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max per column and group."""
    by = list(by)
    moments = long_agg(df, cols, {"count": F.count, "mean": F.avg, "std": F.stddev_samp,
                                  "min": lambda c: F.min(F.col(c).cast("double")),
                                  "max": lambda c: F.max(F.col(c).cast("double"))}, by)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by)
    return moments.join(q, [*by, "column"], "left").select(
        *by, "column", "count", "mean", "std", "min",
        F.get("q", 0).alias("q25"), F.get("q", 1).alias("q50"), F.get("q", 2).alias("q75"), "max",
    )


def null_profile(df: DataFrame, cols=None, by=()) -> DataFrame:
    """Missing cells per column: count and share."""
    cols = [c for c in (cols or df.columns) if c not in by]
    return long_agg(df, cols, {
        "nulls": lambda c: F.count_if(F.col(c).isNull()),
        "share": lambda c: F.avg(F.col(c).isNull().cast("double")),
    }, by)


def table_info(df: DataFrame) -> DataFrame:
    """Column name, type, non-null count and row count."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return long_agg(df, df.columns, {
        "dtype": lambda c: F.lit(types[c]),
        "non_null": F.count,
        "rows": lambda c: F.count(F.lit(1)),
    })


def distinct_counts(df: DataFrame, cols, approximate: bool = False) -> DataFrame:
    """Distinct values per column; exact counts come from one table of (column, value), combined before the shuffle."""
    cols = list(cols)
    if approximate:
        return long_agg(df, cols, {"nunique": F.approx_count_distinct})
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("place"), F.xxhash64(F.col(c)).alias("k"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])))
    found = long.where(F.col("value").isNotNull()).distinct().groupBy("place").agg(F.count("*").alias("nunique"))
    all_cols = df.sparkSession.createDataFrame(list(enumerate(cols)), "place int, column string")
    return all_cols.join(found, "place", "left").select("column", F.coalesce("nunique", F.lit(0)).cast("bigint").alias("nunique"))


def first_values(df: DataFrame, cols, n: int = 5) -> DataFrame:
    """The ``n`` smallest distinct values of each column, a missing value counting as one.

    The rank filter becomes a partial top-n before the shuffle, so one column's
    values never gather whole in a task.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("e")).select("e.*").distinct()
    order = Window.partitionBy("column").orderBy(F.col("value").asc_nulls_last())
    return long.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= n)


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Rows per value; with ``normalize`` also their share."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    if not normalize:
        return counts
    rows = df.where(F.col(col).isNotNull()).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / rows.scalar())


def skewness(df: DataFrame, cols) -> DataFrame:
    """Bias-corrected sample skewness per column."""

    def corrected(c):
        n = F.count(c).cast("double")
        return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))

    return long_agg(df, cols, {"skew": corrected})


def correlations(df: DataFrame, cols, absolute: bool = False) -> DataFrame:
    """Pearson correlation of every column pair (upper triangle) in one aggregation."""
    pairs = list(combinations(cols, 2))
    exprs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        c = F.corr(F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double")))
        exprs.append((F.abs(c) if absolute else c).alias(f"c{i}"))
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)]
    return df.agg(*exprs).select(F.inline(F.array(*rows)))


def correlated_columns(df: DataFrame, cols, threshold: float = 0.9) -> list[str]:
    """Columns to drop so that no remaining pair correlates above the threshold.

    Walks the pairs from the strongest down and drops the later-listed column.
    """
    pairs = sorted((r for r in correlations(df, cols, absolute=True).collect() if r["corr"] is not None),
                   key=lambda r: (-r["corr"], r["a"], r["b"]))
    gone: list[str] = []
    for r in pairs:
        if r["corr"] > threshold and r["a"] not in gone and r["b"] not in gone:
            gone.append(r["b"])
    return gone


def with_group_stats(df: DataFrame, keys, **stats: Column) -> DataFrame:
    """Attach per-group aggregates to every row of the group.

    A grouped aggregation (combined map-side) joined back, not a window, so a
    hot key never fills one task. The group table is stored first: the planner
    then knows its size, broadcasts it when small (the rows are not shuffled at
    all) and otherwise joins with skew handling.
    """
    keys = list(keys)
    table = present(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(materialise(table, "groups"), keys, "left")


def group_frequency(df: DataFrame, key: str, out: str = "freq") -> DataFrame:
    """Share of all rows that carry the row's key."""
    rows = df.agg(F.count("*").cast("double").alias("n"))
    sized = with_group_stats(df, [key], __n=F.count("*"))
    return sized.withColumn(out, F.col("__n") / rows.scalar()).drop("__n")


def group_apply(df: DataFrame, keys, stats: dict[str, Column], outputs: dict[str, Column]) -> DataFrame:
    """Per-group arithmetic: compute aggregates per group, then row expressions over them."""
    return with_group_stats(df, keys, **stats).withColumns(outputs).drop(*stats)


def group_apply_pandas(df: DataFrame, keys, fn, schema, max_group_rows: int = 1_000_000) -> DataFrame:
    """A user function over whole groups, for what column expressions cannot say.

    The largest group is measured first; above the bound the call is refused,
    since one group has to fit in one Python worker.
    """
    keys = list(keys)
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest > max_group_rows:
        raise ValueError(f"a group of {largest} rows exceeds {max_group_rows}; use group_apply instead")
    return df.groupBy(*keys).applyInPandas(fn, schema)


def pivot_table(df: DataFrame, index, columns: str, values, agg: Column, fill=None) -> DataFrame:
    """Group rows by ``index`` and spread ``columns`` over the given values."""
    out = present(df, index).groupBy(*index).pivot(columns, list(values)).agg(agg)
    return out if fill is None else out.na.fill(fill, subset=[str(v) for v in values])


def pivot_values(df: DataFrame, col: str, bound: int = 1000) -> list:
    """Sorted distinct values of a pivot column, refused above ``bound``."""
    rows = df.where(F.col(col).isNotNull()).select(col).distinct().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{col} has more than {bound} values")
    return sorted(r[0] for r in rows)


def crosstab(df: DataFrame, a: str, b: str, values=None) -> DataFrame:
    """Counts of every (a, b) combination, zero where absent."""
    values = list(values) if values is not None else pivot_values(df, b)
    return present(df, [a, b]).groupBy(a).pivot(b, values).count().na.fill(0)


def mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value; the smallest one wins a tie."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col(col).alias("v")))
    return value_counts(df, col).agg(best.alias("b")).select(F.col("b.v").alias(col), (-F.col("b.neg")).alias("n"))


def modes(df: DataFrame, cols) -> dict:
    """Most frequent value of several columns as plain values (fitted state)."""
    parts = [mode(df, c).select(F.lit(c).alias("column"), F.to_json(F.struct(F.col(c).alias("v"))).alias("v")) for c in cols]
    import json

    return {r["column"]: json.loads(r["v"]).get("v") for r in reduce(DataFrame.unionByName, parts).collect()}


def histograms(df: DataFrame, cols, bins: int) -> DataFrame:
    """Equal-width bin counts of several columns in two passes; a column's last bin includes its maximum.

    Empty bins stay, with zero; a column without values has no bins.
    """
    cols = list(cols)
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    bounds = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    span = {c: (bounds[f"lo{i}"], (bounds[f"hi{i}"] - bounds[f"lo{i}"]) / bins or 1.0) for i, c in enumerate(cols) if bounds[f"lo{i}"] is not None}
    schema = "column string, low double, width double"
    if not span:
        return df.sparkSession.createDataFrame([], "column string, bin bigint, low double, high double, n bigint")
    spots = [F.struct(F.lit(c).alias("column"), F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint").alias("bin"))
             for c, (low, width) in span.items()]
    counts = df.select(F.inline(F.array(*spots))).where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count("*").alias("n"))
    edges = df.sparkSession.createDataFrame([(c, low, width) for c, (low, width) in span.items()], schema)
    grid = edges.select("column", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"), "low", "width").select(
        "column", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("low"), (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("high"))
    return grid.join(counts, ["column", "bin"], "left").na.fill(0, subset=["n"])


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bin counts; the last bin includes the maximum. Empty bins stay, with zero."""
    return histograms(df, [col], bins).drop("column")


def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Quartiles and whiskers (last value within 1.5 IQR of the box) per group."""
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], [by]).select(
        by, F.get("q", 0).alias("q1"), F.get("q", 1).alias("med"), F.get("q", 2).alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.when((F.col(col) >= F.col("q1") - reach) & (F.col(col) <= F.col("q3") + reach), F.col(col))
    return (
        df.select(by, col).join(materialise(q, "quartiles"), by)
        .groupBy(by, "q1", "med", "q3")
        .agg(F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))
    )


def kde(df: DataFrame, col: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density on an even grid (Scott bandwidth); no rows for fewer than two different values.

    Every grid point is one sum in a single aggregation: each task reduces its
    rows to ``points`` numbers, nothing is multiplied out.
    """
    n, dev, low, high = df.agg(F.count(col), F.stddev_samp(col), F.min(col), F.max(col)).first()
    if not dev:  # fewer than two different values have no density
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    h = dev * n ** (-0.2)
    step = (high - low) / (points - 1)
    grid = [low + i * step for i in range(points)]
    norm = n * h * math.sqrt(2 * math.pi)
    sums = [F.sum(F.exp(-0.5 * F.pow((F.col(col) - F.lit(g)) / F.lit(h), 2))).alias(f"p{i}") for i, g in enumerate(grid)]
    rows = [F.struct(F.lit(i).alias("i"), F.lit(g).alias("x"), (F.col(f"p{i}") / F.lit(norm)).alias("density"))
            for i, g in enumerate(grid)]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def profile_report(df: DataFrame, bins: int = 10, top: int = 3) -> DataFrame:
    """One long table (column, section, item, value) describing every column.

    Sections: type, counts, numeric moments and quartiles, top values,
    histogram bins, correlations and alerts.
    """
    numeric = columns_by_dtype(df, "numeric")
    out = []

    def section(frame: DataFrame, name: str, items: list[str]):
        rows = F.array(*[F.struct(F.lit(i).alias("item"), F.col(i).cast("string").alias("value")) for i in items])
        out.append(frame.select("column", F.lit(name).alias("section"), F.inline(rows)))

    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = long_agg(df, df.columns, {
        "dtype": lambda c: F.lit(types[c]),
        "rows": lambda c: F.count(F.lit(1)),
        "missing": lambda c: F.count_if(F.col(c).isNull()),
        "zeros": lambda c: F.count_if(F.col(c) == 0) if c in numeric else F.lit(0).cast("bigint"),
    })
    # Every (column, value) once, counted: distinct values and the most frequent ones both come from it.
    cells = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("item")) for c in df.columns])))
    values = materialise(cells.where(F.col("item").isNotNull()).groupBy("column", "item").agg(F.count("*").alias("n")), "values")
    distinct = values.groupBy("column").agg(F.count("*").alias("distinct"))
    base = counts.join(distinct, "column", "left").na.fill(0, subset=["distinct"])
    section(base, "counts", ["dtype", "rows", "missing", "zeros", "distinct"])
    alerts = base.select("column", F.lit("alert").alias("section"), F.explode(F.filter(F.array(
        F.when(F.col("distinct") <= 1, F.lit("constant")),
        F.when(F.col("distinct") == F.col("rows"), F.lit("unique")),
        F.when(F.col("missing") > 0.35 * F.col("rows"), F.lit("mostly missing")),
        F.when(F.col("zeros") > 0.5 * F.col("rows"), F.lit("mostly zero")),
    ), lambda a: a.isNotNull())).alias("item")).withColumn("value", F.lit("true"))
    out.append(alerts)
    if numeric:
        section(describe(df, numeric), "describe", ["mean", "std", "min", "q25", "q50", "q75", "max"])
        section(skewness(df, numeric), "shape", ["skew"])
    order = Window.partitionBy("column").orderBy(F.desc("n"), "item")
    ranked = values.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    out.append(ranked.select("column", F.lit("top").alias("section"), "item", F.col("n").cast("string").alias("value")))
    if numeric:
        out.append(histograms(df, numeric, bins).select(
            "column", F.lit("histogram").alias("section"), F.col("bin").cast("string").alias("item"), F.col("n").cast("string").alias("value")))
    if len(numeric) > 1:
        out.append(correlations(df, numeric).select(F.col("a").alias("column"), F.lit("correlation").alias("section"),
                                                    F.col("b").alias("item"), F.col("corr").cast("string").alias("value")))
    return reduce(DataFrame.unionByName, out)
