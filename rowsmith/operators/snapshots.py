"""Profiles of table snapshots that merge without reading the rows again.

A snapshot is described once, by one aggregation, as one small row per column: counts, moments, and three sketches of
fixed size (quantiles, distinct values, frequent values). Such rows can be stored, added up in any order and nested, and
read as a report of all the rows that went into them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.operators.clean import columns_by_dtype
from rowsmith.operators.stats import long_agg
from rowsmith.session import materialise

QUANTILE_SIZE = 800  # ranks are off by about 0.4 % of the rows
DISTINCT_LOG = 14  # exact up to 2 ** 14 values, then within about 2 %
TRACKED = 4096  # values followed by the frequent-value sketch; exact while a column has at most three quarters as many
STEPS = 1000  # quantiles that a histogram is read from


def column_sketches(df: DataFrame, by=(), quantile_size: int = QUANTILE_SIZE, distinct_log: int = DISTINCT_LOG,
                    tracked: int = TRACKED) -> DataFrame:
    """One row per column (and group ``by``): what ``merge_sketches`` adds up and ``sketch_report`` reads.

    NaN counts as missing. A table without rows gives columns of no rows, or no groups. Values are compared by their
    text. The sizes must be the same in all snapshots that are merged.
    """
    cols = [c for c in df.columns if c not in by]
    numeric = set(columns_by_dtype(df, "numeric"))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def present(c: str) -> Column:
        col = F.col(f"`{c}`")
        return F.when(~F.isnan(col), col) if types[c] in ("double", "float") else col

    def value(c: str) -> Column:
        return present(c).cast("double") if c in numeric else F.lit(None).cast("double")

    def frequent(c: str) -> Column:
        cell = f"nullif(`{c}`, CAST('NaN' AS {types[c]}))" if types[c] in ("double", "float") else f"`{c}`"
        return F.expr(f"approx_top_k_accumulate(CAST({cell} AS string), {int(tracked)}) FILTER (WHERE {cell} IS NOT NULL)")

    return long_agg(df, cols, {
        "dtype": lambda c: F.lit(types[c]),
        "rows": lambda c: F.count(F.lit(1)),
        "missing": lambda c: F.count_if(present(c).isNull()),
        "zeros": lambda c: F.count_if(value(c) == 0),
        "numbers": lambda c: F.count(value(c)),
        "mean": lambda c: F.avg(value(c)),
        "spread": lambda c: F.var_pop(value(c)) * F.count(value(c)),
        "low": lambda c: F.min(value(c)),
        "high": lambda c: F.max(value(c)),
        "quantiles": lambda c: F.kll_sketch_agg_double(value(c), F.lit(quantile_size)),
        "values": lambda c: F.theta_sketch_agg(F.when(present(c).isNotNull(), F.xxhash64(present(c).cast("string"))), F.lit(distinct_log)),
        "frequent": frequent,
    }, by)


def merge_sketches(*snapshots: DataFrame, quantile_size: int = QUANTILE_SIZE, distinct_log: int = DISTINCT_LOG,
                   tracked: int = TRACKED) -> DataFrame:
    """One row per column for all snapshots together, of the same form, so that it can be merged again.

    Group columns of the snapshots are summed over. A column that only some snapshots have describes their rows; one
    whose type changed carries all its types.
    """
    wanted = ["column", "dtype", "rows", "missing", "zeros", "numbers", "mean", "spread", "low", "high", "quantiles", "values", "frequent"]
    parts = reduce(DataFrame.unionByName, [s.select(*wanted) for s in snapshots])
    centre = parts.groupBy("column").agg(F.try_divide(F.sum(F.col("numbers") * F.col("mean")), F.sum("numbers")).alias("centre"))
    # Squares of distances from the common mean, never of the values: no cancellation for large means.
    both = parts.join(centre, "column")
    return both.groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_set("dtype")), " or ").alias("dtype"),
        *[F.sum(c).alias(c) for c in ("rows", "missing", "zeros", "numbers")],
        F.first("centre").alias("mean"),
        F.sum(F.col("spread") + F.col("numbers") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("spread"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles", F.lit(quantile_size)).alias("quantiles"),
        F.theta_union_agg("values", F.lit(distinct_log)).alias("values"),
        F.expr(f"approx_top_k_combine(frequent, {int(tracked)})").alias("frequent"),
    ).select(*wanted)


def sketch_report(sketches: DataFrame, bins: int = 10, top: int = 3) -> DataFrame:
    """The sketches as the long table (column, section, item, value) of ``profile_report``, without correlations.

    Counts, mean, deviation and extremes are exact. Quartiles, distinct and frequent values and histogram bins come from
    the sketches. Columns without numbers have no ``describe`` and ``histogram`` rows.
    """
    sketches = materialise(sketches, "sketches")  # one small row per column, read by every section
    some = F.col("numbers") > 0
    quartile = F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    base = sketches.withColumn("distinct", F.theta_sketch_estimate("values")).withColumn("quartile", quartile).withColumn(
        "std", F.when(F.col("numbers") > 1, F.sqrt(F.col("spread") / (F.col("numbers") - 1))))

    def section(frame: DataFrame, name: str, items: dict[str, Column]) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("item"), v.cast("string").alias("value")) for k, v in items.items()]
        return frame.select("column", F.lit(name).alias("section"), F.inline(F.array(*pairs)))

    counts = section(base, "counts", {c: F.col(c) for c in ("dtype", "rows", "missing", "zeros", "distinct")})
    numbers = base.where(some)
    moments = section(numbers, "describe", {
        "mean": F.col("mean"), "std": F.col("std"), "min": F.col("low"), "q25": F.get("quartile", F.lit(0)),
        "q50": F.get("quartile", F.lit(1)), "q75": F.get("quartile", F.lit(2)), "max": F.col("high")})
    best = F.inline(F.expr(f"approx_top_k_estimate(frequent, {int(top)})"))
    common = base.where("rows > missing").select("column", best).select(
        "column", F.lit("top").alias("section"), "item", F.col("count").cast("string").alias("value"))
    # The share of rows up to an edge, read off evenly spaced quantiles; a bin holds the difference of two shares.
    steps = F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit((i + 0.5) / STEPS) for i in range(STEPS)]))
    held = numbers.where("high > low").select("column", "numbers", "low", "high", steps.alias("steps"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))

    def upto(i: Column) -> Column:
        edge = F.col("low") + i * (F.col("high") - F.col("low")) / bins
        return F.when(i <= 0, 0.0).when(i >= bins, 1.0).otherwise(F.size(F.filter("steps", lambda v: v < edge)) / STEPS)

    share = upto(F.col("bin") + 1) - upto(F.col("bin"))
    histogram = held.select("column", F.lit("histogram").alias("section"), F.col("bin").cast("string").alias("item"),
                            F.round(share * F.col("numbers")).cast("bigint").cast("string").alias("value"))
    alerts = base.select("column", F.lit("alert").alias("section"), F.explode(F.filter(F.array(
        F.when(F.col("distinct") <= 1, F.lit("constant")),
        F.when(F.col("missing") > 0.35 * F.col("rows"), F.lit("mostly missing")),
        F.when(F.col("zeros") > 0.5 * F.col("rows"), F.lit("mostly zero")),
    ), lambda a: a.isNotNull())).alias("item")).withColumn("value", F.lit("true"))
    return reduce(DataFrame.unionByName, [counts, alerts, moments, common, histogram])
