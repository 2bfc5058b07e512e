"""Order statistics that stay distributed: ranks, running sums, exact quantiles.

A window without partitions, or an exact ``percentile`` on a hot group, pulls
its whole input into one task. Here equal values are counted first, then cut
into value buckets of near-equal row count; a running sum inside each bucket
plus the total of the buckets before it gives the position of every value.
Quantiles need the values around a few ranks only and narrow them down by
counting.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rowsmith.session import materialise

ROWS_PER_BUCKET = 1_000_000
PARTS = 1024  # of a value range, per level of the quantile search


def _bucket_count(df: DataFrame, rows: int = 0) -> int:
    """Buckets grow with the cluster and with the rows."""
    return max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BUCKET))


def _number(col: str) -> Column:
    """The column as double, NaN counting as missing."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def _octave(value: Column) -> Column:
    """A whole number that grows with the value: sign and logarithm in steps of about 6 %, 0 for 0; below 60 000 values
    cover all doubles, and the two infinities have their own."""
    size = F.abs(value)
    step = F.when(size == float("inf"), F.lit(30_000)).otherwise(F.floor(F.log(size) * F.lit(16.0)).cast("int") + 12_000)
    return F.when(value > 0, step).when(value < 0, -step).otherwise(0)


def value_positions(df: DataFrame, col: str, by=(), buckets: int | None = None) -> DataFrame:
    """Per distinct value: ``n`` rows, ``below`` rows with a smaller value, ``total`` rows.

    The values may be of any type that can be ordered. Null and NaN values and
    null group keys are left out. The counted values are dealt into ranges and
    stored with their range number, so every later branch sees the same ranges.
    """
    by = list(by)
    kept = df.where(F.col(col).isNotNull())
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        kept = kept.where(~F.isnan(col))
    for k in by:
        kept = kept.where(F.col(k).isNotNull())
    counts = kept.groupBy(*by, col).agg(F.count("*").alias("n"))
    ranges = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialise(counts.repartitionByRange(ranges, col).withColumn("__bucket", F.spark_partition_id()), "ranges")
    keys = [*by, "__bucket"]
    sums = counts.groupBy(*keys).agg(F.sum("n").alias("__bn"))
    # At most one row per range and group.
    ordered = Window.partitionBy(*by).orderBy("__bucket")
    offsets = sums.select(
        *keys,
        F.coalesce(F.sum("__bn").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__bn").over(Window.partitionBy(*by)).alias("total"),
    )
    inside = Window.partitionBy(*keys).orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("__within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return within.join(offsets, keys).select(
        *by, col, "n", (F.col("__before") + F.col("__within")).alias("below"), "total"
    )


def running_sum(df: DataFrame, value: str, order, out: str) -> DataFrame:
    """``out``: the sum of ``value`` up to and including the row, in the given order, without one sorting task."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(df.repartitionByRange(ranges, *order).withColumn("__bucket", F.spark_partition_id()), "ranges")
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("__bucket").agg(F.sum(value).alias("__bn")).select(
        "__bucket", F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn(out, F.sum(value).over(inside)).join(offsets, "__bucket").withColumn(
        out, F.col(out) + F.col("__before")).drop("__bucket", "__before")


def hash_positions(df: DataFrame, hash_col: str, tie_cols, by=(), out: str = "pos", buckets: int | None = None) -> DataFrame:
    """Zero-based position of every row by a uniform 32-bit hash, within ``by``.

    The hash is spread evenly, so its value range gives the buckets, whose
    number follows from the rows; no task holds more than one bucket of one group.
    """
    by = list(by)
    n = buckets or _bucket_count(df, df.count())
    cut = df.withColumn("__bucket", F.floor(F.col(hash_col) * F.lit(float(n)) / F.lit(4294967296.0)))
    keys = [*by, "__bucket"]
    sums = cut.groupBy(*keys).agg(F.count("*").alias("__bn"))
    ordered = Window.partitionBy(*by).orderBy("__bucket")
    offsets = sums.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("__bn").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__bn").over(Window.partitionBy(*by)).alias(f"{out}_total"),
    )
    inside = Window.partitionBy(*keys).orderBy(hash_col, *tie_cols)
    placed = cut.withColumn("__rn", F.row_number().over(inside))
    # Null-safe, so rows without a group value keep a place of their own.
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return placed.join(offsets, same).withColumn(out, F.col("__before") + F.col("__rn") - 1).drop(
        "__bucket", "__rn", "__before", *[f"__k{i}" for i in range(len(keys))])


def percent_rank_average(df: DataFrame, col: str, by=(), out: str = "pct") -> DataFrame:
    """Average rank of ties divided by the group size, for every row."""
    pos = value_positions(df, col, by).select(
        *by, col, ((F.col("below") + (F.col("n") + 1) / 2) / F.col("total")).alias(out)
    )
    return df.join(pos, [*by, col], "left")


def _targets(probs) -> list[tuple[Column, Column]]:
    """The two neighbouring zero-based ranks of every probability, from ``total``."""
    out = []
    for p in probs:
        pos = (F.col("total") - 1) * F.lit(float(p))
        out.append((F.floor(pos), F.ceil(pos)))
    return out


def _pick(probs, col: str) -> list[Column]:
    """Aggregates that interpolate linearly between the two neighbouring order statistics."""
    out = []
    for p, (lo, hi) in zip(probs, _targets(probs)):
        first = F.max(F.when((F.col("below") <= lo) & (lo < F.col("below") + F.col("n")), F.col(col)))
        second = F.max(F.when((F.col("below") <= hi) & (hi < F.col("below") + F.col("n")), F.col(col)))
        frac = F.max((F.col("total") - 1) * F.lit(float(p)) - lo)
        out.append(F.when(first == second, first).otherwise(first + (second - first) * frac))
    return out


def _holding(counted: DataFrame, group, within, bucket: str, probs) -> DataFrame:
    """Of counted buckets (n, lo, hi) those that hold a wanted rank, with the rows before them and the group's total.

    ``within`` names the columns that tell apart the buckets of the level above; their ``before`` is carried on.
    """
    order = Window.partitionBy(*group, *within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(order), F.lit(0))
    if within:
        counted = counted.withColumn("before", F.col("before") + ahead)
    else:
        counted = counted.withColumn("before", ahead).withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
    wanted = F.lit(False)
    for lo, hi in _targets(probs):
        for rank in (lo, hi):
            wanted = wanted | ((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")))
    return counted.where(wanted)


def exact_quantiles(df: DataFrame, cols, probs, by=(), buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact linear quantiles in long form: (*by, column, q array<double>), null for a column without values.

    All columns go together. Values are counted by octave (``_octave``); counts tell which octaves hold the wanted
    ranks, and these are cut between their smallest and largest value into ``buckets`` (1024) parts, level by level,
    until a part that holds a wanted rank has at most ``rows_per_bucket`` rows or a single value. Only the rows of those
    parts are then counted by value and ordered. A level is one map-side combined count; the driver learns one thing of
    it, whether another level is needed, and no value, edge or sample, so nothing there grows with the rows.
    """
    cols, by, probs, parts = list(cols), list(by), [float(p) for p in probs], float(buckets or PARTS)
    kept = df
    for k in by:
        kept = kept.where(F.col(k).isNotNull())
    values = [f"__v{i}" for i in range(len(cols))]
    kept = kept.select(*by, *[_number(c).alias(v) for c, v in zip(cols, values)])
    rows = F.array(*[F.struct(F.lit(i).alias("__c"), F.col(v).alias("__q")) for i, v in enumerate(values)])
    long = kept.select(*by, F.inline(rows)).where(F.col("__q").isNotNull()).withColumn("__octave", _octave(F.col("__q")))
    group = [*by, "__c"]
    part = [*group, "__octave", "lo", "hi", "before", "total"]
    counts = [F.count(F.lit(1)).alias("n"), F.min("__q").alias("lo"), F.max("__q").alias("hi")]

    def rows_in(targets: DataFrame) -> DataFrame:
        # A few parts per group and octave, of disjoint value ranges.
        return long.join(targets.drop("n"), [*group, "__octave"]).where(F.col("__q").between(F.col("lo"), F.col("hi")))

    first = _holding(long.groupBy(*group, "__octave").agg(*counts), group, [], "__octave", probs)
    targets = materialise(first.select(*part, "n"), "targets")
    wide = (F.col("n") > rows_per_bucket) & (F.col("lo") < F.col("hi"))
    while targets.where(wide).take(1):
        inner = rows_in(targets.where(wide))
        inner = inner.withColumn("__part", F.floor((F.col("__q") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(parts)))
        inner = inner.withColumnsRenamed({"lo": "__lo", "hi": "__hi"})
        cut = inner.groupBy(*group, "__octave", "__lo", "__hi", "before", "total", "__part").agg(*counts)
        cut = _holding(cut, group, ["__octave", "__lo", "__hi", "before", "total"], "__part", probs)
        targets = materialise(targets.where(~wide).union(cut.select(*part, "n")), "targets")
    single = F.col("lo") == F.col("hi")
    seen = [*group, "before", "total", "__q", "n"]
    counted = rows_in(targets.where(~single)).groupBy(*group, "before", "total", "__q").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(*group, "before", "total").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select(*seen, (F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("below"))
    known = targets.where(single).withColumnRenamed("lo", "__q").select(*seen, F.col("before").alias("below"))
    found = counted.union(known).groupBy(*group).agg(F.array(*_pick(probs, "__q")).alias("q"))
    groups = kept.select(*by).distinct() if by else df.sparkSession.range(1).select()
    names = F.array(*[F.struct(F.lit(i).alias("__c"), F.lit(c).alias("column")) for i, c in enumerate(cols)])
    return groups.select(*by, F.inline(names)).join(found, group, "left").select(*by, "column", "q")


def column_quantiles(df: DataFrame, cols, probs) -> dict[str, list[float]]:
    """Ungrouped exact quantiles as plain numbers: fitted state of a transformer."""
    return {r["column"]: list(r["q"]) if r["q"] else [] for r in exact_quantiles(df, cols, probs).collect()}
