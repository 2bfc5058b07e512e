"""Splits, folds, weights and resampling. Every choice follows from a row key and a seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from rowsmith.functions.hashing import hash_u32, uniform
from rowsmith.operators.ranks import hash_positions


def train_test_split(df: DataFrame, keys, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    u = uniform(keys, seed)
    return df.where(u < train), df.where(u >= train)


def mark_split(df: DataFrame, keys, train: float = 0.8, seed: int = 42, out: str = "part") -> DataFrame:
    return df.withColumn(out, F.when(uniform(keys, seed) < train, "train").otherwise("test"))


def temporal_split(df: DataFrame, year: str) -> tuple[DataFrame, DataFrame]:
    """The last year is the test part, everything before it the training part."""
    last = df.agg(F.max(year)).first()[0]
    return df.where(F.col(year) < F.lit(last)), df.where(F.col(year) == F.lit(last))


def sample_fraction(df: DataFrame, keys, frac: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A sampled part and its complement."""
    return train_test_split(df, keys, frac, seed)


def kfold(df: DataFrame, keys, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 by key hash; needs no shuffle."""
    return df.withColumn(out, F.floor(uniform(keys, seed) * F.lit(float(k))).cast("int"))


def stratified_kfold(df: DataFrame, label: str, keys, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds whose class counts differ by at most one."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    hashed = df.withColumn("__h", hash_u32(keys, seed))
    placed = hash_positions(hashed, "__h", keys, [label], "__pos")
    return placed.withColumn(out, (F.col("__pos") % k).cast("int")).drop("__h", "__pos", "__pos_total")


MAX_CLASSES = 10_000


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class as plain numbers; refused for a column that is no class label."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[label]: r["n"] for r in counts}


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * class count) on every row with a label; the class table may be of any size."""
    from rowsmith.operators.stats import with_group_stats

    known = df.where(F.col(label).isNotNull())
    total, classes = known.agg(F.count("*"), F.count_distinct(label)).first()
    sized = with_group_stats(df, [label], __n=F.count("*"))
    return sized.withColumn(out, F.lit(float(total)) / (F.lit(float(classes)) * F.col("__n"))).drop("__n")


LARGEST_DRAW = 16.0


def bootstrap(df: DataFrame, keys, frac: float = 1.0, seed: int = 42, out: str = "copies") -> DataFrame:
    """Sampling with replacement: each row appears a Poisson(frac) number of times.

    The count is the inverse of the Poisson distribution at the row's uniform
    number, so it needs no pass over the data and no shuffle. A large ``frac``
    is the sum of several smaller draws.
    """
    import math

    draws = max(1, math.ceil(frac / LARGEST_DRAW))
    rate, copies = frac / draws, F.lit(0)
    for d in range(draws):
        u = uniform(keys, seed + 1_000_003 * d)
        cum, term, steps = 0.0, math.exp(-rate), 0
        while cum < 1 - 1e-12:
            cum += term
            copies = copies + (u >= F.lit(cum)).cast("int")
            steps += 1
            term *= rate / steps
    counted = df.withColumn(out, copies).where(F.col(out) > 0)
    return counted.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col(out)))).drop("__i", out)


def smote(df: DataFrame, label: str, key: str, vector: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthesise rows of every smaller class until it is as large as the largest.

    Each new row lies on the segment between a row and one of its ``k`` nearest
    rows of the same class; the row's position by hash sets its share of the
    quota, and hashes of key and copy number choose neighbour and point.
    A class of a single row has no neighbour and is refused.
    Returns the columns key, label, vector (array of double), ``synthetic`` and
    ``origin``, the key of the row that a new one started from. New rows have
    keys of their own: negative numbers, or the origin's text with a number.
    """
    from rowsmith.operators.neighbours import nearest

    sizes = class_counts(df, label)
    target = max(sizes.values(), default=0)
    rows = df.select(key, label, F.col(vector).cast("array<double>").alias(vector))
    whole = rows.withColumn("synthetic", F.lit(False)).withColumn("origin", F.col(key))
    alone = sorted(str(c) for c, n in sizes.items() if n < 2 <= target)
    if alone:
        raise ValueError(f"{label}: classes of a single row cannot be oversampled: {', '.join(alone)}")
    grow = {c: n for c, n in sizes.items() if n < target}
    if not grow:
        return whole
    part = rows.where(F.col(label).isin(list(grow)))
    near = nearest(part, part, key, vector, k, exclude_self=True, within=label)
    # At most k entries per row.
    options = near.groupBy("query_key").agg(F.array_sort(F.collect_list(F.struct("rank", "ref_key"))).alias("__near"))

    def per_class(fn):
        out = F.lit(None).cast("bigint")
        for c, n in grow.items():
            out = F.when(F.col(label) == F.lit(c), F.lit(fn(n))).otherwise(out)
        return out

    placed = hash_positions(part.withColumn("__h", hash_u32(key, seed)), "__h", [key], [label], "__pos")
    quota = per_class(lambda n: (target - n) // n) + (F.col("__pos") < per_class(lambda n: (target - n) % n)).cast("int")
    copies = (
        placed.withColumn("__q", quota).where(F.col("__q") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__q"))))
        .join(options, F.col(key) == F.col("query_key"))
        .withColumn("__pick", F.floor(uniform([key, "__copy"], seed + 1) * F.size("__near")).cast("int"))
        .withColumn("__gap", uniform([key, "__copy"], seed + 2))
        .withColumn("__other", F.get(F.col("__near"), F.col("__pick"))["ref_key"])
        .select(key, label, "__copy", F.col(vector).alias("__a"), "__other", "__gap")
    )
    ends = part.select(F.col(key).alias("__other"), F.col(vector).alias("__b"))
    numeric = isinstance(df.schema[key].dataType, T.IntegralType)
    own = -F.abs(F.shiftright(F.xxhash64(key, "__copy"), 2)) - 1 if numeric else F.concat_ws("#", F.col(key).cast("string"), "__copy")
    made = copies.join(ends, "__other").select(
        own.cast("bigint" if numeric else "string").alias(key), F.col(label),
        F.zip_with("__a", "__b", lambda a, b: a + F.col("__gap") * (b - a)).alias(vector),
        F.lit(True).alias("synthetic"), F.col(key).alias("origin"),
    )
    return whole.withColumn(key, F.col(key).cast("bigint" if numeric else "string")).unionByName(made)
