"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rowsmith.functions.hashing import hash_u32

# The tables of the test data directory.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; NaN is NULL from here on."""
    return nan_to_null(spark.read.parquet(f"{folder}/{name}.parquet"))


def load_tables(spark: SparkSession, folder: str, names=None) -> dict[str, DataFrame]:
    """A keyed bag of tables stored side by side in one folder."""
    return {n: table(spark, folder, n) for n in (names or TABLES)}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing floats are NULL from here on; aggregates then skip them."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[
        F.when(F.isnan(F.col(f"`{c}`")), None).otherwise(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`")
        for c in df.columns
    ])


def plain_names(df: DataFrame) -> DataFrame:
    """Dots in column names become underscores; the operators refer to columns by plain name."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


# Cells that mean a missing value in CSV files.
NULL_TOKENS = ("", "NA", "N/A", "NaN", "nan", "null", "NULL")


def read_csv(spark: SparkSession, path: str, schema=None, sep: str = ",", nulls=NULL_TOKENS, multiline: bool = False,
             partitions: int | None = None, malformed: str | None = None, **options) -> DataFrame:
    """CSV with a header, doubled quotes and missing-value tokens. A ``.gz`` suffix selects the codec.

    Dots in column names are replaced (``plain_names``). Quoted cells keep their text, tokens included in ``nulls``
    become NULL. ``schema`` names the types; without one they are inferred from the cells that are left, which costs a
    pass: whole numbers, decimals, dates, times, true and false, else text. ``multiline`` allows
    line breaks inside quoted cells; such a file, like a gzip file, is read by one task: ``partitions`` deals the rows
    out afterwards. ``malformed`` names a column that counts the cells of a row whose text does not fit their type.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multiline).options(**options)
    if schema is None:
        df = _inferred(reader.csv(path), nulls)
    else:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        raw = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])).csv(path)
        cells = [_without_tokens(F.col(f"`{f.name}`"), nulls, T.StringType()) for f in wanted.fields]
        typed = [c if isinstance(f.dataType, T.StringType) else F.trim(c).try_cast(f.dataType) for c, f in zip(cells, wanted.fields)]
        extra = []
        if malformed:
            bad = [(c.isNotNull() & t.isNull()).cast("int") for c, t in zip(cells, typed)]
            extra = [sum(bad[1:], bad[0]).alias(malformed)]
        df = raw.select(*[t.alias(f.name) for t, f in zip(typed, wanted.fields)], *extra)
    df = nan_to_null(plain_names(df))
    return df.repartition(partitions) if partitions else df


# What a cell must look like to count as of a type, besides being read as such.
_LOOKS = {
    "int": r"[+-]?\d+", "bigint": r"[+-]?\d+", "double": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", "date": r"\d{4}-\d{1,2}-\d{1,2}",
    "timestamp": r"\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?", "boolean": r"(?i)true|false",
}


def _inferred(raw: DataFrame, nulls) -> DataFrame:
    """Text columns without missing-value tokens, each in the first type that all its cells have; one pass for all."""
    cells = [_without_tokens(F.col(f"`{c}`"), nulls, T.StringType()) for c in raw.columns]
    fits = []
    for i, cell in enumerate(cells):
        fits.append(F.count(cell).alias(f"n{i}"))
        for kind, looks in _LOOKS.items():
            fits.append(F.count(F.when(F.trim(cell).rlike(f"^(?:{looks})$"), F.trim(cell).try_cast(kind))).alias(f"{kind}{i}"))
    seen = raw.agg(*fits).first()
    out = []
    for i, (name, cell) in enumerate(zip(raw.columns, cells)):
        kind = next((k for k in _LOOKS if seen[f"n{i}"] and seen[f"{k}{i}"] == seen[f"n{i}"]), None)
        out.append((F.trim(cell).try_cast(kind) if kind else cell).alias(name))
    return raw.select(*out)


def _without_tokens(cell: Column, nulls, kind) -> Column:
    return F.when(cell.isin(list(nulls)), None).otherwise(cell) if isinstance(kind, T.StringType) else cell


def write_csv(df: DataFrame, path: str, sep: str = ",", gzip: bool = False) -> str:
    writer = df.write.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)
    return path


def save_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Snapshot handed to the next job."""
    df.write.mode(mode).parquet(path)
    return path


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def inline_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A literal table for a handful of hand-written rows."""
    return spark.createDataFrame(rows, schema)


def write_submission(df: DataFrame, path: str, id_col: str, pred_col: str, names=("index", "y")) -> str:
    """Two-column prediction file."""
    return write_csv(df.select(F.col(id_col).alias(names[0]), F.col(pred_col).alias(names[1])), path)


def sequence_frame(spark: SparkSession, low: float, high: float, n: int) -> DataFrame:
    """``n`` evenly spaced points from ``low`` to ``high``, both included."""
    step = (high - low) / (n - 1) if n > 1 else 0.0
    return spark.range(n).select(F.col("id").alias("i"), (F.lit(low) + F.col("id") * F.lit(step)).alias("x"))


def head(df: DataFrame, n: int, by) -> DataFrame:
    return df.orderBy(by).limit(n)


def tail(df: DataFrame, n: int, by) -> DataFrame:
    by = F.col(by) if isinstance(by, str) else by
    return df.orderBy(by.desc()).limit(n)


def sample_n(df: DataFrame, n: int, keys, seed: int = 42) -> DataFrame:
    """``n`` rows drawn by key hash; the same rows on every run."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return df.orderBy(hash_u32(keys, seed), *keys).limit(n)
