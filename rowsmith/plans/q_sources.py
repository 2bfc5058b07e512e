"""Sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rowsmith.functions.hashing import randint, uniform
from rowsmith.plans.registry import query
from rowsmith.session import scratch_path
from rowsmith.sources import tables as io

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"

# The holidays of the test calendar (name, day, days before, days after).
HOLIDAYS = [
    ("new_year", "1996-01-01", 0, 1), ("new_year", "1997-01-01", 0, 1), ("new_year", "1998-01-01", 0, 1),
    ("midsummer", "1996-06-24", 0, 1), ("midsummer", "1997-06-24", 0, 1), ("midsummer", "1998-06-24", 0, 1),
    ("fair", "1997-06-25", 0, 1),
]
HOLIDAY_SCHEMA = "holiday string, ds string, lower_window bigint, upper_window bigint"
HOLIDAY_VALUES = ", ".join(f"('{n}', DATE '{d}', {a}, {b})" for n, d, a, b in HOLIDAYS)
HOLIDAY_SQL = f"(SELECT * FROM (VALUES {HOLIDAY_VALUES}) v(holiday, ds, lower_window, upper_window))"


def holidays(spark) -> DataFrame:
    return io.inline_table(spark, HOLIDAYS, HOLIDAY_SCHEMA).withColumn("ds", F.col("ds").cast("date"))


def _round_trip(spark, sf, **how) -> DataFrame:
    path = scratch_path(spark, "csv")
    io.write_csv(io.table(spark, sf, "customer"), path, **how)
    return io.read_csv(spark, path, CUSTOMER, sep=how.get("sep", ","))


@query("read_csv_header", "SELECT * FROM customer")
def read_csv_header(spark, sf):
    return _round_trip(spark, sf)


@query("read_csv_semicolon", "SELECT * FROM customer")
def read_csv_semicolon(spark, sf):
    return _round_trip(spark, sf, sep=";")


@query("read_csv_gzip", "SELECT * FROM customer")
def read_csv_gzip(spark, sf):
    return _round_trip(spark, sf, gzip=True)


@query("read_csv_blanks", """
    SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def read_csv_blanks(spark, sf):
    """Empty cells come back as NULL."""
    path = scratch_path(spark, "csv")
    holes = io.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    io.write_csv(holes, path)
    return io.read_csv(spark, path, "c_custkey bigint, c_acctbal double, c_mktsegment string")


@query("read_csv_inferred", """
    SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS key, CASE WHEN c_custkey % 5 > 1 THEN c_acctbal END AS balance,
           CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 <> 0 THEN DATE '2020-01-01' + c_custkey::INT % 1000 END AS day,
           c_custkey % 2 = 0 AS even, c_custkey || CASE WHEN c_custkey % 13 = 0 THEN 'x' ELSE '' END AS code,
           'key:int balance:double segment:string day:date even:boolean code:string' AS types
    FROM customer""")
def read_csv_inferred(spark, sf):
    """Types found without a schema in columns that hold every token for a missing value."""
    c, token = F.col("c_custkey"), F.array(*[F.lit(t) for t in io.NULL_TOKENS])
    gap = F.get(token, (c % len(io.NULL_TOKENS)).cast("int"))
    odd = io.table(spark, sf, "customer").select(
        F.when(c % 7 != 0, c.cast("string")).otherwise("N/A").alias("key"),
        F.when(c % 5 > 1, F.col("c_acctbal").cast("string")).otherwise(gap).alias("balance"),
        F.when(c % 11 != 0, F.col("c_mktsegment")).otherwise(gap).alias("segment"),
        F.when(c % 3 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (c % 1000).cast("int")).cast("string")).otherwise("nan").alias("day"),
        F.when(c % 2 == 0, "true").otherwise("False").alias("even"),
        F.concat(c.cast("string"), F.when(c % 13 == 0, "x").otherwise("")).alias("code"))
    out = io.read_csv(spark, io.write_csv(odd, scratch_path(spark, "odd")))
    types = " ".join(f"{f.name}:{f.dataType.simpleString()}" for f in out.schema.fields)
    return out.withColumn("key", F.col("key").cast("bigint")).withColumn("types", F.lit(types))


@query("csv_quotes_and_breaks", """
    SELECT doc_id, text, CASE WHEN doc_id % 3 <> 0 THEN n_chars END AS n_chars, (doc_id % 5 = 0)::INT AS malformed
    FROM (SELECT doc_id, n_chars, 'say "' || text || '", ok' || chr(10) || 'next' AS text FROM documents)""")
def csv_quotes_and_breaks(spark, sf):
    """Cells with quotes, separators and line breaks, missing-value tokens and a number that is none."""
    docs = io.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit('say "'), "text", F.lit('", ok\nnext')).alias("text"),
        F.when(F.col("doc_id") % 3 == 0, "NA").otherwise(F.col("n_chars").cast("string")).alias("n_chars"),
        F.when(F.col("doc_id") % 5 == 0, "12x").otherwise("12").alias("more"))
    path = io.write_csv(docs, scratch_path(spark, "quoted"))
    out = io.read_csv(spark, path, "doc_id bigint, text string, n_chars bigint, more int", multiline=True, malformed="malformed")
    return out.select("doc_id", "text", "n_chars", "malformed")


@query("load_tables_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in io.TABLES))
def load_tables_counts(spark, sf):
    bag = io.load_tables(spark, sf)
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in bag.items()
    ])


@query("dataset_snapshot", """
    SELECT l_returnflag, count(*) AS n, count(l_discount) AS with_discount, round(sum(l_quantity), 2) AS qty
    FROM (SELECT l_returnflag, nullif(l_discount, 0) AS l_discount, l_quantity FROM lineitem)
    GROUP BY l_returnflag""")
def dataset_snapshot(spark, sf):
    """A cleaned table written by one job and aggregated by the next."""
    cleaned = io.table(spark, sf, "lineitem").select(
        "l_returnflag", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_quantity")
    saved = io.load_dataset(spark, io.save_dataset(cleaned, scratch_path(spark, "snapshot")))
    return saved.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count("l_discount").alias("with_discount"),
        F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("inline_calendar_orders", f"""
    SELECT h.holiday, h.ds, count(o_orderkey) AS orders
    FROM {HOLIDAY_SQL} h LEFT JOIN orders ON o_orderdate::DATE = h.ds GROUP BY ALL""")
def inline_calendar_orders(spark, sf):
    """A hand-written calendar joined to the orders of its days."""
    per_day = io.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("ds")).agg(
        F.count("*").alias("orders"))
    return holidays(spark).join(per_day, "ds", "left").select(
        "holiday", "ds", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"))


@query("random_columns", """
    SELECT o_orderkey, round(h(o_orderkey, 42) / 4294967296.0, 9) AS u,
           floor(h(o_orderkey, 7) / 4294967296.0 * 10)::BIGINT AS k
    FROM orders""".replace("h(o_orderkey, 42)", "('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT")
    .replace("h(o_orderkey, 7)", "('0x' || substr(md5(o_orderkey || ':7'), 1, 8))::BIGINT"))
def random_columns(spark, sf):
    return io.table(spark, sf, "orders").select(
        "o_orderkey", F.round(uniform("o_orderkey", 42), 9).alias("u"), randint("o_orderkey", 7, 0, 10).alias("k"))


@query("sequence_grid", """
    WITH r AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
    g AS (SELECT i, lo + i * (hi - lo) / 49 AS x, (hi - lo) / 49 AS step FROM r, range(50) t(i))
    SELECT g.i::BIGINT AS i, round(x, 6) AS x, round(sin(2 * pi() * x / 50), 6) AS wave,
           count(l_quantity) AS n
    FROM g LEFT JOIN lineitem ON l_quantity >= x - step / 2 AND l_quantity < x + step / 2
    GROUP BY ALL""")
def sequence_grid(spark, sf):
    """An even grid over the quantity range, with the rows nearest to each point."""
    items = io.table(spark, sf, "lineitem")
    low, high = items.agg(F.min("l_quantity"), F.max("l_quantity")).first()
    step = (high - low) / 49
    spot = F.floor((F.col("l_quantity") - F.lit(low)) / F.lit(step) + 0.5).cast("bigint")
    counts = items.groupBy(spot.alias("i")).agg(F.count("*").alias("n"))
    grid = io.sequence_frame(spark, low, high, 50)
    return grid.join(counts, "i", "left").select(
        "i", F.round("x", 6).alias("x"), F.round(F.sin(2 * F.pi() * F.col("x") / 50), 6).alias("wave"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("preview_head", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_head(spark, sf):
    return io.head(io.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), 5, "o_orderkey")


@query("preview_tail", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def preview_tail(spark, sf):
    return io.tail(io.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 5, "o_orderkey")


@query("preview_sample", """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT, o_orderkey LIMIT 10""")
def preview_sample(spark, sf):
    return io.sample_n(io.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10, "o_orderkey", 42)


@query("submission_file", """
    SELECT c_custkey AS "index", CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS y FROM customer""")
def submission_file(spark, sf):
    """Predictions by rule, written as a two-column file and read back."""
    scored = io.table(spark, sf, "customer").withColumn("pred", (F.col("c_acctbal") > 0).cast("int"))
    path = io.write_submission(scored, scratch_path(spark, "submission"), "c_custkey", "pred")
    return io.read_csv(spark, path, "index bigint, y int")
