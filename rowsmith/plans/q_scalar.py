"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import scalar as S
from rowsmith.operators.ordered import factorize
from rowsmith.operators.ranks import column_quantiles
from rowsmith.plans.registry import query
from rowsmith.sources.tables import table


@query("ratio_feature", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice / l_quantity, 8) AS unit_price,
      CASE WHEN l_discount = 0 THEN NULL ELSE round(l_tax / l_discount, 6) END AS tax_ratio FROM lineitem""")
def ratio_feature(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.round(S.ratio("l_extendedprice", "l_quantity"), 8).alias("unit_price"),
        F.round(S.ratio("l_tax", "l_discount"), 6).alias("tax_ratio"))


@query("log_features", """
    SELECT event_id, CASE WHEN value > 0 THEN round(ln(value), 6) END AS log_value,
      CASE WHEN value > -1 THEN round(ln(1 + value), 6) END AS log1p_value FROM events""")
def log_features(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.round(S.safe_log("value"), 6).alias("log_value"),
        F.round(S.safe_log1p("value"), 6).alias("log1p_value"))


@query("sum_of_flags", """
    SELECT (l_quantity > 25)::INT + (l_discount > 0.05)::INT + (l_tax > 0.04)::INT + (l_returnflag = 'R')::INT AS flags,
      count(*) AS n FROM lineitem GROUP BY 1""")
def sum_of_flags(spark, sf):
    flags = S.count_true([F.col("l_quantity") > 25, F.col("l_discount") > 0.05, F.col("l_tax") > 0.04,
                          F.col("l_returnflag") == "R"])
    return table(spark, sf, "lineitem").groupBy(flags.alias("flags")).agg(F.count("*").alias("n"))


@query("count_positive", """
    SELECT (l_quantity > 0)::INT + (l_discount > 0)::INT + (l_tax > 0)::INT AS positive, count(*) AS n
    FROM lineitem GROUP BY 1""")
def count_positive(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        S.count_positive(["l_quantity", "l_discount", "l_tax"]).alias("positive")).agg(F.count("*").alias("n"))


@query("row_mean", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      round((l_quantity + coalesce(nullif(l_discount, 0), 0) + l_tax) / (2 + (l_discount <> 0)::INT), 6) AS mean
    FROM lineitem""")
def row_mean(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.round(S.row_mean(["l_quantity", S.null_if("l_discount", 0.0), "l_tax"]), 6).alias("mean"))


@query("split_text", """
    SELECT split_part(o_orderpriority, '-', 1) AS rank, split_part(o_orderpriority, '-', 2) AS word, count(*) AS n
    FROM orders GROUP BY ALL""")
def split_text(spark, sf):
    return table(spark, sf, "orders").groupBy(
        S.split_part("o_orderpriority", "-", 0).alias("rank"), S.split_part("o_orderpriority", "-", 1).alias("word")
    ).agg(F.count("*").alias("n"))


@query("text_prefix", "SELECT p_partkey, substr(p_type, 1, 2) AS kind FROM part")
def text_prefix(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.prefix("p_type", 2).alias("kind"))


@query("text_concat", """
    SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_brand || '_' || p_type END AS label FROM part""")
def text_concat(spark, sf):
    kind = F.when(F.col("p_partkey") % 4 != 0, F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", S.joined("_", "p_brand", kind).alias("label"))


@query("decade_label", """
    SELECT (year(o_orderdate) // 10 * 10)::VARCHAR || 's' AS decade, count(*) AS n FROM orders GROUP BY 1""")
def decade_label(spark, sf):
    return table(spark, sf, "orders").groupBy(S.decade_label(F.year("o_orderdate")).alias("decade")).agg(
        F.count("*").alias("n"))


@query("parse_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate::DATE END AS parsed FROM orders""")
def parse_dates(spark, sf):
    """Text dates day/month/year, one in ten unreadable."""
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("unknown")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", S.parse_date(text, "dd/MM/yyyy").alias("parsed"))


@query("date_parts", """
    SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS n FROM orders GROUP BY ALL""")
def date_parts(spark, sf):
    return table(spark, sf, "orders").groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))


@query("age_in_years", """
    SELECT o_orderkey, date_part('year', age(TIMESTAMP '2024-06-15', o_orderdate))::INT AS years FROM orders""")
def age_in_years(spark, sf):
    as_of = F.lit("2024-06-15").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", S.age_in_years("o_orderdate", as_of).alias("years"))


@query("year_delta", """
    SELECT o_orderkey, (2013 - year(o_orderdate))::INT AS to_2013,
      ((SELECT max(year(o_orderdate)) FROM orders) - year(o_orderdate))::INT AS to_last FROM orders""")
def year_delta(spark, sf):
    df = table(spark, sf, "orders")
    last = df.agg(F.max(F.year("o_orderdate")).alias("y"))
    return df.select("o_orderkey", (2013 - F.year("o_orderdate")).alias("to_2013"),
                     (last.scalar() - F.year("o_orderdate")).alias("to_last"))


@query("percent_error", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      round(least(greatest(l_extendedprice * (1 - l_discount) / l_extendedprice - 1, -0.05), 0.05), 6) AS err,
      (l_extendedprice * l_tax - 1000 > 0) AS above, round(abs(l_extendedprice * l_tax - 1000), 4) AS gap
    FROM lineitem""")
def percent_error(spark, sf):
    gap = F.col("l_extendedprice") * F.col("l_tax") - 1000
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.round(S.percent_error(F.col("l_extendedprice") * (1 - F.col("l_discount")), "l_extendedprice", 0.05), 6).alias("err"),
        (gap > 0).alias("above"), F.round(F.abs(gap), 4).alias("gap"))


@query("factorize", """
    WITH k AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS brand FROM part),
    f AS (SELECT brand, min(p_partkey) AS first FROM k WHERE brand IS NOT NULL GROUP BY 1),
    c AS (SELECT brand, row_number() OVER (ORDER BY first) - 1 AS code FROM f)
    SELECT p_partkey, k.brand, coalesce(code, -1)::BIGINT AS code FROM k LEFT JOIN c ON k.brand = c.brand""")
def factorize_brand(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("brand"))
    return factorize(df, "brand", "p_partkey").select("p_partkey", "brand", F.col("code").cast("bigint").alias("code"))


@query("cut_fixed_edges", """
    SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 18 THEN '(0, 18]'
                WHEN l_quantity > 18 AND l_quantity <= 45 THEN '(18, 45]' END AS bin, count(*) AS n
    FROM lineitem GROUP BY 1""")
def cut_fixed_edges(spark, sf):
    return table(spark, sf, "lineitem").groupBy(S.cut("l_quantity", [0, 18, 45]).alias("bin")).agg(F.count("*").alias("n"))


@query("quantile_cut", """
    WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b,
                      quantile_cont(o_totalprice, 0.75) AS c FROM orders)
    SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 0 WHEN o_totalprice <= b THEN 1
      WHEN o_totalprice <= c THEN 2 ELSE 3 END AS bin FROM orders, q""")
def quantile_cut(spark, sf):
    df = table(spark, sf, "orders")
    edges = column_quantiles(df, ["o_totalprice"], [0, 0.25, 0.5, 0.75, 1])["o_totalprice"]
    return df.select("o_orderkey", S.cut("o_totalprice", edges, [0, 1, 2, 3], include_lowest=True).alias("bin"))
