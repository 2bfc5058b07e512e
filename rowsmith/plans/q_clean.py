"""Projection, predicates and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import scalar as S
from rowsmith.operators import clean
from rowsmith.plans.registry import query
from rowsmith.sources.tables import table


def holed_lineitem(spark, sf):
    """lineitem with missing cells derived by rule."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_quantity", "l_extendedprice",
        S.null_if("l_discount", 0.0).alias("l_discount"),
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_orderkey") % 2 != 0, F.col("l_linenumber")).alias("l_linenumber"),
    )


HOLED = """(SELECT l_orderkey, l_returnflag, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount,
    CASE WHEN l_orderkey % 3 <> 0 THEN l_tax END AS l_tax,
    CASE WHEN l_orderkey % 2 <> 0 THEN l_linenumber END AS l_linenumber FROM lineitem)"""


@query("drop_columns", "SELECT p_partkey, p_brand, p_type FROM part")
def drop_columns(spark, sf):
    return clean.drop_columns(table(spark, sf, "part"), "p_name", "p_size", "p_retailprice", "not_there")


@query("rename_columns", "SELECT p_partkey AS part_id, p_brand AS brand, p_size FROM part")
def rename_columns(spark, sf):
    return clean.rename(table(spark, sf, "part").select("p_partkey", "p_brand", "p_size"),
                        {"p_partkey": "part_id", "p_brand": "brand"})


@query("select_numeric", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_numeric(spark, sf):
    return clean.select_by_dtype(table(spark, sf, "orders"), include="numeric")


@query("select_text", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def select_text(spark, sf):
    df = table(spark, sf, "orders")
    return df.select("o_orderkey", *clean.columns_by_dtype(df, "string"))


@query("month_as_category", """
    SELECT month(o_orderdate)::VARCHAR AS month, count(*) AS n FROM orders GROUP BY 1""")
def month_as_category(spark, sf):
    """Month starts as a number and is moved to the text group before counting per text column."""
    df = table(spark, sf, "orders").select(F.month("o_orderdate").alias("month"), "o_totalprice")
    moved = clean.as_category(df, "month")
    return moved.groupBy(*clean.columns_by_dtype(moved, "string")).agg(F.count("*").alias("n"))


@query("drop_sparse_columns", f"""
    SELECT l_orderkey, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax FROM {HOLED}""")
def drop_sparse_columns(spark, sf):
    return clean.drop_sparse_columns(holed_lineitem(spark, sf), 0.35)


@query("dropna_subset", """
    SELECT c_custkey, bal, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg
    FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal FROM customer) WHERE bal IS NOT NULL""")
def dropna_subset(spark, sf):
    return clean.dropna(_holed_customer(spark, sf), ["bal"])


@query("dropna_any", """
    SELECT c_custkey, c_acctbal AS bal, c_mktsegment AS seg FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0""")
def dropna_any(spark, sf):
    return clean.dropna(_holed_customer(spark, sf))


def _holed_customer(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("seg"))


@query("filter_zscore", """
    SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi
    FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem)
    WHERE abs((l_extendedprice - m) / s) < 1.5 GROUP BY 1""")
def filter_zscore(spark, sf):
    kept = clean.keep_within_z(table(spark, sf, "lineitem"), "l_extendedprice", 1.5)
    return kept.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))


@query("remove_outliers", """
    SELECT event_id, value FROM events,
      (SELECT avg(value) AS m, stddev_pop(value) AS s, avg(user_id) AS um, stddev_pop(user_id) AS us FROM events)
    WHERE NOT abs((value - m) / s) > 3 AND NOT abs((user_id - um) / us) > 3""")
def remove_outliers(spark, sf):
    return clean.remove_outliers(table(spark, sf, "events"), ["value", "user_id"], 3).select("event_id", "value")


@query("outlier_removal_report", """
    SELECT event_type, count(*) AS n_before, count(*) FILTER (WHERE NOT abs((value - m) / s) > 3) AS n_after
    FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) GROUP BY 1""")
def outlier_removal_report(spark, sf):
    df = table(spark, sf, "events")
    z = clean.z_of("value", clean.population_stats(df, ["value"])["value"])
    return df.groupBy("event_type").agg(
        F.count("*").alias("n_before"), F.count_if(~(F.abs(z) > 3)).alias("n_after"))


@query("drop_row_outliers", """
    WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_extendedprice) AS em,
        stddev_pop(l_extendedprice) AS es, avg(l_discount) AS dm, stddev_pop(l_discount) AS ds,
        avg(l_tax) AS tm, stddev_pop(l_tax) AS ts FROM lineitem)
    SELECT l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem, s
    WHERE NOT ((abs((l_quantity - qm) / qs) >= 1.7)::INT + (abs((l_extendedprice - em) / es) >= 1.7)::INT
      + (abs((l_discount - dm) / ds) >= 1.7)::INT + (abs((l_tax - tm) / ts) >= 1.7)::INT) / 4.0 > 0.2
    GROUP BY 1""")
def drop_row_outliers(spark, sf):
    kept = clean.drop_row_outliers(table(spark, sf, "lineitem"),
                                   ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 1.7, 0.2)
    return kept.groupBy("l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("zero_to_null", """
    SELECT l_returnflag, count(*) AS n, count(nullif(l_discount, 0)) AS discounts, count(nullif(l_tax, 0)) AS taxes,
      round(avg(nullif(l_discount, 0)), 6) AS mean_discount FROM lineitem GROUP BY 1""")
def zero_to_null(spark, sf):
    df = table(spark, sf, "lineitem").withColumns({c: S.null_if(c, 0.0) for c in ("l_discount", "l_tax")})
    return df.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count("l_discount").alias("discounts"), F.count("l_tax").alias("taxes"),
        F.round(F.avg("l_discount"), 6).alias("mean_discount"))


@query("map_values", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status
    FROM orders""")
def map_values(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", S.map_values("o_orderstatus", {"F": "finished", "O": "open"}).alias("status"))


@query("binarize", "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS urgent FROM orders")
def binarize(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", S.binary_flag(F.col("o_orderpriority") == "5-LOW", 0, 1).alias("urgent"))


@query("cast_flag", """
    SELECT (l_discount <> 0)::INT::VARCHAR AS has_discount, l_linenumber::VARCHAR AS line, count(*) AS n
    FROM lineitem GROUP BY ALL""")
def cast_flag(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        S.nonzero_flag("l_discount").alias("has_discount"), F.col("l_linenumber").cast("string").alias("line")
    ).agg(F.count("*").alias("n"))


@query("clip_to_train_range", """
    WITH k AS (SELECT *, ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT / 4294967296.0 AS u FROM orders),
    r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM k WHERE u < 0.8)
    SELECT o_orderkey, round(least(greatest(o_totalprice * 1.5 - 20000, lo), hi), 4) AS clipped FROM k, r WHERE u >= 0.8""")
def clip_to_train_range(spark, sf):
    from rowsmith.operators.resample import train_test_split

    train, test = train_test_split(table(spark, sf, "orders"), "o_orderkey", 0.8, 42)
    guess = test.withColumn("guess", F.col("o_totalprice") * 1.5 - 20000)
    return clean.clip_to_fitted(guess, train, "guess", "o_totalprice", "clipped").select(
        "o_orderkey", F.round("clipped", 4).alias("clipped"))


@query("predicates", """
    SELECT count(*) FILTER (WHERE d > 0.05) AS gt, count(*) FILTER (WHERE d < 0.05) AS lt,
      count(*) FILTER (WHERE d >= 0.05) AS ge, count(*) FILTER (WHERE d = 0.05) AS eq,
      count(*) FILTER (WHERE d BETWEEN 0.02 AND 0.05) AS inside,
      count(*) FILTER (WHERE NOT (d BETWEEN 0.02 AND 0.05) AND d IS NOT NULL) AS outside_known,
      count(*) FILTER (WHERE NOT coalesce(d BETWEEN 0.02 AND 0.05, false)) AS outside_or_missing
    FROM (SELECT nullif(l_discount, 0) AS d FROM lineitem)""")
def predicates(spark, sf):
    """Unknown comparisons count as false, also under negation."""
    d = F.col("d")
    df = table(spark, sf, "lineitem").select(S.null_if("l_discount", 0.0).alias("d"))
    inside = S.truth(d.between(0.02, 0.05))
    return df.agg(
        F.count_if(S.truth(d > 0.05)).alias("gt"), F.count_if(S.truth(d < 0.05)).alias("lt"),
        F.count_if(S.truth(d >= 0.05)).alias("ge"), F.count_if(S.truth(d == 0.05)).alias("eq"),
        F.count_if(inside).alias("inside"), F.count_if(~inside & d.isNotNull()).alias("outside_known"),
        F.count_if(~inside).alias("outside_or_missing"))


@query("mask_select", """
    SELECT l_returnflag, count(*) AS n FROM lineitem
    WHERE l_quantity >= 10 AND NOT (l_extendedprice BETWEEN 20000 AND 60000) AND l_linestatus = 'O' GROUP BY 1""")
def mask_select(spark, sf):
    df = table(spark, sf, "lineitem")
    mask = (F.col("l_quantity") >= 10) & ~F.col("l_extendedprice").between(20000, 60000) & (F.col("l_linestatus") == "O")
    return clean.where_true(df, mask).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("melt_numeric", """
    SELECT variable, count(*) AS n, round(sum(value), 2) AS total FROM
      (UNPIVOT (SELECT l_orderkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax
       INTO NAME variable VALUE value) GROUP BY 1""")
def melt_numeric(spark, sf):
    long = clean.melt(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_quantity", "l_discount", "l_tax"])
    return long.groupBy("variable").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
