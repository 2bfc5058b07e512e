"""Aggregation, profiling and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import scalar as S
from rowsmith.operators import stats as A
from rowsmith.operators.ranks import exact_quantiles
from rowsmith.operators.snapshots import column_sketches, merge_sketches, sketch_report
from rowsmith.plans.q_clean import HOLED, holed_lineitem
from rowsmith.plans.registry import query
from rowsmith.session import materialise
from rowsmith.sources.tables import table

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("pivot_mean_price", """
    SELECT l_returnflag || '/' || l_linestatus AS grp,
      round(avg(l_extendedprice) FILTER (WHERE l_quantity > 0 AND l_quantity <= 18), 4) AS "(0, 18]",
      round(avg(l_extendedprice) FILTER (WHERE l_quantity > 18 AND l_quantity <= 80), 4) AS "(18, 80]"
    FROM lineitem GROUP BY 1""")
def pivot_mean_price(spark, sf):
    """Mean price by return flag and line status across quantity bands."""
    df = table(spark, sf, "lineitem").select(
        S.joined("/", "l_returnflag", "l_linestatus").alias("grp"),
        S.cut("l_quantity", [0, 18, 80]).alias("band"), "l_extendedprice")
    return A.pivot_table(df, ["grp"], "band", ["(0, 18]", "(18, 80]"], F.round(F.avg("l_extendedprice"), 4))


@query("pivot_two_levels", """
    SELECT l_returnflag, round(sum(l_quantity) FILTER (WHERE k = 'F_low'), 2) AS "F_low",
      round(sum(l_quantity) FILTER (WHERE k = 'F_high'), 2) AS "F_high",
      round(coalesce(sum(l_quantity) FILTER (WHERE k = 'O_low'), 0), 2) AS "O_low",
      round(coalesce(sum(l_quantity) FILTER (WHERE k = 'O_high'), 0), 2) AS "O_high"
    FROM (SELECT *, l_linestatus || '_' || CASE WHEN l_extendedprice <= (SELECT median(l_extendedprice) FROM lineitem)
      THEN 'low' ELSE 'high' END AS k FROM lineitem) GROUP BY 1""")
def pivot_two_levels(spark, sf):
    """Columns from two keys: line status and the half of the price range."""
    df = table(spark, sf, "lineitem")
    mid = exact_quantiles(df, ["l_extendedprice"], [0.5]).select(F.get("q", 0).alias("m"))
    half = F.when(F.col("l_extendedprice") <= mid.scalar(), "low").otherwise("high")
    keyed = df.select("l_returnflag", S.joined("_", "l_linestatus", half).alias("k"), "l_quantity")
    return A.pivot_table(keyed, ["l_returnflag"], "k", ["F_low", "F_high", "O_low", "O_high"],
                         F.round(F.sum("l_quantity"), 2), fill=0.0)


@query("global_stats", """
    SELECT round(sum(l_discount), 4) AS sum, round(avg(l_discount), 6) AS mean, min(l_discount) AS min,
      max(l_discount) AS max, count(l_discount) AS count FROM (SELECT nullif(l_discount, 0) AS l_discount FROM lineitem)""")
def global_stats(spark, sf):
    df = holed_lineitem(spark, sf)
    out = A.total(df, "l_discount", "sum", "mean", "min", "max", "count")
    return out.withColumns({"sum": F.round("sum", 4), "mean": F.round("mean", 6)})


@query("group_sum_mean", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity_sum,
      round(avg(l_quantity), 6) AS l_quantity_mean, round(avg(l_extendedprice), 4) AS l_extendedprice_mean
    FROM lineitem GROUP BY ALL""")
def group_sum_mean(spark, sf):
    out = A.group_agg(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"],
                      {"l_quantity": ["sum", "mean"], "l_extendedprice": "mean"})
    return out.withColumns({"l_quantity_sum": F.round("l_quantity_sum", 2), "l_quantity_mean": F.round("l_quantity_mean", 6),
                            "l_extendedprice_mean": F.round("l_extendedprice_mean", 4)})


@query("group_null_key", """
    SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS price
    FROM part WHERE p_partkey % 9 <> 0 GROUP BY 1""")
def group_null_key(spark, sf):
    """Rows without a key belong to no group."""
    df = table(spark, sf, "part").withColumn("p_brand", F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")))
    out = A.group_agg(df, ["p_brand"], {"p_retailprice": ["count", "mean"]})
    return out.select("p_brand", F.col("p_retailprice_count").alias("n"), F.round("p_retailprice_mean", 4).alias("price"))


@query("group_median", """
    SELECT event_type, round(median(value), 6) AS value_median, round(median(user_id), 6) AS user_id_median
    FROM events GROUP BY 1""")
def group_median(spark, sf):
    out = A.group_median(table(spark, sf, "events"), ["event_type"], ["value", "user_id"])
    return out.select("event_type", F.round("value_median", 6).alias("value_median"),
                      F.round("user_id_median", 6).alias("user_id_median"))


@query("group_median_spread", """
    SELECT event_type, round(median(value), 6) AS med FROM events GROUP BY 1""")
def group_median_spread(spark, sf):
    """The same medians by the form for columns with very many distinct values."""
    q = exact_quantiles(table(spark, sf, "events"), ["value"], [0.5], ["event_type"], buckets=200)
    return q.select("event_type", F.round(F.get("q", 0), 6).alias("med"))


@query("agg_list", """
    SELECT l_returnflag, min(l_quantity) AS l_quantity_min, median(l_quantity) AS l_quantity_median,
      max(l_quantity) AS l_quantity_max, min(l_discount) AS l_discount_min,
      round(median(l_discount), 6) AS l_discount_median, max(l_discount) AS l_discount_max FROM lineitem GROUP BY 1""")
def agg_list(spark, sf):
    """Several functions on every column."""
    fs = ["min", "median", "max"]
    out = A.group_agg(table(spark, sf, "lineitem"), ["l_returnflag"], {"l_quantity": fs, "l_discount": fs})
    return out.withColumn("l_discount_median", F.round("l_discount_median", 6))


@query("agg_per_column", """
    SELECT l_linestatus, min(l_quantity) AS l_quantity_min, max(l_extendedprice) AS l_extendedprice_max,
      count(DISTINCT l_suppkey) AS l_suppkey_nunique, round(stddev_samp(l_tax), 6) AS l_tax_std
    FROM lineitem GROUP BY 1""")
def agg_per_column(spark, sf):
    out = A.group_agg(table(spark, sf, "lineitem"), ["l_linestatus"], {
        "l_quantity": "min", "l_extendedprice": "max", "l_suppkey": "nunique", "l_tax": "std"})
    return out.withColumn("l_tax_std", F.round("l_tax_std", 6))


def _rounded(df, places=4):
    return df.withColumns({c: F.round(c, places) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


def _describe_sql(table_sql, col, by=""):
    key = f"{by}, " if by else ""
    return f"""SELECT {key}'{col}' AS "column", count({col}) AS count, round(avg({col}), 4) AS mean,
      round(stddev_samp({col}), 4) AS std, round(min({col})::DOUBLE, 4) AS min,
      round(quantile_cont({col}, 0.25)::DOUBLE, 4) AS q25, round(quantile_cont({col}, 0.5)::DOUBLE, 4) AS q50,
      round(quantile_cont({col}, 0.75)::DOUBLE, 4) AS q75, round(max({col})::DOUBLE, 4) AS max
      FROM {table_sql} {'GROUP BY ' + by if by else ''}"""


@query("describe_columns", " UNION ALL ".join(_describe_sql(HOLED, c) for c in NUM))
def describe_columns(spark, sf):
    return _rounded(A.describe(holed_lineitem(spark, sf), NUM))


@query("describe_groups", " UNION ALL ".join(_describe_sql("events", c, "event_type") for c in ("value", "user_id")))
def describe_groups(spark, sf):
    return _rounded(A.describe(table(spark, sf, "events"), ["value", "user_id"], ["event_type"]))


@query("null_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
    round(avg(({c} IS NULL)::INT), 6) AS share FROM {HOLED}""" for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")))
def null_profile(spark, sf):
    out = A.null_profile(holed_lineitem(spark, sf), ["l_quantity", "l_discount", "l_tax", "l_linenumber"])
    return out.withColumn("share", F.round("share", 6))


@query("null_profile_groups", " UNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
    round(avg(({c} IS NULL)::INT), 6) AS share FROM {HOLED} GROUP BY 1""" for c in ("l_discount", "l_tax", "l_linenumber")))
def null_profile_groups(spark, sf):
    out = A.null_profile(holed_lineitem(spark, sf), ["l_discount", "l_tax", "l_linenumber"], ["l_returnflag"])
    return out.withColumn("share", F.round("share", 6))


@query("table_info", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) AS "rows" FROM customer"""
    for c, t in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string"))))
def table_info(spark, sf):
    return A.table_info(table(spark, sf, "customer"))


@query("distinct_counts", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS nunique FROM part"""
    for c in ("p_name", "p_brand", "p_type", "p_size")))
def distinct_counts(spark, sf):
    return A.distinct_counts(table(spark, sf, "part"), ["p_name", "p_brand", "p_type", "p_size"])


@query("first_values", " UNION ALL ".join(f"""
    (SELECT '{c}' AS "column", v AS value, (row_number() OVER (ORDER BY v NULLS LAST))::INT AS pos
     FROM (SELECT DISTINCT {c}::VARCHAR AS v FROM part) ORDER BY v NULLS LAST LIMIT 5)""" for c in ("p_name", "p_brand", "p_type")))
def first_values(spark, sf):
    return A.first_values(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"], 5)


@query("value_counts", """
    SELECT quality, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY 1""")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "labels"), "quality", True).withColumn("share", F.round("share", 6))


@query("skewness", """
    SELECT 'value' AS "column", round(skewness(value), 5) AS skew FROM events
    UNION ALL SELECT 'user_id', round(skewness(user_id), 5) FROM events""")
def skewness(spark, sf):
    return A.skewness(table(spark, sf, "events"), ["value", "user_id"]).withColumn("skew", F.round("skew", 5))


@query("correlations", " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, round(abs(corr({a}, {b})), 6) AS corr FROM {HOLED}"""
    for i, a in enumerate(NUM) for b in NUM[i + 1:]))
def correlations(spark, sf):
    """Absolute Pearson correlation per pair of columns over the rows where both are known."""
    return A.correlations(holed_lineitem(spark, sf), NUM, absolute=True).withColumn("corr", F.round("corr", 6))


@query("corr_prune", """
    WITH f AS (SELECT l_quantity AS a, l_quantity * 2 + l_tax AS b, l_extendedprice AS c, l_discount AS d FROM lineitem),
    m AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(b, c) AS bc, corr(a, d) AS ad, corr(b, d) AS bd, corr(c, d) AS cd FROM f)
    SELECT name FROM (VALUES ('a'), ('c'), ('d')) v(name), m
    WHERE ab > 0.9 AND abs(ac) <= 0.95 AND abs(bc) <= 0.95 AND abs(ad) <= 0.95 AND abs(cd) <= 0.95""")
def corr_prune(spark, sf):
    """Names of the columns kept after dropping one of each strongly correlated pair."""
    f = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("a"), (F.col("l_quantity") * 2 + F.col("l_tax")).alias("b"),
        F.col("l_extendedprice").alias("c"), F.col("l_discount").alias("d"))
    gone = A.correlated_columns(f, ["a", "b", "c", "d"], 0.95)
    return A.table_info(f.drop(*gone)).select(F.col("column").alias("name"))


@query("group_transform", """
    SELECT c_custkey, round(avg(c_acctbal) OVER (PARTITION BY c_nationkey), 4) AS nation_mean,
      count(*) OVER (PARTITION BY c_nationkey) AS nation_count,
      round(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey), 4) AS centred FROM customer""")
def group_transform(spark, sf):
    out = A.with_group_stats(table(spark, sf, "customer"), ["c_nationkey"], nation_mean=F.avg("c_acctbal"), nation_count=F.count("*"))
    return out.select("c_custkey", F.round("nation_mean", 4).alias("nation_mean"), "nation_count",
                      F.round(F.col("c_acctbal") - F.col("nation_mean"), 4).alias("centred"))


@query("group_apply", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      round(l_extendedprice / sum(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS share FROM lineitem""")
def group_apply(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity")
    out = A.group_apply(df, ["l_suppkey"], {"total": F.sum("l_quantity")},
                        {"share": F.round(S.ratio("l_extendedprice", "total"), 6)})
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "share")


@query("group_apply_function", """
    SELECT c_custkey, c_nationkey, round((c_acctbal - lo) / nullif(hi - lo, 0), 6) AS scaled FROM customer
    JOIN (SELECT c_nationkey, min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer GROUP BY 1) USING (c_nationkey)""")
def group_apply_function(spark, sf):
    """A user function over whole (size-checked) groups."""

    def scale(pdf):
        low, high = pdf["c_acctbal"].min(), pdf["c_acctbal"].max()
        pdf["scaled"] = ((pdf["c_acctbal"] - low) / (high - low)) if high > low else None
        return pdf[["c_custkey", "c_nationkey", "scaled"]]

    df = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out = A.group_apply_pandas(df, ["c_nationkey"], scale, "c_custkey bigint, c_nationkey int, scaled double")
    return out.withColumn("scaled", F.round("scaled", 6))


@query("crosstab", """
    SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F", count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
    FROM lineitem GROUP BY 1""")
def crosstab(spark, sf):
    return A.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("group_frequency", """
    SELECT c_custkey, round(count(*) OVER (PARTITION BY c_nationkey) / count(*) OVER (), 6) AS freq FROM customer""")
def group_frequency(spark, sf):
    return A.group_frequency(table(spark, sf, "customer"), "c_nationkey").select("c_custkey", F.round("freq", 6).alias("freq"))


@query("mode", """
    SELECT 'p_type' AS "column", p_type AS value, n FROM
      (SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 1)
    UNION ALL SELECT 'p_brand', p_brand, n FROM
      (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 1)""")
def mode(spark, sf):
    df = table(spark, sf, "part")
    parts = [A.mode(df, c).select(F.lit(c).alias("column"), F.col(c).alias("value"), "n") for c in ("p_type", "p_brand")]
    return parts[0].unionByName(parts[1])


@query("profile_report", """
    WITH b AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_nationkey = 0) AS z0,
        count(DISTINCT c_custkey) AS d1, count(DISTINCT c_name) AS d2, count(DISTINCT c_nationkey) AS d3,
        count(DISTINCT c_acctbal) AS d4, count(DISTINCT c_mktsegment) AS d5,
        count(*) FILTER (WHERE c_custkey = 0) AS zk, count(*) FILTER (WHERE c_acctbal = 0) AS zb FROM customer)
    SELECT "column", item, value::BIGINT AS value FROM b, LATERAL (VALUES
      ('c_custkey', 'rows', n), ('c_name', 'rows', n), ('c_nationkey', 'rows', n), ('c_acctbal', 'rows', n), ('c_mktsegment', 'rows', n),
      ('c_custkey', 'missing', 0), ('c_name', 'missing', 0), ('c_nationkey', 'missing', 0), ('c_acctbal', 'missing', 0), ('c_mktsegment', 'missing', 0),
      ('c_custkey', 'zeros', zk), ('c_name', 'zeros', 0), ('c_nationkey', 'zeros', z0), ('c_acctbal', 'zeros', zb), ('c_mktsegment', 'zeros', 0),
      ('c_custkey', 'distinct', d1), ('c_name', 'distinct', d2), ('c_nationkey', 'distinct', d3), ('c_acctbal', 'distinct', d4), ('c_mktsegment', 'distinct', d5)
    ) v("column", item, value)""")
def profile_report(spark, sf):
    """The count section of the profile, as numbers."""
    out = A.profile_report(table(spark, sf, "customer"))
    return out.where((F.col("section") == "counts") & (F.col("item") != "dtype")).select(
        "column", "item", F.col("value").try_cast("bigint").alias("value"))


@query("profile_full")
def profile_full(spark, sf):
    return A.profile_report(table(spark, sf, "orders"))


def yearly_sketches(spark, sf):
    """Orders described year by year, as a table that grows by one snapshot a year."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"))
    return materialise(column_sketches(orders, by=["year"]), "sketches")


@query("merged_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", item, round(value::DOUBLE, 6) AS value FROM (SELECT count(*) AS n, count(*) - count({c}) AS gone,
      {f"count(*) FILTER (WHERE {c} = 0), avg({c}), stddev_samp({c}), min({c}), max({c})" if number else "0, NULL, NULL, NULL, NULL"} FROM orders) t(n, gone, z, m, s, lo, hi),
      LATERAL (VALUES ('rows', n::DOUBLE), ('missing', gone), ('zeros', z), ('mean', m), ('std', s), ('min', lo), ('max', hi)) v(item, value)
    WHERE value IS NOT NULL""" for c, number in (
        ("o_orderkey", 1), ("o_custkey", 1), ("o_totalprice", 1), ("o_orderstatus", 0), ("o_orderpriority", 0))))
def merged_profile(spark, sf):
    """What merged yearly snapshots know exactly: counts and moments of all rows, which are not read again."""
    report = sketch_report(merge_sketches(yearly_sketches(spark, sf)))
    return report.where(F.col("item").isin("rows", "missing", "zeros", "mean", "std", "min", "max") & F.col("section").isin("counts", "describe")).select(
        "column", "item", F.round(F.col("value").try_cast("double"), 6).alias("value"))


@query("merged_profile_common", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", {c} AS item, count(*)::VARCHAR AS value FROM orders GROUP BY {c}""" for c in ("o_orderstatus", "o_orderpriority")))
def merged_profile_common(spark, sf):
    """Values of the two columns of few values, from the merged sketches of frequent values."""
    report = sketch_report(merge_sketches(yearly_sketches(spark, sf)), top=10)
    return report.where("section = 'top' AND column IN ('o_orderstatus', 'o_orderpriority')").select("column", "item", "value")


@query("merged_profile_sketched")
def merged_profile_sketched(spark, sf):
    """The whole report of the merged snapshots; quartiles, distinct values and bins are within the bounds of the sketches."""
    return sketch_report(merge_sketches(yearly_sketches(spark, sf)))


@query("histogram", """
    WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
    c AS (SELECT least(floor((value - lo) / w), 19)::BIGINT AS bin, count(*) AS n FROM events, r GROUP BY 1)
    SELECT i::BIGINT AS bin, round(lo + i * w, 6) AS low, round(lo + (i + 1) * w, 6) AS high, coalesce(n, 0)::BIGINT AS n
    FROM r, range(20) t(i) LEFT JOIN c ON c.bin = i""")
def histogram(spark, sf):
    out = A.histogram(table(spark, sf, "events"), "value", 20)
    return out.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("box_stats", """
    WITH m AS (SELECT month(o_orderdate)::INT AS month, o_totalprice AS p FROM orders),
    q AS (SELECT month, quantile_cont(p, 0.25) AS q1, quantile_cont(p, 0.5) AS med, quantile_cont(p, 0.75) AS q3 FROM m GROUP BY 1)
    SELECT month, round(any_value(q1), 4) AS q1, round(any_value(med), 4) AS med, round(any_value(q3), 4) AS q3,
      min(p) FILTER (WHERE p >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
      max(p) FILTER (WHERE p <= q3 + 1.5 * (q3 - q1)) AS whisker_high
    FROM m JOIN q USING (month) GROUP BY 1""")
def box_stats(spark, sf):
    df = table(spark, sf, "orders").select(F.month("o_orderdate").alias("month"), "o_totalprice")
    out = A.box_stats(df, "o_totalprice", "month")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "med", "q3")})


@query("kde", """
    WITH s AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h, min(value) AS lo,
        (max(value) - min(value)) / 49 AS step FROM events),
    g AS (SELECT i, lo + i * step AS x, n, h FROM s, range(50) t(i))
    SELECT i::INT AS i, round(x, 6) AS x, round(sum(exp(-0.5 * pow((value - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8) AS density
    FROM g, events GROUP BY i, x""")
def kde(spark, sf):
    out = A.kde(table(spark, sf, "events"), "value", 50)
    return out.withColumns({"x": F.round("x", 6), "density": F.round("density", 8)})
