"""Joins, set operations, ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions.hashing import uniform
from rowsmith.operators import ordered as O
from rowsmith.operators import relate as J
from rowsmith.operators import stats as A
from rowsmith.plans.q_sources import HOLIDAY_SQL, holidays
from rowsmith.plans.registry import query
from rowsmith.operators.series import holiday_calendar
from rowsmith.sources.tables import table


def U(key: str, seed: int) -> str:
    """SQL text of the keyed uniform number."""
    return f"(('0x' || substr(md5({key} || ':{seed}'), 1, 8))::BIGINT / 4294967296.0)"


@query("lookup_group_mean", f"""
    WITH t AS (SELECT o_orderpriority, avg(o_totalprice) AS m FROM orders WHERE {U('o_orderkey', 42)} < 0.5 GROUP BY 1)
    SELECT o_orderkey, round(m, 4) AS priority_mean FROM orders LEFT JOIN t USING (o_orderpriority)
    WHERE {U('o_orderkey', 42)} >= 0.5""")
def lookup_group_mean(spark, sf):
    """Group means learned on the training half, attached to the other half."""
    df = table(spark, sf, "orders")
    u = uniform("o_orderkey", 42)
    means = df.where(u < 0.5).groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 4).alias("priority_mean"))
    return J.lookup(df.where(u >= 0.5), means, ["o_orderpriority"]).select("o_orderkey", "priority_mean")


@query("lookup_two_keys", """
    WITH t AS (SELECT p_brand, p_type, avg(p_retailprice) AS m FROM part WHERE p_size < 20 GROUP BY ALL)
    SELECT p_partkey, round(m, 8) AS mean FROM part LEFT JOIN t USING (p_brand, p_type)""")
def lookup_two_keys(spark, sf):
    """A fitted two-key table; groups unseen at fit time give NULL."""
    df = table(spark, sf, "part")
    means = df.where("p_size < 20").groupBy("p_brand", "p_type").agg(F.round(F.avg("p_retailprice"), 8).alias("mean"))
    return J.lookup(df, means, ["p_brand", "p_type"]).select("p_partkey", "mean")


@query("aligned_columns", """
    SELECT o_orderkey, o_totalprice AS truth, round(o_totalprice * 0.9 + 1000, 4) AS guess FROM orders""")
def aligned_columns(spark, sf):
    df = table(spark, sf, "orders")
    truth = df.select("o_orderkey", F.col("o_totalprice").alias("truth"))
    guess = df.select("o_orderkey", F.round(F.col("o_totalprice") * 0.9 + 1000, 4).alias("guess"))
    return J.aligned(truth, guess, "o_orderkey")


@query("anti_join_sample", f"SELECT c_custkey, c_acctbal FROM customer WHERE {U('c_custkey', 42)} >= 0.3")
def anti_join_sample(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    sampled = df.where(uniform("c_custkey", 42) < 0.3).select("c_custkey")
    return J.without(df, sampled, "c_custkey")


@query("semi_join_calendar", f"""
    SELECT o_orderkey, o_orderdate::DATE AS ds FROM orders WHERE o_orderdate::DATE IN
      (SELECT (ds + s::INT)::DATE FROM {HOLIDAY_SQL}, range(lower_window, upper_window + 1) t(s))""")
def semi_join_calendar(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ds"))
    return J.only_in(df, holiday_calendar(holidays(spark)), "ds")


@query("stack_rows", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS half FROM orders""")
def stack_rows(spark, sf):
    df = table(spark, sf, "orders")
    cols = ("o_orderkey", "o_totalprice")
    early, late = df.where("o_orderdate < date'1998-01-01'"), df.where("o_orderdate >= date'1998-01-01'")
    return J.stack_rows(early.select(*cols), late.select(*reversed(cols)), label="half", names=["early", "late"])


@query("date_difference", f"""
    SELECT DISTINCT o_orderdate::DATE AS ds FROM orders WHERE o_totalprice > 450000
    EXCEPT SELECT (ds + s::INT)::DATE FROM {HOLIDAY_SQL}, range(lower_window, upper_window + 1) t(s)""")
def date_difference(spark, sf):
    """Days with an extreme order, minus the calendar days."""
    big = table(spark, sf, "orders").where("o_totalprice > 450000").select(F.col("o_orderdate").cast("date").alias("ds"))
    return J.key_difference(big, holiday_calendar(holidays(spark)).select("ds"))


@query("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark, sf):
    return J.distinct_rows(table(spark, sf, "customer").select("c_nationkey", "c_mktsegment"))


@query("percent_rank", """
    SELECT p_partkey, round((rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0)
      / count(*) OVER (), 8) AS pct FROM part""")
def percent_rank(spark, sf):
    out = O.percent_rank_average(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice")
    return out.select("p_partkey", F.round("pct", 8).alias("pct"))


@query("percent_rank_groups", """
    SELECT event_id, round((rank() OVER (PARTITION BY event_type ORDER BY value) +
      (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0) / count(*) OVER (PARTITION BY event_type), 8) AS pct FROM events""")
def percent_rank_groups(spark, sf):
    out = O.percent_rank_average(table(spark, sf, "events").select("event_id", "event_type", "value"), "value", ["event_type"])
    return out.select("event_id", F.round("pct", 8).alias("pct"))


@query("sorted_positions", """
    SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice) AS up, rank() OVER (ORDER BY o_totalprice DESC) AS down FROM orders""")
def sorted_positions(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    both = O.sort_rank(O.sort_rank(df, "o_totalprice", "up"), "o_totalprice", "down", descending=True)
    return both.select("o_orderkey", F.col("up").cast("bigint").alias("up"), F.col("down").cast("bigint").alias("down"))


@query("top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.top_n(df, 10, F.desc("o_totalprice"), "o_orderkey")


SHARES = """(SELECT s_nationkey, sum(l_extendedprice) AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)"""


def nation_revenue(spark, sf):
    """Revenue per supplier nation: per supplier first, then joined and summed."""
    per_supplier = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.sum("l_extendedprice").alias("r"))
    return per_supplier.join(table(spark, sf, "supplier"), "s_suppkey").groupBy("s_nationkey").agg(F.sum("r").alias("revenue"))


@query("cumulative_share", f"""
    SELECT s_nationkey, round(sum(revenue) OVER (ORDER BY revenue DESC, s_nationkey) / sum(revenue) OVER (), 8) AS cumulative FROM {SHARES}""")
def cumulative_share(spark, sf):
    curve = O.cumulative_share(nation_revenue(spark, sf), "revenue", [F.desc("revenue"), "s_nationkey"])
    return curve.select("s_nationkey", F.round("cumulative", 8).alias("cumulative"))


@query("first_reaching", f"""
    SELECT min(i) AS components, min(i) - 1 AS old_index FROM (SELECT row_number() OVER (ORDER BY revenue DESC, s_nationkey) AS i,
      sum(revenue) OVER (ORDER BY revenue DESC, s_nationkey) / sum(revenue) OVER () AS c FROM {SHARES}) WHERE c >= 0.85""")
def first_reaching(spark, sf):
    """How many nations make up 85 % of the revenue."""
    from pyspark.sql import Window

    order = [F.desc("revenue"), "s_nationkey"]
    curve = O.cumulative_share(nation_revenue(spark, sf), "revenue", order)
    curve = curve.withColumn("i", F.row_number().over(Window.orderBy(*order)))
    count = O.first_reaching(curve, "cumulative", "i", 0.85)
    index = O.first_reaching(curve, "cumulative", "i", 0.85, zero_based=True)
    return count.select(F.col("components").cast("bigint").alias("components"),
                        index.scalar().cast("bigint").alias("old_index"))


@query("elbow_of_curve", """
    WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
    c AS (SELECT least(floor((value - lo) / w), 19)::BIGINT AS bin, count(*) AS n FROM events, r GROUP BY 1),
    f AS (SELECT t.i AS i, (SELECT coalesce(sum(n), 0) FROM c WHERE bin >= t.i) AS y FROM range(20) t(i)),
    d AS (SELECT i, (max(y) OVER () - y) / (max(y) OVER () - min(y) OVER ()) - (i - min(i) OVER ()) / (max(i) OVER () - min(i) OVER ()) AS gap FROM f),
    p AS (SELECT i, gap, lag(gap) OVER (ORDER BY i) AS a, lead(gap) OVER (ORDER BY i) AS b FROM d)
    SELECT min(i)::BIGINT AS elbow FROM p WHERE gap >= a AND gap >= b""")
def elbow_of_curve(spark, sf):
    """Knee of the curve 'events at or above the bin'."""
    from pyspark.sql import Window

    hist = A.histogram(table(spark, sf, "events"), "value", 20)
    left = F.sum("n").over(Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0))
    return O.elbow(hist.select("bin", left.alias("y")), "bin", "y")
