"""Profiles by sketches: merged snapshots against exact figures of all rows."""

import math

import pytest

from pyspark.sql import functions as F

from rowsmith.operators.snapshots import column_sketches, merge_sketches, sketch_report
from rowsmith.session import materialise
from rowsmith.sources.tables import table


def as_dict(report):
    return {(r["column"], r["section"], r["item"]): r["value"] for r in report.collect()}


def test_merged_equals_union_within_bounds(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", "l_returnflag")
    stored = materialise(column_sketches(lines, by=["l_returnflag"]), "sketches")
    merged = merge_sketches(stored)
    assert sorted(merged.columns) == sorted(merge_sketches(merged).columns)
    got = as_dict(sketch_report(merge_sketches(merged), bins=8))
    n = lines.count()
    for c in ("l_extendedprice", "l_quantity", "l_orderkey"):
        exact = lines.agg(F.avg(c).alias("m"), F.stddev_samp(c).alias("s"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                          F.count_distinct(c).alias("d")).first()
        assert int(got[c, "counts", "rows"]) == n
        assert float(got[c, "describe", "mean"]) == pytest.approx(exact["m"], rel=1e-12)
        assert float(got[c, "describe", "std"]) == pytest.approx(exact["s"], rel=1e-10)
        assert float(got[c, "describe", "min"]) == exact["lo"] and float(got[c, "describe", "max"]) == exact["hi"]
        assert int(got[c, "counts", "distinct"]) == pytest.approx(exact["d"], rel=0.03)
        for item, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            v = float(got[c, "describe", item])
            below = lines.where(F.col(c) < v).count() / n
            upto = lines.where(F.col(c) <= v).count() / n
            assert below - 0.01 <= p <= upto + 0.01
        lo, hi = exact["lo"], exact["hi"]
        true = lines.where(F.col(c) < lo + (hi - lo) / 8).count()
        assert abs(int(got[c, "histogram", "0"]) - true) <= 0.02 * n
    flags = {r["l_quantity"]: r["count"] for r in lines.groupBy("l_quantity").count().collect()}
    best = sorted(flags.values(), reverse=True)[:3]
    assert sorted((int(v) for (c, s, _), v in got.items() if c == "l_quantity" and s == "top"), reverse=True) == best


def test_order_of_merging_does_not_matter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    parts = [materialise(column_sketches(orders.where(F.pmod(F.col("o_orderkey"), F.lit(3)) == i)), "part") for i in range(3)]
    a = as_dict(sketch_report(merge_sketches(*parts)))
    b = as_dict(sketch_report(merge_sketches(parts[2], merge_sketches(parts[1], parts[0]))))
    whole = as_dict(sketch_report(column_sketches(orders)))
    assert set(a) == set(b) == set(whole)
    for k in a:
        if k[1] in ("counts", "top", "alert"):
            assert a[k] == b[k] == whole[k], k


def test_edges(spark, rows):
    odd = rows([(None, float("nan"), "", 0), (1, 2.0, "", 0), (None, None, None, 0)], "few int, part double, word string, none int")
    got = as_dict(sketch_report(column_sketches(odd)))
    assert got["part", "counts", "missing"] == "2" and got["part", "counts", "distinct"] == "1"
    assert got["word", "counts", "distinct"] == "1" and got["word", "top", ""] == "2"  # an empty text is a value
    assert got["part", "describe", "mean"] == "2.0" and got["part", "describe", "std"] is None
    assert ("none", "alert", "mostly zero") in got and ("few", "alert", "mostly missing") in got
    assert ("word", "describe", "mean") not in got
    empty = column_sketches(odd.where("1 = 0"))
    nothing = as_dict(sketch_report(empty))
    assert nothing["part", "counts", "rows"] == "0" and ("part", "describe", "mean") not in nothing
    joined = as_dict(sketch_report(merge_sketches(empty, column_sketches(odd))))
    assert joined["part", "describe", "mean"] == "2.0" and math.isclose(float(joined["part", "describe", "q50"]), 2.0)


def test_added_and_changed_columns(spark, rows):
    old = column_sketches(rows([(1, "a")], "n int, t string"))
    new = column_sketches(rows([(2.5, "b", True)], "n double, t string, extra boolean"))
    got = as_dict(sketch_report(merge_sketches(old, new)))
    assert got["n", "counts", "dtype"] == "double or int" and got["n", "describe", "mean"] == "1.75"
    assert got["extra", "counts", "rows"] == "1" and got["t", "counts", "distinct"] == "2"


def test_large_mean_keeps_its_deviation(spark):
    far = spark.range(1000).select((F.col("id") + 1e9).alias("v"), F.pmod("id", F.lit(7)).alias("g"))
    got = as_dict(sketch_report(merge_sketches(column_sketches(far, by=["g"]))))
    assert float(got["v", "describe", "std"]) == pytest.approx(288.8194360957494, rel=1e-12)
