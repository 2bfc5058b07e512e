"""Distributed order statistics against numpy, with a hot value and a hot group."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.operators import ordered, ranks, stats


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 6000
    key = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abc"), n))
    value = np.where(rng.random(n) < 0.35, 7.0, np.round(rng.normal(10, 5, n), 3))
    data = [(i, str(k), None if i % 13 == 0 else float(v)) for i, (k, v) in enumerate(zip(key, value))]
    return spark.createDataFrame(data, "id bigint, k string, v double").persist()


def test_quantiles_for_any_buckets(frame):
    probs = [0, 0.1, 0.25, 0.5, 0.77, 1]
    pdf = frame.toPandas()
    for parts, limit in ((2, 1), (2, 300), (64, 10), (None, 1), (None, None)):
        how = {"buckets": parts, "rows_per_bucket": limit or ranks.ROWS_PER_BUCKET}
        got = {r["k"]: r["q"] for r in ranks.exact_quantiles(frame, ["v"], probs, ["k"], **how).collect()}
        for k, part in pdf.groupby("k"):
            assert np.allclose(got[k], part["v"].dropna().quantile(probs)), (limit, k)
        one = ranks.exact_quantiles(frame, ["v"], probs, **how).first()["q"]
        assert np.allclose(one, pdf["v"].dropna().quantile(probs))


@pytest.mark.parametrize("buckets", [1, 7, 200])
def test_value_positions(frame, buckets):
    got = {r["v"]: (r["n"], r["below"], r["total"]) for r in ranks.value_positions(frame, "v", buckets=buckets).collect()}
    v = frame.toPandas()["v"].dropna().to_numpy()
    assert got == {x: (int((v == x).sum()), int((v < x).sum()), len(v)) for x in np.unique(v)}


def test_percent_rank_like_pandas(frame):
    got = ranks.percent_rank_average(frame, "v", ["k"]).toPandas().set_index("id")["pct"].sort_index()
    pdf = frame.toPandas().set_index("id")
    want = pdf.groupby("k")["v"].rank(pct=True).sort_index()
    assert np.allclose(got, want, equal_nan=True)


def test_hash_positions_are_dense(frame):
    from rowsmith.functions.hashing import hash_u32

    placed = ranks.hash_positions(frame.withColumn("h", hash_u32("id", 1)), "h", ["id"], ["k"])
    for _, part in placed.toPandas().groupby("k"):
        assert sorted(part["pos"]) == list(range(len(part)))
        assert (part.sort_values(["h", "id"])["pos"].to_numpy() == np.arange(len(part))).all()


def test_empty_and_single(rows):
    empty = rows([], "k string, v double")
    assert ranks.exact_quantiles(empty, ["v"], [0.5], ["k"]).count() == 0
    assert ranks.value_positions(empty, "v").count() == 0
    one = rows([("a", 4.0)], "k string, v double")
    assert ranks.exact_quantiles(one, ["v"], [0, 0.5, 1], ["k"]).first()["q"] == [4.0] * 3


def test_factorize_first_appearance(rows):
    df = rows([(5, "b"), (2, "a"), (3, None), (9, "a"), (1, "c")], "id bigint, v string")
    got = {r["id"]: r["code"] for r in ordered.factorize(df, "v", "id").collect()}
    assert got == {1: 0, 2: 1, 9: 1, 5: 2, 3: -1}


def test_elbow_and_first_reaching(rows):
    curve = rows([(k, 100.0 / k) for k in range(1, 11)], "k int, cost double")
    assert ordered.elbow(curve, "k", "cost").first()["elbow"] == 3
    shares = rows([(1, 0.6), (2, 0.85), (3, 1.0)], "i int, c double")
    assert ordered.first_reaching(shares, "c", "i", 0.85).first()[0] == 2
    assert ordered.first_reaching(shares, "c", "i", 0.85, zero_based=True).first()[0] == 1


def test_cumulative_share_of_a_long_curve(spark):
    out = ordered.cumulative_share(spark.range(9000).withColumn("v", F.lit(1.0)), "v", ["id"]).toPandas()
    assert np.allclose(out["cumulative"], (out["id"] + 1) / 9000)


def test_sort_rank_of_dates_and_text(rows):
    df = rows([("2024-01-05", "b"), ("2023-01-05", "a"), (None, "b"), ("2024-01-05", "ab")], "d string, t string").withColumn("d", F.col("d").cast("date"))
    assert sorted((r["pos"] or 0) for r in ordered.sort_rank(df, "d").collect()) == [0, 1, 2, 2]
    assert {r["t"]: r["pos"] for r in ordered.sort_rank(df, "t", descending=True).collect()} == {"b": 1, "ab": 3, "a": 4}


def test_group_function_refuses_large_groups(spark):
    with pytest.raises(ValueError):
        stats.group_apply_pandas(spark.range(20).withColumn("k", F.lit(1)), ["k"], lambda p: p, "id bigint, k int", max_group_rows=10)


def test_octaves_rise_with_the_value(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([10.0 ** rng.uniform(-320, 308, 3000), np.nextafter(1.0, [0, 2]), [5e-324, 1.7976931348623157e308, np.inf, 0.0, -0.0]])
    v = np.unique(np.concatenate([v, -v]))
    rows = spark.createDataFrame([(float(x),) for x in v], "v double").select("v", ranks._octave(F.col("v")).alias("o")).orderBy("v").collect()
    o = [r["o"] for r in rows]
    assert all(a <= b for a, b in zip(o, o[1:])) and o[0] == -30_000 and o[-1] == 30_000
    assert {r["o"] for r in rows if r["v"] == 0} == {0}


def test_quantiles_of_odd_values(spark):
    """Neighbouring doubles, huge spans, infinities, missing values, whole columns without values; several columns at once."""
    rng = np.random.default_rng(8)
    near = 1.0 + np.arange(400) * 2.0**-52
    span = np.concatenate([-(10.0 ** rng.uniform(-300, 300, 200)), 10.0 ** rng.uniform(-300, 300, 200)])
    data = [(float(a), float(b), None, float("inf") if i % 3 else -1.0, float("nan") if i % 2 else 2.0) for i, (a, b) in enumerate(zip(near, span))]
    df = spark.createDataFrame(data, "near double, span double, none double, inf double, nan double")
    probs = [0, 0.3, 0.5, 0.999, 1]
    for limit in (1, 50):
        got = {r["column"]: r["q"] for r in ranks.exact_quantiles(df, df.columns, probs, rows_per_bucket=limit).collect()}
        assert np.array_equal(got["near"], np.quantile(near, probs)) and np.allclose(got["span"], np.quantile(span, probs))
        assert got["none"] is None and got["nan"] == [2.0] * 5
        assert got["inf"][:2] == [-1.0, -1.0] and got["inf"][-1] == float("inf")


def test_quantiles_leave_the_driver_alone(spark, monkeypatch):
    """Whatever the rows, a level brings one row at most to the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen = []
    for name in ("collect", "toPandas", "toArrow", "take"):
        def spied(self, *args, _old=getattr(DataFrame, name)):
            out = _old(self, *args)
            seen.append(len(out))
            return out
        monkeypatch.setattr(DataFrame, name, spied)
    for rows in (1000, 100_000):
        ranks.exact_quantiles(spark.range(rows).select((F.col("id") * 1.5).alias("v")), ["v"], [0.5], rows_per_bucket=100)
    assert seen and max(seen) <= 1
