"""Time-series rules on small series."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.operators import many_series as MS, series as TS

DAY = dt.date(2020, 1, 1)


def frame(spark, values, series="a"):
    return spark.createDataFrame([(series, DAY + dt.timedelta(i), None if v is None else float(v)) for i, v in enumerate(values)], "series string, ds date, y double")


def test_interpolation_ends(spark):
    df = frame(spark, [None, None, 1.0, None, None, 4.0, None])
    got = [r["y"] for r in TS.interpolate(df).orderBy("ds").collect()]
    assert got == [None, None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_grid_per_series(spark):
    df = frame(spark, [1.0, None, 3.0]).where("y is not null").unionByName(frame(spark, [5.0], "b"))
    got = TS.as_daily(df)
    assert {r["series"]: r["count"] for r in got.groupBy("series").count().collect()} == {"a": 3, "b": 1}


@pytest.mark.parametrize("period", [7, 4])
def test_decomposition_recovers_season(spark, period):
    season = np.array([3.0, -1.0, 2.0, -4.0, 1.5, -0.5, -1.0])[:period]
    season -= season.mean()
    y = [10 + 0.5 * i + season[i % period] for i in range(8 * period)]
    out = TS.seasonal_decompose(frame(spark, y), period).orderBy("ds").toPandas()
    inner = out.dropna()
    assert np.allclose(inner["resid"], 0, atol=1e-9)
    assert np.allclose(out["seasonal"], season[out["t"] % period])
    assert out["trend"].isna().sum() == 2 * (period // 2)


def test_rolling_excludes_current_row(spark):
    out = TS.rolling_stats(frame(spark, [1.0, 2.0, 3.0, None, 5.0]), "y", 3).orderBy("ds").collect()
    assert [r["prev_mean"] for r in out] == [None, None, None, 2.0, None]


def test_outliers_spare_calendar_days(spark):
    y = [1.0, 2.0, 1.0, 2.0, 1.0, 2.0, 1.0, 90.0, 2.0, 1.0]
    z = TS.rolling_zscore(frame(spark, y), "y", 7)
    assert [r["ds"] for r in TS.flag_outliers(z, "z").collect()] == [DAY + dt.timedelta(7)]
    calendar = spark.createDataFrame([("h", DAY + dt.timedelta(7))], "holiday string, ds date")
    assert TS.flag_outliers(z, "z", calendar).count() == 0
    fixed = TS.repair_outliers(frame(spark, y), TS.flag_outliers(z, "z")).orderBy("ds").collect()
    assert fixed[7]["y"] == 1.5


def test_calendar_windows(spark):
    h = spark.createDataFrame([("a", DAY, -1, 1), ("b", DAY, 0, 0)], "holiday string, ds date, lower_window int, upper_window int")
    cal = TS.holiday_calendar(h)
    assert cal.count() == 4
    flags = {r["ds"]: (r["hol_0"], r["hol_1"]) for r in TS.holiday_flags(cal, ["a", "b"]).collect()}
    assert flags[DAY] == (1, 1) and flags[DAY + dt.timedelta(1)] == (1, 0)


def planted(n):
    t = np.arange(n)
    return 50 + 0.05 * t + 4 * np.sin(2 * np.pi * t / 7) + 9 * np.cos(2 * np.pi * t / 365)


def test_forecast_recovers_planted_signal(spark):
    y = planted(1460)
    df = frame(spark, [float(v) for v in y[:1095]])
    model = TS.AdditiveForecast().fit(df)
    out = model.predict(TS.future_frame(df, 365)).orderBy("ds").toPandas()
    assert len(out) == 1460
    assert np.abs(out["yhat"].to_numpy()[1095:] - y[1095:]).max() < 2.0
    assert (out["yhat_lower"] < out["yhat_upper"]).all()
    parts = model.components(TS.future_frame(df, 10)).toPandas()
    assert np.allclose(parts["yhat"], parts[["trend", "weekly", "yearly", "holidays"]].sum(axis=1))


def test_forecast_holiday_effect_and_backtest(spark):
    y = planted(1100)
    days = list(range(100, 1100, 200))
    y[days] += 30
    df = frame(spark, [float(v) for v in y])
    cal = spark.createDataFrame([("h", DAY + dt.timedelta(i)) for i in days], "holiday string, ds date")
    part = TS.AdditiveForecast().fit(df, cal).components(df.select("series", "ds")).where(F.col("holidays") > 20)
    assert part.count() == len(days)
    assert TS.backtest(df, 365, cal).first()["median_abs_error"] < 1.5


def test_many_series(spark):
    y = planted(800)
    df = frame(spark, [float(v) for v in y]).unionByName(frame(spark, [float(2 * v) for v in y], "b"))
    out = MS.forecast_many(df, 30).toPandas()
    assert len(out) == 60
    a, b = (out[out["series"] == s].sort_values("ds")["yhat"].to_numpy() for s in "ab")
    assert np.allclose(b, 2 * a) and np.abs(a - planted(830)[800:]).max() < 0.5


def test_many_series_as_one_by_one(spark):
    """Series of different start, length, level and noise, with gaps: as the model of one series, on all parts."""
    rng = np.random.default_rng(4)
    df, calendars = None, []
    for k, (start, n, level) in enumerate([(0, 900, 1.0), (200, 500, 1e6), (50, 40, -3.0)]):
        y = level * (1 + 0.1 * rng.standard_normal(n) + 0.3 * np.sin(2 * np.pi * np.arange(n) / 7) + 0.002 * np.maximum(np.arange(n) - n / 2, 0))
        values = [None] * start + [None if rng.random() < 0.1 and 0 < i < n - 1 else float(v) for i, v in enumerate(y)]
        part = frame(spark, values, f"s{k}").where(F.col("ds") >= F.lit(DAY + dt.timedelta(start)))
        df = part if df is None else df.unionByName(part)
    cal = spark.createDataFrame([("h", DAY + dt.timedelta(i)) for i in (60, 100, 300, 301, 465)], "holiday string, ds date")
    many = MS.ManySeriesForecast(changepoints=10).fit(df, cal)
    days = TS.future_frame(df, 60)
    got = many.predict(days).toPandas().set_index(["series", "ds"]).sort_index()
    parts = many.components(days).toPandas().set_index(["series", "ds"]).sort_index()
    for k in range(3):
        own = df.where(F.col("series") == f"s{k}")
        one = TS.AdditiveForecast(changepoints=10).fit(own, cal)
        want = one.predict(TS.future_frame(own, 60)).toPandas().set_index(["series", "ds"]).sort_index()
        mine = got.loc[[f"s{k}"]]
        size = np.abs(want["yhat"]).max()
        assert len(mine) == len(want)
        assert np.abs(mine[["yhat", "yhat_lower", "yhat_upper"]].to_numpy() - want[["yhat", "yhat_lower", "yhat_upper"]].to_numpy()).max() < 1e-7 * size
        split = one.components(TS.future_frame(own, 60)).toPandas().set_index(["series", "ds"]).sort_index()
        for c in ("trend", "weekly", "yearly", "holidays"):
            assert np.abs(parts.loc[[f"s{k}"], c].to_numpy() - split[c].to_numpy()).max() < 1e-6 * size


def test_many_series_odd_input(spark):
    day = lambda i: DAY + dt.timedelta(i)
    rows = [("one", day(0), 5.0), ("none", day(0), None), (None, day(0), 1.0), (None, day(1), 2.0)]
    rows += [("flat", day(i), 2.5) for i in range(20)] + [("two", day(0), 1.0), ("two", day(9), 3.0)]
    df = spark.createDataFrame(rows, "series string, ds date, y double")
    out = MS.forecast_many(df, 3).collect()
    by = {}
    for r in out:
        by.setdefault(r["series"], []).append(r["yhat"])
    assert set(by) == {"one", "flat", "two"} and all(len(v) == 3 for v in by.values())
    assert np.allclose(by["one"], 5.0) and np.allclose(by["flat"], 2.5) and all(np.isfinite(v) for v in by["two"])
    assert MS.forecast_many(df.limit(0), 3).collect() == []


def test_holidays_of_one_series(spark):
    y = [10.0 + (30.0 if i in (20, 50) else 0.0) for i in range(80)]
    df = frame(spark, y, "a").unionByName(frame(spark, [10.0] * 80, "b"))
    cal = spark.createDataFrame([("a", "h", DAY + dt.timedelta(i)) for i in (20, 50, 85)], "series string, holiday string, ds date")
    out = {(r["series"], r["ds"]): r["yhat"] for r in MS.forecast_many(df, 10, cal, changepoints=0, weekly_order=0, yearly_order=0).collect()}
    assert abs(out["a", DAY + dt.timedelta(85)] - 40) < 0.1 and abs(out["b", DAY + dt.timedelta(85)] - 10) < 1e-6


def test_coefficients_table(spark):
    model = MS.ManySeriesForecast(changepoints=0, weekly_order=1, yearly_order=0).fit(frame(spark, [float(i) for i in range(50)]))
    rows = {r["term"]: r["value"] for r in model.coefficients_table().collect()}
    assert set(rows) == {"x_t", "x_weekly_s1", "x_weekly_c1"} and abs(rows["x_t"] - 49) < 1e-3
