"""Daily time series over the order history."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import many_series as MS, series as TS
from rowsmith.operators.ordered import last_rows_split
from rowsmith.plans.q_sources import HOLIDAY_SQL, holidays
from rowsmith.plans.registry import query
from rowsmith.session import materialise
from rowsmith.sources.tables import table

GRID = """
    d AS (SELECT o_orderdate::DATE AS ds, sum(o_totalprice) AS y FROM orders GROUP BY 1),
    g AS (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ds
          FROM (SELECT min(ds) AS lo, max(ds) AS hi FROM d)),
    grid AS (SELECT g.ds, y, (g.ds - (SELECT min(ds) FROM d))::BIGINT AS t FROM g LEFT JOIN d USING (ds))"""
# Days whose number is a multiple of 5 are blanked, so that every scale has gaps of one or more days.
HOLES = f"""{GRID}, holed AS (SELECT ds, t, CASE WHEN t % 5 <> 0 AND t % 11 <> 1 THEN y END AS y FROM grid)"""
FILLED = f"""{HOLES}, known AS (SELECT t AS kt, y AS ky FROM holed WHERE y IS NOT NULL),
    filled AS (SELECT h.ds, h.t, CASE WHEN h.y IS NOT NULL THEN h.y WHEN p.kt IS NULL THEN NULL WHEN n.kt IS NULL THEN p.ky
        ELSE p.ky + (n.ky - p.ky) / (n.kt - p.kt) * (h.t - p.kt) END AS y
      FROM holed h ASOF LEFT JOIN known p ON h.t >= p.kt ASOF LEFT JOIN known n ON h.t <= n.kt)"""
# Leading gaps stay empty, so the decomposition works on the filled days from the first known one.
CLEAN = f"""{GRID}, known AS (SELECT t AS kt, y AS ky FROM grid WHERE y IS NOT NULL),
    clean AS (SELECT h.ds, h.t, CASE WHEN h.y IS NOT NULL THEN h.y
        ELSE p.ky + (n.ky - p.ky) / (n.kt - p.kt) * (h.t - p.kt) END AS y
      FROM grid h ASOF LEFT JOIN known p ON h.t >= p.kt ASOF LEFT JOIN known n ON h.t <= n.kt)"""
DECOMP = f"""{CLEAN},
    ma AS (SELECT ds, t, y, CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS trend FROM clean
           WINDOW w AS (ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    ph AS (SELECT t % 7 AS phase, avg(y - trend) AS m FROM ma GROUP BY 1),
    dec AS (SELECT ds, t, y, trend, m - (SELECT avg(m) FROM ph) AS seasonal,
            y - trend - (m - (SELECT avg(m) FROM ph)) AS resid FROM ma JOIN ph ON ph.phase = ma.t % 7)"""
ROLLZ = f"""{DECOMP}, roll AS (SELECT *, count(resid) OVER w AS c, avg(resid) OVER w AS m, stddev_pop(resid) OVER w AS s FROM dec
        WINDOW w AS (ORDER BY t ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT ds, t, y, resid, CASE WHEN c = 7 THEN m END AS prev_mean, CASE WHEN c = 7 THEN s END AS prev_std,
          CASE WHEN c = 7 AND s <> 0 THEN (resid - m) / s END AS z FROM roll)"""
CAL = f"(SELECT DISTINCT (ds + s::INT)::DATE AS ds FROM {HOLIDAY_SQL}, range(lower_window, upper_window + 1) t(s))"


def grid(spark, sf):
    orders = table(spark, sf, "orders")
    return TS.as_daily(TS.daily(orders, "o_orderdate", F.sum("o_totalprice")))


def holed(spark, sf):
    df = TS.positions(grid(spark, sf))
    return df.select("series", "ds", F.when((F.col("t") % 5 != 0) & (F.col("t") % 11 != 1), F.col("y")).alias("y"))


def filled(spark, sf):
    return TS.interpolate(grid(spark, sf))


def rolled(spark, sf):
    return TS.rolling_zscore(TS.seasonal_decompose(filled(spark, sf)).select("series", "ds", "y", "resid"), "resid", 7)


@query("daily_grid", f"WITH {GRID} SELECT ds, round(y, 4) AS y FROM grid")
def daily_grid(spark, sf):
    return grid(spark, sf).select("ds", F.round("y", 4).alias("y"))


@query("daily_grid_many_series", """
    WITH d AS (SELECT o_orderpriority AS series, o_orderdate::DATE AS ds, count(*) AS y FROM orders GROUP BY ALL),
    g AS (SELECT series, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS ds
          FROM (SELECT series, min(ds) AS lo, max(ds) AS hi FROM d GROUP BY 1))
    SELECT series, count(*) AS days, count(y) AS known FROM g LEFT JOIN d USING (series, ds) GROUP BY 1""")
def daily_grid_many_series(spark, sf):
    df = TS.as_daily(TS.daily(table(spark, sf, "orders"), "o_orderdate", F.count("*"), F.col("o_orderpriority")))
    return df.groupBy("series").agg(F.count("*").alias("days"), F.count("y").alias("known"))


@query("interpolate", f"WITH {FILLED} SELECT ds, round(y, 4) AS y FROM filled")
def interpolate(spark, sf):
    return TS.interpolate(holed(spark, sf)).select("ds", F.round("y", 4).alias("y"))


@query("linear_trend", f"""
    WITH {CLEAN}, r AS (SELECT regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM clean)
    SELECT ds, round(a + b * t, 2) AS trend FROM clean, r""")
def linear_trend(spark, sf):
    return TS.linear_trend(filled(spark, sf)).select("ds", F.round("trend", 2).alias("trend"))


@query("detrend", f"""
    WITH {CLEAN}, r AS (SELECT regr_slope(y, t) AS b, regr_intercept(y, t) AS a, avg(t) AS mt FROM clean)
    SELECT ds, round(y - (a + b * t) + a + b * mt, 2) AS detrended FROM clean, r""")
def detrend(spark, sf):
    return TS.detrend(filled(spark, sf)).select("ds", F.round("detrended", 2).alias("detrended"))


@query("seasonal_decompose", f"""
    WITH {DECOMP} SELECT ds, round(trend, 2) AS trend, round(seasonal, 2) AS seasonal, round(resid, 2) AS resid FROM dec""")
def seasonal_decompose(spark, sf):
    return TS.seasonal_decompose(filled(spark, sf)).select(
        "ds", *[F.round(c, 2).alias(c) for c in ("trend", "seasonal", "resid")])


@query("residual_zscore", f"""
    WITH {DECOMP} SELECT ds, round((resid - avg(resid) OVER ()) / stddev_pop(resid) OVER (), 6) AS z FROM dec""")
def residual_zscore(spark, sf):
    return TS.zscore(TS.seasonal_decompose(filled(spark, sf)), "resid").select("ds", F.round("z", 6).alias("z"))


@query("rolling_stats", f"""
    WITH {HOLES}, r AS (SELECT ds, count(y) OVER w AS c, avg(y) OVER w AS m, stddev_pop(y) OVER w AS s FROM holed
      WINDOW w AS (ORDER BY t ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
    SELECT ds, CASE WHEN c = 3 THEN round(m, 4) END AS prev_mean, CASE WHEN c = 3 THEN round(s, 4) END AS prev_std FROM r""")
def rolling_stats(spark, sf):
    return TS.rolling_stats(holed(spark, sf), "y", 3).select(
        "ds", F.round("prev_mean", 4).alias("prev_mean"), F.round("prev_std", 4).alias("prev_std"))


@query("rolling_zscore", f"WITH {ROLLZ} SELECT ds, round(z, 5) AS z FROM z")
def rolling_zscore(spark, sf):
    return rolled(spark, sf).select("ds", F.round("z", 5).alias("z"))


@query("flag_outliers", f"""
    WITH {ROLLZ} SELECT ds, round(z, 5) AS z FROM z WHERE z IS NOT NULL AND NOT z BETWEEN -3 AND 3
      AND ds NOT IN (SELECT ds FROM {CAL})""")
def flag_outliers(spark, sf):
    calendar = TS.holiday_calendar(holidays(spark))
    return TS.flag_outliers(rolled(spark, sf), "z", calendar).select("ds", F.round("z", 5).alias("z"))


@query("repair_outliers", f"""
    WITH {ROLLZ}, bad AS (SELECT ds FROM z WHERE z IS NOT NULL AND NOT z BETWEEN -3 AND 3 AND ds NOT IN (SELECT ds FROM {CAL})),
    blank AS (SELECT ds, t, CASE WHEN ds NOT IN (SELECT ds FROM bad) THEN y END AS y FROM z),
    kn AS (SELECT t AS kt, y AS ky FROM blank WHERE y IS NOT NULL)
    SELECT h.ds, round(CASE WHEN h.y IS NOT NULL THEN h.y WHEN p.kt IS NULL THEN NULL WHEN n.kt IS NULL THEN p.ky
        ELSE p.ky + (n.ky - p.ky) / (n.kt - p.kt) * (h.t - p.kt) END, 4) AS y
    FROM blank h ASOF LEFT JOIN kn p ON h.t >= p.kt ASOF LEFT JOIN kn n ON h.t <= n.kt""")
def repair_outliers(spark, sf):
    scored = rolled(spark, sf)
    flagged = TS.flag_outliers(scored, "z", TS.holiday_calendar(holidays(spark)))
    return TS.repair_outliers(filled(spark, sf), flagged).select("ds", F.round("y", 4).alias("y"))


@query("holiday_calendar", f"""
    WITH d AS (SELECT o_orderdate::DATE AS ds, count(*) AS n FROM orders GROUP BY 1)
    SELECT ds, max((holiday = 'fair')::INT) AS fair, max((holiday = 'midsummer')::INT) AS midsummer,
      max((holiday = 'new_year')::INT) AS new_year, coalesce(any_value(n), 0)::BIGINT AS orders
    FROM (SELECT holiday, (ds + s::INT)::DATE AS ds FROM {HOLIDAY_SQL}, range(lower_window, upper_window + 1) t(s)) LEFT JOIN d USING (ds)
    GROUP BY 1""")
def holiday_calendar(spark, sf):
    """Indicator per holiday name and the orders of each calendar day."""
    names = ["fair", "midsummer", "new_year"]
    flags = TS.holiday_flags(TS.holiday_calendar(holidays(spark)), names)
    flags = flags.withColumnsRenamed({f"hol_{i}": n for i, n in enumerate(names)})
    orders = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("ds")).agg(F.count("*").alias("orders"))
    return flags.join(orders, "ds", "left").na.fill(0, subset=["orders"])


@query("last_days_split", f"""
    WITH {GRID}, r AS (SELECT *, row_number() OVER (ORDER BY ds DESC) AS i FROM grid)
    SELECT CASE WHEN i <= 365 THEN 'test' ELSE 'train' END AS part, count(*) AS days, min(ds) AS first, max(ds) AS last FROM r GROUP BY 1""")
def last_days_split(spark, sf):
    return last_rows_split(grid(spark, sf), "ds", 365).groupBy("part").agg(
        F.count("*").alias("days"), F.min("ds").alias("first"), F.max("ds").alias("last"))


@query("future_frame", f"""
    WITH {GRID} SELECT ds FROM grid UNION ALL
    SELECT unnest(generate_series(hi + INTERVAL 1 DAY, hi + INTERVAL 365 DAY, INTERVAL 1 DAY))::DATE FROM (SELECT max(ds)::TIMESTAMP AS hi FROM grid)""")
def future_frame(spark, sf):
    return TS.future_frame(grid(spark, sf), 365).select("ds")


def _model(spark, sf):
    history = materialise(filled(spark, sf), "history")
    return history, TS.AdditiveForecast().fit(history, TS.holiday_calendar(holidays(spark)))


@query("forecast")
def forecast(spark, sf):
    history, model = _model(spark, sf)
    return model.predict(TS.future_frame(history, 365)).drop("series")


@query("forecast_line", f"""
    WITH {GRID}, k AS (SELECT t, ln(y) AS y FROM grid WHERE y IS NOT NULL),
    m AS (SELECT regr_slope(y, t) AS b, regr_intercept(y, t) AS a, sqrt(sum(y * y) / count(*)) AS scale FROM k),
    e AS (SELECT sqrt(avg(pow(y - a - b * t, 2))) AS sigma FROM k, m),
    days AS (SELECT ds, t FROM grid WHERE y IS NOT NULL UNION ALL
      SELECT (hi + CAST(i AS INTEGER))::DATE, last + i FROM (SELECT max(ds) AS hi, max(t) AS last FROM grid), range(1, 31) r(i))
    SELECT ds, round(a + b * t, 5) AS yhat, round(a + b * t - 1.2816 * sigma, 5) AS yhat_lower FROM days, m, e""")
def forecast_line(spark, sf):
    """Without knots, waves and holidays the forecast is the least-squares line with its residual band."""
    history = TS.daily(table(spark, sf, "orders"), "o_orderdate", F.log(F.sum("o_totalprice")))
    model = TS.AdditiveForecast(changepoints=0, yearly_order=0, weekly_order=0).fit(history)
    out = model.predict(TS.future_frame(history, 30))
    return out.select("ds", F.round("yhat", 5).alias("yhat"), F.round("yhat_lower", 5).alias("yhat_lower"))


@query("forecast_components")
def forecast_components(spark, sf):
    history, model = _model(spark, sf)
    return model.components(TS.future_frame(history, 365)).drop("series")


def _priorities(spark, sf):
    return TS.daily(table(spark, sf, "orders"), "o_orderdate", F.sum("o_totalprice"), F.col("o_orderpriority"))


@query("forecast_many_series")
def forecast_many_series(spark, sf):
    """A year ahead for every order priority: knots, waves, holidays and interval."""
    return MS.forecast_many(TS.as_daily(_priorities(spark, sf)), 365, TS.holiday_calendar(holidays(spark)))


# Per series the days, their numbers and the day a series begins.
PRIORITIES = """
    d AS (SELECT o_orderpriority AS series, o_orderdate::DATE AS ds, sum(o_totalprice) AS y FROM orders GROUP BY ALL),
    s AS (SELECT *, min(ds) OVER (PARTITION BY series) AS lo, max(ds) OVER (PARTITION BY series) AS hi FROM d)"""


@query("forecast_many_line", f"""
    WITH {PRIORITIES}, m AS (SELECT series, any_value(lo) AS lo, any_value(hi) AS hi, regr_slope(y, ds - lo) AS b, regr_intercept(y, ds - lo) AS a FROM s GROUP BY 1),
    e AS (SELECT series, sqrt(avg(pow(y - a - b * (ds - s.lo), 2))) AS sigma FROM s JOIN m USING (series) GROUP BY 1),
    ahead AS (SELECT series, (hi + CAST(i AS INTEGER))::DATE AS ds, a + b * (hi + CAST(i AS INTEGER) - lo) AS yhat FROM m, range(1, 31) r(i))
    SELECT series, ds, round(yhat, 2) AS yhat, round(yhat - 1.2816 * sigma, 2) AS yhat_lower, round(yhat + 1.2816 * sigma, 2) AS yhat_upper
    FROM ahead JOIN e USING (series)""")
def forecast_many_line(spark, sf):
    """Without knots, waves and holidays every series is continued by its least-squares line with its residual band."""
    out = MS.forecast_many(_priorities(spark, sf), 30, changepoints=0, yearly_order=0, weekly_order=0, penalty=0.0)
    return out.select("series", "ds", *[F.round(c, 2).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


@query("forecast_many_holidays", f"""
    WITH {PRIORITIES}, x AS (SELECT series, y, (ds - lo)::DOUBLE AS t, (ds IN (SELECT ds FROM {CAL}))::INT::DOUBLE AS h, lo FROM s),
    c AS (SELECT series, covar_pop(t, t) AS tt, covar_pop(t, h) AS th, covar_pop(h, h) AS hh, covar_pop(t, y) AS ty, covar_pop(h, y) AS hy,
          avg(t) AS mt, avg(h) AS mh, avg(y) AS my FROM x GROUP BY 1),
    w AS (SELECT *, (ty * hh - hy * th) / (tt * hh - th * th) AS b, (hy * tt - ty * th) / (tt * hh - th * th) AS g FROM c)
    SELECT series, ds, round(my + b * ((ds - lo) - mt) - g * mh, 2) AS trend, round(g * (ds IN (SELECT ds FROM {CAL}))::INT, 2) AS holidays,
           round(my + b * ((ds - lo) - mt) + g * ((ds IN (SELECT ds FROM {CAL}))::INT - mh), 2) AS yhat
    FROM s JOIN w USING (series)""")
def forecast_many_holidays(spark, sf):
    """A line and one holiday effect per series: the components of every day of the history."""
    days = _priorities(spark, sf)
    calendar = TS.holiday_calendar(holidays(spark)).withColumn("holiday", F.lit("any")).distinct()
    model = MS.ManySeriesForecast(changepoints=0, yearly_order=0, weekly_order=0, penalty=0.0).fit(days, calendar)
    out = model.components(days.select("series", "ds"))
    return out.select("series", "ds", *[F.round(c, 2).alias(c) for c in ("trend", "holidays", "yhat")])


@query("forecast_many_backtest", f"""
    WITH {PRIORITIES}, f AS (SELECT * FROM s WHERE ds <= hi - 100),
    m AS (SELECT series, regr_slope(y, ds - lo) AS b, regr_intercept(y, ds - lo) AS a FROM f GROUP BY 1),
    e AS (SELECT series, sqrt(avg(pow(y - a - b * (ds - lo), 2))) AS sigma FROM f JOIN m USING (series) GROUP BY 1)
    SELECT series, count(*) AS days, round(avg(abs(y - a - b * (ds - lo))), 2) AS mean_abs_error,
           round(sqrt(avg(pow(y - a - b * (ds - lo), 2))), 2) AS rmse,
           round(avg((abs(y - a - b * (ds - lo)) <= 1.2816 * sigma)::INT), 6) AS coverage
    FROM s JOIN m USING (series) JOIN e USING (series) WHERE ds > hi - 100 GROUP BY 1""")
def forecast_many_backtest(spark, sf):
    """Every series' last 100 days against the line through the days before."""
    out = MS.backtest_many(_priorities(spark, sf), 100, changepoints=0, yearly_order=0, weekly_order=0, penalty=0.0)
    return out.select("series", "days", *[F.round(c, 2).alias(c) for c in ("mean_abs_error", "rmse")], F.round("coverage", 6).alias("coverage"))


@query("forecast_backtest")
def forecast_backtest(spark, sf):
    logs = filled(spark, sf).withColumn("y", F.log("y"))
    return TS.backtest(logs, 365, TS.holiday_calendar(holidays(spark)))
