"""Daily time series: grid, gaps, trend, season, anomalies, forecast.

Input is first aggregated to one row per (series, day), so a series never has
more rows than its calendar and every window below is bounded by that.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.session import materialise

SERIES, DS, Y = "series", "ds", "y"


def daily(df: DataFrame, time_col: str, value: Column, series: Column | None = None) -> DataFrame:
    """One row per series and day with the aggregated value."""
    key = F.lit("all") if series is None else series
    return df.groupBy(key.alias(SERIES), F.col(time_col).cast("date").alias(DS)).agg(value.alias(Y))


def as_daily(df: DataFrame) -> DataFrame:
    """Fill the calendar between the first and the last day; new days have no value."""
    span = df.groupBy(SERIES).agg(F.min(DS).alias("lo"), F.max(DS).alias("hi"))
    grid = span.select(SERIES, F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias(DS))
    return grid.join(df, [SERIES, DS], "left")


def positions(df: DataFrame) -> DataFrame:
    """Zero-based day number inside each series (the grid has no holes)."""
    start = F.min(DS).over(Window.partitionBy(SERIES))
    return df.withColumn("t", F.datediff(DS, start).cast("bigint"))


def interpolate(df: DataFrame, col: str = Y) -> DataFrame:
    """Linear by position; leading gaps stay, trailing gaps repeat the last value."""
    w = Window.partitionBy(SERIES).orderBy(DS)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    # Running backwards, each row costs the same however long the series is.
    ahead = Window.partitionBy(SERIES).orderBy(F.col(DS).desc()).rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col(col).isNotNull(), F.struct(F.col("t"), F.col(col).alias("v")))
    both = positions(df).withColumn("__p", F.last(known, True).over(back)).withColumn("__n", F.last(known, True).over(ahead))
    slope = F.try_divide(F.col("__n.v") - F.col("__p.v"), F.col("__n.t") - F.col("__p.t"))
    filled = (
        F.when(F.col(col).isNotNull(), F.col(col))
        .when(F.col("__p").isNull(), F.lit(None))
        .when(F.col("__n").isNull(), F.col("__p.v"))
        .otherwise(F.col("__p.v") + slope * (F.col("t") - F.col("__p.t")))
    )
    return both.withColumn(col, filled).drop("__p", "__n", "t")


def trend_lines(df: DataFrame, col: str = Y) -> DataFrame:
    """Least-squares line over the day number, one row per series."""
    return positions(df).groupBy(SERIES).agg(
        F.regr_slope(F.col(col), F.col("t").cast("double")).alias("slope"),
        F.regr_intercept(F.col(col), F.col("t").cast("double")).alias("intercept"),
    )


def linear_trend(df: DataFrame, col: str = Y) -> DataFrame:
    return positions(df).join(trend_lines(df, col), SERIES).withColumn(
        "trend", F.col("intercept") + F.col("slope") * F.col("t")
    )


def detrend(df: DataFrame, col: str = Y) -> DataFrame:
    """Remove the straight line and add back its mean."""
    mean = F.avg("trend").over(Window.partitionBy(SERIES))
    return linear_trend(df, col).withColumn("detrended", F.col(col) - F.col("trend") + mean)


def seasonal_decompose(df: DataFrame, period: int = 7, col: str = Y) -> DataFrame:
    """Additive split into centred moving average, phase means and the rest."""
    w = Window.partitionBy(SERIES).orderBy(DS)
    half = period // 2
    span = w.rowsBetween(-half, half)
    full = F.count(col).over(span) == 2 * half + 1
    if period % 2:
        smooth = F.avg(col).over(span)
    else:
        ends = F.lag(col, half).over(w) + F.lead(col, half).over(w)
        smooth = (F.sum(col).over(span) - 0.5 * ends) / period
    base = positions(df).withColumn("trend", F.when(full, smooth)).withColumn("phase", F.col("t") % period)
    means = (
        base.groupBy(SERIES, "phase").agg(F.avg(F.col(col) - F.col("trend")).alias("__m"))
        .withColumn("seasonal", F.col("__m") - F.avg("__m").over(Window.partitionBy(SERIES)))
        .drop("__m")
    )
    return base.join(means, [SERIES, "phase"]).withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal"))


def zscore(df: DataFrame, col: str, out: str = "z") -> DataFrame:
    """Distance from the series mean in population deviations; gaps are skipped."""
    w = Window.partitionBy(SERIES)
    return df.withColumn(out, F.try_divide(F.col(col) - F.avg(col).over(w), F.stddev_pop(col).over(w)))


def rolling_stats(df: DataFrame, col: str, window: int) -> DataFrame:
    """Mean and population deviation of the ``window`` rows before the current one."""
    w = Window.partitionBy(SERIES).orderBy(DS).rowsBetween(-window, -1)
    full = F.count(col).over(w) == window
    return df.withColumn("prev_mean", F.when(full, F.avg(col).over(w))).withColumn(
        "prev_std", F.when(full, F.stddev_pop(col).over(w))
    )


def rolling_zscore(df: DataFrame, col: str, window: int = 7, out: str = "z") -> DataFrame:
    rolled = rolling_stats(df, col, window)
    return rolled.withColumn(out, F.try_divide(F.col(col) - F.col("prev_mean"), F.col("prev_std")))


def flag_outliers(df: DataFrame, z: str, calendar: DataFrame | None = None, bound: float = 3.0) -> DataFrame:
    """Days whose z lies outside ``[-bound, bound]`` and that are not calendar days."""
    hits = df.where(F.col(z).isNotNull() & ~F.col(z).between(-bound, bound))
    return hits if calendar is None else hits.join(calendar.select(DS).distinct(), DS, "left_anti")


def repair_outliers(df: DataFrame, flagged: DataFrame, col: str = Y) -> DataFrame:
    """Blank the flagged days and fill them by interpolation."""
    marks = flagged.select(SERIES, DS).withColumn("__bad", F.lit(True))
    blank = df.join(marks, [SERIES, DS], "left").withColumn(col, F.when(F.col("__bad").isNull(), F.col(col)))
    return interpolate(blank.drop("__bad"), col)


def holiday_calendar(holidays: DataFrame) -> DataFrame:
    """Rows (holiday, ds, lower_window, upper_window) expanded to every affected day."""
    days = F.expr("sequence(date_add(ds, cast(lower_window as int)), date_add(ds, cast(upper_window as int)), interval 1 day)")
    return holidays.select("holiday", F.explode(days).alias(DS))


def holiday_flags(calendar: DataFrame, names) -> DataFrame:
    """One 0/1 column per holiday name; several names may fall on one date."""
    return calendar.groupBy(DS).agg(*[F.max((F.col("holiday") == n).cast("int")).alias(f"hol_{i}") for i, n in enumerate(names)])


def future_frame(df: DataFrame, days: int = 365) -> DataFrame:
    """The days of the history followed by ``days`` more."""
    end = df.groupBy(SERIES).agg(F.max(DS).alias("hi"))
    more = end.select(SERIES, F.explode(F.sequence(F.date_add("hi", 1), F.date_add("hi", days))).alias(DS))
    return df.select(SERIES, DS).unionByName(more)


class AdditiveForecast:
    """Trend with slope changes, weekly and yearly waves, and holiday effects.

    One design row per day. The slope changes are penalised and the other
    columns are not (they enter on a larger scale, where the penalty is
    negligible), so changepoints that do not help shrink away. Fits the days of
    one series at a time on the cluster; ``many_series`` covers many series.
    """

    FREE = 1000.0

    def __init__(self, changepoints: int = 25, yearly_order: int = 2, weekly_order: int = 3,
                 year_period: float = 365.0, penalty: float = 0.01, width: float = 1.2816):
        self.changepoints, self.yearly_order, self.weekly_order = changepoints, yearly_order, weekly_order
        self.year_period, self.penalty, self.width = year_period, penalty, width

    def _design(self, days: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
        scaled = F.datediff(F.col(DS), F.lit(self.start)) / F.lit(self.days).cast("double")
        cols = {"x_t": scaled}
        groups: dict[str, list[str]] = {"trend": ["x_t"], "weekly": [], "yearly": [], "holidays": []}
        for i in range(self.changepoints):
            knot = 0.8 * (i + 1) / (self.changepoints + 1)
            cols[f"x_c{i}"] = F.greatest(scaled - F.lit(knot), F.lit(0.0))
            groups["trend"].append(f"x_c{i}")
        number = F.datediff(F.col(DS), F.lit("1970-01-01").cast("date"))
        for name, order, period in (("weekly", self.weekly_order, 7.0), ("yearly", self.yearly_order, self.year_period)):
            for k in range(1, order + 1):
                angle = number * F.lit(2 * math.pi * k / period)
                cols[f"x_{name}_s{k}"], cols[f"x_{name}_c{k}"] = F.sin(angle), F.cos(angle)
                groups[name] += [f"x_{name}_s{k}", f"x_{name}_c{k}"]
        out = days.withColumns(cols)
        if self.calendar is not None:
            hol = [f"hol_{i}" for i in range(len(self.names))]
            out = self._with_holidays(out).na.fill(0, subset=hol)
            groups["holidays"] = hol
        return out, groups

    def _with_holidays(self, days: DataFrame) -> DataFrame:
        return days.join(holiday_flags(self.calendar, self.names), DS, "left")

    def fit(self, df: DataFrame, calendar: DataFrame | None = None) -> "AdditiveForecast":
        df = materialise(df.where(F.col(Y).isNotNull()), "history")  # one row per day, read by several passes
        self.calendar = calendar
        self.names = [] if calendar is None else sorted(r[0] for r in calendar.select("holiday").distinct().collect())
        low, high, mean, dev, one, other = df.agg(
            F.min(DS), F.max(DS), F.avg(Y), F.stddev_pop(Y), F.min(SERIES), F.max(SERIES)).first()
        if one != other:
            raise ValueError("one series at a time; use ManySeriesForecast for several")
        self.start, self.days, dev = low, max((high - low).days, 1), dev or 1.0
        design, groups = self._design(df)
        self.features = [c for g in groups.values() for c in g]
        scale = {c: 1.0 if c.startswith("x_c") else self.FREE for c in self.features}
        sized = design.select(*[(F.col(c) * F.lit(scale[c])).alias(c) for c in self.features], ((F.col(Y) - F.lit(mean)) / F.lit(dev)).alias(Y))
        rows = VectorAssembler(inputCols=self.features, outputCol="features").transform(sized).select("features", Y)
        model = LinearRegression(labelCol=Y, regParam=self.penalty, elasticNetParam=0.0, standardization=False, solver="normal").fit(rows)
        self.coefficients = {c: float(v) * scale[c] * dev for c, v in zip(self.features, model.coefficients)}
        self.intercept = float(model.intercept) * dev + mean
        self.sigma = float(model.summary.rootMeanSquaredError) * dev
        return self

    def components(self, days: DataFrame) -> DataFrame:
        """The part of each column group for every day, and their sum."""
        design, groups = self._design(days)
        parts = {}
        for name, cols in groups.items():
            total = F.lit(self.intercept if name == "trend" else 0.0)
            for c in cols:
                total = total + F.col(c) * F.lit(self.coefficients[c])
            parts[name] = total
        out = design.select(*days.columns, *[p.alias(n) for n, p in parts.items()])
        return out.withColumn("yhat", F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("holidays"))

    def predict(self, days: DataFrame) -> DataFrame:
        """Expected value with an 80 % interval from the residual spread."""
        reach = F.lit(self.width * self.sigma)
        out = self.components(days)
        return out.select(*days.columns, "yhat", (F.col("yhat") - reach).alias("yhat_lower"),
                          (F.col("yhat") + reach).alias("yhat_upper"))


def backtest(df: DataFrame, horizon: int = 365, calendar: DataFrame | None = None, **options) -> DataFrame:
    """Hold out the last ``horizon`` days and report the median absolute error of the forecast."""
    cutoff = df.agg(F.date_sub(F.max(DS), horizon)).first()[0]
    model = AdditiveForecast(**options).fit(df.where(F.col(DS) <= F.lit(cutoff)), calendar)
    held = model.predict(df.where(F.col(DS) > F.lit(cutoff)))
    return held.agg(
        F.count("*").alias("days"),
        F.median(F.abs(F.col(Y) - F.col("yhat"))).alias("median_abs_error"),
    ).withColumn("one_minus_error", 1 - F.col("median_abs_error"))
