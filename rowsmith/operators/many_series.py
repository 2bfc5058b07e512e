"""The additive forecast for any number of series at once.

The design is built by column expressions, with knots on each series' own
calendar. All products of two design columns are added up per series, one
partial sum per task and series, so a series is one row of normal equations
however long it is. The small systems of many series are solved together, a
batch of rows at a time, and predictions are a join with the coefficients.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from rowsmith.operators.series import DS, SERIES, Y, AdditiveForecast, future_frame, holiday_flags
from rowsmith.session import materialise


def _product_places(n: int) -> np.ndarray:
    """Where a second-degree expansion of ``n`` columns holds the product of columns i and j, and where column i."""
    place, at = np.zeros((n + 1, n), int), 0
    for i in range(n):  # column i alone, then its products with columns 0 to i
        place[n, i] = at
        for j in range(i + 1):
            place[i, j] = place[j, i] = at + 1 + j
        at += i + 2
    return place


def solve_ridge(cov: np.ndarray, cross: np.ndarray, penalty: float) -> np.ndarray:
    """Batches of ``(cov + penalty * I) w = cross``; columns that do not vary get 0, and so does, with no penalty, what
    the data leave open."""
    d = np.sqrt(np.einsum("bii->bi", cov) + penalty)
    d = np.where(d > 0, d, 1.0)
    scaled = (cov + penalty * np.eye(cov.shape[1])) / (d[:, :, None] * d[:, None, :])
    right = (cross / d)[:, :, None]
    inverse = np.linalg.solve(scaled, right) if penalty > 0 else np.linalg.pinv(scaled, rcond=1e-12, hermitian=True) @ right
    return inverse[:, :, 0] / d


class ManySeriesForecast(AdditiveForecast):
    """``AdditiveForecast`` for every series of a table: same design, penalty, components and interval.

    A calendar with a ``series`` column holds for those series only. Days without a value are not fitted; a series
    without any value, or without a key, gets no forecast. A series of one value is forecast by that value.
    """

    def _with_holidays(self, days: DataFrame) -> DataFrame:
        if SERIES not in self.calendar.columns:
            return super()._with_holidays(days)
        flags = [F.max((F.col("holiday") == n).cast("int")).alias(f"hol_{i}") for i, n in enumerate(self.names)]
        return days.join(self.calendar.groupBy(SERIES, DS).agg(*flags), [SERIES, DS], "left")

    def _design(self, days: DataFrame):
        self.start, self.days = F.col("__start"), F.col("__days")
        return super()._design(days)

    def fit(self, df: DataFrame, calendar: DataFrame | None = None) -> "ManySeriesForecast":
        df = materialise(df.where(F.col(Y).isNotNull() & F.col(SERIES).isNotNull()).select(SERIES, DS, F.col(Y).cast("double")), "history")
        self.calendar = calendar
        self.names = [] if calendar is None else sorted(r[0] for r in calendar.select("holiday").distinct().collect())
        scale = df.groupBy(SERIES).agg(
            F.min(DS).alias("__start"), F.greatest(F.datediff(F.max(DS), F.min(DS)), F.lit(1)).alias("__days"),
            F.avg(Y).alias("__mean"), F.stddev_pop(Y).alias("__dev"), F.count(F.lit(1)).alias("__n"))
        scale = materialise(scale.withColumn("__dev", F.when(F.col("__dev") > 0, F.col("__dev")).otherwise(1.0)), "scale")
        design, groups = self._design(df.join(scale, SERIES))
        self.features = [c for g in groups.values() for c in g]
        free = np.array([1.0 if c.startswith("x_c") else self.FREE for c in self.features])
        rows = design.withColumn(Y, (F.col(Y) - F.col("__mean")) / F.col("__dev"))
        rows = VectorAssembler(inputCols=[*self.features, Y], outputCol="__row").transform(rows).select(SERIES, "__row")
        rows = PolynomialExpansion(degree=2, inputCol="__row", outputCol="__products").transform(rows)
        sums = rows.groupBy(SERIES).agg(Summarizer.mean(F.col("__products")).alias("__means"))
        width, penalty = len(self.features), self.penalty
        place = _product_places(width + 1)

        @F.pandas_udf("beta array<double>, intercept double, sigma double")
        def solved(means: pd.Series) -> pd.DataFrame:
            m = np.stack(means.to_numpy())
            single = m[:, place[-1]]
            cov = m[:, place[:-1]] - single[:, :, None] * single[:, None, :]
            x, cross = cov[:, :width, :width] * free[:, None] * free[None, :], cov[:, :width, width] * free
            w = solve_ridge(x, cross, penalty) if width else np.zeros((len(m), 0))
            rest = cov[:, width, width] - 2 * np.einsum("bi,bi->b", w, cross) + np.einsum("bi,bij,bj->b", w, x, w)
            beta = w * free
            return pd.DataFrame({
                "beta": list(beta), "intercept": single[:, width] - np.einsum("bi,bi->b", beta, single[:, :width]),
                "sigma": np.sqrt(np.maximum(rest, 0.0))})

        fitted = sums.select(SERIES, solved(vector_to_array("__means")).alias("__fit"))
        dev = F.col("__dev")
        self.model = materialise(fitted.join(scale, SERIES).select(
            SERIES, "__start", "__days", F.col("__n").alias("days"),
            F.transform("__fit.beta", lambda b: b * dev).alias("__beta"),
            (F.col("__fit.intercept") * dev + F.col("__mean")).alias("__intercept"),
            (F.col("__fit.sigma") * dev).alias("sigma")), "model")
        return self

    def coefficients_table(self) -> DataFrame:
        """(series, term, value) of every fitted column, and the number of days and the residual spread."""
        terms = F.arrays_zip(F.array(*[F.lit(c) for c in self.features]).cast("array<string>").alias("term"), F.col("__beta").alias("value"))
        return self.model.select(SERIES, "days", "sigma", F.explode(terms).alias("t")).select(SERIES, "days", "sigma", "t.term", "t.value")

    def components(self, days: DataFrame) -> DataFrame:
        design, groups = self._design(days.join(self.model.select(SERIES, "__start", "__days", "__beta", "__intercept"), SERIES))
        at = {c: i for i, c in enumerate(self.features)}
        parts = {}
        for name, cols in groups.items():
            total = F.col("__intercept") if name == "trend" else F.lit(0.0)
            for c in cols:
                total = total + F.col(c) * F.col("__beta")[at[c]]
            parts[name] = total
        out = design.select(*days.columns, *[p.alias(n) for n, p in parts.items()])
        return out.withColumn("yhat", F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("holidays"))

    def predict(self, days: DataFrame) -> DataFrame:
        """Expected value with an interval from the residual spread of its series."""
        out = self.components(days).join(self.model.select(SERIES, "sigma"), SERIES)
        reach = F.lit(self.width) * F.col("sigma")
        return out.select(*days.columns, "yhat", (F.col("yhat") - reach).alias("yhat_lower"), (F.col("yhat") + reach).alias("yhat_upper"))


def forecast_many(df: DataFrame, horizon: int = 365, calendar: DataFrame | None = None, **options) -> DataFrame:
    """The ``horizon`` days behind the last day of each series, forecast with an interval."""
    model = ManySeriesForecast(**options).fit(df, calendar)
    days = future_frame(df, horizon)
    last = df.groupBy(SERIES).agg(F.max(DS).alias("__last"))
    ahead = days.join(last, SERIES).where(F.col(DS) > F.col("__last")).drop("__last")
    return model.predict(ahead)


def backtest_many(df: DataFrame, horizon: int = 365, calendar: DataFrame | None = None, **options) -> DataFrame:
    """Per series: hold out its last ``horizon`` days, fit the rest, and report errors and the interval's coverage."""
    split = df.join(df.groupBy(SERIES).agg(F.date_sub(F.max(DS), horizon).alias("__cut")), SERIES)
    model = ManySeriesForecast(**options).fit(split.where(F.col(DS) <= F.col("__cut")), calendar)
    held = model.predict(split.where((F.col(DS) > F.col("__cut")) & F.col(Y).isNotNull()).drop("__cut"))
    error = F.abs(F.col(Y) - F.col("yhat"))
    return held.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("days"), F.avg(error).alias("mean_abs_error"), F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.col(Y).between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")).alias("coverage"))
