"""Linear, logistic and margin models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import FitStep, FittedStep, Settings, integer, names, number, text
from rowsmith.features.numeric import VectorScaler
from rowsmith.operators.resample import balanced_weights, kfold
from rowsmith.operators.stats import present
from rowsmith.session import side_by_side


def least_squares(cols, label: str, prediction: str = "prediction") -> Pipeline:
    """Ordinary least squares by the normal equations."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol="features"),
        LinearRegression(labelCol=label, predictionCol=prediction, solver="normal", regParam=0.0),
    ])


class Logistic(FitStep):
    """L2-penalised logistic regression with inverse strength ``C``.

    Spark averages the loss over the rows, so the penalty is ``1 / (C * rows)``, with the rows that are fitted.
    ``C`` 0 means no penalty. The fitted step is Spark's own model.
    """

    featuresCol = text("featuresCol")
    labelCol = text("labelCol")
    weightCol = text("weightCol")
    C = number("C")
    defaults = {"featuresCol": "features", "labelCol": "label", "C": 1.0}

    def _fit(self, df: DataFrame):
        strength = self.value("C")
        penalty = 1.0 / (strength * max(df.count(), 1)) if strength else 0.0
        model = LogisticRegression(labelCol=self.value("labelCol"), featuresCol=self.value("featuresCol"), regParam=penalty,
                                   standardization=False, maxIter=100)
        return (model.setWeightCol(self.value("weightCol")) if self.value("weightCol") else model).fit(df)


def logistic(label: str = "label", C: float = 1.0, weight: str | None = None, features: str = "features") -> Logistic:
    return Logistic(labelCol=label, C=C, weightCol=weight, featuresCol=features)


def coefficient_table(spark, model, cols) -> DataFrame:
    rows = [(c, float(v)) for c, v in zip(cols, model.coefficients)] + [("intercept", float(model.intercept))]
    return spark.createDataFrame(rows, "column string, coefficient double")


def simple_regression(df: DataFrame, x: str, y: str, by=()) -> DataFrame:
    """Straight line per group in one aggregation."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return present(df, by).groupBy(*by).agg(
        F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"),
        F.regr_r2(ys, xs).alias("r2"), F.count("*").alias("n"))


def quadratic_regression(df: DataFrame, x: str, y: str, by=()) -> DataFrame:
    """Parabola per group: moments in one aggregation, the 3x3 system in column arithmetic.

    Powers are taken around the overall mean and in units of the deviation, so
    that sums of fourth powers keep their digits; the coefficients are given
    in the original unit.
    """
    mid, unit = df.agg(F.avg(F.col(x).cast("double")), F.stddev_pop(F.col(x).cast("double"))).first()
    unit = unit or 1.0
    u, v = (F.col(x) - F.lit(mid)) / F.lit(unit), F.col(y).cast("double")
    sums = [F.sum(F.pow(u, F.lit(float(p)))).alias(f"s{p}") for p in range(1, 5)]
    sums += [F.sum(v).alias("t0"), F.sum(u * v).alias("t1"), F.sum(u * u * v).alias("t2"), F.count("*").alias("n")]
    m = present(df, [x, y, *by]).groupBy(*by).agg(*sums)
    c = {k: F.col(k) for k in ("s1", "s2", "s3", "s4", "t0", "t1", "t2", "n")}

    def det(a, b, d):
        return a[0] * (b[1] * d[2] - b[2] * d[1]) - a[1] * (b[0] * d[2] - b[2] * d[0]) + a[2] * (b[0] * d[1] - b[1] * d[0])

    rows = [[c["n"], c["s1"], c["s2"]], [c["s1"], c["s2"], c["s3"]], [c["s2"], c["s3"], c["s4"]]]
    rhs = [c["t0"], c["t1"], c["t2"]]
    whole = det(*rows)
    p = [F.try_divide(det(*[[rhs[i] if j == k else rows[i][j] for j in range(3)] for i in range(3)]), whole) for k in range(3)]
    a, b, q = p[0], p[1] / F.lit(unit), p[2] / F.lit(unit * unit)
    return m.select(*by, "n", (a - b * F.lit(mid) + q * F.lit(mid * mid)).alias("c0"), (b - 2 * q * F.lit(mid)).alias("c1"), q.alias("c2"))


class _MarginParams(Settings):
    featuresCol = text("featuresCol")
    labelCol = text("labelCol")
    keyCols = names("keyCols", "row key that decides the calibration fold")
    degree = integer("degree")
    folds = integer("folds")
    seed = integer("seed")
    regParam = number("regParam")
    maxIter = integer("maxIter")
    defaults = {"featuresCol": "features", "labelCol": "label", "degree": 3, "folds": 5, "seed": 42, "regParam": 0.01, "maxIter": 50}


class FittedMargin(_MarginParams, FittedStep):
    """Margin model plus the sigmoid that turns the margin into a probability."""

    def _transform(self, df: DataFrame) -> DataFrame:
        a, b = self.state["slope"], self.state["offset"]
        out = self.models["margin"].transform(df)
        raw = F.get(vector_to_array("rawPrediction"), 1)
        p = 1 / (1 + F.exp(-(F.lit(a) * raw + F.lit(b))))
        return out.drop("__z", "__poly", "__zp").withColumn("probability", array_to_vector(F.array(1 - p, p)))


class PolynomialMargin(_MarginParams, FitStep):
    """Two-class margin model on explicit polynomial features, with probabilities.

    The features are scaled, expanded to all products up to ``degree``, and
    separated linearly with balanced class weights. Probabilities come from a
    logistic curve fitted on margins of held-out folds.
    """

    model = FittedMargin

    def _stages(self) -> Pipeline:
        label = self.value("labelCol")
        return Pipeline(stages=[
            VectorScaler(inputCol=self.value("featuresCol"), outputCol="__z"),
            PolynomialExpansion(inputCol="__z", outputCol="__poly", degree=self.value("degree")),
            VectorScaler(inputCol="__poly", outputCol="__zp"),
            LinearSVC(featuresCol="__zp", labelCol=label, weightCol="__w", regParam=self.value("regParam"), maxIter=self.value("maxIter")),
        ])

    def _fit(self, df: DataFrame) -> FittedMargin:
        label, folds = self.value("labelCol"), self.value("folds")
        rows = kfold(balanced_weights(df, label, "__w"), self.value("keyCols"), folds, self.value("seed"), "__fold")
        rows = rows.persist()
        try:
            def margins(i):
                model = self._stages().fit(rows.where(F.col("__fold") != i))
                return model.transform(rows.where(F.col("__fold") == i)).select(
                    label, "__w", array_to_vector(F.array(F.get(vector_to_array("rawPrediction"), 1))).alias("__m"))

            held = reduce(DataFrame.unionByName, side_by_side(df.sparkSession, [lambda i=i: margins(i) for i in range(folds)]))
            curve = LogisticRegression(featuresCol="__m", labelCol=label, standardization=False).fit(held)
            whole = self._stages().fit(rows)
        finally:
            rows.unpersist()
        out = self.fitted({"slope": float(curve.coefficients[0]), "offset": float(curve.intercept)})
        out.models = {"margin": whole}
        return out
