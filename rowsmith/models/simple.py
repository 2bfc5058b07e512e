"""Nearest-neighbour and naive Bayes models."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.features.base import FitStep, FittedStep, Settings, integer, text
from rowsmith.operators.neighbours import class_shares, nearest, running_mean
from rowsmith.operators.resample import class_counts
from rowsmith.operators.stats import long_agg
from rowsmith.session import materialise


def as_array(df: DataFrame, col: str) -> Column:
    """A feature column as array<double>, whether it is a vector or an array."""
    return vector_to_array(F.col(col)) if isinstance(df.schema[col].dataType, VectorUDT) else F.col(col).cast("array<double>")


class _KnnParams(Settings):
    featuresCol = text("featuresCol")
    labelCol = text("labelCol")
    keyCol = text("keyCol", "unique row key of training and scored rows")
    k = integer("k")
    defaults = {"featuresCol": "features", "labelCol": "label", "k": 5}


def _numbered(df: DataFrame) -> DataFrame:
    """Rows with a number of their own, stored: keys of scored rows may repeat."""
    return materialise(df.withColumn(ROW, F.monotonically_increasing_id()), "asked")


ROW = "__row"


class FittedKnnClassifier(_KnnParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        df = _numbered(df)
        asked = df.select(ROW, as_array(df, self.value("featuresCol")).alias("vec"))
        near = nearest(asked, self.tables["train"], ROW, "vec", self.value("k"), ref_key="ref_key", carry="label")
        classes = self.state["classes"]
        shares = class_shares(near, "label", classes)
        best = F.array_position("probability", F.array_max("probability")) - 1
        labels = F.array(*[F.lit(float(c)) for c in classes])
        out = shares.select(F.col("query_key").alias(ROW), F.get(labels, best.cast("int")).alias("prediction"),
                            array_to_vector("probability").alias("probability"))
        # Stored once: the search is costly and later steps read the result many times.
        return df.join(materialise(out, "scores"), ROW, "left").drop(ROW)


class KnnClassifier(_KnnParams, FitStep):
    """Majority vote of the ``k`` nearest training rows; the smallest class wins a tie."""

    model = FittedKnnClassifier

    def _fit(self, df: DataFrame) -> FittedKnnClassifier:
        train = df.select(F.col(self.value("keyCol")).alias("ref_key"), as_array(df, self.value("featuresCol")).alias("vec"),
                          F.col(self.value("labelCol")).cast("double").alias("label"))
        train = materialise(train, "knn")
        classes = sorted(class_counts(train, "label"))
        return self.fitted({"classes": classes}, train=train)


class FittedKnnRegressor(_KnnParams, FittedStep):
    def neighbours(self, df: DataFrame, k: int | None = None, key: str | None = None) -> DataFrame:
        key = key or self.value("keyCol")
        asked = df.select(key, as_array(df, self.value("featuresCol")).alias("vec"))
        return nearest(asked, self.tables["train"], key, "vec", k or self.value("k"), ref_key="ref_key", carry="label")

    def predict_all_k(self, df: DataFrame, k: int) -> DataFrame:
        """Prediction for every number of neighbours from 1 to ``k``, from one neighbour search."""
        return running_mean(self.neighbours(df, k), "label").withColumnRenamed("query_key", self.value("keyCol"))

    def _transform(self, df: DataFrame) -> DataFrame:
        df = _numbered(df)
        mean = self.neighbours(df, key=ROW).groupBy("query_key").agg(F.avg("label").alias("prediction")).withColumnRenamed("query_key", ROW)
        return df.join(materialise(mean, "scores"), ROW, "left").drop(ROW)


class KnnRegressor(_KnnParams, FitStep):
    """Mean of the ``k`` nearest training rows."""

    model = FittedKnnRegressor

    def _fit(self, df: DataFrame) -> FittedKnnRegressor:
        train = df.select(F.col(self.value("keyCol")).alias("ref_key"), as_array(df, self.value("featuresCol")).alias("vec"),
                          F.col(self.value("labelCol")).cast("double").alias("label"))
        return self.fitted({}, train=materialise(train, "knn"))


class _BayesParams(Settings):
    labelCol = text("labelCol")
    defaults = {"labelCol": "label"}


class FittedBayes(_BayesParams, FittedStep):
    """Log posterior of every class as column arithmetic."""

    def _transform(self, df: DataFrame) -> DataFrame:
        scores = []
        for c in self.state["classes"]:
            score = F.lit(c["log_prior"])
            for name, (mean, var) in c["stats"].items():
                score = score - 0.5 * (F.lit(math.log(2 * math.pi * var)) + F.pow(F.col(name) - F.lit(mean), 2) / F.lit(var))
            scores.append(score)
        out = df.withColumn("__s", F.array(*scores))
        best = F.array_position("__s", F.array_max("__s")) - 1
        weights = F.transform("__s", lambda s: F.exp(s - F.array_max("__s")))
        total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
        labels = F.array(*[F.lit(c["label"]) for c in self.state["classes"]])
        return out.withColumn("prediction", F.get(labels, best.cast("int"))).withColumn(
            "probability", array_to_vector(F.transform(weights, lambda x: x / total))).drop("__s")


class GaussianBayes(_BayesParams, FitStep):
    """Naive Bayes with one normal distribution per class and column.

    Variances get 1e-9 of the largest column variance added, so that a
    constant column does not divide by zero.
    """

    model = FittedBayes

    def _fit(self, df: DataFrame) -> FittedBayes:
        label, cols = self.value("labelCol"), self.value("inputCols")
        known = df.where(F.col(label).isNotNull())
        widest = known.agg(*[F.var_pop(F.col(c).cast("double")) for c in cols]).first()
        eps = 1e-9 * max(v or 0.0 for v in widest)
        per = long_agg(known, cols, {"n": lambda c: F.count(F.lit(1)), "m": lambda c: F.avg(F.col(c).cast("double")),
                                     "v": lambda c: F.var_pop(F.col(c).cast("double"))}, [label]).collect()
        total = sum(r["n"] for r in per) / len(cols)
        classes = []
        for value in sorted({r[label] for r in per}):
            mine = [r for r in per if r[label] == value]
            classes.append({"label": value, "log_prior": math.log(mine[0]["n"] / total),
                            "stats": {r["column"]: [r["m"], r["v"] + eps] for r in mine}})
        return self.fitted({"classes": classes})
