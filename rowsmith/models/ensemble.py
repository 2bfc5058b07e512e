"""Models made of other models."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import FitStep, FittedStep, MadeOfSteps, Settings, integer, number, text
from rowsmith.operators.resample import bootstrap, stratified_kfold
from rowsmith.session import materialise, side_by_side

RESULTS = ("prediction", "probability", "rawPrediction")


def fit_all(members: list[Estimator], df: DataFrame) -> list[Model]:
    return side_by_side(df.sparkSession, [lambda m=m: m.copy().fit(df) for m in members])


def probabilities(model, df: DataFrame, out: str) -> DataFrame:
    """Class probabilities of one member as an array column, its other outputs dropped."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")).drop(*[c for c in RESULTS if c not in df.columns])


def _average(df: DataFrame, members: list[str], drop: bool = True) -> DataFrame:
    # A member fitted without the last classes gives them probability 0.
    total = F.col(members[0])
    for m in members[1:]:
        total = F.zip_with(total, F.col(m), lambda a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))
    mean = F.transform(total, lambda v: v / F.lit(float(len(members))))
    out = df.withColumn("__p", mean)
    out = out.withColumn("prediction", (F.array_position("__p", F.array_max("__p")) - 1).cast("double"))
    out = out.withColumn("probability", array_to_vector("__p")).drop("__p")
    return out.drop(*members) if drop else out


class FittedVote(FittedStep):
    """Mean of the members' probabilities; classes are numbered 0, 1, ..."""

    def member_scores(self, df: DataFrame) -> DataFrame:
        for i, m in enumerate(self.members):
            df = probabilities(m, df, f"__m{i}")
        return df

    def _transform(self, df: DataFrame) -> DataFrame:
        return _average(self.member_scores(df), [f"__m{i}" for i in range(len(self.members))])


class SoftVote(MadeOfSteps, FitStep):
    """Average of the class probabilities of several fitted classifiers."""

    model = FittedVote

    def __init__(self, members: list[Estimator] | None = None, **params):
        super().__init__(**params)
        self.members = members or []

    def to_parts(self):
        return {}, self.numbered(self.members)

    @classmethod
    def from_parts(cls, plain, parts):
        return cls([parts[f"m{i}"] for i in range(len(parts))])

    def _fit(self, df: DataFrame) -> FittedVote:
        out = self.fitted({})
        out.models = self.numbered(fit_all(self.members, df))
        return out


class _BagParams(Settings):
    keyCol = text("keyCol")
    featuresCol = text("featuresCol")
    count = integer("count")
    rows = number("rows", "expected share of rows in each sample, drawn with replacement")
    columns = number("columns", "share of feature columns in each sample")
    seed = integer("seed")
    defaults = {"featuresCol": "features", "count": 10, "rows": 0.75, "columns": 0.75, "seed": 42}


class FittedBag(_BagParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        for i, (m, cols) in enumerate(zip(self.members, self.state["columns"])):
            view = VectorAssembler(inputCols=cols, outputCol="__f").transform(df)
            df = probabilities(m, view, f"__m{i}").drop("__f")
        return _average(df, [f"__m{i}" for i in range(len(self.members))])


class Bagging(MadeOfSteps, _BagParams, FitStep):
    """Copies of one classifier, each fitted on resampled rows and a subset of the columns.

    The member reads its features from ``__f`` and its row key from ``__key``
    when it needs one.
    """

    model = FittedBag

    def __init__(self, member: Estimator | None = None, **params):
        super().__init__(**params)
        self.member = member

    def to_parts(self):
        return {}, {"member": self.member}

    @classmethod
    def from_parts(cls, plain, parts):
        return cls(parts["member"])

    def _fit(self, df: DataFrame) -> FittedBag:
        import random

        cols, key = self.value("inputCols"), self.value("keyCol")
        width = max(1, round(self.value("columns") * len(cols)))
        subsets, tasks = [], []
        for i in range(self.value("count")):
            seed = self.value("seed") + i
            chosen = sorted(random.Random(seed).sample(cols, width), key=cols.index)
            rows = bootstrap(df, key, self.value("rows"), seed)
            view = VectorAssembler(inputCols=chosen, outputCol="__f").transform(rows)
            tasks.append(lambda view=view: self.member.copy().fit(view))
            subsets.append(chosen)
        out = self.fitted({"columns": subsets})
        out.models = self.numbered(side_by_side(df.sparkSession, tasks))
        return out


class _StackParams(Settings):
    keyCol = text("keyCol")
    labelCol = text("labelCol")
    folds = integer("folds")
    seed = integer("seed")
    defaults = {"labelCol": "label", "folds": 5, "seed": 42}


def _stacked_features(df: DataFrame, n: int) -> DataFrame:
    joined = F.concat(*[F.slice(F.col(f"__m{i}"), 2, F.size(f"__m{i}") - 1) for i in range(n)])
    return df.withColumn("__stack", array_to_vector(joined)).drop(*[f"__m{i}" for i in range(n)])


class FittedStack(_StackParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        for i, m in enumerate(self.members):
            df = probabilities(m, df, f"__m{i}")
        return self.models["final"].transform(_stacked_features(df, len(self.members))).drop("__stack")


class Stacking(MadeOfSteps, _StackParams, FitStep):
    """A final classifier trained on the members' out-of-fold probabilities.

    ``final`` reads its features from ``__stack``. Every training row is scored
    by members that were fitted without its fold.
    """

    model = FittedStack

    def __init__(self, members: list[Estimator] | None = None, final: Estimator | None = None, **params):
        super().__init__(**params)
        self.members, self.final = members or [], final

    def to_parts(self):
        return {}, {**self.numbered(self.members), "final": self.final}

    @classmethod
    def from_parts(cls, plain, parts):
        return cls([parts[f"m{i}"] for i in range(len(parts) - 1)], parts["final"])

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        rows = materialise(stratified_kfold(df, self.value("labelCol"), self.value("keyCol"), self.value("folds"),
                                            self.value("seed"), "__fold"), "folds")

        def scored(i):
            train, held = rows.where(F.col("__fold") != i), rows.where(F.col("__fold") == i)
            for j, m in enumerate(self.members):
                held = probabilities(m.copy().fit(train), held, f"__m{j}")
            return held

        parts = side_by_side(df.sparkSession, [lambda i=i: scored(i) for i in range(self.value("folds"))])
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _fit(self, df: DataFrame) -> FittedStack:
        scored = materialise(_stacked_features(self.out_of_fold(df), len(self.members)), "stack")
        out = self.fitted({})
        out.models = self.numbered(fit_all(self.members, df)) | {"final": self.final.fit(scored)}
        return out
