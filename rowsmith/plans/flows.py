"""Chains of steps: samplers that act only while fitting, edits, cross-validation, search."""

from __future__ import annotations

import copy
import importlib
import itertools
import json
import random
import time
import uuid

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import MadeOfSteps, PlainStep, names, text
from rowsmith.features.numeric import BinColumns, YeoJohnson
from rowsmith.operators.clean import columns_by_dtype
from rowsmith.operators.resample import kfold, smote, stratified_kfold
from rowsmith.session import materialise, side_by_side


class Sampler:
    """A step that changes the training rows and is absent from the fitted chain."""

    def resample(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def settings(self) -> dict:
        """Constructor arguments, for saving."""
        return dict(self.__dict__)


class SmoteSampler(Sampler):
    """Oversampling of the smaller classes over numeric columns; other columns are not kept."""

    def __init__(self, cols, label: str, key: str, k: int = 5, seed: int = 42):
        self.cols, self.label, self.key, self.k, self.seed = list(cols), label, key, k, seed

    def resample(self, df: DataFrame) -> DataFrame:
        packed = df.select(self.key, self.label, F.array(*[F.col(c).cast("double") for c in self.cols]).alias("__v"))
        rows = smote(materialise(packed, "smote"), self.label, self.key, "__v", self.k, self.seed)
        out = rows.select(self.key, self.label, *[F.get("__v", i).alias(c) for i, c in enumerate(self.cols)])
        return materialise(out, "smote")


class AssembleByType(PlainStep):
    """Gather all numeric columns except the excluded ones into a vector; resolved when applied."""

    exclude = names("exclude")
    outputCol = text("outputCol")
    defaults = {"exclude": [], "outputCol": "features"}

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = [c for c in columns_by_dtype(df, "numeric") if c not in self.value("exclude")]
        return VectorAssembler(inputCols=cols, outputCol=self.value("outputCol")).transform(df)


class ColumnSteps(MadeOfSteps, Estimator, MLReadable, MLWritable):
    """Branches of steps on groups of columns; columns outside every group pass through.

    ``branches`` is a list of (group, steps): the group is 'numeric', 'string'
    or a list of names, and is resolved from the schema at fit time. Training
    rows that a step encodes differently (out of fold) are handed on.
    """

    def __init__(self, branches, exclude=()):
        super().__init__()
        self.branches, self.exclude = branches, tuple(exclude)

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self.fit_transform(df)[0]

    def fit_transform(self, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
        fitted = []
        resolved = [(columns_by_dtype(df, g) if isinstance(g, str) else list(g), steps) for g, steps in self.branches]
        for cols, steps in resolved:
            cols = [c for c in cols if c not in self.exclude]
            for step in steps if cols else []:
                model, rows = _fit_step(step.copy()._set(inputCols=cols), df)
                df = model.transform(df) if rows is None else rows
                fitted.append(model)
        return PipelineModel(fitted), df

    def to_parts(self):
        steps = {f"b{i}s{j}": step for i, (_, branch) in enumerate(self.branches) for j, step in enumerate(branch)}
        groups = [[g if isinstance(g, str) else list(g), len(branch)] for g, branch in self.branches]
        return {"groups": groups, "exclude": list(self.exclude)}, steps

    @classmethod
    def from_parts(cls, plain, parts):
        branches = [(g, [parts[f"b{i}s{j}"] for j in range(n)]) for i, (g, n) in enumerate(plain["groups"])]
        return cls(branches, plain["exclude"])


class PowerAndBalance(MadeOfSteps, Estimator, MLReadable, MLWritable):
    """Power transform of the numeric columns, SMOTE while fitting, then indicator bins.

    Of ``cols`` those that the table has take part. The bins are learned from the oversampled rows, which are handed on
    as training rows; a fitted chain holds the transform and the bins and leaves the rows alone.
    """

    def __init__(self, cols, label: str, key: str = "doc_id", k: int = 5, seed: int = 42):
        super().__init__()
        self.cols, self.label, self.key, self.k, self.seed = list(cols), label, key, k, seed

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self.fit_transform(df)[0]

    def fit_transform(self, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
        cols = [c for c in self.cols if c in df.columns]
        power = YeoJohnson(inputCols=cols).fit(df)
        rows = SmoteSampler(cols, self.label, self.key, self.k, self.seed).resample(power.transform(df))
        bins = BinColumns(inputCols=cols, strategy="uniform", encode="onehot").fit(rows)
        return PipelineModel([power, bins]), bins.transform(rows)

    def to_parts(self):
        return {"cols": self.cols, "label": self.label, "key": self.key, "k": self.k, "seed": self.seed}, {}

    @classmethod
    def from_parts(cls, plain, parts):
        return cls(**plain)


def _fit_step(step, df: DataFrame):
    """(fitted step, transformed training rows or None when not produced yet)."""
    if hasattr(step, "fit_transform"):
        return step.fit_transform(df)
    if isinstance(step, Estimator):
        return step.fit(df), None
    return step, None


class Flow(MadeOfSteps, Estimator, MLReadable, MLWritable):
    """A chain of steps in which samplers take part in fitting only.

    Steps that encode training rows differently (out of fold) are honoured,
    also inside branches and nested chains. The fitted chain is an ordinary
    ``PipelineModel``; the unfitted one can be saved as well.
    """

    def __init__(self, steps: list):
        super().__init__()
        self.steps = list(steps)

    def _fit(self, df: DataFrame) -> PipelineModel:
        if not self.steps or isinstance(self.steps[-1], Sampler):
            return self.fit_transform(df)[0]
        before, df = Flow(self.steps[:-1]).fit_transform(df)
        return PipelineModel([*before.stages, _fit_step(self.steps[-1], df)[0]])  # nobody reads its training rows

    def fit_transform(self, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
        """The fitted chain and the training rows as the last step leaves them."""
        fitted: list[Transformer] = []
        for step in self.steps:
            if isinstance(step, Sampler):
                df = step.resample(df)
                continue
            model, rows = _fit_step(step, df)
            fitted.append(model)
            df = model.transform(df) if rows is None else rows
        return PipelineModel(fitted), df

    def to_parts(self):
        plan, parts = [], {}
        for i, step in enumerate(self.steps):
            if isinstance(step, Sampler):
                plan.append({"sampler": f"{type(step).__module__}.{type(step).__qualname__}", "settings": step.settings()})
            else:
                plan.append(f"s{i}")
                parts[f"s{i}"] = step
        return {"plan": plan}, parts

    @classmethod
    def from_parts(cls, plain, parts):
        steps = []
        for entry in plain["plan"]:
            if isinstance(entry, str):
                steps.append(parts[entry])
            else:
                module, _, name = entry["sampler"].rpartition(".")
                steps.append(getattr(importlib.import_module(module), name)(**entry["settings"]))
        return cls(steps)

    def copy(self, extra=None) -> "Flow":
        return Flow([s if isinstance(s, Sampler) else s.copy(extra) for s in self.steps])

    def replace_last(self, step) -> "Flow":
        return Flow(self.steps[:-1] + [step])

    def named(self, kind: type):
        """First step of a type."""
        return next(s for s in self.steps if isinstance(s, kind))

    def with_params(self, **params) -> "Flow":
        """``step_name__param`` settings on a copy; the step name is the class name in lower case.

        A name that fits no step or no setting of it is an error.
        """
        steps = [copy.copy(s) if isinstance(s, Sampler) else s.copy() for s in self.steps]
        for key, value in params.items():
            owner, _, name = key.partition("__")
            mine = [s for s in steps if type(s).__name__.lower() == owner]
            if not mine or not all(name in s.settings() if isinstance(s, Sampler) else s.hasParam(name) for s in mine):
                raise ValueError(f"no setting {key!r} in {[type(s).__name__.lower() for s in steps]}")
            for s in mine:
                if isinstance(s, Sampler):
                    setattr(s, name, value)
                else:
                    s._set(**{name: value})
        return Flow(steps)


def _fold_task(estimator: Estimator, df: DataFrame, evaluator: Evaluator, fold: str, f):
    """Fit on all folds but one and score that one, as a function to call later."""

    def run() -> float:
        model = estimator.copy().fit(df.where(F.col(fold) != f).drop(fold))
        return float(evaluator.evaluate(model.transform(df.where(F.col(fold) == f).drop(fold))))

    return run


def _folds(df: DataFrame, fold: str) -> list[int]:
    return sorted(r[0] for r in df.select(fold).distinct().collect())


def fold_scores(estimator: Estimator, df: DataFrame, evaluator: Evaluator, fold: str = "fold", parallelism: int = 4) -> DataFrame:
    """Refit the whole chain once per fold and score the fold that was left out."""
    folds = _folds(df, fold)
    scores = side_by_side(df.sparkSession, [_fold_task(estimator, df, evaluator, fold, f) for f in folds], parallelism)
    return df.sparkSession.createDataFrame([(int(f), s) for f, s in zip(folds, scores)], "fold int, score double")


def cross_val_score(estimator: Estimator, df: DataFrame, evaluator: Evaluator, keys, k: int = 5, seed: int = 42, stratify: str | None = None) -> DataFrame:
    """Score per fold; classes are spread evenly over the folds when ``stratify`` is given."""
    split = stratified_kfold(df, stratify, keys, k, seed) if stratify else kfold(df, keys, k, seed)
    return fold_scores(estimator, materialise(split, "folds"), evaluator)


def parameter_grid(choices: dict[str, list]) -> list[dict]:
    keys = list(choices)
    return [dict(zip(keys, values)) for values in itertools.product(*choices.values())]


def _ranked(spark, points: list[dict], scores: list[list[float]], evaluator: Evaluator) -> DataFrame:
    found = [(i, json.dumps(p, sort_keys=True), sum(s) / len(s)) for i, (p, s) in enumerate(zip(points, scores))]
    sign = -1 if evaluator.isLargerBetter() else 1
    found.sort(key=lambda r: (sign * r[2], r[0]))
    return spark.createDataFrame([(*r, pos + 1) for pos, r in enumerate(found)], "point int, params string, mean_score double, rank int")


def search(make, points: list[dict], df: DataFrame, evaluator: Evaluator, keys, k: int = 5, seed: int = 42,
           stratify: str | None = None, parallelism: int = 4) -> DataFrame:
    """Mean fold score of every parameter point, best first.

    ``make(**point)`` builds the estimator. The folds are computed and stored
    once; every point and fold reads the same rows. Points whose chains begin
    alike share the fitted steps of a fold and the rows that these leave.
    """
    spark = df.sparkSession
    split = stratified_kfold(df, stratify, keys, k, seed) if stratify else kfold(df, keys, k, seed)
    rows = materialise(split, "folds").persist()
    try:
        folds = _folds(rows, "fold")
        flat = _shared_scores([make(**p) for p in points], rows, evaluator, "fold", folds, parallelism)
    finally:
        rows.unpersist()
    n = len(folds)
    return _ranked(spark, points, [flat[i * n : (i + 1) * n] for i in range(len(points))], evaluator)


def _beginnings(estimator: Estimator) -> list[tuple[str, object]]:
    """The steps of a chain, each under a fingerprint of itself and all steps before it; a step that has none is equal to no other."""
    from rowsmith.plans.step_cache import settings_of

    out, so_far = [], ""
    for step in estimator.steps if isinstance(estimator, Flow) else [estimator]:
        try:
            own = settings_of(step)
        except TypeError:
            own = uuid.uuid4().hex
        so_far = json.dumps([so_far, own], sort_keys=True)
        out.append((so_far, step))
    return out


def _shared_scores(estimators: list[Estimator], rows: DataFrame, evaluator: Evaluator, fold: str, folds, parallelism: int) -> list[float]:
    """Score of every estimator and fold, estimator by estimator.

    Steps are fitted level by level, each beginning once per fold. Rows that
    several steps read next are stored; the last steps are fitted and scored
    on their own.
    """
    spark = rows.sparkSession
    chains = [_beginnings(e) for e in estimators]
    readers: dict[str, set[str]] = {}  # what follows a beginning
    for chain in chains:
        for before, (name, _) in zip(["", *[n for n, _ in chain]], chain):
            readers.setdefault(before, set()).add(name)
    state = {("", f): (rows.where(F.col(fold) != f).drop(fold), rows.where(F.col(fold) == f).drop(fold)) for f in folds}

    def grown(before, name, step, f):
        def run():
            train, test = state[before, f]
            if isinstance(step, Sampler):
                train = step.resample(train)
            else:
                model, out = _fit_step(step.copy(), train)
                train, test = model.transform(train) if out is None else out, model.transform(test)
            if len(readers[name]) > 1:
                train, test = materialise(train, "prefix"), materialise(test, "prefix")
            return train, test

        return run

    def scored(before, step, f):
        def run():
            train, test = state[before, f]
            return float(evaluator.evaluate(Flow([step]).copy().fit(train).transform(test)))

        return run

    for level in range(max(len(c) for c in chains) - 1):
        # Every beginning once, and only those that a chain goes on from.
        wanted = {c[level][0]: (c[level - 1][0] if level else "", c[level][1]) for c in chains if len(c) > level + 1}
        at = [(name, f) for name in wanted for f in folds]
        state.update(zip(at, side_by_side(spark, [grown(wanted[n][0], n, wanted[n][1], f) for n, f in at], parallelism)))
    ends = [(c[-2][0] if len(c) > 1 else "", c[-1][1], f) for c in chains for f in folds]
    return side_by_side(spark, [scored(*e) for e in ends], parallelism)


def search_last_step(flow: Flow, make, points: list[dict], df: DataFrame, evaluator: Evaluator, keys, k: int = 5, seed: int = 42,
                     stratify: str | None = None, parallelism: int = 4) -> DataFrame:
    """Like ``search`` for points that only change the last step of a flow.

    The steps before it are fitted once per fold and their output is stored;
    every point then fits its last step on the stored rows.
    """
    spark = df.sparkSession
    split = stratified_kfold(df, stratify, keys, k, seed) if stratify else kfold(df, keys, k, seed)
    rows = materialise(split, "folds")

    def prepare(f):
        def run():
            prefix, train = Flow(flow.steps[:-1]).copy().fit_transform(rows.where(F.col("fold") != f).drop("fold"))
            test = prefix.transform(rows.where(F.col("fold") == f).drop("fold"))
            return materialise(train, "prefix"), materialise(test, "prefix")

        return run

    def scored(point, train, test):
        return lambda: float(evaluator.evaluate(make(**point).fit(train).transform(test)))

    parts = side_by_side(spark, [prepare(f) for f in _folds(rows, "fold")], parallelism)
    flat = side_by_side(spark, [scored(p, *part) for p in points for part in parts], parallelism)
    n = len(parts)
    return _ranked(spark, points, [flat[i * n : (i + 1) * n] for i in range(len(points))], evaluator)


def grid_search(make, choices: dict[str, list], df: DataFrame, evaluator: Evaluator, keys, **options) -> DataFrame:
    return search(make, parameter_grid(choices), df, evaluator, keys, **options)


def random_search(make, choices: dict[str, list], draws: int, df: DataFrame, evaluator: Evaluator, keys, seed: int = 42, **options) -> DataFrame:
    """``draws`` distinct points of the grid, chosen by seed."""
    points = parameter_grid(choices)
    chosen = random.Random(seed).sample(points, min(draws, len(points)))
    return search(make, chosen, df, evaluator, keys, seed=seed, **options)


def best_params(result: DataFrame) -> dict:
    return json.loads(result.where(F.col("rank") == 1).first()["params"])


class BalancedAccuracy(Evaluator):
    """Mean recall of the classes, as an evaluator for the functions above."""

    def __init__(self, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, df: DataFrame) -> float:
        from rowsmith.operators.metrics import balanced_accuracy

        view = df.select(F.col(self.label).cast("double").alias("y"), F.col(self.prediction).cast("double").alias("p"))
        return float(balanced_accuracy(view, "y", "p").first()[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def leaderboard(models: dict[str, Transformer], df: DataFrame, label: str, positive=1.0) -> DataFrame:
    """F1 and scoring time of fitted models, best first. Each model has its own name."""
    from rowsmith.operators.metrics import f1_binary

    rows = []
    for name, model in models.items():
        scored = model.transform(df).select(F.col(label).cast("double").alias("y"), F.col("prediction").alias("p"))
        start = time.perf_counter()
        scored.write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        rows.append((name, float(f1_binary(scored, "y", "p", positive).first()["f1"]), seconds))
    rows.sort(key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame([(*r, i + 1) for i, r in enumerate(rows)], "model string, f1 double, seconds double, rank int")


def score(model: Transformer, df: DataFrame, keys) -> DataFrame:
    """Batch scoring: keys, prediction and, for classifiers, the probability of the predicted class."""
    out = model.transform(df)
    keep = [*keys, "prediction"]
    if "probability" in out.columns:
        out = out.withColumn("confidence", F.array_max(vector_to_array("probability")))
        keep.append("confidence")
    return out.select(*keep)
