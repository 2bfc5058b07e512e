"""Tree models and what can be read from them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import FitStep, FittedStep, Settings, integer, text
from rowsmith.models.forest import GrownForest, fit_forest
from rowsmith.operators.ranks import column_quantiles
from rowsmith.operators.resample import class_counts
from rowsmith.session import materialise


def decision_tree(label: str = "label", depth: int = 30, seed: int = 42, **more) -> DecisionTreeClassifier:
    """Depth 30 is the deepest Spark grows; it stands for an unlimited tree."""
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed, **more)


# Bytes of node statistics (rows x trees x those of a node) up to which Spark's own forest is taken.
SPARK_FOREST = 1 << 32


class _DeepForest:
    """Spark's forest, but on large tables small nodes are finished in grouped tasks (``models.forest``).

    Spark sends statistics of full width for every node, and deep trees have nearly as many nodes as rows.
    """

    def _grown(self, df: DataFrame, classify: bool) -> GrownForest | None:
        """None where Spark's own forest serves: small tables, and settings that only it has."""
        get = self.getOrDefault
        attrs = df.schema[get("featuresCol")].metadata.get("ml_attr", {}).get("attrs", {})
        if self.isDefined("weightCol") or get("impurity") not in ("gini", "variance") or get("leafCol") or get("maxBins") > 256 or "nominal" in attrs:
            return None
        if classify and self.isDefined("thresholds"):
            return None
        x, y = vector_to_array(F.col(get("featuresCol"))), F.col(get("labelCol")).cast("double")
        wrong = F.isnan(y) | (y.isNull()) | (F.abs(y) == float("inf")) | (((y < 0) | (y != F.floor(y))) if classify else F.lit(False))
        rough = x.isNull() | F.exists(x, lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
        rows, width, narrow, top, bad = df.agg(
            F.count(F.lit(1)), F.max(F.size(x)), F.min(F.size(x)), F.max(y), F.count(F.when(wrong | rough, 1))).first()
        if not rows or not width or width != narrow or bad or (classify and top >= 100):
            return None  # Spark says what is wrong
        classes = int(top) + 1 if classify else 0
        m = columns_a_node(get("featureSubsetStrategy"), width, get("numTrees"), classify)
        bins = min(get("maxBins"), rows)
        if rows * get("numTrees") * m * bins * (classes or 3) * 8 <= SPARK_FOREST:
            return None
        names = {c: get(c) for c in ("featuresCol", "labelCol", "predictionCol", *(("probabilityCol", "rawPredictionCol") if classify else ()))}
        return fit_forest(df, names, {
            "trees": get("numTrees"), "depth": get("maxDepth"), "bins": bins, "m": m, "width": width, "classes": classes,
            "least": max(get("minInstancesPerNode"), get("minWeightFractionPerNode") * rows), "gain": get("minInfoGain"),
            "rate": get("subsamplingRate"), "bootstrap": get("bootstrap"), "seed": get("seed") & (2**63 - 1), "rows": rows})

    def write(self):
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls):
        return DefaultParamsReader(cls)


class ForestClassifier(_DeepForest, RandomForestClassifier):
    def _fit(self, df: DataFrame):
        return self._grown(df, True) or super()._fit(df)


class ForestRegressor(_DeepForest, RandomForestRegressor):
    def _fit(self, df: DataFrame):
        return self._grown(df, False) or super()._fit(df)


def columns_a_node(strategy: str, width: int, trees: int, classify: bool) -> int:
    """How many columns a node looks at, by the names and numbers of ``featureSubsetStrategy``."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classify else "onethird"
    named = {"all": width, "sqrt": math.sqrt(width), "log2": math.log2(width), "onethird": width / 3}
    if strategy in named:
        share = named[strategy]
    else:
        share = float(strategy) if strategy.isdigit() else float(strategy) * width
    return max(1, min(width, math.ceil(share)))


def forest_classifier(label: str = "label", trees: int = 100, seed: int = 42, **more) -> ForestClassifier:
    """As deep as Spark grows (30), unless ``maxDepth`` is given. Rows keep their nodes, so no pass walks or ships grown trees."""
    return ForestClassifier(labelCol=label, numTrees=trees, seed=seed, **{"maxDepth": 30, "maxMemoryInMB": 512, "cacheNodeIds": True, **more})


def forest_regressor(label: str = "label", trees: int = 100, seed: int = 42, **more) -> ForestRegressor:
    """As deep as Spark grows (30) over all columns, unless said otherwise."""
    return ForestRegressor(labelCol=label, numTrees=trees, seed=seed, **{"maxDepth": 30, "maxMemoryInMB": 512, "cacheNodeIds": True, "featureSubsetStrategy": "all", **more})


def boosted_classifier(label: str = "label", rounds: int = 100, depth: int = 3, rate: float = 0.1, subsample: float = 1.0,
                       features: str = "all", seed: int = 42, **more) -> GBTClassifier:
    return GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
                         featureSubsetStrategy=features, seed=seed, **more)


def boosted_regressor(label: str = "label", rounds: int = 100, depth: int = 3, rate: float = 0.1, subsample: float = 1.0,
                      features: str = "all", seed: int = 42, **more) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
                        featureSubsetStrategy=features, seed=seed, **more)


def importance_table(spark, model, cols) -> DataFrame:
    values = model.featureImportances.toArray()
    return spark.createDataFrame([(c, float(v)) for c, v in zip(cols, values)], "column string, importance double")


def tree_rules(spark, model, cols) -> DataFrame:
    """The nodes of a fitted tree as a table: feature, threshold, prediction, parent."""
    rows: list[tuple] = []

    def walk(node, parent, depth):
        me = len(rows)
        if node.subtreeDepth() == 0:
            rows.append((me, parent, depth, None, None, float(node.prediction()), float(node.impurity())))
            return
        split = node.split()
        threshold = float(split.threshold())
        rows.append((me, parent, depth, cols[split.featureIndex()], threshold, float(node.prediction()), float(node.impurity())))
        walk(node.leftChild(), me, depth + 1)
        walk(node.rightChild(), me, depth + 1)

    walk(model._call_java("rootNode"), None, 0)
    return spark.createDataFrame(
        rows, "node int, parent int, depth int, feature string, threshold double, prediction double, impurity double")


class _BoostParams(Settings):
    featuresCol = text("featuresCol")
    labelCol = text("labelCol")
    rounds = integer("rounds")
    seed = integer("seed")
    bins = integer("bins")
    checkpointEvery = integer("checkpointEvery")  # of no effect: a round stores nothing
    defaults = {"featuresCol": "features", "labelCol": "label", "rounds": 50, "seed": 42, "bins": 32, "checkpointEvery": 10}


def _stump_column(stump: dict, features: str):
    x = F.get(vector_to_array(F.col(features)), stump["feature"]) if stump["feature"] is not None else None
    if x is None:
        return F.lit(stump["left"])
    return F.when(x <= F.lit(stump["threshold"]), F.lit(stump["left"])).otherwise(F.lit(stump["right"]))


class FittedBoost(_BoostParams, FittedStep):
    """Weighted vote of stumps, as one column expression."""

    def _transform(self, df: DataFrame) -> DataFrame:
        classes, stumps = self.state["classes"], self.state["stumps"]
        feats = self.value("featuresCol")
        votes = []
        for c in classes:
            total = F.lit(0.0)
            for s in stumps:
                total = total + F.when(_stump_column(s, feats) == F.lit(float(c)), F.lit(s["alpha"])).otherwise(F.lit(0.0))
            votes.append(total)
        weight = sum(s["alpha"] for s in stumps) or 1.0
        out = df.withColumn("__votes", F.array(*votes))
        best = F.array_position("__votes", F.array_max("__votes")) - 1
        share = F.transform("__votes", lambda v: v / F.lit(weight))
        return out.withColumn("prediction", F.get(F.array(*[F.lit(float(c)) for c in classes]), best.cast("int"))).withColumn(
            "probability", array_to_vector(share)).drop("__votes")


class AdaBoost(_BoostParams, FitStep):
    """Multi-class boosting of one-split trees (SAMME) on binned columns.

    Columns are cut once at up to ``bins`` - 1 quantiles and stored as one byte a
    value. A round is one pass over the bytes: the weight of a row follows from
    the stumps so far, and the sums of weight by (column, bin, class) give the
    best split, its leaves and its error together. Only these sums reach the
    driver; a lost executor costs its part of one round.
    """

    model = FittedBoost

    def _fit(self, df: DataFrame) -> FittedBoost:
        feats, label, bins = self.value("featuresCol"), self.value("labelCol"), self.value("bins")
        if not 2 <= bins <= 256:
            raise ValueError("bins must lie between 2 and 256")
        rows = df.select(vector_to_array(F.col(feats)).alias("x"), F.col(label).cast("double").alias("label"))
        rows = materialise(rows.where(F.col("label").isNotNull()), "rows")  # cuts and bins read it several times
        counts = class_counts(rows, "label")
        if not counts:
            raise ValueError("no row has a label")
        classes = sorted(counts)
        edges = _column_edges(rows, bins)
        blocks = materialise(_binned(rows, edges, classes), "bins")
        stumps: list[dict] = []
        for _ in range(self.value("rounds")):
            stump, error = best_stump(_weight_sums(blocks, edges, stumps, classes, bins), edges, classes)
            if error <= 0:
                stumps = stumps or [stump | {"alpha": 1.0}]
                break
            alpha = math.log((1 - error) / error) + math.log(len(classes) - 1) if len(classes) > 1 else 0.0
            if alpha <= 0:
                break
            stumps.append(stump | {"alpha": alpha})
        if not stumps:
            top = min(classes, key=lambda c: (-counts[c], c))
            stumps = [{"feature": None, "threshold": 0.0, "left": top, "right": top, "alpha": 1.0}]
        return self.fitted({"classes": classes, "stumps": stumps, "rows": float(sum(counts.values()))})


def _column_edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Distinct inner quantiles of every column of the array ``x``."""
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    cols = [f"x{i}" for i in range(width)]
    wide = rows.select(*[F.get("x", i).alias(c) for i, c in enumerate(cols)])
    cuts = column_quantiles(wide, cols, [i / bins for i in range(1, bins)]) if cols else {}
    return [np.unique(cuts[c]) for c in cols]


def _binned(rows: DataFrame, edges: list[np.ndarray], classes: list[float]) -> DataFrame:
    """Blocks of rows: class numbers and, column by column, the number of edges below each value, a byte each."""
    levels = np.array(classes)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            cut = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]) if edges else np.zeros((0, len(x)))
            label = np.searchsorted(levels, batch.column("label").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array([label.astype(np.int16).tobytes()], pa.binary()), pa.array([cut.astype(np.uint8).tobytes()], pa.binary())],
                names=["labels", "bins"])

    return rows.mapInArrow(run, "labels binary, bins binary")


def _weight_sums(blocks: DataFrame, edges, stumps: list[dict], classes: list[float], bins: int) -> np.ndarray:
    """Sum of weight by (column, bin, class). A row weighs exp of the alphas of the stumps that miss it."""
    k, d = len(classes), len(edges)
    number = {c: i for i, c in enumerate(classes)}
    # In bins a threshold is the number of its edge; alphas are shifted so that no weight overflows.
    plan = [(s["feature"], None if s["feature"] is None else int(np.searchsorted(edges[s["feature"]], s["threshold"])),
             number[s["left"]], number[s["right"]], s["alpha"]) for s in stumps]

    def run(batches):
        total = np.zeros((max(d, 1), bins, k))
        for batch in batches:
            for raw, cut in zip(batch.column("labels"), batch.column("bins")):
                label = np.frombuffer(raw.as_buffer(), np.int16).astype(np.int64)
                x = np.frombuffer(cut.as_buffer(), np.uint8).reshape(d, len(label))
                missed = np.zeros(len(label))
                for feature, edge, left, right, alpha in plan:
                    said = left if feature is None else np.where(x[feature] <= edge, left, right)
                    # Centred, so that weights of many rounds stay near one.
                    missed += alpha * ((said != label) - 0.5)
                w = np.exp(missed)
                for j in range(d):
                    total[j] += np.bincount(x[j] * np.int64(k) + label, w, minlength=bins * k).reshape(bins, k)
                if not d:
                    total[0, 0] += np.bincount(label, w, minlength=k)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], names=["place", "w"])

    out = np.zeros(max(d, 1) * bins * k)
    sums = blocks.mapInArrow(run, "place long, w double").groupBy("place").agg(F.sum("w").alias("w")).toArrow()
    out[sums["place"].to_numpy()] = sums["w"].to_numpy()
    return out.reshape(max(d, 1), bins, k)


def best_stump(sums: np.ndarray, edges: list[np.ndarray], classes: list[float]) -> tuple[dict, float]:
    """The split of least weighted Gini impurity and the share of weight it misses; ties: first column, then edge.

    A leaf says the class of most weight, the smallest of equal ones. Without a split that parts rows the stump says one
    class everywhere.
    """
    whole = sums[0].sum(axis=0)
    top = int(whole.argmax())
    best = ({"feature": None, "threshold": 0.0, "left": classes[top], "right": classes[top]}, 1 - whole[top] / whole.sum())
    pure = (whole**2).sum() / whole.sum()
    for j, cuts in enumerate(edges):
        left = sums[j].cumsum(axis=0)[: len(cuts)]
        right = sums[j].sum(axis=0) - left
        a, b = left.sum(axis=1), right.sum(axis=1)
        parts = (a > 1e-12 * whole.sum()) & (b > 1e-12 * whole.sum())
        score = np.where(parts, (left**2).sum(axis=1) / np.where(parts, a, 1) + (right**2).sum(axis=1) / np.where(parts, b, 1), -np.inf)
        at = int(score.argmax()) if len(score) else 0
        if len(score) and score[at] > pure * (1 + 1e-12):
            pure = score[at]
            said = int(left[at].argmax()), int(right[at].argmax())
            hit = left[at, said[0]] + right[at, said[1]]
            best = ({"feature": j, "threshold": float(cuts[at]), "left": classes[said[0]], "right": classes[said[1]]}, 1 - hit / whole.sum())
    return best
