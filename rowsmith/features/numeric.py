"""Transformers of numeric columns."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.ml.feature import PCA, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from rowsmith.features.base import FitStep, FittedStep, PlainStep, Settings, flag, integer, names, number, text
from rowsmith.functions.scalar import left_closed_bin, ratio, signed_power
from rowsmith.operators.clean import population_stats
from rowsmith.operators.ranks import column_quantiles
from rowsmith.session import materialise


class FittedMean(FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(self.state[c])) for c in self.value("inputCols") if self.state[c] is not None})


class MeanImputer(FitStep):
    """Fill missing numbers with the training mean."""

    model = FittedMean

    def _fit(self, df: DataFrame) -> FittedMean:
        cols = self.value("inputCols")
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return self.fitted({c: row[c] for c in cols})


class _GroupParams(Settings):
    keyCols = names("keyCols", "group keys")
    inputCol = text("inputCol", "column whose group mean is learned")
    outputCol = text("outputCol", "column written")


class FittedGroupMean(_GroupParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        keys, c = self.value("keyCols"), self.value("inputCol")
        return df.join(self.tables["means"], keys, "left").withColumn(c, F.coalesce(F.col(c), F.col("__mean"))).drop("__mean")


class GroupMeanImputer(_GroupParams, FitStep):
    """Fill missing numbers with the mean of the row's group in the training rows."""

    model = FittedGroupMean

    def _fit(self, df: DataFrame) -> FittedGroupMean:
        means = df.groupBy(*self.value("keyCols")).agg(F.avg(self.value("inputCol")).alias("__mean"))
        return self.fitted(means=materialise(means, "means"))


class FittedGroupRatio(_GroupParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = ratio(self.value("inputCol"), "__mean")
        return df.join(self.tables["means"], self.value("keyCols"), "left").withColumn(self.value("outputCol"), out).drop("__mean")


class GroupRatio(_GroupParams, FitStep):
    """Value divided by the training mean of its group; unseen groups give NULL."""

    model = FittedGroupRatio

    def _fit(self, df: DataFrame) -> FittedGroupRatio:
        means = df.groupBy(*self.value("keyCols")).agg(F.avg(self.value("inputCol")).alias("__mean"))
        return self.fitted(means=materialise(means, "means"))


class FittedScaler(FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.state.items() if m is not None})


class ZScaler(FitStep):
    """Zero mean and unit population deviation; a constant column is only centred."""

    model = FittedScaler

    def _fit(self, df: DataFrame) -> FittedScaler:
        stats = population_stats(df, self.value("inputCols"))
        return self.fitted({c: [m, s or 1.0] for c, (m, s) in stats.items()})


class PolynomialColumns(PlainStep):
    """Named products of the input columns up to a degree, with a bias column first."""

    degree = integer("degree")
    bias = flag("bias")
    defaults = {"degree": 2, "bias": True}

    def output_names(self) -> list[str]:
        return [n for n, _ in self._terms()]

    def _terms(self):
        cols = self.value("inputCols")
        terms = [("1", F.lit(1.0))] if self.value("bias") else []
        for d in range(1, self.value("degree") + 1):
            for combo in combinations_with_replacement(cols, d):
                powers = [(c, combo.count(c)) for c in dict.fromkeys(combo)]
                expr = None
                for c in combo:
                    expr = F.col(c) if expr is None else expr * F.col(c)
                terms.append((" ".join(c if p == 1 else f"{c}^{p}" for c, p in powers), expr))
        return terms

    def _transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.withColumns({n: e for n, e in self._terms() if n not in have})


class _BinParams(Settings):
    bins = integer("bins")
    strategy = text("strategy", "quantile or uniform")
    encode = text("encode", "ordinal or onehot")
    defaults = {"bins": 5, "strategy": "quantile", "encode": "ordinal"}


# Bounds of a column without values: whatever comes later falls into one bin.
NO_EDGES = [0.0, 1.0]


class FittedBins(_BinParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        spots = {c: left_closed_bin(c, edges) for c, edges in self.state.items()}
        if self.value("encode") == "ordinal":
            return df.withColumns(spots)
        wide = {f"{c}_{i}": (spot == i).cast("int") for c, spot in spots.items() for i in range(max(len(self.state[c]) - 1, 1))}
        return df.withColumns(wide).drop(*self.state)


class BinColumns(_BinParams, FitStep):
    """Cut numbers into bins learned on the training rows.

    Bins are ``[a, b)``; values outside the training range fall into the end
    bins. Quantile bins narrower than 1e-8 are merged with their neighbour.
    """

    model = FittedBins

    def _fit(self, df: DataFrame) -> FittedBins:
        cols, n = self.value("inputCols"), self.value("bins")
        edges: dict[str, list[float]] = {}
        if self.value("strategy") == "quantile":
            for c, cuts in column_quantiles(df, cols, [i / n for i in range(n + 1)]).items():
                cuts = cuts or NO_EDGES
                edges[c] = [cuts[0]] + [b for a, b in zip(cuts, cuts[1:]) if b - a > 1e-8]
        else:
            row = df.agg(*[f(F.col(c).cast("double")) for c in cols for f in (F.min, F.max)]).first()
            for i, c in enumerate(cols):
                low, high = row[2 * i], row[2 * i + 1]
                edges[c] = NO_EDGES if low is None else [low + (high - low) * j / n for j in range(n + 1)]
        return self.fitted({c: edges[c] for c in cols})


class _PowerParams(Settings):
    standardize = flag("standardize")
    defaults = {"standardize": True}


class FittedPower(_PowerParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (lam, mean, dev) in self.state.items():
            value = signed_power(c, lam)
            out[c] = (value - F.lit(mean)) / F.lit(dev) if self.value("standardize") else value
        return df.withColumns(out)


class YeoJohnson(_PowerParams, FitStep):
    """Power transform with the lambda of the highest likelihood, then z-scores.

    Each round evaluates a grid of lambdas for all columns in one aggregation
    and zooms in; a parabola through the last three points gives the answer.
    The lambdas are values of one array, so all rounds and fits share one
    compiled plan.
    """

    model = FittedPower
    GRID, ROUNDS = 9, 5

    def _fit(self, df: DataFrame) -> FittedPower:
        cols = self.value("inputCols")
        base = df.agg(*[F.count(c).alias(f"n_{c}") for c in cols],
                      *[F.sum(F.signum(c) * F.log1p(F.abs(c))).alias(f"j_{c}") for c in cols]).first()
        span, lams = {c: (-3.0, 5.0) for c in cols}, {}
        for _ in range(self.ROUNDS):
            grids = {c: [lo + (hi - lo) * i / (self.GRID - 1) for i in range(self.GRID)] for c, (lo, hi) in span.items()}
            var = {at: v[0] for at, v in _power_stats(df, cols, [grids[c] for c in cols], F.var_pop).items()}
            for k, c in enumerate(cols):
                grid = grids[c]
                score = []
                for i, lam in enumerate(grid):
                    v = var.get((k, i))
                    good = v is not None and 0 < v < math.inf
                    score.append(-0.5 * base[f"n_{c}"] * math.log(v) + (lam - 1) * base[f"j_{c}"] if good else -math.inf)
                best, step = max(range(self.GRID), key=lambda i: score[i]), grid[1] - grid[0]
                at_end = best in (0, self.GRID - 1)
                reach = step * (self.GRID if at_end else 1.0)
                span[c], lams[c] = (grid[best] - reach, grid[best] + reach), grid[best]
                if not at_end and math.isfinite(score[best - 1]) and math.isfinite(score[best + 1]):
                    bend = score[best - 1] - 2 * score[best] + score[best + 1]
                    if bend < 0:
                        lams[c] += 0.5 * step * (score[best - 1] - score[best + 1]) / bend
        stats = _power_stats(df, cols, [[lams[c]] for c in cols], F.avg, F.stddev_pop)
        moments = [stats.get((k, 0), (None, None)) for k in range(len(cols))]
        return self.fitted({c: [lams[c], mean, dev or 1.0] for c, (mean, dev) in zip(cols, moments)})


def _power_stats(df: DataFrame, cols, lams: list[list[float]], *stats) -> dict[tuple[int, int], tuple]:
    """Aggregates of the power transform by number of the column and of its lambda."""
    values = df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("x")) for k, c in enumerate(cols)])))
    grid = F.array(*[F.array(*[F.lit(float(v)) for v in of]) for of in lams])
    spread = values.select("k", "x", F.posexplode(F.get(grid, F.col("k"))).alias("i", "lam"))
    found = spread.groupBy("k", "i").agg(*[f(signed_power("x", F.col("lam"))) for f in stats]).collect()
    return {(r[0], r[1]): tuple(r)[2:] for r in found}


def named_columns(df: DataFrame, vector: str, out: list[str]) -> DataFrame:
    """Spread a vector column over named double columns."""
    arr = vector_to_array(F.col(vector))
    return df.withColumns({n: F.get(arr, i) for i, n in enumerate(out)})


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


class _ScaleParams(Settings):
    inputCol = text("inputCol")
    outputCol = text("outputCol")
    scale = flag("scale", "divide by the population deviation")
    defaults = {"scale": True}


class FittedVectorScaler(_ScaleParams, FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(s).alias("s")) for m, s in zip(self.state["mean"], self.state["scale"])])
        values = F.zip_with(vector_to_array(F.col(self.value("inputCol"))), pairs, lambda v, p: (v - p["m"]) / p["s"])
        return df.withColumn(self.value("outputCol"), array_to_vector(values))


class VectorScaler(_ScaleParams, FitStep):
    """Zero mean and unit population deviation of every entry of a vector column; a constant entry is only centred."""

    model = FittedVectorScaler

    def _fit(self, df: DataFrame) -> FittedVectorScaler:
        found = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(self.value("inputCol"))).alias("s")).first()["s"]
        n = found["count"]
        wide = [math.sqrt(v * (n - 1) / n) if n else 0.0 for v in found["variance"]]
        return self.fitted({"mean": [float(m) for m in found["mean"]],
                            "scale": [w if w > 0 and self.value("scale") else 1.0 for w in wide]})


class _AxesParams(Settings):
    inputCol = text("inputCol")
    outputCol = text("outputCol")
    k = integer("k", "components to keep; all by default")
    variance = number("variance", "share of the variance that the kept components reach")
    scale = flag("scale")
    defaults = {"outputCol": "pca", "scale": True}


class FittedAxes(_AxesParams, FittedStep):
    @property
    def ratios(self) -> list[float]:
        return self.state["ratios"]

    @property
    def kept(self) -> int:
        return self.state["kept"]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.models["axes"].transform(self.models["scaler"].transform(df)).drop("__z")
        return VectorSlicer(inputCol="__axes", outputCol=self.value("outputCol"), indices=list(range(self.kept))).transform(out).drop("__axes")

    def variance_table(self, spark) -> DataFrame:
        """Explained share and running share per component."""
        rows, run = [], 0.0
        for i, r in enumerate(self.ratios):
            run += r
            rows.append((i + 1, r, run))
        return spark.createDataFrame(rows, "component int, share double, cumulative double")


class PrincipalAxes(_AxesParams, FitStep):
    """Centre and scale a vector column by the population deviation, then project on its main directions.

    ``variance`` keeps as many components as needed to reach that share. All
    components are found at once; the kept ones are the first of them.
    """

    model = FittedAxes

    def _fit(self, df: DataFrame) -> FittedAxes:
        scaler = VectorScaler(inputCol=self.value("inputCol"), outputCol="__z", scale=self.value("scale")).fit(df)
        size = len(scaler.state["mean"])
        axes = PCA(k=size, inputCol="__z", outputCol="__axes").fit(scaler.transform(df))
        ratios = [float(v) for v in axes.explainedVariance]
        keep = self.value("k") or size
        if self.value("variance") is not None:
            run, keep = 0.0, size
            for i, r in enumerate(ratios):
                run += r
                if run >= self.value("variance"):
                    keep = i + 1
                    break
        out = self.fitted({"ratios": ratios, "kept": keep})
        out.models = {"scaler": scaler, "axes": axes}
        return out


def anova_f(df: DataFrame, cols, label: str) -> DataFrame:
    """F statistic of every column against the classes, from one grouped aggregation."""
    from rowsmith.operators.stats import long_agg

    per = long_agg(df.where(F.col(label).isNotNull()), cols, {
        "n": F.count, "m": F.avg, "v": lambda c: F.var_pop(F.col(c).cast("double"))}, [label])
    # One row per class and column from here on.
    total = per.groupBy("column").agg(F.sum("n").alias("rows"), F.count("*").alias("k"),
                                      (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    both = per.join(total, "column")
    sums = both.groupBy("column", "rows", "k").agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("mean"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    f = F.try_divide(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("rows") - F.col("k")))
    return sums.select("column", f.alias("f"))


class FittedChoice(FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        gone = [c for c in self.value("inputCols") if c not in self.state["kept"]]
        return df.drop(*gone)


class SelectBest(FitStep):
    """Keep the ``k`` columns with the highest F statistic against the label."""

    labelCol = text("labelCol")
    k = integer("k")
    defaults = {"labelCol": "label", "k": 10}
    model = FittedChoice

    def _fit(self, df: DataFrame) -> FittedChoice:
        cols = self.value("inputCols")
        scores = {r["column"]: r["f"] for r in anova_f(df, cols, self.value("labelCol")).collect()}
        ranked = sorted(cols, key=lambda c: (-(scores.get(c) or -1.0), cols.index(c)))
        return self.fitted({"kept": ranked[: self.value("k")], "scores": scores})


def mutual_information(df: DataFrame, label: str, numeric=(), discrete=(), bins: int = 10, label_bins: int | None = None) -> DataFrame:
    """Mutual information (nats) of each column with the label, from joint counts.

    Numbers are cut into equal-frequency bins, discrete columns keep their
    codes. All columns share one grouped count of (column, x, y).
    """
    probs = [i / bins for i in range(bins + 1)]
    cut_cols = list(numeric) + ([label] if label_bins else [])
    edges = column_quantiles(df, cut_cols, probs) if cut_cols else {}

    def code(c, cut):
        return (left_closed_bin(c, sorted(set(edges[c]))) if cut else F.col(c)).cast("string")

    y = code(label, bool(label_bins))
    pairs = [F.struct(F.lit(c).alias("column"), code(c, c in numeric).alias("x"), y.alias("y")) for c in [*numeric, *discrete]]
    joint = df.select(F.inline(F.array(*pairs))).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    joint = materialise(joint.groupBy("column", "x", "y").agg(F.count("*").alias("n")), "joint")
    by_x = joint.groupBy("column", "x").agg(F.sum("n").alias("nx"))
    by_y = joint.groupBy("column", "y").agg(F.sum("n").alias("ny"))
    all_n = joint.groupBy("column").agg(F.sum("n").alias("rows"))
    term = F.col("n") / F.col("rows") * F.log(F.col("n") * F.col("rows") / (F.col("nx") * F.col("ny")))
    return joint.join(by_x, ["column", "x"]).join(by_y, ["column", "y"]).join(all_n, "column").groupBy("column").agg(
        F.greatest(F.sum(term), F.lit(0.0)).alias("mi"))


def compare_rankings(a: DataFrame, b: DataFrame, name_a: str, name_b: str, key: str = "column", value: str = "score") -> DataFrame:
    """Two importance tables side by side as percentage ranks in long form (one row per column and list)."""
    from rowsmith.operators.ranks import percent_rank_average

    ranked = [percent_rank_average(t.select(key, F.col(value).cast("double").alias("__s")), "__s").select(key, F.col("pct").alias(n))
              for t, n in ((a, name_a), (b, name_b))]
    return ranked[0].join(ranked[1], key).unpivot([key], [name_a, name_b], "list", "pct")
