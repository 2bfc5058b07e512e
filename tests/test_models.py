"""Properties of models on frames with a planted signal."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowsmith.features import numeric as N
from rowsmith.models import cluster as K
from rowsmith.models import ensemble as E
from rowsmith.models import linear as L
from rowsmith.models import simple as B
from rowsmith.models import trees as T
from rowsmith.operators import metrics

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def classed(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] ** 2 + x[:, 1] > 0.8).astype(float)
    data = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return N.assemble(spark.createDataFrame(data, "id bigint, a double, b double, c double, label double"), COLS).persist()


def accuracy(df):
    return metrics.accuracy(df, "label", "prediction").first()[0]


def test_logistic_matches_penalised_optimum(classed):
    n = classed.count()
    m = L.logistic(C=1.0).fit(classed)
    pdf = classed.toPandas()
    x, y = pdf[COLS].to_numpy(), pdf["label"].to_numpy()
    w, b = m.coefficients.toArray(), m.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(w + x.T @ (p - y)).max() < 1e-2  # gradient of sum of losses plus half the squared norm


def test_least_squares_recovers_line(spark):
    df = spark.range(50).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"))
    df = df.withColumn("y", 3 * F.col("x") - 2 * F.col("z") + 1)
    m = L.least_squares(["x", "z"], "y").fit(df).stages[-1]
    got = {r["column"]: r["coefficient"] for r in L.coefficient_table(spark, m, ["x", "z"]).collect()}
    assert got == pytest.approx({"x": 3, "z": -2, "intercept": 1}, abs=1e-6)


def test_tree_rules_and_importance(spark, classed):
    m = T.decision_tree(depth=3).fit(classed)
    rules = T.tree_rules(spark, m, COLS).toPandas()
    assert len(rules) == m.numNodes and rules["depth"].max() == m.depth
    imp = T.importance_table(spark, m, COLS).toPandas()
    assert abs(imp["importance"].sum() - 1) < 1e-9 and imp.sort_values("importance").iloc[0]["column"] == "c"


def test_adaboost_beats_its_stump(classed):
    one = T.AdaBoost(rounds=1).fit(classed).transform(classed)
    many = T.AdaBoost(rounds=12, checkpointEvery=5).fit(classed).transform(classed)
    assert accuracy(many) > accuracy(one)
    p = np.array([r[0] for r in many.select(vector_to_array("probability")).collect()])
    assert np.allclose(p.sum(axis=1), 1)


def test_boosting_beats_the_mean(spark):
    df = N.assemble(spark.range(400).select("id", (F.col("id") % 20).alias("x"), F.sin(F.col("id") % 20).alias("y")), ["x"])
    out = T.boosted_regressor("y", rounds=15).fit(df).transform(df)
    assert RegressionEvaluator(labelCol="y", metricName="r2").evaluate(out) > 0.8


def test_margin_model_needs_products(classed):
    m = L.PolynomialMargin(keyCols=["id"], degree=3, folds=2, maxIter=30).fit(classed)
    out = m.transform(classed)
    assert accuracy(out) > 0.9
    p = out.select(vector_to_array("probability")[1].alias("p"), "label").toPandas()
    assert p[p["label"] == 1]["p"].mean() > p[p["label"] == 0]["p"].mean() + 0.4


def test_vote_is_the_mean(classed):
    members = [L.logistic(), B.GaussianBayes(inputCols=COLS), T.decision_tree(depth=2)]
    fitted = E.SoftVote(members).fit(classed)
    got = np.array([r[0] for r in fitted.transform(classed).orderBy("id").select(vector_to_array("probability")).collect()])
    parts = [np.array([r[0] for r in m.transform(classed).orderBy("id").select(vector_to_array("probability")).collect()]) for m in fitted.members]
    assert np.allclose(got, np.mean(parts, axis=0))


def test_stacking_does_not_leak(classed):
    """With a 1-neighbour member every row would find itself, unless its fold is left out."""
    member = B.KnnClassifier(keyCol="id", k=1)
    noise = classed.withColumn("label", (F.pmod(F.xxhash64("id"), F.lit(2))).cast("double"))
    stack = E.Stacking([member], T.decision_tree(depth=1).setFeaturesCol("__stack"), keyCol="id", folds=3)
    oof = stack.out_of_fold(noise).select("label", F.get("__m0", 1).alias("p")).toPandas()
    assert len(oof) == 300 and (oof["label"] == oof["p"]).mean() < 0.7
    seen = member.fit(noise).transform(noise)
    assert accuracy(seen) == 1.0


def test_bagging_uses_column_subsets(classed):
    fitted = E.Bagging(T.decision_tree(depth=4, featuresCol="__f"), inputCols=COLS, keyCol="id", count=3).fit(classed)
    assert [len(c) for c in fitted.state["columns"]] == [2, 2, 2]
    assert accuracy(fitted.transform(classed)) > 0.6


def test_composites_survive_saving(classed, tmp_path):
    fitted = E.SoftVote([L.logistic(), B.GaussianBayes(inputCols=COLS)]).fit(classed)
    fitted.write().save(str(tmp_path / "vote"))
    again = E.FittedVote.load(str(tmp_path / "vote"))
    a, b = (m.transform(classed).select("id", "prediction").orderBy("id").collect() for m in (fitted, again))
    assert a == b


def test_pca_shares(classed):
    axes = N.PrincipalAxes(inputCol="features", outputCol="p").fit(classed)
    assert abs(sum(axes.ratios) - 1) < 1e-9 and axes.ratios == sorted(axes.ratios, reverse=True)
    x = classed.toPandas()[COLS].to_numpy()
    eig = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert np.allclose(axes.ratios, eig / eig.sum())
    assert N.PrincipalAxes(inputCol="features", outputCol="p", variance=0.5).fit(classed).kept == 2


def test_ward_matches_plain_merging(spark):
    pts = [0.0, 0.1, 5.0, 5.2, 20.0]
    merges = K._ward_merges(np.array([[p] for p in pts]), np.ones(5))
    assert [(a, b) for a, b, _, _ in merges] == [(0, 1), (2, 3), (5, 6), (4, 7)]
    assert [s for *_, s in merges] == [2, 2, 4, 5]
    assert merges[0][2] == pytest.approx(0.1) and merges[1][2] == pytest.approx(0.2)
    assert [m[2] for m in merges] == sorted(m[2] for m in merges)


def test_ward_cut(spark):
    data = [(i, [float(10 * (i % 3)) + 0.01 * i]) for i in range(60)]
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(data, "id bigint, v array<double>").withColumn("features", array_to_vector("v"))
    out = K.WardTree(micro=12).fit(df).assign(df, 3).select((F.col("id") % 3).alias("k"), "cluster").distinct()
    assert out.count() == 3 and out.select("cluster").distinct().count() == 3


def test_elbow_scan(spark):
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame([(i, [float(100 * (i % 4)), float(i % 7) / 10]) for i in range(120)], "id bigint, v array<double>")
    df = df.withColumn("features", array_to_vector("v"))
    scan = K.elbow_scan(df, range(2, 8))
    assert K.best_k(scan) == 4


def test_unfitted_ensembles_keep_their_members(classed, tmp_path):
    whole = [
        E.SoftVote([L.logistic(), B.GaussianBayes(inputCols=COLS)]),
        E.Bagging(T.decision_tree(depth=2, featuresCol="__f"), inputCols=COLS, keyCol="id", count=3),
        E.Stacking([B.GaussianBayes(inputCols=COLS)], T.decision_tree(depth=1).setFeaturesCol("__stack"), keyCol="id", folds=3),
    ]
    for i, model in enumerate(whole):
        model.write().save(str(tmp_path / f"m{i}"))
        again = type(model).load(str(tmp_path / f"m{i}"))
        a, b = (m.fit(classed).transform(classed).select("id", "prediction").orderBy("id").collect() for m in (model, again))
        assert a == b


def test_bins_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    for strategy in ("quantile", "uniform"):
        out = N.BinColumns(inputCols=["a", "b"], bins=2, strategy=strategy).fit(df).transform(df).collect()
        assert [r["b"] for r in out] == [None, None] and [r["a"] for r in out] == [0, 1]


def test_adaboost_rounds_as_by_weights(spark):
    """Stumps, errors and votes of eight rounds on four classes against plain loops over rows and cuts."""
    rng = np.random.default_rng(6)
    x = np.round(rng.standard_normal((600, 3)), 1)
    y = (x[:, 0] > 0) * 1.0 + 2.0 * (x[:, 1] + 0.3 * rng.standard_normal(600) > 0.2)
    df = spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], "a double, b double, c double, label double")
    df = N.assemble(df, ["a", "b", "c"])
    stumps = T.AdaBoost(rounds=8, bins=16).fit(df).state["stumps"]
    w, classes = np.ones(600), [0.0, 1.0, 2.0, 3.0]
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, 16) / 16)) for j in range(3)]
    for s in stumps:
        best = None
        for j in range(3):
            for e in cuts[j]:
                left = x[:, j] <= e
                sums = [np.array([w[m & (y == c)].sum() for c in classes]) for m in (left, ~left)]
                score = sum((v**2).sum() / v.sum() for v in sums if v.sum())
                if best is None or score > best[0] + 1e-9:
                    best = (score, j, e, classes[sums[0].argmax()], classes[sums[1].argmax()])
        _, j, e, lo, hi = best
        assert (s["feature"], s["left"], s["right"]) == (j, lo, hi) and abs(s["threshold"] - e) < 1e-12
        miss = np.where(x[:, j] <= e, lo, hi) != y
        error = w[miss].sum() / w.sum()
        assert abs(s["alpha"] - (np.log((1 - error) / error) + np.log(3))) < 1e-9
        w = w * np.exp(s["alpha"] * miss)


def test_adaboost_without_a_split(spark):
    same = N.assemble(spark.createDataFrame([(1.0, 0.0), (1.0, 1.0), (1.0, 1.0), (1.0, None)], "a double, label double"), ["a"])
    model = T.AdaBoost(rounds=5).fit(same)
    assert {r["prediction"] for r in model.transform(same).collect()} == {1.0}
    one = N.assemble(spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, label double"), ["a"])
    assert {r["prediction"] for r in T.AdaBoost(rounds=5).fit(one).transform(one).collect()} == {3.0}
    with pytest.raises(ValueError):
        T.AdaBoost().fit(one.limit(0))


def test_forests_keep_the_nodes_of_rows(spark):
    """No pass walks or ships the trees grown so far; the trees are the same."""
    x = F.col("id").cast("double")
    df = N.assemble(spark.range(300).select((x % 31).alias("a"), (x % 3).alias("label"), (x * x % 101).alias("y")), ["a"])
    for make, label in ((T.forest_classifier, "label"), (T.forest_regressor, "y")):
        assert make(label).getCacheNodeIds()
        kept, walked = (make(label, trees=3, cacheNodeIds=c).fit(df) for c in (True, False))
        assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]
