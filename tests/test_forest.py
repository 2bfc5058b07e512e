"""Forests whose small nodes are finished in grouped tasks."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowsmith.features import numeric as N
from rowsmith.models import forest as G
from rowsmith.models import trees as T


@pytest.fixture
def own(monkeypatch):
    """Every forest is a large one, and a task finishes at most 64 rows."""
    monkeypatch.setattr(T, "SPARK_FOREST", 0)
    monkeypatch.setattr(G, "LOCAL_ROWS", 64)


@pytest.fixture(scope="module")
def df(spark):
    x = np.random.default_rng(5).normal(size=(600, 4))
    data = [(i, *map(float, r), float(int(r[0] > 0) + int(r[1] > 0.5)), float(3 * r[0] + r[2])) for i, r in enumerate(x)]
    return N.assemble(spark.createDataFrame(data, "id long, a double, b double, c double, d double, label double, y double"), list("abcd")).cache()


def test_large_tables_leave_sparks_forest(spark, monkeypatch):
    """Spark sends full statistics for every node; that many rows and nodes are not given to it."""
    monkeypatch.setattr(T.RandomForestRegressor, "_fit", lambda *a: pytest.fail("Spark's own forest"))
    monkeypatch.setattr(G, "LOCAL_ROWS", 1000)
    monkeypatch.setattr(T, "SPARK_FOREST", 1 << 22)
    big = N.assemble(spark.range(4000).selectExpr("cast(id % 7 as double) a", "cast(id % 7 * 2 as double) y"), ["a"])
    out = T.forest_regressor("y", trees=5).fit(big).transform(big)
    assert out.where(F.abs(F.col("prediction") - F.col("y")) > 1e-9).count() == 0 and out.count() == 4000


def test_one_tree_over_all_rows_is_sparks_tree(spark, own, monkeypatch):
    """Columns of few values have the same thresholds, and no row is drawn: every split must agree."""
    few = N.assemble(spark.range(500).selectExpr(
        "id", "cast(id % 13 as double) a", "cast(id * id % 19 as double) b", "cast(id % 13 + (id * id % 19) * 3 + id % 5 as double) y",
        "cast((id % 13 > 6) as int) + cast((id * id % 19 > 9) as int) label"), ["a", "b"])
    for make, label in ((T.forest_regressor, "y"), (T.forest_classifier, "label")):
        model = make(label, trees=1, maxDepth=4, bootstrap=False).fit(few)
        assert isinstance(model, G.GrownForest)
        monkeypatch.setattr(T, "SPARK_FOREST", 1 << 60)
        spark_model = make(label, trees=1, maxDepth=4, bootstrap=False).fit(few)
        monkeypatch.setattr(T, "SPARK_FOREST", 0)
        a, b = ({r["id"]: r["prediction"] for r in m.transform(few).collect()} for m in (model, spark_model))
        assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-9
        assert np.allclose(model.featureImportances.toArray(), spark_model.featureImportances.toArray(), atol=1e-9)


def test_large_forest_classifies(spark, own, df, tmp_path):
    model = T.forest_classifier(trees=20).fit(df)
    out = model.transform(df)
    rows = out.select("id", "label", "prediction", vector_to_array("probability").alias("p")).collect()
    assert len(rows) == 600 and {len(r["p"]) for r in rows} == {3}
    assert all(abs(sum(r["p"]) - 1) < 1e-9 for r in rows) and np.mean([r["label"] == r["prediction"] for r in rows]) > 0.98
    share = model.featureImportances.toArray()
    assert abs(share.sum() - 1) < 1e-9 and share[0] > share[2] and share[1] > share[3]
    assert len(model.state["top"]["feature"]) > 20  # the roots were split by passes
    model.write().save(str(tmp_path / "forest"))
    again = G.GrownForest.load(str(tmp_path / "forest")).transform(df)
    assert {(r["id"], r["prediction"]) for r in again.collect()} == {(r["id"], r["prediction"]) for r in rows}
    assert T.forest_classifier(trees=20).fit(df).transform(df).select("id", "probability").exceptAll(out.select("id", "probability")).count() == 0


def test_large_forest_regresses_and_odd_rows(spark, own, df):
    model = T.forest_regressor("y", trees=20).fit(df)
    out = model.transform(df.union(df))  # rows that come twice stay twice
    r = out.agg(F.corr("y", "prediction"), F.count("prediction")).first()
    assert r[0] > 0.97 and r[1] == 1200
    same = N.assemble(spark.createDataFrame([(1.0, 4.0)] * 200, "a double, y double"), ["a"])  # no split parts the rows
    assert {r["prediction"] for r in T.forest_regressor("y", trees=3).fit(same).transform(same).collect()} == {4.0}
    with pytest.raises(Exception):
        T.forest_regressor("y", trees=3).fit(N.assemble(spark.createDataFrame([(1.0, 4.0), (2.0, None)], "a double, y double"), ["a"]))


def test_unfitted_forest_is_saved_as_itself(spark, tmp_path):
    T.forest_regressor("y", trees=7).write().save(str(tmp_path / "plain"))
    again = T.ForestRegressor.load(str(tmp_path / "plain"))
    assert isinstance(again, T.ForestRegressor) and again.getNumTrees() == 7 and again.getLabelCol() == "y" and again.getMaxDepth() == 30


def test_draws_are_poisson():
    w = G.draws(np.arange(20000), 3, 1, 1.0, True)
    assert abs(w.mean() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.01 and abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.03


def _few(spark, n: int):
    """Three columns, one of more values than bins; half of the rows are alike but for their labels."""
    return N.assemble(spark.range(n).selectExpr("id", "if(id % 2 = 0, 3, id * 7 % 90) a", "if(id % 2 = 0, 1, id % 5) b", "if(id % 2 = 0, 0, id * id % 11) c").selectExpr(
        "*", "a + b * 10 - c + id % 3 + 0.25 y", "cast(pmod(a + b + id % 2, 4) as int) label"), list("abc"))


def test_few_cells_need_neither_passes_nor_travelling_rows(spark, own, tmp_path, monkeypatch):
    df = _few(spark, 3000)
    monkeypatch.setattr(G._Top, "_pass", lambda *a: pytest.fail("a pass over all rows"))
    monkeypatch.setattr(G.GrownForest, "_votes", lambda *a: pytest.fail("a row for every tree"))
    for make, label in ((T.forest_regressor, "y"), (T.forest_classifier, "label")):
        model = make(label, trees=8).fit(df)
        out = model.transform(df)
        right = out.agg(F.corr("prediction", label), F.count("prediction")).first()
        assert right[0] > 0.95 and right[1] == 3000 and out.columns[: len(df.columns)] == df.columns
        model.write().save(str(tmp_path / label))
        again = G.GrownForest.load(str(tmp_path / label))
        assert again.transform(df).select("id", "prediction").exceptAll(out.select("id", "prediction")).count() == 0


def test_trees_of_cells_are_the_trees_of_rows(spark, own, monkeypatch):
    """The same trees as from single rows: equal predictions for all rows, and equal importances."""
    df = _few(spark, 3000)
    monkeypatch.setattr(G, "LOCAL_ROWS", 1 << 17)
    for make, label, more in ((T.forest_regressor, "y", {}), (T.forest_regressor, "y", {"minInstancesPerNode": 30, "subsamplingRate": 0.5, "bootstrap": False}),
                              (T.forest_classifier, "label", {}), (T.forest_classifier, "label", {"maxDepth": 3})):
        seen = []
        for grid in (1 << 16, 0):
            monkeypatch.setattr(G, "GRID", grid)
            model = make(label, trees=6, **more).fit(df)
            assert ("votes" in model.tables) == bool(grid)
            out = model.transform(df)
            found = out.select("id", "prediction", *([vector_to_array("probability").alias("p")] if label == "label" else [])).orderBy("id").collect()
            seen.append((np.array([r["prediction"] for r in found]), np.array([r["p"] for r in found]) if label == "label" else 0, model.featureImportances.toArray()))
        assert all(np.allclose(a, b, rtol=1e-9, atol=1e-9) for a, b in zip(*seen))


def test_thresholds_from_counts(spark, monkeypatch):
    """Counted values give the thresholds of the exact quantiles; a column of too many values in all tasks is left to those."""
    rows = spark.range(6000, numPartitions=7).selectExpr("array(cast(id * id % 101 as double), cast(id % 9 as double), sqrt(id), -3.5) x").cache()
    cuts = G.column_cuts(rows, 4, 32)
    monkeypatch.setattr(G, "VALUES", 0)
    plain = G.column_cuts(rows, 4, 32)
    assert [c.tolist() for c in cuts] == [c.tolist() for c in plain]
    assert [len(c) for c in cuts] == [31, 8, 31, 0]
    monkeypatch.setattr(G, "column_quantiles", lambda df, cols, probs: pytest.fail("quantiles of columns that were counted"))
    monkeypatch.setattr(G, "VALUES", 1 << 12)
    assert len(G.column_cuts(rows.selectExpr("slice(x, 1, 2) x"), 2, 32)[0]) == 31


def test_trees_of_occupied_cells_are_the_trees_of_rows(spark, own, monkeypatch):
    """More possible cells than a table of votes may have, few with rows: no pass splits nodes, and a cell is scored once."""
    df = _few(spark, 3000)
    monkeypatch.setattr(G, "GRID", 0)
    votes, passed, walked = G.GrownForest._votes, G._Top._pass, []
    monkeypatch.setattr(G.GrownForest, "_votes", lambda self, rows: walked.append(rows.count()) or votes(self, rows))
    for make, label in ((T.forest_regressor, "y"), (T.forest_classifier, "label")):
        seen = []
        for codes in (1 << 62, 0):  # 0: as with very many columns
            monkeypatch.setattr(G, "CODES", codes)
            monkeypatch.setattr(G, "LOCAL_ROWS", 1 << 17 if not codes else 256)
            monkeypatch.setattr(G._Top, "_pass", (lambda *a: pytest.fail("a pass over all rows")) if codes else passed)
            model = make(label, trees=6).fit(df)
            out = model.transform(df).select("id", "prediction").orderBy("id").collect()
            assert len(out) == 3000 and "votes" not in model.tables
            seen.append((np.array([r["prediction"] for r in out]), model.featureImportances.toArray()))
        assert all(np.allclose(a, b, rtol=1e-9, atol=1e-9) for a, b in zip(*seen))
        assert walked[-2] < 1000 and walked[-1] == 3000


@pytest.mark.parametrize("classes,bins", [(0, 32), (3, 32), (0, 200)])
def test_splits_of_small_nodes_are_those_over_all_bins(classes, bins):
    rng = np.random.default_rng(7)
    size = rng.integers(1, 40, 300)
    node = np.repeat(np.arange(300), size)
    x = rng.integers(0, bins, (len(node), 6)).astype(np.uint8) // rng.integers(1, 9, 6).astype(np.uint8)
    label = rng.integers(0, 3, len(node)).astype(float) if classes else rng.normal(size=len(node))
    w = rng.integers(1, 4, len(node)).astype(float)
    slots = np.sort(rng.random((300, 6)).argsort(axis=1)[:, :4], axis=1)
    slot, edge, gain, _, _ = G.best_splits(G._hist(x, label, w, node, slots, bins, classes), classes, 2)
    got = G.node_splits(x, label, w, node, slots, bins, classes, 2)
    some = np.isfinite(gain)
    assert some.sum() > 200 and (got[2] == gain).all()
    assert (got[0][some] == slot[some]).all() and (got[1][some] == edge[some]).all()
