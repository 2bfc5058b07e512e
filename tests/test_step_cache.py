"""Fitted steps shared by chains, points and runs."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from rowsmith.features import numeric as N
from rowsmith.models import linear as L
from rowsmith.models import trees as T
from rowsmith.plans import flows
from rowsmith.plans.q_evaluate import churn, churn_flow
from rowsmith.plans.step_cache import StepCache, data_version, search_cached, settings_of


@pytest.fixture(scope="module")
def line(spark):
    x = F.when(F.col("id") % 7 != 0, (F.col("id") % 10).cast("double"))
    return spark.range(200).select("id", x.alias("x"), (F.col("id") % 10 * 3).cast("double").alias("y")).persist()


def chain(strength=0.0, centre=True):
    steps = [N.MeanImputer(inputCols=["x"])] + ([N.ZScaler(inputCols=["x"])] if centre else [])
    model = L.least_squares(["x"], "y")
    model.getStages()[-1].setRegParam(strength)
    return flows.Flow([*steps, model])


def test_version_follows_the_rows_only(spark, line):
    base = data_version(line)
    assert data_version(line.repartition(5).orderBy(F.desc("id"))) == base
    assert data_version(line.unionByName(line.limit(1))) != base
    assert data_version(line.withColumnRenamed("x", "z")) != base
    assert data_version(line.withColumn("x", F.col("x").cast("float"))) != base
    swapped = [data_version(spark.createDataFrame(r, "a int, b int")) for r in ([(1, None)], [(None, 1)], [])]
    assert len(set(swapped)) == 3
    maps = [data_version(spark.createDataFrame([({"k": v},)], "m map<string,int>")) for v in (1, 2)]
    assert maps[0] != maps[1]


def test_settings_ignore_generated_names():
    assert settings_of(chain()) == settings_of(chain())
    assert settings_of(chain()) != settings_of(chain(0.5))
    assert settings_of(churn_flow(k=3)) != settings_of(churn_flow(k=5))


def test_fitted_steps_are_refused(line):
    with pytest.raises(TypeError):
        settings_of(N.MeanImputer(inputCols=["x"]).fit(line))


def test_grid_over_two_steps_fits_each_prefix_once_per_fold(spark, line, tmp_path):
    scorer = RegressionEvaluator(labelCol="y", metricName="rmse")
    points = flows.parameter_grid({"strength": [0.0, 0.5], "centre": [True, False]})
    cache = StepCache(spark, str(tmp_path / "steps"))
    got = search_cached(cache, chain, points, line, scorer, ["id"], k=2).orderBy("point").collect()
    want = flows.search(chain, points, line, scorer, ["id"], k=2).orderBy("point").collect()
    assert [(r["params"], round(r["mean_score"], 9)) for r in got] == [(r["params"], round(r["mean_score"], 9)) for r in want]
    counts = {n: cache.fitted.count(n) for n in set(cache.fitted)}
    assert counts == {"MeanImputer": 2, "ZScaler": 2, "Pipeline": 8}
    assert cache.entries().count() == 12

    later = StepCache(spark, str(tmp_path / "steps"))
    again = search_cached(later, chain, points, line, scorer, ["id"], k=2).orderBy("point").collect()
    assert later.fitted == [] and [r["mean_score"] for r in again] == [r["mean_score"] for r in got]

    assert later.remove(F.col("step") == "ZScaler") == 2 and later.entries().count() == 10
    search_cached(later, chain, points, line, scorer, ["id"], k=2)
    assert later.fitted == ["ZScaler"] * 2
    assert later.remove() == 12 and later.entries().count() == 0


def test_other_rows_are_other_entries(spark, line, tmp_path):
    cache = StepCache(spark, str(tmp_path / "steps"))
    cache.fit(chain(), line)
    cache.fit(chain(), line.where("id < 100"))
    cache.fit(chain(), line.repartition(3))
    assert cache.fitted.count("MeanImputer") == 2 and cache.found.count("MeanImputer") == 1


def test_interrupted_entry_is_written_anew(spark, line, tmp_path):
    cache = StepCache(spark, str(tmp_path / "steps"))
    cache.fit(chain(), line)
    key = cache.entries().where("step = 'ZScaler'").first()["key"]
    (attempt,) = (tmp_path / "steps" / key).iterdir()
    for file in (attempt / "entry").iterdir():
        file.unlink()
    other = StepCache(spark, str(tmp_path / "steps"))
    other.fit(chain(), line)
    assert other.fitted == ["ZScaler"]


def test_sampler_and_encoded_rows_come_back(spark, small, tmp_path):
    df = churn(spark, small)
    flow = lambda depth: churn_flow().replace_last(T.decision_tree(depth=depth))
    cache = StepCache(spark, str(tmp_path / "steps"))
    cache.fit(flow(2), df)
    kept = cache.fit(flow(3), df).transform(df).select("doc_id", "prediction").orderBy("doc_id").collect()
    assert kept == flow(3).fit(df).transform(df).select("doc_id", "prediction").orderBy("doc_id").collect()
    assert sorted(cache.fitted) == sorted(["CrossFitTargetEncoder", "SelectBest", "PowerAndBalance", "DecisionTreeClassifier", "DecisionTreeClassifier"])
    assert cache.found == ["CrossFitTargetEncoder", "SelectBest", "PowerAndBalance"]


def test_empty_table(spark, tmp_path):
    cache = StepCache(spark, str(tmp_path / "steps"))
    empty = spark.createDataFrame([], "id long, x double, y double")
    cache.fit(flows.Flow([N.MeanImputer(inputCols=["x"])]), empty)
    assert cache.fitted == ["MeanImputer"] and StepCache(spark, str(tmp_path / "none")).entries().count() == 0
