"""Chains of steps, persistence, search, run log, streams."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from rowsmith.features import category as C
from rowsmith.features import numeric as N
from rowsmith.models import linear as L
from rowsmith.models import trees as T
from rowsmith.plans import flows
from rowsmith.plans.q_evaluate import churn, churn_flow, price_flow, sales
from rowsmith.plans.runs import RunLog
from rowsmith.session import shared_folder
from rowsmith.streaming import events as EV


def test_fitted_flow_predicts_the_same_after_reload(spark, small, tmp_path):
    df = sales(spark, small)
    model = price_flow(5).fit(df)
    model.write().overwrite().save(str(tmp_path / "flow"))
    again = PipelineModel.load(str(tmp_path / "flow"))
    a, b = (m.transform(df).select("id", "prediction").orderBy("id").collect() for m in (model, again))
    assert a == b and len(a) == df.count()


def test_unfitted_steps_can_be_saved(spark, small, tmp_path):
    df = sales(spark, small)
    steps = Pipeline(stages=[N.MeanImputer(inputCols=["size"]), N.ZScaler(inputCols=["size"]), C.ModeImputer(inputCols=["brand"])])
    steps.write().overwrite().save(str(tmp_path / "steps"))
    again = Pipeline.load(str(tmp_path / "steps"))
    a, b = (p.fit(df).transform(df).orderBy("id").collect() for p in (steps, again))
    assert a == b


def test_sampler_is_gone_after_fitting(spark, small):
    df = churn(spark, small)
    model = churn_flow().fit(df)
    assert isinstance(model, PipelineModel) and not [s for s in model.stages if isinstance(s, flows.Sampler)]
    assert model.transform(df).count() == df.count()


def test_sampler_equalises_training_rows(spark, small):
    df = churn(spark, small).select("doc_id", "chars", "words", "label")
    _, rows = flows.Flow([flows.SmoteSampler(["chars", "words"], "label", "doc_id", 5)]).fit_transform(df)
    counts = [r["count"] for r in rows.groupBy("label").count().collect()]
    assert len(counts) == 2 and counts[0] == counts[1]


def test_editing_a_flow():
    flow = churn_flow()
    other = flow.replace_last(T.decision_tree(depth=2))
    assert type(other.steps[-1]).__name__ == "DecisionTreeClassifier" and type(flow.steps[-1]).__name__ == "GBTClassifier"
    tuned = flow.with_params(selectbest__k=2, gbtclassifier__maxDepth=4)
    assert tuned.named(N.SelectBest).value("k") == 2 and flow.named(N.SelectBest).value("k") == 4
    assert tuned.steps[-1].getMaxDepth() == 4 and flow.steps[-1].getMaxDepth() == 3


def test_cross_validation_refits_everything(spark, small):
    scores = flows.cross_val_score(price_flow(3), sales(spark, small), RegressionEvaluator(labelCol="price"), ["id"], 3)
    assert [r["fold"] for r in scores.orderBy("fold").collect()] == [0, 1, 2]


@pytest.fixture(scope="module")
def line(spark):
    df = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 * 3).cast("double").alias("y"))
    return df.persist()


def make(depth):
    return flows.Flow([N.ZScaler(inputCols=["x"]), flows.AssembleByType(exclude=["id", "y"]), T.forest_regressor("y", trees=1, maxDepth=depth, bootstrap=False)])


def test_search_ranks_points(line):
    scorer = RegressionEvaluator(labelCol="y", metricName="rmse")
    out = flows.grid_search(make, {"depth": [1, 4]}, line, scorer, ["id"], k=2)
    assert flows.best_params(out) == {"depth": 4}
    again = flows.random_search(make, {"depth": [1, 2, 3, 4]}, 2, line, scorer, ["id"], k=2, seed=5)
    assert again.count() == 2


def test_search_fits_equal_beginnings_once_per_fold(line, monkeypatch):
    """Points that differ in their last step share the steps before it, with the scores of separate fits."""
    fits = []
    plain = N.ZScaler._fit
    monkeypatch.setattr(N.ZScaler, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    scorer = RegressionEvaluator(labelCol="y", metricName="rmse")
    got = flows.search(make_or_tree, [{"depth": d} for d in (1, 2, 4, 0)], line, scorer, ["id"], k=2).orderBy("point").collect()
    assert len(fits) == 2
    for point, depth in enumerate((1, 2, 4, 0)):
        alone = [r["score"] for r in flows.cross_val_score(make_or_tree(depth), line, scorer, ["id"], k=2).collect()]
        assert got[point]["mean_score"] == pytest.approx(sum(alone) / 2, abs=1e-9)


def make_or_tree(depth):
    """A chain, or for depth 0 a chain that is the beginning of the others with another end."""
    return make(depth) if depth else flows.Flow([flows.AssembleByType(exclude=["id", "y"]), T.forest_regressor("y", trees=1, maxDepth=1, bootstrap=False)])


def test_power_transform_rounds_share_one_plan(spark, monkeypatch):
    """No lambda is written into the plan, so that a fit compiles its rounds once; the numbers are those of single aggregates."""
    from rowsmith.features import numeric

    seen = []
    plain = numeric.signed_power
    monkeypatch.setattr(numeric, "signed_power", lambda c, lam: seen.append(lam) or plain(c, lam))
    df = spark.range(60).select((F.col("id") * F.col("id") - 300).cast("double").alias("a"), F.when(F.col("id") % 3 > 0, F.exp(F.col("id") / 20)).alias("b"),
                                F.lit(None).cast("double").alias("c"))
    state = numeric.YeoJohnson(inputCols=["a", "b", "c"]).fit(df).state
    assert seen and not any(isinstance(lam, float) for lam in seen)
    for c in "abc":
        lam, mean, dev = state[c]
        want = df.agg(F.avg(plain(c, lam)), F.stddev_pop(plain(c, lam))).first()
        assert (mean, dev) == (want[0] if want[0] is None else pytest.approx(want[0], rel=1e-9), pytest.approx(want[1], rel=1e-9) if want[1] else 1.0)


def test_stored_prefix_gives_the_same_scores(line):
    scorer = RegressionEvaluator(labelCol="y", metricName="rmse")
    points = [{"depth": 1}, {"depth": 4}]
    full = flows.search(make, points, line, scorer, ["id"], k=2).orderBy("point").collect()
    fast = flows.search_last_step(make(1), lambda depth: T.forest_regressor("y", trees=1, maxDepth=depth, bootstrap=False), points, line, scorer, ["id"], k=2)
    assert [round(r["mean_score"], 9) for r in full] == [round(r["mean_score"], 9) for r in fast.orderBy("point").collect()]


def test_leaderboard_keeps_models_of_one_class_apart(spark, small):
    from rowsmith.plans.q_models import scaled_docs

    df = scaled_docs(spark, small)
    board = flows.leaderboard({"a": T.decision_tree(depth=1).fit(df), "b": T.decision_tree(depth=6).fit(df)}, df, "label")
    assert [r["rank"] for r in board.orderBy("rank").collect()] == [1, 2] and board.count() == 2


def test_run_log(spark, line, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    model = L.least_squares(["x"], "y").fit(line)
    log.log("e1", "first", {"p": 1}, {"rmse": 2.0})
    log.log("e1", "second", {"p": 2}, {"rmse": 1.0}, {"kind": "line"}, model=model, sample=line, registered="best")
    log.log("e2", "third", {}, {"rmse": 0.5})
    assert [r["name"] for r in log.search("e1", "rmse", larger_is_better=False).collect()] == ["second", "first"]
    assert log.search("e1", "rmse", larger_is_better=False, limit=1).first()["input_schema"]
    loaded = PipelineModel.load(log.registered_model("best"))
    assert loaded.transform(line).where(F.abs(F.col("prediction") - F.col("y")) > 1e-6).count() == 0
    with pytest.raises(KeyError):
        log.registered_model("nothing")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_stream_continues_from_its_checkpoint(spark, small, tmp_path):
    model = L.least_squares(["user_id"], "value").fit(spark.read.parquet(f"{small}/events.parquet"))
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    n = spark.read.parquet(f"{small}/events.parquet").count()
    for _ in range(2):
        EV.score_stream(model, EV.event_stream(spark, small), ["event_id"], out, check)
        assert spark.read.parquet(out).count() == n


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError, match="no setting"):
        churn_flow().with_params(selectbst__k=2)
    with pytest.raises(ValueError, match="no setting"):
        churn_flow().with_params(selectbest__kk=2)


def test_unfitted_chains_survive_saving(spark, small, tmp_path):
    df = churn(spark, small).select("doc_id", "lang", "chars", "words", "label")
    flow = flows.Flow([
        flows.ColumnSteps([(["lang"], [C.CrossFitTargetEncoder(labelCol="label", keyCols=["doc_id"])])]),
        flows.SmoteSampler(["lang", "chars", "words"], "label", "doc_id", 3),
        flows.AssembleByType(exclude=["doc_id", "label"]), T.decision_tree(depth=3),
    ])
    flow.write().save(str(tmp_path / "flow"))
    again = flows.Flow.load(str(tmp_path / "flow"))
    assert [type(s) for s in again.steps] == [type(s) for s in flow.steps]
    a, b = (f.fit(df).transform(df).orderBy("doc_id").select("doc_id", "prediction").collect() for f in (flow, again))
    assert a == b


def test_encoded_rows_leave_a_branch(spark, small):
    df = churn(spark, small).select("doc_id", "lang", "label")
    step = C.CrossFitTargetEncoder(labelCol="label", keyCols=["doc_id"])
    _, rows = flows.Flow([flows.ColumnSteps([(["lang"], [step])])]).fit_transform(df)
    alone = step.copy()._set(inputCols=["lang"]).fit_transform(df)[1]
    assert rows.orderBy("doc_id").select("lang").collect() == alone.orderBy("doc_id").select("lang").collect()


def test_churn_chain_saved_and_loaded(spark, small, tmp_path):
    """The whole chain, unfitted and fitted: encoder, selection, power transform with oversampling, bins, boosting."""
    from rowsmith.plans import q_evaluate as Q

    df = Q.churn(spark, small)
    Q.churn_flow(rounds=3).write().save(str(tmp_path / "chain"))
    loaded = flows.Flow.load(str(tmp_path / "chain"))
    step = next(s for s in loaded.steps if isinstance(s, flows.PowerAndBalance))
    assert (step.label, step.key, step.k) == ("label", "doc_id", 5)
    model = loaded.fit(df)
    want = [tuple(r) for r in Q.churn_flow(rounds=3).fit(df).transform(df).select("doc_id", "prediction").orderBy("doc_id").collect()]
    assert [tuple(r) for r in model.transform(df).select("doc_id", "prediction").orderBy("doc_id").collect()] == want
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert [tuple(r) for r in again.transform(df).select("doc_id", "prediction").orderBy("doc_id").collect()] == want


def test_fit_makes_no_training_rows_after_the_last_step(line, monkeypatch):
    chain = flows.Flow([N.ZScaler(inputCols=["x"]), N.MeanImputer(inputCols=["x"])])
    seen, scaled, filled = [], N.FittedScaler._transform, N.FittedMean._transform
    monkeypatch.setattr(N.FittedScaler, "_transform", lambda s, df: seen.append("scaled") or scaled(s, df))
    monkeypatch.setattr(N.FittedMean, "_transform", lambda s, df: seen.append("filled") or filled(s, df))
    model = chain.fit(line)
    assert seen == ["scaled"] and len(model.stages) == 2
    fitted, rows = chain.fit_transform(line)
    assert seen == ["scaled"] * 2 + ["filled"] and rows.count() == line.count()
    assert model.transform(line).exceptAll(fitted.transform(line)).count() == 0


def test_random_search_fits_all_rounds(spark, small, monkeypatch):
    """Every point of the query is the whole chain with the rounds of a final fit."""
    from rowsmith.plans import q_evaluate

    seen = []
    monkeypatch.setattr(flows, "search", lambda make, points, *rows, **more: seen.append([make(**p) for p in points]))
    q_evaluate.random_search(spark, small)
    final = churn_flow().steps
    assert [len(c) for c in seen] == [10]
    for chain in seen[0]:
        assert [type(s) for s in chain.steps] == [type(s) for s in final] and chain.steps[-1].getMaxIter() == final[-1].getMaxIter() == 100
