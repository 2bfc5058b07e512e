"""Evaluation, chains of steps, search and the run log."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from rowsmith.features import category as C
from rowsmith.features import numeric as N
from rowsmith.models import linear as L
from rowsmith.models import simple as B
from rowsmith.models import trees as T
from rowsmith.operators import metrics as M
from rowsmith.plans import flows
from rowsmith.plans.q_features import DOC_COLS, doc_features
from rowsmith.plans.q_models import scaled
from rowsmith.plans.q_relate import U
from rowsmith.plans.registry import query
from rowsmith.plans.runs import RunLog
from rowsmith.plans.step_cache import StepCache, search_cached
from rowsmith.session import scratch_path
from rowsmith.sources.tables import table


def guesses(spark, sf):
    """Predictions by formula: price from a shifted price."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("y"),
        (F.col("o_totalprice") * 0.9 + (F.col("o_custkey") * 37) % 20000).alias("p"))


GUESS = "(SELECT o_orderkey, o_orderpriority, o_totalprice AS y, o_totalprice * 0.9 + (o_custkey * 37) % 20000 AS p FROM orders)"


def classes(spark, sf):
    """Class predictions by formula: return flag from quantity and tax."""
    p = F.when(F.col("l_quantity") < 15, "A").when(F.col("l_tax") > 0.04, "N").otherwise("R")
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("y"), p.alias("p"))


CLASSES = "(SELECT l_returnflag AS y, CASE WHEN l_quantity < 15 THEN 'A' WHEN l_tax > 0.04 THEN 'N' ELSE 'R' END AS p FROM lineitem)"


@query("regression_metrics", f"""
    SELECT round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 8) AS r2, round(avg(abs(y - p)), 4) AS mae, round(avg(abs(y - p) / abs(y)), 8) AS mape,
      round(sqrt(avg(pow(y - p, 2))), 4) AS rmse FROM {GUESS}, (SELECT avg(o_totalprice) AS m FROM orders)""")
def regression_metrics(spark, sf):
    out = M.regression_metrics(guesses(spark, sf), "y", "p")
    return out.select(F.round("r2", 8).alias("r2"), F.round("mae", 4).alias("mae"), F.round("mape", 8).alias("mape"), F.round("rmse", 4).alias("rmse"))


@query("regression_metrics_groups", f"""
    SELECT o_orderpriority, round(1 - sum(pow(y - p, 2)) / (count(*) * var_pop(y)), 8) AS r2, round(avg(abs(y - p)), 4) AS mae FROM {GUESS} GROUP BY 1""")
def regression_metrics_groups(spark, sf):
    out = M.regression_metrics(guesses(spark, sf), "y", "p", ["o_orderpriority"])
    return out.select("o_orderpriority", F.round("r2", 8).alias("r2"), F.round("mae", 4).alias("mae"))


@query("median_absolute_error", f"SELECT round(median(abs(y - p)), 4) AS median_abs_error FROM {GUESS}")
def median_absolute_error(spark, sf):
    return M.median_absolute_error(guesses(spark, sf), "y", "p").withColumn("median_abs_error", F.round("median_abs_error", 4))


@query("log_error_score", f"""
    SELECT round(median(abs(ln(y) - ln(p))), 8) AS median_abs_error, round(1 - median(abs(ln(y) - ln(p))), 8) AS one_minus_error FROM {GUESS}""")
def log_error_score(spark, sf):
    out = M.log_error_score(guesses(spark, sf), "y", "p")
    return out.withColumns({c: F.round(c, 8) for c in ("median_abs_error", "one_minus_error")})


@query("accuracy", f"SELECT round(avg((y = p)::INT), 8) AS accuracy FROM {CLASSES}")
def accuracy(spark, sf):
    return M.accuracy(classes(spark, sf), "y", "p").withColumn("accuracy", F.round("accuracy", 8))


@query("balanced_accuracy", f"""
    SELECT round(avg(r), 8) AS balanced_accuracy FROM (SELECT y, avg((y = p)::INT) AS r FROM {CLASSES} GROUP BY 1)""")
def balanced_accuracy(spark, sf):
    return M.balanced_accuracy(classes(spark, sf), "y", "p").withColumn("balanced_accuracy", F.round("balanced_accuracy", 8))


@query("f1_binary", """
    WITH g AS (SELECT quality AS y, (n_chars > 800)::INT AS p FROM documents JOIN labels USING (doc_id))
    SELECT round(2 * sum(y * p) / (sum(y) + sum(p)), 8) AS f1 FROM g""")
def f1_binary(spark, sf):
    df = doc_features(spark, sf).select(F.col("quality").alias("y"), (F.col("chars") > 800).cast("int").alias("p"))
    return M.f1_binary(df, "y", "p").withColumn("f1", F.round("f1", 8))


@query("confusion_matrix", f"""
    SELECT y, count(*) FILTER (WHERE p = 'A') AS "A", count(*) FILTER (WHERE p = 'N') AS "N", count(*) FILTER (WHERE p = 'R') AS "R" FROM {CLASSES} GROUP BY 1""")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(classes(spark, sf), "y", "p", ["A", "N", "R"])


@query("classification_report", f"""
    WITH k AS (SELECT c, count(*) FILTER (WHERE y = c) AS support, count(*) FILTER (WHERE p = c) AS guessed, count(*) FILTER (WHERE y = c AND p = c) AS hit
        FROM {CLASSES}, (VALUES ('A'), ('N'), ('R')) v(c) GROUP BY 1),
    s AS (SELECT c, support, hit, coalesce(hit / nullif(guessed, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall FROM k),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM s)
    SELECT c AS label, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM f
    UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 8), round(sum(hit) / sum(support), 8), round(sum(hit) / sum(support), 8), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8),
      round(sum(f1 * support) / sum(support), 8), sum(support)::BIGINT FROM f""")
def classification_report(spark, sf):
    out = M.classification_report(classes(spark, sf), "y", "p")
    return out.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


MISSING = """(SELECT CASE WHEN l_orderkey % 9 <> 0 THEN l_returnflag END AS y,
    CASE WHEN l_partkey % 11 <> 0 THEN CASE WHEN l_quantity < 15 THEN 'A' WHEN l_tax > 0.04 THEN 'N' ELSE 'R' END END AS p FROM lineitem)"""


@query("balanced_accuracy_missing", f"""
    SELECT round(avg(r), 8) AS balanced_accuracy FROM (
      SELECT y, avg((y = p)::INT) AS r FROM {MISSING} WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1)""")
def balanced_accuracy_missing(spark, sf):
    """Rows without a truth or without a prediction take no part."""
    p = F.when(F.col("l_quantity") < 15, "A").when(F.col("l_tax") > 0.04, "N").otherwise("R")
    df = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 9 != 0, F.col("l_returnflag")).alias("y"), F.when(F.col("l_partkey") % 11 != 0, p).alias("p"))
    return M.balanced_accuracy(df, "y", "p").withColumn("balanced_accuracy", F.round("balanced_accuracy", 8))


@query("regression_metrics_missing", f"""
    WITH g AS (SELECT y, p FROM {GUESS} WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0)
    SELECT round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 8) AS r2, round(avg(abs(y - p)), 4) AS mae FROM g, (SELECT avg(y) AS m FROM g)""")
def regression_metrics_missing(spark, sf):
    df = guesses(spark, sf).select(F.when(F.col("o_orderkey") % 7 != 0, F.col("y")).alias("y"), F.when(F.col("o_orderkey") % 5 != 0, F.col("p")).alias("p"))
    return M.regression_metrics(df, "y", "p").select(F.round("r2", 8).alias("r2"), F.round("mae", 4).alias("mae"))


@query("leaderboard")
def leaderboard(spark, sf):
    df = doc_features(spark, sf)
    train, test = df.where("doc_id % 4 <> 0"), df.where("doc_id % 4 = 0")
    models = {
        "logistic": L.logistic(), "tree": T.decision_tree(depth=5), "bayes": B.GaussianBayes(inputCols=DOC_COLS),
        "neighbours": B.KnnClassifier(keyCol="doc_id", k=5), "forest": T.forest_classifier(),
    }
    return flows.leaderboard({n: scaled(m).fit(train) for n, m in models.items()}, test, "label")


def price_flow(trees: int = 100) -> flows.Flow:
    """Group ratio, imputation, out-of-fold target encoding, forest."""
    return flows.Flow([
        N.GroupRatio(keyCols=["brand", "kind"], inputCol="visible", outputCol="visible_ratio"),
        flows.ColumnSteps([
            (["size", "visible", "visible_ratio"], [N.MeanImputer()]),
            (["brand", "kind"], [C.ModeImputer()]),
        ]),
        C.CrossFitTargetEncoder(inputCols=["brand", "kind"], labelCol="price", keyCols=["id"]),
        flows.AssembleByType(exclude=["id", "price", "fold"]),
        T.forest_regressor("price", trees=trees),
    ])


def sales(spark, sf):
    """Parts with missing sizes and brands, and a visibility share whose zeros mean missing."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 6 != 0, F.col("p_size").cast("double")).alias("size"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand")).alias("brand"), F.col("p_type").alias("kind"),
        (F.col("p_partkey") % 17 / 100).alias("visible"), F.col("p_retailprice").alias("price"))


@query("fit_and_score_flow")
def fit_and_score_flow(spark, sf):
    """Fit the whole chain on the training part and score the rest."""
    df = sales(spark, sf)
    model = price_flow().fit(df.where("id % 5 <> 0"))
    return model.transform(df.where("id % 5 = 0")).select("id", "price", "prediction")


@query("cross_validation")
def cross_validation(spark, sf):
    scorer = RegressionEvaluator(labelCol="price", metricName="rmse")
    return flows.cross_val_score(price_flow(), sales(spark, sf), scorer, ["id"])


@query("cross_validation_line", f"""
    WITH k AS (SELECT p_size AS x, p_retailprice AS y, floor({U('p_partkey', 42)} * 5)::INT AS fold FROM part),
    m AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (SELECT DISTINCT fold FROM k) f JOIN k ON k.fold <> f.fold GROUP BY 1)
    SELECT fold, round(sqrt(avg(pow(y - a - b * x, 2))), 5) AS score FROM k JOIN m USING (fold) GROUP BY 1""")
def cross_validation_line(spark, sf):
    """The same over a straight line, whose fold errors follow from sums."""
    df = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"))
    out = flows.cross_val_score(L.least_squares(["x"], "y"), df, RegressionEvaluator(labelCol="y", metricName="rmse"), ["p_partkey"])
    return out.withColumn("score", F.round("score", 5))


def churn_flow(label: str = "label", k: int = 5, columns: int = 4, depth: int = 3, rounds: int = 100, **more) -> flows.Flow:
    """Target encoding, column choice, power transform, oversampling, binning, boosting."""
    cols = [*DOC_COLS, "lang", "source"]
    return flows.Flow([
        C.CrossFitTargetEncoder(inputCols=["lang", "source"], labelCol=label, keyCols=["doc_id"]),
        N.SelectBest(inputCols=cols, labelCol=label, k=columns),
        flows.PowerAndBalance(cols, label, k=k),
        flows.AssembleByType(exclude=["doc_id", label]),
        T.boosted_classifier(label, rounds=rounds, depth=depth, **more),
    ])


def churn(spark, sf):
    return doc_features(spark, sf).select("doc_id", "lang", "source", *DOC_COLS, "label")


@query("oversampled_flow")
def oversampled_flow(spark, sf):
    """The sampler acts while fitting only: every scored row comes back exactly once."""
    df = churn(spark, sf)
    model = churn_flow().fit(df.where("doc_id % 4 <> 0"))
    return model.transform(df.where("doc_id % 4 = 0")).select("doc_id", "label", "prediction")


# Rounds of the boosted model in the two searches below; a fit of the chain, and random_search, take 100.
SEARCH_ROUNDS = 10


@query("grid_search")
def grid_search(spark, sf):
    """Eight points, five folds, over the chain with its scaler."""
    df = doc_features(spark, sf).select("doc_id", "label", *DOC_COLS)
    grid = {"rate": [0.1, 0.3], "subsample": [0.75, 0.85], "features": ["sqrt", "log2"]}
    return flows.grid_search(lambda **p: scaled(T.boosted_classifier(rounds=SEARCH_ROUNDS, **p)), grid, df, flows.BalancedAccuracy(), ["doc_id"], stratify="label")


@query("search_with_stored_prefix")
def search_with_stored_prefix(spark, sf):
    """Grid over the last step only; the steps before it, sampler included, run once per fold."""
    points = flows.parameter_grid({"depth": [2, 4], "rate": [0.1, 0.3], "subsample": [0.75, 0.85]})
    return flows.search_last_step(
        churn_flow(), lambda **p: T.boosted_classifier(rounds=SEARCH_ROUNDS, **p), points, churn(spark, sf),
        flows.BalancedAccuracy(), ["doc_id"], stratify="label")


@query("search_with_step_cache", f"""
    WITH k AS (SELECT p_partkey AS id, p_brand AS brand, p_type AS kind, CASE WHEN p_partkey % 6 <> 0 THEN p_size::DOUBLE END AS x,
        p_retailprice AS y, floor({U('p_partkey', 42)} * 5)::INT AS fold FROM part),
    f AS (SELECT f.fold, id, k.fold = f.fold AS held, brand, kind, x, y FROM (SELECT DISTINCT fold FROM k) f CROSS JOIN k),
    c AS (
        SELECT 'brand' AS grp, *, coalesce(x, avg(x) FILTER (WHERE NOT held) OVER (PARTITION BY fold, brand)) AS full_x FROM f
        UNION ALL SELECT 'kind', *, coalesce(x, avg(x) FILTER (WHERE NOT held) OVER (PARTITION BY fold, kind)) FROM f),
    m AS (SELECT grp, fold, regr_slope(y, full_x) AS b, regr_intercept(y, full_x) AS a, sum(full_x * y) / sum(full_x * full_x) AS o
        FROM c WHERE NOT held GROUP BY ALL),
    e AS (SELECT grp, fold, true AS bias, sqrt(avg(pow(y - a - b * full_x, 2))) AS err FROM c JOIN m USING (grp, fold) WHERE held GROUP BY ALL
        UNION ALL SELECT grp, fold, false, sqrt(avg(pow(y - o * full_x, 2))) FROM c JOIN m USING (grp, fold) WHERE held GROUP BY ALL),
    n AS (SELECT count(*) AS prefix_fits FROM (SELECT DISTINCT grp, fold FROM e))
    SELECT grp AS group_column, bias, round(avg(err), 4) AS rmse, any_value(prefix_fits) AS prefix_fits FROM e, n GROUP BY ALL""")
def search_with_step_cache(spark, sf):
    """Grid over two steps, group imputation and line: each imputation is fitted once per fold, for all lines after it."""
    df = table(spark, sf, "part").select(
        "p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_retailprice").alias("y"),
        F.when(F.col("p_partkey") % 6 != 0, F.col("p_size").cast("double")).alias("x"))

    def chain(by: str, bias: bool) -> flows.Flow:
        line = L.least_squares(["x"], "y")
        line.getStages()[-1].setFitIntercept(bias)
        return flows.Flow([N.GroupMeanImputer(keyCols=[by], inputCol="x", outputCol="x"), line])

    cache = StepCache(spark, scratch_path(spark, "steps"))
    points = flows.parameter_grid({"by": ["brand", "kind"], "bias": [True, False]})
    found = search_cached(cache, chain, points, df, RegressionEvaluator(labelCol="y", metricName="rmse"), ["p_partkey"])
    fits = cache.entries().where("step = 'GroupMeanImputer'").agg(F.count("*").alias("prefix_fits"))
    point = F.from_json("params", "by string, bias boolean")
    return found.select(point["by"].alias("group_column"), point["bias"].alias("bias"), F.round("mean_score", 4).alias("rmse")).crossJoin(fits)


@query("random_search")
def random_search(spark, sf):
    """Ten draws, five folds, over settings of the whole churn chain, each fit with all rounds of its boosted model."""
    grid = {"columns": [3, 5, 7], "k": [3, 5], "depth": [2, 3, 5], "rate": [0.1, 0.3]}
    return flows.random_search(lambda **p: churn_flow(**p), grid, 10, churn(spark, sf), flows.BalancedAccuracy(), ["doc_id"], stratify="label")


@query("run_log")
def run_log(spark, sf):
    """Two runs logged and found again, best first."""
    df = doc_features(spark, sf)
    train, test = df.where("doc_id % 4 <> 0"), df.where("doc_id % 4 = 0")
    log = RunLog(spark, scratch_path(spark, "runs"))
    for depth in (2, 5):
        model = scaled(T.decision_tree(depth=depth)).fit(train)
        score = flows.BalancedAccuracy().evaluate(model.transform(test))
        log.log("documents", f"tree-{depth}", {"depth": depth}, {"balanced_accuracy": score}, {"kind": "tree"}, model=model,
                sample=train.select("doc_id", *DOC_COLS), registered="document-tree")
    return log.search("documents", "balanced_accuracy").select(
        "experiment", "name", F.element_at("metrics", "balanced_accuracy").alias("score"), F.element_at("params", "depth").alias("depth"))
