"""Models: regression, classification, neighbours, ensembles, clusters."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowsmith.features import numeric as N
from rowsmith.models import cluster as K
from rowsmith.models import ensemble as E
from rowsmith.models import linear as L
from rowsmith.models import simple as B
from rowsmith.models import trees as T
from rowsmith.operators import neighbours as NN
from rowsmith.operators import resample as R
from rowsmith.operators.metrics import regression_exprs
from rowsmith.plans import flows
from rowsmith.plans.q_features import DOC_COLS, DOCS, doc_features, doc_numbers, embedded
from rowsmith.plans.registry import query
from rowsmith.sources.tables import table


def scaled(model) -> flows.Flow:
    """A chain that scales the document columns by its training rows and fits ``model`` on their vector."""
    return flows.Flow([N.ZScaler(inputCols=DOC_COLS), VectorAssembler(inputCols=DOC_COLS, outputCol="features"), model])


def scaled_docs(spark, sf):
    """Labelled documents with scaled columns and a feature vector, for fits that split nothing off."""
    df = doc_features(spark, sf)
    return N.assemble(N.ZScaler(inputCols=DOC_COLS).fit(df).transform(df), DOC_COLS)


def _scored(df, key="doc_id"):
    return df.select(key, "label", "prediction", F.round(F.get(vector_to_array("probability"), 1), 6).alias("p1"))


@query("regression_line", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
      round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem""")
def regression_line(spark, sf):
    out = L.simple_regression(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


@query("regression_line_groups", """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
      count(*) AS n FROM lineitem GROUP BY 1""")
def regression_line_groups(spark, sf):
    out = L.simple_regression(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), "n")


@query("regression_parabola_groups", """
    WITH r AS (SELECT l_returnflag, l_quantity AS x, l_quantity * l_quantity AS x2, l_extendedprice AS y FROM lineitem),
    s AS (SELECT l_returnflag, regr_slope(x2, x) AS b, regr_intercept(x2, x) AS a, regr_slope(y, x) AS yb, avg(x) AS mx, avg(x2) AS mx2, avg(y) AS my,
        count(*) AS n FROM r GROUP BY 1),
    q AS (SELECT l_returnflag, regr_slope(y, x2 - a - b * x) AS c2 FROM r JOIN s USING (l_returnflag) GROUP BY 1)
    SELECT l_returnflag, n, round(c2, 4) AS c2, round(yb - c2 * b, 3) AS c1, round(my - (yb - c2 * b) * mx - c2 * mx2, 2) AS c0 FROM s JOIN q USING (l_returnflag)""")
def regression_parabola_groups(spark, sf):
    out = L.quadratic_regression(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", "n", F.round("c2", 4).alias("c2"), F.round("c1", 3).alias("c1"), F.round("c0", 2).alias("c0"))


@query("least_squares_coefficients", """
    WITH s AS (SELECT covar_pop(l_quantity, l_quantity) AS aa, covar_pop(l_tax, l_tax) AS bb, covar_pop(l_quantity, l_tax) AS ab,
        covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_tax, l_extendedprice) AS ty, avg(l_quantity) AS ma, avg(l_tax) AS mb, avg(l_extendedprice) AS my FROM lineitem),
    c AS (SELECT (ay * bb - ty * ab) / (aa * bb - ab * ab) AS p, (ty * aa - ay * ab) / (aa * bb - ab * ab) AS q, ma, mb, my FROM s)
    SELECT 'l_quantity' AS "column", round(p, 3) AS coefficient FROM c UNION ALL SELECT 'l_tax', round(q, 3) FROM c
    UNION ALL SELECT 'intercept', round(my - p * ma - q * mb, 3) FROM c""")
def least_squares_coefficients(spark, sf):
    cols = ["l_quantity", "l_tax"]
    model = L.least_squares(cols, "l_extendedprice").fit(table(spark, sf, "lineitem"))
    return L.coefficient_table(spark, model.stages[-1], cols).withColumn("coefficient", F.round("coefficient", 3))


@query("polynomial_regression")
def polynomial_regression(spark, sf):
    """Least squares on degree-2 features of scaled columns, clipped to the training range."""
    from rowsmith.operators.clean import clip_to_fitted

    cols = ["l_quantity", "l_discount", "l_tax"]
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", *cols, "l_extendedprice")
    train, test = df.where("l_orderkey % 5 > 0"), df.where("l_orderkey % 5 = 0")
    scaler = N.ZScaler(inputCols=cols).fit(train)
    step = N.PolynomialColumns(inputCols=cols, bias=False)
    model = L.least_squares(step.output_names(), "l_extendedprice").fit(step.transform(scaler.transform(train)))
    out = model.transform(step.transform(scaler.transform(test)))
    return clip_to_fitted(out, train, "prediction", "l_extendedprice", "clipped").select("l_orderkey", "l_partkey", "l_extendedprice", "clipped")


@query("logistic_regression")
def logistic_regression(spark, sf):
    df = R.balanced_weights(scaled_docs(spark, sf), "label")
    return _scored(L.logistic(weight="weight").fit(df).transform(df))


@query("logistic_log_odds", """
    WITH c AS (SELECT l_linenumber < 3 AS x, sum((l_returnflag = 'R')::INT) AS a, sum((l_returnflag <> 'R')::INT) AS b FROM lineitem GROUP BY 1)
    SELECT 'intercept' AS "column", round(ln(a / b), 3) AS coefficient FROM c WHERE NOT x
    UNION ALL SELECT 'early', round(ln(a / b) - (SELECT ln(a / b) FROM c WHERE NOT x), 3) FROM c WHERE x""")
def logistic_log_odds(spark, sf):
    """Without a penalty, one yes/no column gives the log odds of its two groups."""
    df = table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") < 3).cast("double").alias("early"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    model = L.logistic(C=0.0).fit(N.assemble(df, ["early"]))
    return L.coefficient_table(spark, model, ["early"]).withColumn("coefficient", F.round("coefficient", 3))


STEPS = "(SELECT l_linenumber::DOUBLE AS x, (l_linenumber * 10 + l_quantity > 60)::INT AS y FROM lineitem)"


@query("tree_stump", f"""
    WITH d AS {STEPS}, v AS (SELECT DISTINCT x FROM d), e AS (SELECT x AS lo, lead(x) OVER (ORDER BY x) AS hi FROM v),
    t AS (SELECT (lo + hi) / 2 AS cut FROM e WHERE hi IS NOT NULL),
    s AS (SELECT cut, x <= cut AS lower, count(*) AS n, avg(y) AS p FROM d, t GROUP BY ALL),
    g AS (SELECT cut, sum(n * 2 * p * (1 - p)) AS bad FROM s GROUP BY 1),
    b AS (SELECT cut FROM g ORDER BY bad, cut LIMIT 1)
    SELECT 1 AS depth, NULL AS threshold, (p > 0.5)::DOUBLE AS prediction, round(2 * p * (1 - p), 8) AS impurity FROM s JOIN b USING (cut)
    UNION ALL SELECT 0, cut, (avg(y) > 0.5)::DOUBLE, round(2 * avg(y) * (1 - avg(y)), 8) FROM d, b GROUP BY cut""")
def tree_stump(spark, sf):
    """The rules of a tree of one split: the threshold with the least Gini impurity."""
    df = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("double").alias("x"), (F.col("l_linenumber") * 10 + F.col("l_quantity") > 60).cast("double").alias("label"))
    rules = T.tree_rules(spark, T.decision_tree(depth=1).fit(N.assemble(df, ["x"])), ["x"])
    return rules.select("depth", "threshold", "prediction", F.round("impurity", 8).alias("impurity"))


@query("decision_tree")
def decision_tree(spark, sf):
    df = scaled_docs(spark, sf)
    return _scored(T.decision_tree(depth=5).fit(df).transform(df))


@query("decision_tree_rules")
def decision_tree_rules(spark, sf):
    return T.tree_rules(spark, T.decision_tree(depth=5).fit(scaled_docs(spark, sf)), DOC_COLS)


@query("feature_importance")
def feature_importance(spark, sf):
    return T.importance_table(spark, T.forest_classifier().fit(scaled_docs(spark, sf)), DOC_COLS)


@query("forest_classifier")
def forest_classifier(spark, sf):
    df = embedded(spark, sf)
    return T.forest_classifier(trees=100).fit(df).transform(df).select("vec_id", "label", "prediction")


@query("forest_regressor")
def forest_regressor(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size", F.length("p_name").alias("name"), F.length("p_type").alias("type"))
    df = N.assemble(df, ["p_size", "name", "type"])
    return T.forest_regressor("p_retailprice").fit(df).transform(df).select("p_partkey", "p_retailprice", "prediction")


@query("boosted_classifier")
def boosted_classifier(spark, sf):
    df = scaled_docs(spark, sf)
    return _scored(T.boosted_classifier(rate=0.3, subsample=0.75, features="sqrt").fit(df).transform(df))


@query("boosted_regressor")
def boosted_regressor(spark, sf):
    df = N.assemble(table(spark, sf, "orders").withColumn("month", F.month("o_orderdate")).withColumn("year", F.year("o_orderdate")),
                    ["o_custkey", "month", "year"])
    out = T.boosted_regressor("o_totalprice", subsample=0.85, features="sqrt").fit(df).transform(df)
    return out.select("o_orderkey", "o_totalprice", "prediction")


@query("boosted_stump", """
    WITH d AS (SELECT l_linenumber AS x, l_linenumber * 10 + l_quantity AS y FROM lineitem),
    c AS (SELECT DISTINCT x AS cut FROM d), s AS (SELECT cut, x <= cut AS lower, count(*) * var_pop(y) AS bad, avg(y) AS m FROM d, c GROUP BY ALL),
    b AS (SELECT cut FROM s GROUP BY 1 HAVING count(*) = 2 ORDER BY sum(bad) LIMIT 1)
    SELECT DISTINCT x::DOUBLE AS x, round(m, 6) AS prediction FROM d, s JOIN b USING (cut) WHERE (x <= cut) = lower""")
def boosted_stump(spark, sf):
    """One round of one split: the two sides with the least squared error, each with its mean."""
    df = table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("double").alias("x"), (F.col("l_linenumber") * 10 + F.col("l_quantity")).alias("y"))
    rows = N.assemble(df, ["x"])
    out = T.boosted_regressor("y", rounds=1, depth=1).fit(rows).transform(rows)
    return out.select("x", F.round("prediction", 6).alias("prediction")).distinct()


@query("adaboost")
def adaboost(spark, sf):
    df = scaled_docs(spark, sf)
    return _scored(T.AdaBoost(rounds=50).fit(df).transform(df))


FLAGS = """
    base AS (SELECT CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END::DOUBLE AS label,
        [(l_shipdate::DATE - DATE '1992-01-01')::DOUBLE, l_quantity::DOUBLE, l_extendedprice::DOUBLE] AS x FROM lineitem),
    edges AS (SELECT f, unnest(list_distinct(quantile_cont(x[f + 1], [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]))) AS e
              FROM base, range(3) r(f) GROUP BY f)"""


def _boost_round(i, weight):
    """The best split of one round: weights by (column, edge, class), impurity, leaves, error."""
    return f"""
    w{i} AS (SELECT label, x, {weight} AS w FROM base),
    h{i} AS (SELECT f, e, label, sum(w) AS t, coalesce(sum(w) FILTER (x[f + 1] <= e), 0) AS l FROM w{i}, edges GROUP BY f, e, label),
    g{i} AS (SELECT f, e, sum(l * l) / sum(l) + sum((t - l) * (t - l)) / sum(t - l) AS score, arg_max(label, l) AS lft, arg_max(label, t - l) AS rgt,
             1 - (max(l) + max(t - l)) / sum(t) AS err FROM h{i} GROUP BY f, e HAVING sum(l) > 0 AND sum(t - l) > 0),
    s{i} AS (SELECT *, ln((1 - err) / err) + ln(2) AS alpha FROM g{i} ORDER BY score DESC, f, e LIMIT 1)"""


MISS_1 = "exp((SELECT alpha FROM s1) * (CASE WHEN x[(SELECT f FROM s1) + 1] <= (SELECT e FROM s1) THEN (SELECT lft FROM s1) ELSE (SELECT rgt FROM s1) END <> label)::INT)"


@query("adaboost_two_rounds", f"""
    WITH {FLAGS}, {_boost_round(1, "1.0")}, {_boost_round(2, MISS_1)},
    s AS (SELECT 1 AS round, * FROM s1 UNION ALL SELECT 2, * FROM s2)
    SELECT round, f::INT AS feature, round(e, 6) AS threshold, lft AS left_class, rgt AS right_class, round(alpha, 8) AS alpha FROM s""")
def adaboost_two_rounds(spark, sf):
    """Two rounds over three classes of lineitem rows: the splits, their leaves and votes."""
    rows = table(spark, sf, "lineitem").select(
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double").alias("day"),
        F.col("l_quantity").cast("double").alias("quantity"), F.col("l_extendedprice").cast("double").alias("price"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("label"))
    rows = VectorAssembler(inputCols=["day", "quantity", "price"], outputCol="features").transform(rows)
    stumps = T.AdaBoost(rounds=2, bins=8).fit(rows).state["stumps"]
    out = [(i + 1, s["feature"], round(s["threshold"], 6), s["left"], s["right"], round(s["alpha"], 8)) for i, s in enumerate(stumps)]
    return spark.createDataFrame(out, "round int, feature int, threshold double, left_class double, right_class double, alpha double")


NEAR = """
    e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    d AS (SELECT a.vec_id AS query_key, b.vec_id AS ref_key, b.label, list_distance(a.v, b.v) AS distance FROM e a JOIN e b ON a.vec_id <> b.vec_id),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY distance, ref_key) AS rank FROM d QUALIFY rank <= {k})"""


@query("nearest_neighbours", f"WITH {NEAR.format(k=7)} SELECT query_key, ref_key, round(distance, 6) AS distance, rank::INT AS rank FROM n")
def nearest_neighbours(spark, sf):
    """The seven nearest other vectors of every vector; small blocks, so that many cells take part."""
    df = table(spark, sf, "embeddings")
    return NN.nearest(df, df, "vec_id", "embedding", 7, exclude_self=True, ref_rows=128, query_rows=256).withColumn("distance", F.round("distance", 6))


TRAIN_TEST = """
    e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    n AS (SELECT a.vec_id AS q, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS r
          FROM e a JOIN e b ON a.vec_id % 4 = 0 AND b.vec_id % 4 <> 0 QUALIFY r <= {k})"""


def _train_test(spark, sf):
    df = embedded(spark, sf)
    return df.where("vec_id % 4 <> 0"), df.where("vec_id % 4 = 0")


@query("knn_classifier", f"""
    WITH {TRAIN_TEST.format(k=7)}, c AS (SELECT q, label, count(*) AS n FROM n GROUP BY ALL)
    SELECT q AS vec_id, label::DOUBLE AS prediction, round(n / 7.0, 6) AS probability FROM c
    QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC, label) = 1""")
def knn_classifier(spark, sf):
    train, test = _train_test(spark, sf)
    out = B.KnnClassifier(keyCol="vec_id", k=7).fit(train).transform(test)
    return out.select("vec_id", "prediction", F.round(F.array_max(vector_to_array("probability")), 6).alias("probability"))


@query("knn_regressor", f"""
    WITH {TRAIN_TEST.format(k=8)} SELECT q AS vec_id, round(avg(label), 6) AS prediction FROM n GROUP BY 1""")
def knn_regressor(spark, sf):
    train, test = _train_test(spark, sf)
    out = B.KnnRegressor(keyCol="vec_id", k=8).fit(train).transform(test)
    return out.select("vec_id", F.round("prediction", 6).alias("prediction"))


@query("knn_sweep", f"""
    WITH {TRAIN_TEST.format(k=20)}, p AS (SELECT q, r AS k, avg(label) OVER (PARTITION BY q ORDER BY r) AS pred FROM n),
    t AS (SELECT k, label + 1 AS y, pred + 1 AS pred FROM p JOIN e ON e.vec_id = q)
    SELECT k::INT AS k, round(avg(abs(y - pred)), 6) AS mae, round(avg(abs(y - pred) / greatest(abs(y), 2.220446049250313e-16)), 6) AS mape,
      round(1 - sum(pow(y - pred, 2)) / (count(*) * var_pop(y)), 6) AS r2 FROM t GROUP BY 1""")
def knn_sweep(spark, sf):
    """Error for every k from 1 to 20 out of one neighbour search (targets shifted by one to avoid zero)."""
    train, test = _train_test(spark, sf)
    all_k = B.KnnRegressor(keyCol="vec_id").fit(train).predict_all_k(test, 20)
    both = all_k.join(test.select("vec_id", "label"), "vec_id").select("k", (F.col("label") + 1).alias("y"), (F.col("prediction") + 1).alias("p"))
    m = regression_exprs("y", "p")
    return both.groupBy("k").agg(*[F.round(m[n], 6).alias(n) for n in ("mae", "mape", "r2")])


@query("gaussian_bayes", f"""
    WITH s AS (SELECT quality, count(*) AS n, {", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in DOC_COLS)} FROM {DOCS} GROUP BY 1),
    w AS (SELECT 1e-9 * greatest({", ".join(f"var_pop({c})" for c in DOC_COLS)}) AS eps FROM {DOCS}),
    p AS (SELECT d.doc_id, d.quality AS truth, s.quality AS cls, ln(n / (SELECT sum(n) FROM s))
        {" ".join(f"- 0.5 * (ln(2 * pi() * (v_{c} + eps)) + pow({c} - m_{c}, 2) / (v_{c} + eps))" for c in DOC_COLS)} AS score FROM {DOCS} d, s, w)
    SELECT doc_id, cls::DOUBLE AS prediction FROM p QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, cls) = 1""")
def gaussian_bayes(spark, sf):
    df = doc_features(spark, sf)
    return B.GaussianBayes(inputCols=DOC_COLS).fit(df).transform(df).select("doc_id", "prediction")


@query("margin_classifier")
def margin_classifier(spark, sf):
    """Polynomial margin model with calibrated probabilities."""
    df = scaled_docs(spark, sf)
    return _scored(L.PolynomialMargin(keyCols=["doc_id"], degree=3).fit(df).transform(df))


@query("bagging")
def bagging(spark, sf):
    df = scaled_docs(spark, sf)
    bag = E.Bagging(B.KnnClassifier(featuresCol="__f", keyCol="doc_id", k=5), inputCols=DOC_COLS, keyCol="doc_id", count=10)
    return _scored(bag.fit(df).transform(df))


def _members():
    return [L.logistic(), B.KnnClassifier(keyCol="doc_id", k=5), B.GaussianBayes(inputCols=DOC_COLS)]


@query("soft_vote")
def soft_vote(spark, sf):
    df = scaled_docs(spark, sf)
    return _scored(E.SoftVote(_members()).fit(df).transform(df))


def _bayes_sql(name, cols):
    """Posterior of quality 1 by Gaussian Bayes over some document columns."""
    return f"""
    {name}s AS (SELECT quality, count(*) AS n, {", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in cols)} FROM {DOCS} GROUP BY 1),
    {name}w AS (SELECT 1e-9 * greatest({", ".join(f"var_pop({c})" for c in cols)}) AS eps FROM {DOCS}),
    {name}p AS (SELECT d.doc_id, s.quality AS cls, ln(n) {" ".join(f"- 0.5 * (ln(2 * pi() * (v_{c} + eps)) + pow({c} - m_{c}, 2) / (v_{c} + eps))" for c in cols)} AS score
        FROM {DOCS} d, {name}s s, {name}w),
    {name} AS (SELECT a.doc_id, 1 / (1 + exp(b.score - a.score)) AS p FROM {name}p a JOIN {name}p b ON a.doc_id = b.doc_id AND a.cls = 1 AND b.cls = 0)"""


@query("soft_vote_bayes", f"""
    WITH {_bayes_sql("x", DOC_COLS[:2])}, {_bayes_sql("y", DOC_COLS[2:])}
    SELECT x.doc_id, round((x.p + y.p) / 2, 6) AS p1 FROM x JOIN y ON x.doc_id = y.doc_id""")
def soft_vote_bayes(spark, sf):
    """The vote of two members is the mean of their probabilities."""
    df = doc_features(spark, sf)
    members = [B.GaussianBayes(inputCols=DOC_COLS[:2]), B.GaussianBayes(inputCols=DOC_COLS[2:])]
    return _scored(E.SoftVote(members).fit(df).transform(df)).select("doc_id", "p1")


@query("stacking")
def stacking(spark, sf):
    df = scaled_docs(spark, sf)
    final = T.boosted_classifier().setFeaturesCol("__stack")
    return _scored(E.Stacking(_members(), final, keyCol="doc_id").fit(df).transform(df))


@query("kmeans")
def kmeans(spark, sf):
    df = embedded(spark, sf)
    return K.kmeans(6).fit(df).transform(df).select("vec_id", "cluster")


@query("assign_to_centres", """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    c AS (SELECT label AS i, v FROM e QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1)
    SELECT vec_id, c.i::INT AS cluster FROM e, c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(e.v, c.v), c.i) = 1""")
def assign_to_centres(spark, sf):
    """One assignment step: the first vector of each label serves as centre."""
    df = embedded(spark, sf)
    first = df.groupBy("label").agg(F.min_by("vec", "vec_id").alias("vec")).orderBy("label").collect()
    return df.select("vec_id", K.nearest_centre(F.col("vec"), [r["vec"] for r in first]).alias("cluster"))


@query("elbow_scan")
def elbow_scan(spark, sf):
    return K.elbow_scan(embedded(spark, sf), range(2, 10))


@query("ward_clusters")
def ward_clusters(spark, sf):
    df = embedded(spark, sf)
    return K.WardTree(micro=100).fit(df).assign(df, 6).select("vec_id", "cluster")


@query("ward_linkage")
def ward_linkage(spark, sf):
    return K.WardTree(micro=100).fit(embedded(spark, sf)).linkage(spark)


@query("cluster_profile", """
    SELECT l_linenumber % 4 AS cluster, median(l_quantity) AS l_quantity_median, round(median(l_extendedprice), 4) AS l_extendedprice_median,
      count(*) AS size FROM lineitem GROUP BY 1""")
def cluster_profile(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("cluster", F.col("l_linenumber") % 4)
    out = K.cluster_profile(df, "cluster", ["l_quantity", "l_extendedprice"])
    return out.withColumn("l_extendedprice_median", F.round("l_extendedprice_median", 4))


@query("batch_score")
def batch_score(spark, sf):
    """A chain fitted on the labelled documents applied to all that have no label."""
    model = scaled(L.logistic()).fit(doc_features(spark, sf))
    unlabelled = doc_numbers(spark, sf).join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")
    return flows.score(model, unlabelled, ["doc_id"])


@query("batch_score_line", """
    WITH m AS (SELECT regr_slope(quality, n_chars) AS b, regr_intercept(quality, n_chars) AS a FROM documents JOIN labels USING (doc_id))
    SELECT doc_id, round(a + b * n_chars, 6) AS prediction FROM documents, m WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def batch_score_line(spark, sf):
    """Scoring with a straight line: every document without a label gets its number."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    model = L.least_squares(["n_chars"], "quality").fit(docs.join(labels, "doc_id"))
    out = flows.score(model, docs.join(labels, "doc_id", "left_anti"), ["doc_id"])
    return out.withColumn("prediction", F.round("prediction", 6))
