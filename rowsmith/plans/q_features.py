"""Fitted transformers, splits and resampling."""

from __future__ import annotations

import math

from pyspark.ml.feature import HashingTF, OneHotEncoder, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowsmith.features import category as C
from rowsmith.features import numeric as N
from rowsmith.features.wide import WideAxes
from rowsmith.functions import scalar as S
from rowsmith.operators import resample as R
from rowsmith.plans.flows import ColumnSteps, Flow
from rowsmith.plans.q_clean import HOLED, holed_lineitem
from rowsmith.plans.q_relate import U
from rowsmith.plans.registry import query
from rowsmith.session import materialise
from rowsmith.sources.tables import table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def U4(seed: int) -> str:
    """SQL text of the uniform number keyed by the four lineitem keys."""
    keys = ", ".join(LINE_KEY)
    return f"(('0x' || substr(md5(concat_ws(':', {keys}, '{seed}')), 1, 8))::BIGINT / 4294967296.0)"


def doc_numbers(spark, sf):
    """All documents with numbers measured on their whole text."""
    return table(spark, sf, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("chars"),
        (S.count_chars("text", " ") + 1).cast("double").alias("words"), S.count_chars("text", "\n").cast("double").alias("lines"),
        S.count_chars("text", "0123456789").cast("double").alias("digits"), S.count_chars("text", ".,;:!?").cast("double").alias("marks"))


def doc_features(spark, sf):
    """The labelled ones of them, stored once for the fits that follow."""
    labelled = doc_numbers(spark, sf).join(table(spark, sf, "labels"), "doc_id").withColumn("label", F.col("quality").cast("double"))
    return materialise(labelled, "documents")


DOC_COLS = ["chars", "words", "lines", "digits", "marks"]
DOCS = r"""(SELECT d.doc_id, lang, source, n_chars::DOUBLE AS chars, len(string_split(text, ' '))::DOUBLE AS words,
    (len(string_split(text, chr(10))) - 1)::DOUBLE AS lines, length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE AS digits,
    length(regexp_replace(text, '[^.,;:!?]', '', 'g'))::DOUBLE AS marks, quality, toxic
    FROM documents d JOIN labels USING (doc_id))"""


@query("impute_mean", f"""
    WITH h AS (SELECT *, l_orderkey % 10 < 8 AS train FROM {HOLED}),
    m AS (SELECT avg(l_discount) AS d, avg(l_tax) AS t FROM h WHERE train)
    SELECT l_returnflag, round(avg(coalesce(l_discount, d)), 6) AS discount, round(avg(coalesce(l_tax, t)), 6) AS tax,
      count(coalesce(l_discount, d)) AS n FROM h, m WHERE NOT train GROUP BY 1""")
def impute_mean(spark, sf):
    """Means learned on the training rows fill the test rows."""
    df = holed_lineitem(spark, sf)
    train, test = df.where("l_orderkey % 10 < 8"), df.where("l_orderkey % 10 >= 8")
    filled = N.MeanImputer(inputCols=["l_discount", "l_tax"]).fit(train).transform(test)
    return filled.groupBy("l_returnflag").agg(
        F.round(F.avg("l_discount"), 6).alias("discount"), F.round(F.avg("l_tax"), 6).alias("tax"), F.count("l_discount").alias("n"))


@query("impute_most_frequent", """
    WITH h AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS p_type,
        CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS p_brand FROM part),
    t AS (SELECT p_type AS tm FROM h WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    b AS (SELECT p_brand AS bm FROM h WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT p_partkey, coalesce(p_type, tm) AS p_type, coalesce(p_brand, bm) AS p_brand FROM h, t, b""")
def impute_most_frequent(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("p_type"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("p_brand"))
    return C.ModeImputer(inputCols=["p_type", "p_brand"]).fit(df).transform(df)


@query("impute_group_mean", """
    WITH h AS (SELECT *, nullif(l_discount, 0) AS d FROM lineitem),
    f AS (SELECT l_returnflag, l_linestatus, coalesce(d, avg(d) OVER (PARTITION BY l_returnflag, l_linestatus)) AS d FROM h)
    SELECT l_returnflag, l_linestatus, count(d) AS n, round(avg(d), 6) AS mean, round(stddev_samp(d), 6) AS std FROM f GROUP BY ALL""")
def impute_group_mean(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", S.null_if("l_discount", 0.0).alias("d"))
    filled = N.GroupMeanImputer(keyCols=["l_returnflag", "l_linestatus"], inputCol="d").fit(df).transform(df)
    return filled.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("d").alias("n"), F.round(F.avg("d"), 6).alias("mean"), F.round(F.stddev_samp("d"), 6).alias("std"))


@query("standard_scale", """
    WITH s AS (SELECT avg(o_totalprice) AS pm, stddev_pop(o_totalprice) AS ps, avg(o_custkey) AS cm, stddev_pop(o_custkey) AS cs FROM orders)
    SELECT o_orderkey, round((o_totalprice - pm) / ps, 6) AS o_totalprice, round((o_custkey - cm) / cs, 6) AS o_custkey FROM orders, s""")
def standard_scale(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    out = N.ZScaler(inputCols=["o_totalprice", "o_custkey"]).fit(df).transform(df)
    return out.withColumns({c: F.round(c, 6) for c in ("o_totalprice", "o_custkey")})


@query("one_hot", """
    SELECT l_linenumber, sum((l_returnflag = 'A')::INT)::BIGINT AS "l_returnflag_A", sum((l_returnflag = 'N')::INT)::BIGINT AS "l_returnflag_N",
      sum((l_returnflag = 'R')::INT)::BIGINT AS "l_returnflag_R", sum((l_linestatus = 'O')::INT)::BIGINT AS "l_linestatus_O" FROM lineitem GROUP BY 1""")
def one_hot(spark, sf):
    df = table(spark, sf, "lineitem").select("l_linenumber", "l_returnflag", "l_linestatus")
    wide = C.OneHotColumns(inputCols=["l_returnflag", "l_linestatus"]).fit(df).transform(df)
    return wide.groupBy("l_linenumber").agg(*[F.sum(c).alias(c) for c in wide.columns if c != "l_linenumber"])


@query("sparse_block_stack", """
    SELECT o_orderkey, (1 + (SELECT count(DISTINCT o_orderpriority) + count(DISTINCT o_orderstatus) FROM orders))::INT AS width,
      round(o_totalprice + 2, 2) AS total FROM orders""")
def sparse_block_stack(spark, sf):
    """A numeric block and sparse indicator blocks side by side in one vector."""
    df = table(spark, sf, "orders")
    text = ["o_orderpriority", "o_orderstatus"]
    codes = StringIndexer(inputCols=text, outputCols=[f"{c}_i" for c in text], stringOrderType="alphabetAsc").fit(df).transform(df)
    hot = OneHotEncoder(inputCols=[f"{c}_i" for c in text], outputCols=[f"{c}_h" for c in text], dropLast=False).fit(codes).transform(codes)
    wide = VectorAssembler(inputCols=["o_totalprice", *[f"{c}_h" for c in text]], outputCol="v").transform(hot)
    arr = vector_to_array("v")
    return wide.select("o_orderkey", F.size(arr).alias("width"),
                       F.round(F.aggregate(arr, F.lit(0.0), lambda a, b: a + b), 2).alias("total"))


@query("polynomial_features", """
    SELECT l_returnflag, sum(1)::DOUBLE AS "1", round(sum(l_quantity), 4) AS l_quantity, round(sum(l_discount), 4) AS l_discount,
      round(sum(l_tax), 4) AS l_tax, round(sum(l_quantity * l_quantity), 4) AS "l_quantity^2", round(sum(l_quantity * l_discount), 4) AS "l_quantity l_discount",
      round(sum(l_quantity * l_tax), 4) AS "l_quantity l_tax", round(sum(l_discount * l_discount), 4) AS "l_discount^2",
      round(sum(l_discount * l_tax), 4) AS "l_discount l_tax", round(sum(l_tax * l_tax), 4) AS "l_tax^2" FROM lineitem GROUP BY 1""")
def polynomial_features(spark, sf):
    step = N.PolynomialColumns(inputCols=["l_quantity", "l_discount", "l_tax"])
    wide = step.transform(table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_tax"))
    return wide.groupBy("l_returnflag").agg(*[F.round(F.sum(f"`{c}`"), 4).alias(c) for c in step.output_names()])


@query("quantile_bins", """
    WITH e AS (SELECT quantile_cont(l_extendedprice, 0.2) AS a, quantile_cont(l_extendedprice, 0.4) AS b,
        quantile_cont(l_extendedprice, 0.6) AS c, quantile_cont(l_extendedprice, 0.8) AS d,
        quantile_cont(l_quantity, 0.2) AS qa, quantile_cont(l_quantity, 0.4) AS qb, quantile_cont(l_quantity, 0.6) AS qc,
        quantile_cont(l_quantity, 0.8) AS qd FROM lineitem)
    SELECT (l_extendedprice >= a)::INT + (l_extendedprice >= b)::INT + (l_extendedprice >= c)::INT + (l_extendedprice >= d)::INT AS l_extendedprice,
      (l_quantity >= qa)::INT + (l_quantity >= qb)::INT + (l_quantity >= qc)::INT + (l_quantity >= qd)::INT AS l_quantity, count(*) AS n
    FROM lineitem, e GROUP BY ALL""")
def quantile_bins(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    out = N.BinColumns(inputCols=["l_extendedprice", "l_quantity"], bins=5).fit(df).transform(df)
    return out.groupBy("l_extendedprice", "l_quantity").agg(F.count("*").alias("n"))


@query("uniform_bins_onehot", """
    WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) - min(o_totalprice) AS w FROM orders),
    b AS (SELECT o_orderstatus, (o_totalprice >= lo + w / 5)::INT + (o_totalprice >= lo + w * 2 / 5)::INT + (o_totalprice >= lo + w * 3 / 5)::INT
        + (o_totalprice >= lo + w * 4 / 5)::INT AS k FROM orders, e)
    SELECT o_orderstatus, sum((k = 0)::INT)::BIGINT AS o_totalprice_0, sum((k = 1)::INT)::BIGINT AS o_totalprice_1, sum((k = 2)::INT)::BIGINT AS o_totalprice_2,
      sum((k = 3)::INT)::BIGINT AS o_totalprice_3, sum((k = 4)::INT)::BIGINT AS o_totalprice_4 FROM b GROUP BY 1""")
def uniform_bins_onehot(spark, sf):
    df = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    wide = N.BinColumns(inputCols=["o_totalprice"], bins=5, strategy="uniform", encode="onehot").fit(df).transform(df)
    return wide.groupBy("o_orderstatus").agg(*[F.sum(c).alias(c) for c in wide.columns if c != "o_orderstatus"])


@query("target_encode_smoothed", """
    WITH k AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS brand, p_retailprice AS y, p_size < 25 AS train FROM part),
    p AS (SELECT avg(y) AS prior FROM k WHERE train),
    e AS (SELECT brand, avg(y) AS m, 1 / (1 + exp(-(count(*) - 20) / 10.0)) AS w FROM k WHERE train AND brand IS NOT NULL GROUP BY 1)
    SELECT p_partkey, round(coalesce(prior * (1 - w) + m * w, prior), 6) AS brand FROM p, k LEFT JOIN e ON k.brand = e.brand WHERE NOT train""")
def target_encode_smoothed(spark, sf):
    """Learned on small parts, applied to the large ones; some brands are missing."""
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("brand"), F.col("p_retailprice").alias("y"), "p_size")
    model = C.SmoothedTargetEncoder(inputCols=["brand"], labelCol="y").fit(df.where("p_size < 25"))
    return model.transform(df.where("p_size >= 25")).select("p_partkey", F.round("brand", 6).alias("brand"))


@query("target_encode_crossfit", f"""
    WITH k AS (SELECT p_partkey, p_brand, p_retailprice AS y, floor({U('p_partkey', 42)} * 5)::INT AS fold FROM part),
    o AS (SELECT f.fold, avg(y) AS m, var_pop(y) AS v FROM (SELECT DISTINCT fold FROM k) f JOIN k ON k.fold <> f.fold GROUP BY 1),
    c AS (SELECT f.fold, p_brand, count(*) AS n, avg(y) AS cm, var_pop(y) AS cv FROM (SELECT DISTINCT fold FROM k) f JOIN k ON k.fold <> f.fold GROUP BY ALL)
    SELECT p_partkey, round(coalesce(cm * (n * v / (n * v + cv)) + m * (1 - n * v / (n * v + cv)), m), 5) AS p_brand
    FROM k JOIN o USING (fold) LEFT JOIN c ON c.fold = k.fold AND c.p_brand = k.p_brand""")
def target_encode_crossfit(spark, sf):
    """Training rows encoded by the other folds."""
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    step = C.CrossFitTargetEncoder(inputCols=["p_brand"], labelCol="p_retailprice", keyCols=["p_partkey"])
    return step.fit_transform(df)[1].select("p_partkey", F.round("p_brand", 5).alias("p_brand"))


@query("target_encode_crossfit_in_branch", f"""
    WITH k AS (SELECT p_partkey, p_brand, p_retailprice AS y, floor({U('p_partkey', 42)} * 5)::INT AS fold FROM part),
    o AS (SELECT f.fold, avg(y) AS m, var_pop(y) AS v FROM (SELECT DISTINCT fold FROM k) f JOIN k ON k.fold <> f.fold GROUP BY 1),
    c AS (SELECT f.fold, p_brand, count(*) AS n, avg(y) AS cm, var_pop(y) AS cv FROM (SELECT DISTINCT fold FROM k) f JOIN k ON k.fold <> f.fold GROUP BY ALL)
    SELECT p_partkey, round(coalesce(cm * (n * v / (n * v + cv)) + m * (1 - n * v / (n * v + cv)), m), 5) AS p_brand
    FROM k JOIN o USING (fold) LEFT JOIN c ON c.fold = k.fold AND c.p_brand = k.p_brand""")
def target_encode_crossfit_in_branch(spark, sf):
    """The same encoder inside a branch of columns inside a chain: training rows never see their own target."""
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    step = C.CrossFitTargetEncoder(labelCol="p_retailprice", keyCols=["p_partkey"])
    rows = Flow([Flow([ColumnSteps([(["p_brand"], [step])])])]).fit_transform(df)[1]
    return rows.select("p_partkey", F.round("p_brand", 5).alias("p_brand"))


@query("target_encode_full", """
    WITH g AS (SELECT avg(p_retailprice) AS m, var_pop(p_retailprice) AS v FROM part WHERE p_size < 25),
    c AS (SELECT p_brand, count(*) AS n, avg(p_retailprice) AS cm, var_pop(p_retailprice) AS cv FROM part WHERE p_size < 25 GROUP BY 1)
    SELECT p_partkey, round(coalesce(cm * (n * v / (n * v + cv)) + m * (1 - n * v / (n * v + cv)), m), 5) AS p_brand
    FROM g, part LEFT JOIN c USING (p_brand) WHERE p_size >= 25""")
def target_encode_full(spark, sf):
    """New rows encoded by all training rows."""
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    step = C.CrossFitTargetEncoder(inputCols=["p_brand"], labelCol="p_retailprice", keyCols=["p_partkey"])
    model = step.fit(df.where("p_size < 25"))
    return model.transform(df.where("p_size >= 25")).select("p_partkey", F.round("p_brand", 5).alias("p_brand"))


@query("weight_of_evidence", """
    WITH t AS (SELECT sum(quality) AS p, count(*) - sum(quality) AS g FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT source, sum(quality) AS pos, count(*) - sum(quality) AS neg, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1)
    SELECT doc_id, round(CASE WHEN n IS NULL OR n = 1 THEN 0 ELSE ln(((pos + 1) / (p + 2)) / ((neg + 1) / (g + 2))) END, 6) AS source
    FROM t, documents LEFT JOIN c USING (source)""")
def weight_of_evidence(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    train = docs.join(table(spark, sf, "labels"), "doc_id")
    model = C.WoeEncoder(inputCols=["source"], labelCol="quality").fit(train)
    return model.transform(docs).select("doc_id", F.round("source", 6).alias("source"))


@query("signed_power", """
    WITH c AS (SELECT event_id, value - 20 AS x FROM events)
    SELECT event_id, round(CASE WHEN x >= 0 THEN (pow(x + 1, 0.5) - 1) / 0.5 ELSE -(pow(1 - x, 1.5) - 1) / 1.5 END, 5) AS half,
      round(CASE WHEN x >= 0 THEN ln(1 + x) ELSE -(pow(1 - x, 2) - 1) / 2 END, 5) AS zero,
      round(CASE WHEN x >= 0 THEN (pow(x + 1, 2) - 1) / 2 ELSE -ln(1 - x) END, 5) AS two FROM c""")
def signed_power(spark, sf):
    x = F.col("value") - 20
    return table(spark, sf, "events").select("event_id", *[
        F.round(S.signed_power(x, lam), 5).alias(n) for n, lam in (("half", 0.5), ("zero", 0.0), ("two", 2.0))])


@query("yeo_johnson")
def yeo_johnson(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value", F.col("user_id").cast("double").alias("user_id"))
    return N.YeoJohnson(inputCols=["value", "user_id"]).fit(df).transform(df)


@query("group_ratio", """
    WITH m AS (SELECT l_returnflag, l_linestatus, avg(l_discount) AS m FROM lineitem WHERE l_orderkey % 10 < 8 GROUP BY ALL)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_discount / m, 6) AS ratio
    FROM lineitem LEFT JOIN m USING (l_returnflag, l_linestatus) WHERE l_orderkey % 10 >= 8""")
def group_ratio(spark, sf):
    """Value over the training mean of its two-key group."""
    df = table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag", "l_linestatus", "l_discount")
    step = N.GroupRatio(keyCols=["l_returnflag", "l_linestatus"], inputCol="l_discount", outputCol="ratio")
    out = step.fit(df.where("l_orderkey % 10 < 8")).transform(df.where("l_orderkey % 10 >= 8"))
    return out.select(*LINE_KEY, F.round("ratio", 6).alias("ratio"))


def embedded(spark, sf):
    from pyspark.ml.functions import array_to_vector

    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("double").alias("label")
    ).withColumn("features", array_to_vector("vec"))


@query("principal_axes")
def principal_axes(spark, sf):
    """Projection on as many axes as explain 85 % of the variance."""
    df = embedded(spark, sf)
    out = N.PrincipalAxes(inputCol="features", variance=0.85).fit(df).transform(df)
    return out.select("vec_id", vector_to_array("pca").alias("pca"))


@query("principal_axes_norms", """
    WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    s AS (SELECT i, avg(x) AS m, var_pop(x) AS v FROM e GROUP BY 1)
    SELECT vec_id, round(sum(pow(x - m, 2) / v), 4) AS norm FROM e JOIN s USING (i) GROUP BY 1""")
def principal_axes_norms(spark, sf):
    """All axes together turn the scaled vectors without changing their length."""
    df = embedded(spark, sf)
    out = N.PrincipalAxes(inputCol="features").fit(df).transform(df)
    norm = F.aggregate(vector_to_array("pca"), F.lit(0.0), lambda s, x: s + x * x)
    return out.select("vec_id", F.round(norm, 4).alias("norm"))


@query("explained_variance")
def explained_variance(spark, sf):
    return N.PrincipalAxes(inputCol="features").fit(embedded(spark, sf)).variance_table(spark)


@query("explained_variance_pair", """
    WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
    SELECT 1 AS component, round((1 + r) / 2, 8) AS share, round((1 + r) / 2, 8) AS cumulative FROM r
    UNION ALL SELECT 2, round((1 - r) / 2, 8), 1.0 FROM r""")
def explained_variance_pair(spark, sf):
    """Two scaled columns: the shares follow from their correlation."""
    df = N.assemble(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    out = N.PrincipalAxes(inputCol="features").fit(df).variance_table(spark)
    return out.select("component", F.round("share", 8).alias("share"), F.round("cumulative", 8).alias("cumulative"))


@query("wide_axes_pair", """
    WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
    SELECT 1 AS component, round((1 + r) / 2, 7) AS share FROM r UNION ALL SELECT 2, round((1 - r) / 2, 7) FROM r""")
def wide_axes_pair(spark, sf):
    """The closed form of two columns, found by products with the covariance."""
    df = N.assemble(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    out = WideAxes(inputCol="features", k=2).fit(df).variance_table(spark)
    return out.select("component", F.round("share", 7).alias("share"))


@query("wide_axes_words")
def wide_axes_words(spark, sf):
    """Documents on the five main axes of their word counts in 2048 hashed columns."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+").transform(docs)
    counts = HashingTF(inputCol="words", outputCol="features", numFeatures=2048).transform(words).select("doc_id", "features")
    out = WideAxes(inputCol="features", k=5, scale=False).fit(counts).transform(counts)
    return out.select("doc_id", vector_to_array("pca").alias("pca"))


@query("anova_f", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", round((sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 4) AS f
    FROM (SELECT quality, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM {DOCS} GROUP BY 1), (SELECT avg({c}) AS g FROM {DOCS})""" for c in DOC_COLS))
def anova_f(spark, sf):
    return N.anova_f(doc_features(spark, sf), DOC_COLS, "quality").withColumn("f", F.round("f", 4))


@query("select_best", f"""
    SELECT "column" AS name FROM ({" UNION ALL ".join(f'''
    SELECT '{c}' AS "column", (sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f
    FROM (SELECT quality, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM {DOCS} GROUP BY 1), (SELECT avg({c}) AS g FROM {DOCS})''' for c in DOC_COLS)})
    ORDER BY f DESC LIMIT 3""")
def select_best(spark, sf):
    """Names of the three columns that separate the classes best."""
    from rowsmith.operators.stats import table_info

    df = doc_features(spark, sf)
    kept = N.SelectBest(inputCols=DOC_COLS, labelCol="quality", k=3).fit(df).transform(df)
    return table_info(kept.select(*[c for c in DOC_COLS if c in kept.columns])).select(F.col("column").alias("name"))


def _mi_sql(name: str, code: str) -> str:
    return f"""SELECT '{name}' AS "column", round(greatest(sum(n / t * ln(n * t / (nx * ny))), 0), 6) AS mi FROM
      (SELECT *, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM
        (SELECT {code} AS x, l_returnflag AS y, count(*) AS n FROM lineitem, e GROUP BY ALL))"""


@query("mutual_information", """
    WITH e AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.75) AS c FROM lineitem)
    """ + " UNION ALL ".join([
        _mi_sql("l_extendedprice", "(l_extendedprice >= a)::INT + (l_extendedprice >= b)::INT + (l_extendedprice >= c)::INT"),
        _mi_sql("l_linestatus", "l_linestatus"), _mi_sql("l_linenumber", "l_linenumber")]))
def mutual_information(spark, sf):
    df = table(spark, sf, "lineitem")
    out = N.mutual_information(df, "l_returnflag", numeric=["l_extendedprice"], discrete=["l_linestatus", "l_linenumber"], bins=4)
    return out.withColumn("mi", F.round("mi", 6))


@query("ranking_comparison")
def ranking_comparison(spark, sf):
    """Mutual information against forest importance as percentage ranks."""
    from rowsmith.models.trees import forest_classifier, importance_table

    df = doc_features(spark, sf)
    mi = N.mutual_information(df, "label", numeric=DOC_COLS).withColumnRenamed("mi", "score")
    forest = forest_classifier().fit(N.assemble(df, DOC_COLS))
    importance = importance_table(spark, forest, DOC_COLS).withColumnRenamed("importance", "score")
    return N.compare_rankings(mi, importance, "mutual_information", "forest")


@query("vector_round_trip", """
    SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS e0, round(embedding[64]::DOUBLE, 6) AS e63,
      round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings""")
def vector_round_trip(spark, sf):
    """Array to named columns, assembled to a vector and back."""
    cols = [f"e{i}" for i in range(64)]
    wide = N.named_columns(embedded(spark, sf), "features", cols).drop("features")
    back = N.assemble(wide, cols, "v").withColumn("a", vector_to_array("v"))
    return back.select("vec_id", F.round("e0", 6).alias("e0"), F.round(F.get("a", 63), 6).alias("e63"),
                       F.round(F.aggregate("a", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query("steps_by_column_type", """
    WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d, avg(o_custkey) AS cm, stddev_pop(o_custkey) AS cd FROM orders)
    SELECT o_orderkey, o_orderdate, round((o_totalprice - m) / d, 6) AS o_totalprice, round((o_custkey - cm) / cd, 6) AS o_custkey,
      (o_orderstatus = 'F')::INT AS "o_orderstatus_F", (o_orderstatus = 'O')::INT AS "o_orderstatus_O", (o_orderstatus = 'P')::INT AS "o_orderstatus_P"
    FROM orders, s""")
def steps_by_column_type(spark, sf):
    """Numbers are scaled, text is one-hot encoded, the rest passes through."""
    df = table(spark, sf, "orders").drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("double"))
    steps = ColumnSteps([("numeric", [N.MeanImputer(), N.ZScaler()]), ("string", [C.ModeImputer(), C.OneHotColumns()])], exclude=["o_orderkey"])
    out = steps.fit(df).transform(df)
    return out.withColumns({c: F.round(c, 6) for c in ("o_totalprice", "o_custkey")})


@query("hash_split", f"""
    SELECT CASE WHEN {U4(42)} < 0.7 THEN 'train' ELSE 'test' END AS part, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1""")
def hash_split(spark, sf):
    out = R.mark_split(table(spark, sf, "lineitem"), LINE_KEY, 0.7, 42)
    return out.groupBy("part").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("temporal_split", """
    SELECT CASE WHEN year(o_orderdate) < (SELECT max(year(o_orderdate)) FROM orders) THEN 'train' ELSE 'test' END AS part,
      count(*) AS n, min(o_orderdate) AS first FROM orders GROUP BY 1""")
def temporal_split(spark, sf):
    df = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    train, test = R.temporal_split(df, "year")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first"))


@query("sample_and_rest", f"""
    SELECT c_custkey, CASE WHEN {U('c_custkey', 7)} < 0.25 THEN 'sample' ELSE 'rest' END AS part FROM customer""")
def sample_and_rest(spark, sf):
    a, b = R.sample_fraction(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 0.25, 7)
    return a.withColumn("part", F.lit("sample")).unionByName(b.withColumn("part", F.lit("rest")))


@query("folds", f"SELECT doc_id, floor({U('doc_id', 42)} * 5)::INT AS fold FROM labels")
def folds(spark, sf):
    return R.kfold(table(spark, sf, "labels").select("doc_id"), "doc_id", 5)


@query("stratified_folds", """
    SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY ('0x' || substr(md5(doc_id || ':42'), 1, 8))::BIGINT, doc_id) - 1) % 5)::INT AS fold
    FROM labels""")
def stratified_folds(spark, sf):
    return R.stratified_kfold(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", 5)


@query("balanced_weights", """
    SELECT doc_id, round(count(*) OVER () / (2 * count(*) OVER (PARTITION BY quality)), 8) AS weight FROM labels""")
def balanced_weights(spark, sf):
    return R.balanced_weights(table(spark, sf, "labels"), "quality").select("doc_id", F.round("weight", 8).alias("weight"))


def _poisson_sql(rate: float) -> str:
    terms, cum, term = [], 0.0, math.exp(-rate)
    for i in range(1, 40):
        cum += term
        terms.append(f"(u >= {cum!r})::INT")
        term *= rate / i
    return " + ".join(terms)


@query("bootstrap", f"""
    SELECT vec_id, ({_poisson_sql(0.75)})::BIGINT AS n FROM (SELECT vec_id, {U('vec_id', 42)} AS u FROM embeddings)
    WHERE ({_poisson_sql(0.75)}) > 0""")
def bootstrap(spark, sf):
    """Rows drawn with replacement; how often each was drawn."""
    drawn = R.bootstrap(table(spark, sf, "embeddings").select("vec_id"), "vec_id", 0.75, 42)
    return drawn.groupBy("vec_id").agg(F.count("*").alias("n"))


@query("smote", """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, ('0x' || substr(md5(vec_id || ':42'), 1, 8))::BIGINT AS h FROM embeddings),
    c AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS target FROM e GROUP BY 1),
    p AS (SELECT e.*, n, target, row_number() OVER (PARTITION BY label ORDER BY h, vec_id) - 1 AS pos FROM e JOIN c USING (label)),
    near AS (SELECT a.vec_id, b.vec_id AS other, b.v AS bv, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) - 1 AS i
             FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.n < a.target),
    copies AS (SELECT p.*, unnest(generate_series(1, ((target - n) // n + (pos < (target - n) % n)::INT)::BIGINT)) AS copy FROM p WHERE n < target),
    made AS (SELECT vec_id, label, v, least(5, n - 1) AS k,
        ('0x' || substr(md5(vec_id || ':' || copy || ':43'), 1, 8))::BIGINT / 4294967296.0 AS u,
        ('0x' || substr(md5(vec_id || ':' || copy || ':44'), 1, 8))::BIGINT / 4294967296.0 AS gap FROM copies)
    SELECT vec_id, label, round(list_sum(v), 5) AS total, false AS synthetic FROM e
    UNION ALL
    SELECT m.vec_id, m.label, round(list_sum(m.v) + gap * (list_sum(bv) - list_sum(m.v)), 5), true
    FROM made m JOIN near ON near.vec_id = m.vec_id AND near.i = floor(u * k)""")
def smote(spark, sf):
    df = table(spark, sf, "embeddings")
    out = R.smote(df, "label", "vec_id", "embedding", 5, 42)
    return out.select(F.col("origin").alias("vec_id"), "label", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, b: a + b), 5).alias("total"), "synthetic")
