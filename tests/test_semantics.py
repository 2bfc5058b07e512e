"""Edge cases: nulls, ties, bin edges, constants, unseen categories, empty input."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowsmith.features import category as C
from rowsmith.features import numeric as N
from rowsmith.functions import scalar as S
from rowsmith.functions.user import vectorised
from rowsmith.operators import clean, metrics, resample, stats
from rowsmith.sources import tables


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_cut_is_right_closed(rows):
    df = rows([(0.0,), (0.1,), (18.0,), (18.1,), (80.0,), (81.0,), (None,)], "v double")
    assert column(df, S.cut("v", [0, 18, 80], ["lo", "hi"])) == [None, "lo", "lo", "hi", "hi", None, None]
    assert column(df, S.cut("v", [0, 18, 80], ["lo", "hi"], include_lowest=True))[0] == "lo"


def test_bins_are_left_closed(rows):
    df = rows([(-5.0,), (0.0,), (1.0,), (2.0,), (9.0,), (None,)], "v double")
    assert column(df, S.left_closed_bin("v", [0, 1, 2])) == [0, 0, 1, 1, 1, None]


def test_nulls_in_scalars(rows):
    df = rows([(1.0, None), (2.0, 0.0), (None, 3.0)], "a double, b double")
    assert column(df, S.ratio("a", "b")) == [None, None, None]
    assert column(df, S.truth(F.col("a") > 1)) == [False, True, False]
    assert column(df, ~S.truth(F.col("a") > 1)) == [True, False, True]
    assert column(df, S.clip("a", 1.5, 9)) == [1.5, 2.0, None]
    assert column(df, S.row_mean(["a", "b"])) == [1.0, 1.0, 3.0]
    assert column(df, S.joined("_", "a", "b")) == [None, "2.0_0.0", None]
    assert column(df, S.count_positive(["a", "b"])) == [1, 1, 1]


def test_age_around_the_birthday(rows):
    df = rows([("2000-06-15",), ("2000-06-16",), ("2000-02-29",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert column(df, S.age_in_years("d", F.lit("2024-06-15").cast("date"))) == [24, 23, 24]


def test_parse_and_decade(rows):
    df = rows([("31/12/1999",), ("1999-12-31",), (None,)], "d string")
    assert [str(d) for d in column(df, S.parse_date("d", "dd/MM/yyyy"))] == ["1999-12-31", "None", "None"]
    assert column(rows([(1989,)], "y int"), S.decade_label("y")) == ["1980s"]


def test_nan_becomes_null(rows):
    df = tables.nan_to_null(rows([(float("nan"), 1), (2.0, 2)], "a double, b int"))
    assert df.agg(F.avg("a"), F.count("a")).first() == (2.0, 1)


def test_dotted_names_and_delimiter(spark, tmp_path):
    (tmp_path / "bank.csv").write_text("emp.var.rate;job\n1.5;clerk\n;\n")
    df = tables.read_csv(spark, str(tmp_path / "bank.csv"), "`emp.var.rate` double, job string", sep=";")
    assert df.columns == ["emp_var_rate", "job"]
    assert [tuple(r) for r in df.collect()] == [(1.5, "clerk"), (None, None)]


def test_group_keys_without_value_are_dropped(rows):
    df = rows([("a", 1.0), (None, 5.0), ("a", None)], "k string, v double")
    assert [tuple(r) for r in stats.group_agg(df, ["k"], {"v": ["sum", "median", "count"]}).collect()] == [("a", 1.0, 1.0, 1)]
    back = stats.with_group_stats(df, ["k"], m=F.avg("v")).select("k", "m").collect()
    assert sorted((r["k"] or "", r["m"]) for r in back) == [("", None), ("a", 1.0), ("a", 1.0)]


def test_mode_tie_takes_smallest(rows):
    df = rows([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert stats.mode(df, "v").first()["v"] == "a"
    assert stats.modes(rows([(3, None), (3, None)], "a int, b string"), ["a"]) == {"a": 3}


def test_skewness_matches_pandas(rows):
    v = [1.0, 2.0, 2.5, 9.0, 30.0]
    got = stats.skewness(rows([(x,) for x in v], "v double"), ["v"]).first()["skew"]
    assert math.isclose(got, pd.Series(v).skew())


def test_correlation_is_pairwise_complete(rows):
    data = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 4.0), (None, 1.0)]
    got = stats.correlations(rows(data, "a double, b double"), ["a", "b"]).first()["corr"]
    assert math.isclose(got, pd.DataFrame(data, columns=["a", "b"]).corr().iloc[0, 1])


def test_correlated_columns_rule(spark):
    df = spark.range(50).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"), (F.col("id") % 7).alias("c"))
    assert stats.correlated_columns(df, ["a", "b", "c"], 0.9) == ["b"]


def test_constant_column(rows):
    df = rows([(5.0, 1.0), (5.0, 3.0)], "a double, b double")
    out = N.ZScaler(inputCols=["a", "b"]).fit(df).transform(df).collect()
    assert [tuple(r) for r in out] == [(0.0, -1.0), (0.0, 1.0)]
    assert clean.remove_outliers(df, ["a", "b"]).count() == 2
    assert stats.histogram(df, "a", 3).agg(F.sum("n")).first()[0] == 2


def test_histogram_includes_maximum(rows):
    got = stats.histogram(rows([(float(i),) for i in range(11)], "v double"), "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 2, 2, 2, 3]


def test_describe_matches_pandas(rows):
    v = [3.0, 1.0, 4.0, 1.5, None, 9.0]
    r = stats.describe(rows([(x,) for x in v], "v double"), ["v"]).first()
    want = pd.Series(v).describe()
    assert [r["count"], r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]] == pytest.approx(list(want))


def test_drop_sparse_uses_strict_bound(rows):
    df = rows([(1, None, None), (1, 2, None), (1, 2, 3), (1, None, None)], "a int, b int, c int")
    assert clean.drop_sparse_columns(df, 0.5).columns == ["a"]
    assert clean.drop_sparse_columns(df, 0.51).columns == ["a", "b"]


def test_drop_missing_column_is_ignored(rows):
    assert clean.drop_columns(rows([(1, 2)], "a int, b int"), "b", "zzz").columns == ["a"]


def test_unseen_category(rows):
    train, new = rows([("x",), ("y",), ("z",)], "c string"), rows([("q",)], "c string")
    strict = C.OneHotColumns(inputCols=["c"]).fit(train)
    with pytest.raises(Exception):
        strict.transform(new).collect()
    loose = C.OneHotColumns(inputCols=["c"], unknown="ignore").fit(train)
    assert tuple(loose.transform(new).first()) == (0, 0, 0)
    both = C.OneHotColumns(inputCols=["c"]).fit(train.where("c <> 'z'"))
    assert both.transform(train.where("c <> 'z'")).columns == ["c_y"]


def test_target_encoders_on_unseen_and_missing(rows):
    train = rows([(i, "a" if i % 2 else "b", float(i % 2)) for i in range(40)], "id bigint, c string, label double")
    new = rows([(1, "zzz", 0.0), (2, None, 0.0)], "id bigint, c string, label double")
    smooth = C.SmoothedTargetEncoder(inputCols=["c"]).fit(train)
    assert [r["c"] for r in smooth.transform(new).collect()] == [0.5, 0.5]
    woe = C.WoeEncoder(inputCols=["c"]).fit(train)
    assert [r["c"] for r in woe.transform(new).collect()] == [0.0, 0.0]


def test_cross_fit_uses_other_folds_only(rows):
    data = [(i, f"c{i % 3}", float(i * 7 % 11)) for i in range(60)]
    df = rows(data, "id bigint, c string, label double")
    step = C.CrossFitTargetEncoder(inputCols=["c"], keyCols=["id"], folds=4)
    _, got = step.fit_transform(df)
    got = {r["id"]: r["c"] for r in got.collect()}
    fold = {r["id"]: r["fold"] for r in resample.kfold(df, "id", 4).collect()}
    for i, c, _ in data:
        rest = [(a, y) for j, a, y in data if fold[j] != fold[i]]
        ys = np.array([y for _, y in rest])
        mine = np.array([y for a, y in rest if a == c])
        w = len(mine) * ys.var() / (len(mine) * ys.var() + mine.var())
        assert math.isclose(got[i], w * mine.mean() + (1 - w) * ys.mean(), rel_tol=1e-9)


def test_quantile_bins_merge_narrow_ones(rows):
    df = rows([(0.0,)] * 8 + [(1.0,), (2.0,)], "v double")
    model = N.BinColumns(inputCols=["v"], bins=5).fit(df)
    assert len(model.state["v"]) == 3
    assert [r["v"] for r in model.transform(rows([(-9.0,), (99.0,)], "v double")).collect()] == [0, 1]


def test_yeo_johnson_lambda(rows):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.lognormal(0, 1, 400), -rng.random(50)])
    df = rows([(float(v),) for v in x], "v double")
    lam = N.YeoJohnson(inputCols=["v"]).fit(df).state["v"][0]

    def loss(l):
        pos = x >= 0
        t = np.empty_like(x)
        t[pos] = ((x[pos] + 1) ** l - 1) / l if abs(l) > 1e-12 else np.log1p(x[pos])
        t[~pos] = -((1 - x[~pos]) ** (2 - l) - 1) / (2 - l)
        return -(-0.5 * len(x) * np.log(t.var()) + (l - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum())

    grid = np.linspace(-1.9, 1.9, 38001)
    assert abs(lam - grid[np.argmin([loss(l) for l in grid])]) < 1e-3


def test_metrics_edge_cases(rows):
    df = rows([("a", "a"), ("a", "b"), ("c", "b")], "y string, p string")
    report = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert report["b"]["precision"] == 0 and report["b"]["support"] == 0
    assert report["c"]["f1"] == 0 and math.isclose(report["a"]["f1"], 2 / 3)
    assert metrics.balanced_accuracy(df, "y", "p").first()[0] == 0.25
    assert metrics.f1_binary(rows([(0, 0)], "y int, p int"), "y", "p").first()[0] == 0.0


def test_folds_partition_the_rows(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    out = resample.stratified_kfold(df, "label", "id", 7).toPandas()
    assert len(out) == 1000 and set(out["id"]) == set(range(1000))
    for _, part in out.groupby("label"):
        sizes = part["fold"].value_counts()
        assert sizes.max() - sizes.min() <= 1


def test_rows_without_a_class_keep_a_fold(rows):
    df = rows([(i, None if i % 3 == 0 else "x") for i in range(30)], "id bigint, label string")
    assert resample.stratified_kfold(df, "label", "id", 5).where("fold is not null").count() == 30


def test_split_does_not_depend_on_partitions(spark):
    a, _ = resample.train_test_split(spark.range(500, numPartitions=1), "id", 0.8)
    b, _ = resample.train_test_split(spark.range(500, numPartitions=9), "id", 0.8)
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())


def test_bootstrap_rate(spark):
    n = resample.bootstrap(spark.range(20000), "id", 0.75).count()
    assert abs(n / 20000 - 0.75) < 0.03


def test_weights_balance_classes(rows):
    df = rows([(1,), (1,), (1,), (0,)], "label int")
    out = resample.balanced_weights(df, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert {r["label"]: r["w"] for r in out} == pytest.approx({0: 2.0, 1: 2.0})


def test_user_function(spark):
    twice = vectorised(lambda s: s * 2, "bigint")
    assert column(spark.range(3), twice("id")) == [0, 2, 4]


def test_profile_covers_every_column(spark, small):
    out = stats.profile_report(tables.table(spark, small, "customer"))
    assert {r[0] for r in out.select("column").distinct().collect()} == set(tables.table(spark, small, "customer").columns)


def test_column_steps_leave_other_columns(rows):
    from rowsmith.plans.flows import ColumnSteps

    df = rows([(1, 2.0, "a", True), (2, None, None, False)], "id int, x double, s string, f boolean")
    out = ColumnSteps([("numeric", [N.MeanImputer()]), ("string", [C.ModeImputer()])], exclude=["id"]).fit(df).transform(df)
    assert [tuple(r) for r in out.collect()] == [(1, 2.0, "a", True), (2, 2.0, "a", False)]


def test_stream_of_a_table_in_many_files(spark, small, tmp_path):
    from rowsmith.streaming.events import append_available, event_stream

    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(5).write.parquet(str(tmp_path / "in" / "events.parquet"))
    append_available(event_stream(spark, str(tmp_path / "in")).select("event_id"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count() > 0


def test_intermediate_tables_are_removed(spark):
    import os

    from rowsmith import session

    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path.removeprefix("file:"))
    session.discard([path])
    assert not os.path.exists(path.removeprefix("file:")) and path not in session.written_since()


def test_density_without_spread(spark):
    from rowsmith.operators import stats

    for rows in ([(2.0,), (2.0,)], [(1.0,)], [(None,)]):
        assert stats.kde(spark.createDataFrame(rows, "v double"), "v").count() == 0
