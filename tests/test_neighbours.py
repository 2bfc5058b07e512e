"""Exact neighbours against brute force, also with a third of the rows in one spot."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.models.simple import KnnClassifier
from rowsmith.operators.neighbours import nearest
from rowsmith.operators.resample import bootstrap, smote


def brute(q, r, k, exclude_self=False, same=None):
    out = {}
    for i, a in q.items():
        d = sorted((float(np.sqrt(((a - b) ** 2).sum())), j) for j, b in r.items()
                   if not (exclude_self and i == j) and (same is None or same[i] == same[j]))
        out[i] = [j for _, j in d[:k]]
    return out


def cloud(n, dim, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).round(2)
    v[: n // 3] = v[0]  # a third of the rows are copies of one point
    v[n // 3 : n // 2] = v[n // 3] + rng.normal(scale=0.01, size=(n // 2 - n // 3, dim)).round(4)
    return {i: v[i] for i in range(n)}


def table(spark, points, group=None):
    data = [(i, [float(x) for x in p], (group or {}).get(i, 0)) for i, p in points.items()]
    return spark.createDataFrame(data, "id bigint, vec array<double>, g int")


def found(df):
    out = {}
    for r in df.orderBy("query_key", "rank").collect():
        out.setdefault(r["query_key"], []).append(r["ref_key"])
    return out


@pytest.mark.parametrize("ref_rows,query_rows", [(16, 32), (50, 1000), (4096, 8192)])
@pytest.mark.parametrize("dim", [2, 8])
def test_same_as_brute_force(spark, ref_rows, query_rows, dim):
    points = cloud(300, dim, dim)
    df = table(spark, points)
    got = nearest(df, df, "id", "vec", 5, exclude_self=True, ref_rows=ref_rows, query_rows=query_rows)
    assert found(got) == brute(points, points, 5, exclude_self=True)


def test_other_queries_and_more_neighbours_than_rows(spark):
    refs, asked = cloud(40, 3, 1), {100 + i: p for i, p in cloud(25, 3, 2).items()}
    got = nearest(table(spark, asked), table(spark, refs), "id", "vec", 60, ref_rows=8)
    assert found(got) == brute(asked, refs, 60)


@pytest.mark.parametrize("ref_rows", [20, 4096])
def test_within_groups_and_carried_column(spark, ref_rows):
    points = cloud(240, 3, 5)
    group = {i: 0 if i < 150 else i % 3 + 1 for i in points}
    df = table(spark, points, group).withColumn("tag", F.col("id") * 10)
    got = nearest(df, df, "id", "vec", 4, exclude_self=True, within="g", carry="tag", ref_rows=ref_rows)
    assert got.where("tag <> ref_key * 10").count() == 0
    assert found(got) == brute(points, points, 4, True, group)


def test_empty_reference(spark):
    df = table(spark, cloud(6, 2, 0))
    assert nearest(df, df.where("id < 0"), "id", "vec", 3).count() == 0


def test_vote_on_resampled_rows_counts_copies(spark):
    df = spark.createDataFrame([(i, [float(i)], float(i % 2)) for i in range(30)], "id bigint, features array<double>, label double")
    drawn = bootstrap(df, "id", 1.5, 3)
    out = KnnClassifier(keyCol="id", k=4).fit(drawn).transform(df).toPandas().set_index("id")
    copies = [(r["id"], r["label"]) for r in drawn.collect()]
    for i in range(30):
        near = sorted(copies, key=lambda c: (abs(c[0] - i), c[0]))[:4]
        assert out.loc[i, "probability"][1] == pytest.approx(sum(l for _, l in near) / 4)


def test_smote_equalises_and_stays_on_segments(spark):
    rng = np.random.default_rng(1)
    data = [(i, 0 if i < 50 else (1 if i < 62 else 2), [float(x) for x in rng.normal(size=3)]) for i in range(70)]
    df = spark.createDataFrame(data, "id bigint, label int, vec array<double>")
    out = smote(df, "label", "id", "vec", 3).collect()
    counts = {}
    for r in out:
        counts[r["label"]] = counts.get(r["label"], 0) + 1
    assert counts == {0: 50, 1: 50, 2: 50}
    base = {i: (c, np.array(v)) for i, c, v in data}
    for r in out:
        if r["synthetic"]:
            a, p = base[r["origin"]][1], np.array(r["vec"])
            near = brute({r["origin"]: a}, {i: v for i, (c, v) in base.items() if c == r["label"]}, 3, True)[r["origin"]]
            ok = False
            for j in near:
                b = base[j][1]
                t = np.dot(p - a, b - a) / np.dot(b - a, b - a)
                ok |= -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * (b - a), p)
            assert ok


def test_smote_refuses_a_single_row(spark):
    df = spark.createDataFrame([(i, int(i == 0), [float(i)]) for i in range(9)], "id bigint, label int, vec array<double>")
    with pytest.raises(ValueError, match="single row"):
        smote(df, "label", "id", "vec", 3)


def test_scored_rows_with_one_key(spark):
    train = spark.createDataFrame([(i, [float(i)], float(i >= 5)) for i in range(10)], "id bigint, features array<double>, label double")
    asked = spark.createDataFrame([(7, [0.0]), (7, [9.0])], "id bigint, features array<double>")
    out = KnnClassifier(keyCol="id", k=3).fit(train).transform(asked).collect()
    assert {(r["features"][0], r["prediction"]) for r in out} == {(0.0, 0.0), (9.0, 1.0)}


def test_large_tables_get_few_large_blocks(spark, monkeypatch):
    """A query travels to few regions, not once to each of many small cells."""
    from rowsmith.operators import neighbours as M

    seen = {}
    real = M._visits

    def watched(*args):
        seen["visits"] = real(*args)
        return seen["visits"]

    monkeypatch.setattr(M, "_visits", watched)
    rng = np.random.default_rng(4)
    points = {i: v for i, v in enumerate(rng.normal(size=(700, 32)).round(3))}
    df = table(spark, points)
    got = nearest(df, df, "id", "vec", 3, exclude_self=True, ref_rows=20, query_rows=20)
    assert found(got) == brute(points, points, 3, True)
    assert seen["visits"].count() == 700
    assert seen["visits"].agg(F.max(F.size("regions"))).first()[0] <= 2 * M.BLOCKS


@pytest.mark.parametrize("ref_rows", [40, 4096])
def test_many_equal_vectors_and_repeated_keys(spark, ref_rows):
    """Of equal vectors the smallest keys are the neighbours; all rows of the own key are left out."""
    spot = [[1.0, 2.0], [1.0, 2.5], [3.0, 0.0]]
    data = [(i // 2, spot[i % 7 % 3]) for i in range(600)]
    df = spark.createDataFrame(data, "id bigint, vec array<double>")
    asked = spark.createDataFrame([(i, data[2 * i][1]) for i in range(0, 300, 11)], "id bigint, vec array<double>")
    got = {}
    for r in nearest(asked, df, "id", "vec", 5, exclude_self=True, ref_rows=ref_rows, query_rows=32).orderBy("query_key", "rank").collect():
        got.setdefault(r["query_key"], []).append((r["distance"], r["ref_key"]))
    for i, v in [(r["id"], r["vec"]) for r in asked.collect()]:
        assert got[i] == sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in data if j != i)[:5]
