"""Whitening against a dense eigendecomposition, and defined results on odd vectors."""

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import queries, whitening
from rowsmith.sources.tables import table


def spectrum(kind, dim, rng):
    return {
        "flat": np.linspace(2, 1, dim), "steep": 100 * 0.8 ** np.arange(dim), "ties": np.repeat(np.arange(dim // 4, 0, -1.0), 4),
        "flat tail": np.concatenate([np.linspace(50, 3, dim // 8), rng.random(dim - dim // 8)]), "low rank": np.where(np.arange(dim) < 5, 3.0, 0.0),
    }[kind]


@pytest.mark.parametrize("dim", [8, 40, 400])
@pytest.mark.parametrize("kind", ["flat", "steep", "ties", "flat tail", "low rank"])
def test_leading_pairs_as_dense(kind, dim):
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    e = spectrum(kind, dim, rng)
    a = (q * e) @ q.T
    a, want = (a + a.T) / 2, min(32, dim)
    values, vectors, residual = whitening.leading_pairs(lambda w: a @ w, dim, want)
    assert np.allclose(values, np.sort(e)[::-1][:want], rtol=0, atol=1e-13 * e.max())
    assert residual < 1e-12 and np.abs(vectors.T @ vectors - np.eye(want)).max() < 1e-13
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-12 * e.max()


def test_query_as_dense(spark, sf):
    got = queries.QUERIES["op13_jacobi_davidson"](spark, sf).toPandas()
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding").toPandas()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows["embedding"]], np.int64)
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    assert len(got) == 32 * n and set(got.component) == set(range(1, 33)) and set(got.n) == {n}
    mine = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows.vec_id].to_numpy()
    want = y @ u / np.sqrt(e)
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine - want * sign).max() < 1e-8
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, e / np.square(y).sum() * n, rtol=1e-12)
    exact = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for i, v in zip(rows.vec_id, x)}
    assert dict(zip(got.vec_id, got.deviation)) == exact
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12
    assert np.abs(mine.T @ mine / n - np.eye(32)).max() < 1e-12


NAN, INF = float("nan"), float("inf")


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    sound = [(i, rng.standard_normal(6).tolist()) for i in range(40)]
    odd = [(100, None), (101, [NAN] + [0.0] * 5), (102, [INF] + [0.0] * 5), (103, [None] + [0.0] * 5), (104, [-INF] * 6), (105, [])]
    rows = sound + odd + [sound[3], sound[3], (None, [0.0] * 6), (7, [1.0, 2.0]), (8, [3.0, 2.0]), (9, [-3.0, 5.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("record", F.lit(1)).withColumn("dim", F.lit(2))
    df = df.withColumn("x", whitening.grid_vector(F.col("embedding")))
    models = whitening.fit(df)
    assert [(m.dim, m.n, len(m.values)) for m in models] == [(2, 3, 2), (6, 43, 6)]
    out = whitening.whiten(df, models).collect()
    assert len(out) == 46 and {100, 101, 102, 103, 104, 105}.isdisjoint(r.record.vec_id for r in out)
    assert len({tuple(r.whitened) for r in out if r.record.vec_id == 3}) == 1
    for m in models:
        w = np.array([r.whitened for r in out if r.dim == m.dim])
        assert np.abs(np.cov(w.T, bias=True) - np.eye(m.dim)).max() < 1e-10 and m.identity_error < 1e-10


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows, tmp_path):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert queries.QUERIES["op13_jacobi_davidson"](spark, str(tmp_path)).collect() == []


def test_constant_and_dependent_entries(spark):
    rows = [(i, [5.0, float(i), 2.0 * i, float(i * i % 7)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>").withColumn("x", whitening.grid_vector(F.col("e")))
    (model,) = whitening.fit(df)
    assert len(model.values) == 2 and model.identity_error < 1e-10


def test_deviation_beyond_a_long():
    x, n = np.array([[2_000_000, -5], [1, 7]], np.int64), 1 << 40
    sums = np.array([3 * n // 2, n // 3], np.int64)
    want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    assert whitening.deviations(x, n, sums).to_pylist() == [Decimal(w) for w in want]
    assert want[0] > 1 << 63
