"""Principal axes of wide vectors against the dense decomposition."""

import numpy as np
import pytest

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from rowsmith.features.numeric import PrincipalAxes
from rowsmith.features.wide import FittedWideAxes, WideAxes
from rowsmith.sources.tables import table


def frame(spark, x, parts=5):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id int, a array<double>").repartition(parts, "id").withColumn("v", array_to_vector("a"))


def exact(x, scale):
    z = x - x.mean(axis=0)
    if scale:
        s = z.std(axis=0)
        z = z / np.where(s > 0, s, 1.0)
    _, size, right = np.linalg.svd(z, full_matrices=False)
    return z, size**2 / (size**2).sum(), right.T


@pytest.mark.parametrize("scale", [True, False])
def test_equals_dense_decomposition(spark, scale):
    r = np.random.default_rng(1)
    x = r.normal(size=(300, 12)) @ r.normal(size=(12, 250)) + 0.3 * r.normal(size=(300, 250)) + 50
    x[:, 7] = 3.25
    z, shares, axes = exact(x, scale)
    model = WideAxes(inputCol="v", k=6, scale=scale).fit(frame(spark, x))
    assert model.ratios == pytest.approx(shares[:6].tolist(), abs=1e-7)
    out = np.array([r.p for r in model.transform(frame(spark, x)).orderBy("id").select(vector_to_array("pca").alias("p")).collect()])
    want = z @ axes[:, :6]
    assert np.abs(np.abs(out) - np.abs(want)).max() < 1e-4 * np.abs(want).max()


def test_flat_spectrum_needs_restarts(spark):
    """Columns of nearly equal variance: the slow case, in which the search space fills up more than once."""
    x = np.random.default_rng(2).normal(size=(1500, 220))
    _, shares, _ = exact(x, True)
    model = WideAxes(inputCol="v", k=3).fit(frame(spark, x))
    assert model.ratios == pytest.approx(shares[:3].tolist(), abs=1e-6)


def test_same_as_narrow_axes(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    narrow = PrincipalAxes(inputCol="v").fit(df)
    wide = WideAxes(inputCol="v", k=10).fit(df)
    assert wide.ratios == pytest.approx(narrow.ratios[:10], abs=1e-6)
    assert wide.variance_table(spark).count() == 10


def test_many_columns(spark):
    """More columns than rows: as many axes as the rows have directions, and all of the variance in them."""
    x = np.random.default_rng(3).normal(size=(9, 5000))
    model = WideAxes(inputCol="v", k=20).fit(frame(spark, x, 3))
    assert len(model.ratios) == 8 and sum(model.ratios) == pytest.approx(1.0, abs=1e-9)


def test_saved_and_null_rows(spark, tmp_path):
    x = np.random.default_rng(4).normal(size=(40, 6))
    df = frame(spark, x).withColumn("v", F.when(F.col("id") != 3, F.col("v")))
    model = WideAxes(inputCol="v", k=2).fit(df)
    model.write().save(str(tmp_path / "m"))
    again = FittedWideAxes.load(str(tmp_path / "m"))
    a, b = (m.transform(df).orderBy("id").select("id", vector_to_array("pca").alias("p")).where("id <> 3").collect() for m in (model, again))
    assert a == b and len(a) == 39
    assert model.transform(df).where("pca IS NULL").count() == 1
    with pytest.raises(ValueError, match="no vectors"):
        WideAxes(inputCol="v").fit(df.where("1 = 0"))
    with pytest.raises(ValueError, match="do not vary"):
        WideAxes(inputCol="v").fit(frame(spark, np.ones((4, 3))))
    with pytest.raises(ValueError, match="not found"):
        WideAxes(inputCol="v", k=1, passes=1, tolerance=1e-12).fit(frame(spark, np.random.default_rng(5).normal(size=(100, 60))))


def test_blocks_of_sparse_and_dense_vectors(monkeypatch):
    """Sparse rows become dense in small blocks inside the task."""
    import pyarrow as pa

    from rowsmith.features import wide

    monkeypatch.setattr(wide, "BLOCK_NUMBERS", 8)
    rows = [(0, 4, [1, 3], [2.0, 5.0]), (1, None, None, [1.0, 2.0, 3.0, 4.0]), (0, 4, [], []), (0, 4, [0], [7.0]), (1, None, None, [0.0, 9.0, 0.0, 1.0])]
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    column = pa.array([dict(zip(("type", "size", "indices", "values"), r)) for r in rows], kind)
    blocks = list(wide._dense(column, 4))
    assert [len(b) for b in blocks] == [2, 2, 1]
    assert np.concatenate(blocks).tolist() == [[0, 2, 0, 5], [1, 2, 3, 4], [0, 0, 0, 0], [7, 0, 0, 0], [0, 9, 0, 1]]
