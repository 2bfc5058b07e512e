"""The external shuffle against its law: one order whatever the plan, gapless slots, equal counts, hot rows spread."""

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import sharding


def placed(df, **options):
    rows = sharding.external_shuffle(df, **options).select("record.doc_id", "record.text", "shard", "slot").collect()
    return sorted((r.doc_id, r.text, r.shard, r.slot) for r in rows)


def test_order_does_not_depend_on_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id is not null").na.fill("", ["text"])
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    kept, seen = {n: spark.conf.get(n) for n in names}, []
    try:
        for parts, adaptive, deal in itertools.product(("3", "8", "40"), ("true", "false"), (False, True)):
            for name, value in zip(names, (parts, adaptive, "-1" if deal else "10MB")):
                spark.conf.set(name, value)
            seen.append(placed(docs.repartition(13).orderBy(F.rand(5)) if deal else docs, bucket_bytes=100_000))
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert all(s == seen[0] for s in seen)
    assert placed(docs, bucket_bytes=100_000, seed=2) != seen[0]
    rows = [r.text for r in docs.collect()]
    assert sorted(t for _, t, _, _ in seen[0]) == sorted(rows)
    by_shard = Counter(s for _, _, s, _ in seen[0])
    assert set(by_shard) == set(range(40)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    assert {(s, n) for _, _, s, n in seen[0]} == {(s, n) for s, c in by_shard.items() for n in range(c)}


@pytest.mark.parametrize("copies", [50, 3000])
def test_rows_equal_in_all_columns(spark, copies):
    rows = [(None, None)] * copies + [(1, "same")] * copies + [(i, f"text {i}") for i in range(2, 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.external_shuffle(df, shards=10, bucket_bytes=2000, most_equal=100).collect()
    assert Counter((r.record.doc_id, r.record.text) for r in out) == Counter(rows)
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s])) for s in sizes)
    hot = Counter(r.shard for r in out if r.record.doc_id == 1)
    if copies > 100:  # spread over all shards, as a random order has it
        assert min(hot.values()) > 0.5 * copies / 10


def test_uniform_order(spark):
    """Of 2000 rows in about 8 buckets, neighbours in the input are far apart and every shard gets its share of each tenth."""
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lpad(F.col("id").cast("string"), 20, "x").alias("text"))
    out = sharding.external_shuffle(df, shards=10, bucket_bytes=9000).select("record.doc_id", "shard").collect()
    table = Counter((r.doc_id // 200, r.shard) for r in out)
    chi = sum((table[i, j] - 20) ** 2 / 20 for i in range(10) for j in range(10))
    assert chi < 140  # 81 degrees of freedom, 0.0001 quantile at 137
