"""Two-pass external shuffle into shards.

Pass one scatters the records by a seeded hash into buckets of a bounded number of bytes. Pass two shuffles every
bucket in memory (Fisher-Yates, ``functions.shuffle``). The buckets in order are one random order of all records, which
is cut into shards whose row counts differ by at most one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowsmith.llm.common import running_before, text_bytes
from rowsmith.session import materialise

MOST_TASKS = 20_000
BUCKETS_A_TASK = 50  # on average; beyond MOST_TASKS times so many buckets they grow instead
MOST_EQUAL = 1_000  # copies of a row up to which they stay in one bucket


def _scattered(docs: DataFrame, seed: int, buckets: int, most_equal: int) -> DataFrame:
    """(bucket, mark, record). Rows equal in all columns and found more than ``most_equal`` times are counted, moved
    once, and dealt singly, so that no bucket holds a hot group."""
    mark = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(mark.alias("mark"), F.struct("*").alias("record"))
    equal = marked.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_equal)
    equal = materialise(equal, "equal")
    bucket = F.pmod("mark", F.lit(buckets)).alias("bucket")
    if not equal.take(1):
        return marked.select(bucket, "mark", "record")
    single = marked.join(equal, "mark", "left_anti").select(bucket, "mark", "record")
    hot = marked.join(equal.select("mark"), "mark", "left_semi")
    # A first record stands for its copies; their numbers are made in stretches, in as many tasks.
    first = hot.groupBy("mark").agg(F.first("record").alias("record"), F.count(F.lit(1)).alias("n"))
    starts = first.select("mark", "record", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(most_equal).cast("bigint"))).alias("from"))
    copies = starts.repartition("mark", "from").select(
        "mark", "record", F.explode(F.sequence("from", F.least(F.col("from") + most_equal, F.col("n")) - 1)).alias("copy"))
    copies = copies.select(F.xxhash64("mark", "copy").alias("mark"), "record").select(bucket, "mark", "record")
    return single.union(copies)


def external_shuffle(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 20240501,
    bucket_bytes: int = 8 << 20,
    key: str = "doc_id",
    text: str = "text",
    most_equal: int = MOST_EQUAL,
) -> DataFrame:
    """One row per record: ``record`` (all its columns), ``shard`` (int) and ``slot`` (long, gapless from 0).

    ``bucket_bytes`` is what one bucket holds on average, hence what a task keeps in memory at a time; the number of
    buckets follows from the measured bytes. A text beyond it makes its bucket larger by that text. The law is `rows`:
    shard counts differ by at most one. The order depends on the rows and the seed alone: buckets are dealt by hash to as
    many tasks (``MOST_TASKS`` at most), and a task shuffles its buckets in order, with a generator seeded by its number.
    Null keys and null or empty texts are records like others. Rows equal in all columns are dealt over all buckets if
    there are more than ``most_equal`` of them. An empty table gives no rows. Columns of ``docs`` cannot clash with the
    results, as they stay inside ``record``.
    """
    rows, size = docs.agg(F.count(F.lit(1)), F.sum(text_bytes(F.col(f"`{text}`")) + 16)).first()
    buckets = max(1, -(-(size or 0) // max(bucket_bytes, (size or 0) // (MOST_TASKS * BUCKETS_A_TASK))))
    placed = _scattered(docs, seed, buckets, most_equal)
    starts = running_before(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket", "n", "first")
    nothing = F.lit(None)
    rows_of = placed.select("bucket", nothing.cast("bigint").alias("first"), "mark", "record").union(
        starts.select("bucket", "first", nothing.cast("bigint"), nothing.cast(placed.schema["record"].dataType)))
    # The start of a bucket travels with its records, so nothing is joined, and the records are shuffled in the task that
    # the buckets were dealt to. Their number is given, so neither settings nor adaptive planning change it.
    filled = (
        rows_of.repartition(min(buckets, MOST_TASKS), "bucket")
        .sortWithinPartitions("bucket", "mark")
        .groupBy("bucket")
        .agg(F.max("first").alias("first"), F.collect_list("record").alias("records"))
    )
    position = F.col("first") + F.col("pos")
    shard = F.expr(f"(position * {shards}L) div {max(rows, 1)}L")
    return (
        filled.select("first", F.posexplode(F.shuffle("records", seed)).alias("pos", "record"))
        .select("record", position.alias("position"))
        .select("record", "position", shard.alias("shard"))
        .select(
            "record",
            F.col("shard").cast("int").alias("shard"),
            (F.col("position") - F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")).alias("slot"),
        )
    )


def write_shards(shuffled: DataFrame, path: str) -> str:
    """Writes the shuffled records as one Parquet folder per shard; a reader sorts a shard by ``slot``.

    A task holds whole buckets, which are adjacent in the order, so it writes to few shards.
    """
    shuffled.write.partitionBy("shard").parquet(path)
    return path
