"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source_size`` copies. The documents of a source stand in an order (near
equal sizes together, else by keyed hash); the prefix sum of the expected copies plus one random offset per source
crosses integers, and a document is emitted once for each integer it crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.llm.common import n_words, unit_hash
from rowsmith.session import materialise

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3


def _keyed(seed: int, *cols: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Target words per source from a table (source, source_size); one small row per source.

    Weights repeat over the sources by code point, null last. The targets share all words by weight; none exceeds
    ``most`` times its source, and the excess is shared again by weight. Sources in the order of ``most * size /
    weight`` reach their limit one after another, so running sums find the level at once. All sizes 0: targets 0.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    out = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * most)
        .withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("full", F.col("limit") * F.col("left_weight") < F.col("weight") * F.col("rest"))
    )
    # The first source that is not full sets the level for all that follow.
    open_rest = F.max(F.when(~F.col("full"), F.struct(-F.col("limit") / F.col("weight"), "rest", "left_weight"))).over(everything)
    out = out.withColumn("open", open_rest)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * F.col("open.rest")).cast("double") / F.col("open.left_weight")
    )
    return out.select("source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame, seed: int = 17, block_rows: int = 500, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """One row per document: ``record`` (all columns), ``size`` (words), ``source_size``, ``target``, ``copies``.

    Positions inside a source come from blocks of about ``block_rows`` documents: a running count over the blocks, then
    a row number inside each, so a source that holds most of the table is spread over many tasks. Copies never exceed
    ``MOST_COPIES``. Null sources are one source. Texts without words count as size 0 and take part like others; a
    source without words gets 0 copies. Repeated rows are separate documents. An empty table gives no rows.
    """
    sized = docs.select(F.struct("*").alias("record")).select(
        "record", F.col("record")[source].alias("source"), F.col("record")[key].alias("id"), n_words(F.col("record")[text]).alias("size"))
    return _planned(sized.withColumn("tie", F.lit(0)), seed, block_rows)


def _planned(sized: DataFrame, seed: int, block_rows: int) -> DataFrame:
    """``sized`` holds record, source, id, size and tie, which orders rows of one id; columns as ``mix_plan``."""
    sized = sized.withColumn("step", F.floor(F.sqrt("size"))).withColumn("mark", _keyed(seed, F.col("id")))
    # A row per source and size step, read by all that follows.
    counts = materialise(sized.groupBy("source", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "sizes")
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")))
    split = counts.select(
        F.col("source").alias("of"), F.col("step").alias("at"), F.ceil(F.col("n") / block_rows).cast("bigint").alias("blocks")
    )
    number = F.conv(F.substring("mark", 1, 8), 16, 10).cast("bigint")
    placed = sized.join(split, F.col("source").eqNullSafe(F.col("of")) & (F.col("step") == F.col("at"))).select(
        "record", "source", "id", "tie", "size", "step", "mark", F.pmod(number, F.col("blocks")).alias("block")
    )
    order = Window.partitionBy("source").orderBy("step", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "step", "block").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select(
            F.col("source").alias("of"), F.col("step").alias("at"), F.col("block").alias("part"), "first", "source_size", "target",
            F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0)).alias("rate"),
            unit_hash(F.lit(seed), F.col("source")).alias("offset"),
        )
    )
    inside = Window.partitionBy("source", "step", "block").orderBy("size", "mark", "id", "tie")
    position = F.col("first") + F.col("row")
    upto = F.floor(position * F.col("rate") + F.col("offset"))
    before = F.floor((position - 1) * F.col("rate") + F.col("offset"))
    return (
        placed.withColumn("row", F.row_number().over(inside))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("step") == F.col("at")) & (F.col("block") == F.col("part")))
        .select(
            "record", "size", "source_size", "target",
            F.least(upto - before, F.lit(MOST_COPIES)).cast("bigint").alias("copies"),
        )
    )


def mix(docs: DataFrame, seed: int = 17, block_rows: int = 500, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixture itself: every document as many times as it was drawn, with its own columns.

    The plan is made on ids, sizes and a hash of the whole row; the documents meet it once, in one join. Rows that are
    equal in all columns are one row of the plan's result and come out as often as all of them were drawn.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select(
        F.struct(row.alias("row"), F.col(f"`{key}`").alias("id")).alias("record"), F.col(f"`{source}`").alias("source"),
        F.col(f"`{key}`").alias("id"), n_words(F.col(f"`{text}`")).alias("size"), row.alias("tie"))
    drawn = _planned(sized, seed, block_rows).groupBy("record").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    drawn = materialise(drawn.where("copies > 0").select(F.col("record.id").alias("of"), F.col("record.row").alias("row"), "copies", "rows"), "copies")
    found = docs.select(F.struct("*").alias("record"), row.alias("row"), F.col(f"`{key}`").alias("id"))
    found = found.join(drawn, (found["row"] == drawn["row"]) & found["id"].eqNullSafe(drawn["of"])).select("record", drawn["row"], "id", "copies", "rows")
    if drawn.where("rows > 1").take(1):
        found = found.where("rows = 1").union(found.where("rows > 1").dropDuplicates(["row", "id"]))
    return found.select(F.explode(F.array_repeat("record", F.col("copies").cast("int"))).alias("record")).select("record.*")
