"""From raw documents to encoded training text.

Toxic documents go, one document of each near-duplicate class stays, repeated passages are cut, sources are mixed to
their target weights, and what is left is encoded. Every stage reads what the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.llm import mixing, near_dup, pieces, substrings, toxicity
from rowsmith.session import discard, materialise, written_since
from rowsmith.sources.tables import table

REJECT = 0.3  # toxicity from which a document goes


def _same_columns(rows: DataFrame, like: DataFrame, changed: dict) -> DataFrame:
    """The columns of ``like`` from ``record``, with some replaced."""
    return rows.select(*[
        (changed[c] if c in changed else F.col(f"record.`{c}`")).cast(f.dataType).alias(c) for c, f in zip(like.columns, like.schema.fields)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labels of the input; null and empty texts get the base rate and stay."""
    learned = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learned)
    scored = toxicity.score(docs, model).where(F.col("score") < REJECT)
    return _same_columns(scored, docs, {"text": F.col("text")})


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that consist of repeats only go; ``n_chars`` follows the remaining text."""
    cut = substrings.drop_repeats(docs).where("n_removed = 0 or n_removed < n_words")
    text = F.col("kept_text")
    size = F.when(F.col("n_removed") == 0, F.col("record.n_chars")).otherwise(F.length(text)) if "n_chars" in docs.columns else None
    return _same_columns(cut, docs, {"text": text} | ({} if size is None else {"n_chars": size}))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes out as often as it was drawn, up to three times."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents without their text, and ``ids`` and ``n_pieces`` (which replace such columns)."""
    found = pieces.encode(docs)
    rest = [c for c in docs.columns if c not in ("text", "ids", "n_pieces")]
    return found.select(*[F.col(f"record.`{c}`").alias(c) for c in rest], "ids", F.size("ids").cast("bigint").alias("n_pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# A fitted classifier and sketches have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again.

    What a stage stores on its way, and the table it read, is deleted once its own table is written. Null and empty
    texts pass all stages (mixing takes them like others), repeated rows come out once after the second stage, and an
    empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = len(written_since())
        earlier = written_since()[-1:] if name != STAGES[0][0] else []
        docs = materialise(stage(spark, docs, sf_dir), name)
        discard(earlier + written_since(before)[:-1])
    return docs
