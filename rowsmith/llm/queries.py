"""Registered queries of the text operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsmith.llm import cotraining, language, pieces, toxicity, whitening
from rowsmith.llm.common import WORD, text_bytes
from rowsmith.llm.fertility import MEASURES, fertility_rules
from rowsmith.llm.lines import drop_lines
from rowsmith.llm.mixing import mix_plan
from rowsmith.llm.near_dup import near_duplicates
from rowsmith.llm.periodic import periodic_runs
from rowsmith.llm.sharding import external_shuffle
from rowsmith.llm.substrings import drop_repeats
from rowsmith.llm.vectors import near_vectors
from rowsmith.sources.tables import table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op5_external_shuffle")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in 40 shards of equal row counts, in seeded random order."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    text = F.col("record.text")
    return external_shuffle(docs, shards=40).select(
        F.col("record.doc_id").alias("doc_id"),
        (text_bytes(text) + 16).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op7_systematic_mix",
    """
    WITH sized AS (
        SELECT doc_id, source, size, CAST(floor(sqrt(size)) AS BIGINT) AS step, md5('17:' || doc_id) AS mark
        FROM (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
              FROM documents)),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS BIGINT) AS weight
        FROM sized GROUP BY source),
    levels AS (
        SELECT *, 3 * source_size AS cap, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
               sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
        FROM sources
        WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source ASC NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    open AS (
        SELECT rest, left_weight FROM levels WHERE NOT cap * left_weight < weight * rest
        ORDER BY CAST(cap AS DOUBLE) / weight, rest DESC, left_weight DESC LIMIT 1),
    targets AS (
        SELECT l.source, l.source_size,
               CASE WHEN cap * l.left_weight < weight * l.rest THEN CAST(cap AS DOUBLE)
                    ELSE CAST(CAST(weight * o.rest AS BIGINT) AS DOUBLE) / CAST(o.left_weight AS BIGINT) END AS target
        FROM levels l, open o),
    blocks AS (SELECT source, step, CAST(ceil(count(*) / 500.0) AS BIGINT) AS n FROM sized GROUP BY ALL),
    ordered AS (
        SELECT s.*, row_number() OVER (PARTITION BY s.source ORDER BY s.step,
                        CAST('0x' || substr(mark, 1, 8) AS BIGINT) % b.n, size, mark, doc_id) AS pos
        FROM sized s JOIN blocks b ON s.source IS NOT DISTINCT FROM b.source AND s.step = b.step),
    rated AS (
        SELECT o.*, source_size, target, target / nullif(source_size, 0) AS rate,
               CAST(CAST('0x' || substr(md5('17:' || coalesce(o.source, '\\N')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS shift
        FROM ordered o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CAST(size * least(coalesce(floor(pos * rate + shift) - floor((pos - 1) * rate + shift), 0), 3) AS BIGINT) AS taken
    FROM rated
    """,
)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of each document the mixture of all sources takes."""
    plan = mix_plan(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return plan.select(
        F.col("record.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query(
    "op6_drop_repeats",
    """
    WITH texts AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS seq
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM texts)),
    later AS (
        SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
    gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS i FROM later),
    words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM texts),
    kept AS (
        SELECT w.doc_id, count(g.i) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY w.i) FILTER (g.i IS NULL), '') AS body
        FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
    SELECT t.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(body, '')) AS kept_sha256
    FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
    """,
)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the 20-word windows that occur earlier."""
    kept = drop_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("kept_text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select(F.col("record.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


@query("op1_order_minhash")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """The near-duplicate class of every document; its smallest document stays."""
    found = near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", (F.col("id") == F.col("class_id")).alias("kept"), "n_words")


def _remainder(key: str, of: int):
    """crc32 of the key as text, modulo ``of``: what the folds are cut by."""
    return F.crc32(F.col(key).cast("string")) % of


@query("op3_char_toxicity")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document; the fold with remainder 2 is never learned from."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"), _remainder("doc_id", 4) != 2)
    return toxicity.score(docs, model).select(
        F.col("record.doc_id").alias("doc_id"),
        (_remainder("record.doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op2_merge_dropout")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as piece ids under merge dropout, and whether decoding gives the text back."""
    encoded = pieces.encode(table(spark, sf, "documents").select("doc_id", "text"))
    return pieces.decode(encoded).select(
        F.col("record.doc_id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_pieces"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
        "ids",
    )


@query("op4_tokenizer_fertility")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """Base counts and the verdict of the fertility bands on every document."""
    judged = fertility_rules(table(spark, sf, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        F.col("record.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", *[F.round(m, 6).alias(m) for m in MEASURES],
    )


@query("op8_crf_language")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; the fold with remainder 1 is never learned from."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    field = language.fit(docs, _remainder("doc_id", 3) != 1)
    return language.label_languages(docs.select("doc_id", "text"), field).select(
        F.col("record.doc_id").alias("doc_id"), (_remainder("record.doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query(
    "op10_hnsw_vectors",
    """
    WITH RECURSIVE sound AS (
        SELECT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings WHERE label IS NOT NULL)
        GROUP BY 1 HAVING count(*) = count(x) AND bool_and(isfinite(x)) AND bool_or(x <> 0)),
    v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings JOIN sound USING (vec_id)),
    linked AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a),
    roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY 1),
    counts AS (SELECT a AS vec_id, count(*) AS n FROM linked GROUP BY 1)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN roots r ON e.vec_id = r.vec_id LEFT JOIN counts c ON e.vec_id = c.vec_id
    """,
)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    found = near_vectors(table(spark, sf, "embeddings"))
    return found.select(F.col("record.vec_id").alias("vec_id"), "n_links", "component_id", "kept")


@query("op9_cotrained_quality")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document; the fold with remainder 3 is never learned from."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf, "labels")
    found = cotraining.quality(docs, table(spark, sf, "pages"), labels, _remainder("doc_id", 4) != 3)
    return found.select(
        F.col("record.doc_id").alias("doc_id"), (_remainder("record.doc_id", 4) == 3).alias("held_out"),
        F.round("text_score", 9).alias("text_score"), F.round("page_score", 9).alias("page_score"),
        F.round("score", 9).alias("score"), (F.col("score") >= 0.5).alias("kept"))


@query(
    "op12_line_bitmaps",
    """
    WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    numbered AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM texts),
    lines AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM numbered),
    spread AS (
        SELECT k, max(doc_id) AS top FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
    judged AS (SELECT l.*, top IS NOT NULL AND doc_id <> top AS gone FROM lines l LEFT JOIN spread s ON l.k = s.k)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the lines that five documents or more hold."""
    kept = drop_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select(F.col("record.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query("op13_jacobi_davidson")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """Every sound vector on up to 32 whitened principal components, one row per vector and component."""
    rows = table(spark, sf, "embeddings").select("vec_id", whitening.grid_vector(F.col("embedding")).alias("x"))
    models = whitening.fit(rows)
    facts = F.create_map(*[x for m in models for x in (F.lit(m.dim), F.struct(
        F.lit(m.n).cast("bigint").alias("n"), F.lit(m.identity_error).alias("error"),
        F.array(*[F.lit(float(e / m.trace)) for e in m.values]).cast("array<double>").alias("shares")))]) if models else F.lit(None).cast(
        "map<int,struct<n:bigint,error:double,shares:array<double>>>")
    found = whitening.whiten(rows, models).withColumn("fact", F.element_at(facts, F.col("dim")))
    return found.select("record", "deviation", "fact", F.posexplode("whitened").alias("pos", "whitened")).select(
        F.col("record.vec_id").alias("vec_id"), (F.col("pos") + 1).cast("int").alias("component"), F.col("fact.n").alias("n"),
        F.col("deviation").cast("bigint").alias("deviation"), "whitened",
        F.col("fact.shares")[F.col("pos")].alias("explained"), F.col("fact.error").alias("identity_error"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with the tail of some texts made periodic: where h = crc32(key) ends in 0, words from a on repeat those
    from a to a + p, with g = h div 10, a = g mod n, p = 1 + (n - a) div (3 + g mod 8) and n words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.withColumn("ws", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n, g = F.coalesce(F.size("ws"), F.lit(0)), F.floor(h / 10)
    words = words.withColumn("n", n).withColumn("a", (g % F.greatest(F.col("n"), F.lit(1))).cast("int"))
    words = words.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("ws", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("ws", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), rest)), " ")
    return words.withColumn("text", F.when(F.col("n") > 0, made).otherwise(F.col("text"))).select(*docs.columns)


@query("op11_recompression_runs")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of four periods and more in every document, the longest of them, and what is left without repetitions."""
    found = periodic_runs(with_periods(table(spark, sf, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("top", longest).select(
        F.col("record.doc_id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.floor(F.expr("1000 * top.length div -top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
