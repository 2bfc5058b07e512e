"""Every operator and stage on missing values, odd texts, repeated rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowsmith.llm import cotraining, fertility, language, mixing, near_dup, pieces, sharding, substrings, toxicity, vectors

LONG = " ".join(f"w{i % 9973}x{i // 9973}" for i in range(40_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven grey wolves watch from the far side of the old stone bridge"

ROWS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None), (4, "", "en", "b"),
    (5, " \t\n ", None, "b"), (6, LONG, "en", "c"), (7, "solo", "fr", "a"), (None, "no key but words " * 3, "fr", None),
    (8, "\x00 ü 𝄞 ▁ <s> \U0010ffff", "xx", "c"), (9, PROSE.upper(), "en", "b"), (9, "another text of the same key", "en", "b"),
]
NAMES = "record id score shard slot size bucket position ids n_pieces key d t start spans band label of n kept n_words lang_pred found text_view page".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long")).select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i in (7, 9))) for i in range(1, 12)] + [(None, 1, 1), (4, None, None), (2, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(0, "http://a.example.com/en/1", "<p>x"), (1, None, None), (2, "nonsense", ""), (3, "https://m.example.com/de/1.html?x=2#y", "<a <a")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def always():
    return F.lit(True)


OPERATORS = {
    "near_duplicates": lambda d, l, p: near_dup.near_duplicates(d),
    "encode": lambda d, l, p: pieces.decode(pieces.encode(d)),
    "toxicity": lambda d, l, p: toxicity.score(d, toxicity.fit(d, l, always())),
    "fertility": lambda d, l, p: fertility.fertility_rules(d),
    "shuffle": lambda d, l, p: sharding.external_shuffle(d, shards=5),
    "substrings": lambda d, l, p: substrings.drop_repeats(d),
    "mixing": lambda d, l, p: mixing.mix_plan(d),
    "language": lambda d, l, p: language.label_languages(d, language.fit(d, always())),
    "quality": lambda d, l, p: cotraining.quality(d, p, l, always()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(docs, labels, pages, name):
    out = OPERATORS[name](docs, labels, pages)
    assert len(set(out.columns)) == len(out.columns)
    assert len(out.collect()) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, pages, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), pages.limit(0)).collect() == []


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, docs, labels, stage, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    if stage is corpus_pipeline.encode:
        assert "ids" in out.columns and len(rows) == len(ROWS)
    else:
        assert out.schema.simpleString() == docs.schema.simpleString()
    assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_near_duplicates_defined(docs):
    found = {(r["id"], r["class_id"]) for r in near_dup.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6)} <= found
    kept = [r["doc_id"] for r in near_dup.drop_near_duplicates(docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, 5, 6, 7, None, 8, 9], key=str)


def test_encoding_defined(docs):
    for r in pieces.decode(pieces.encode(docs)).collect():
        assert r["decoded"] == (r["text"] or "")
        assert (r["ids"] == []) == (not r["text"])


def test_substrings_defined(docs):
    rows = substrings.drop_repeats(docs).collect()
    by = [(r["record"]["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows]
    n = len(PROSE.split())
    assert (1, n, 0, PROSE) in by and by.count((2, n, n, "")) == 2
    assert (3, 0, 0, None) in by and (4, 0, 0, "") in by and (5, 0, 0, " \t\n ") in by and (6, 40_000, 0, LONG) in by


def test_fertility_defined(docs):
    by = {r["record"]["doc_id"]: r for r in fertility.fertility_rules(docs).collect()}
    assert by[3]["n_words"] == 0 and by[3]["base_failed"] and not by[3]["kept"] and by[3]["piece_chars"] is None
    assert by[1]["kept"] and not by[7]["kept"]


def test_language_defined(docs):
    field = language.fit(docs, always())
    by = {r["record"]["doc_id"]: (r["lang_pred"], r["score"]) for r in language.label_languages(docs, field).collect()}
    assert by[3] == by[4] == by[5] == ("und", 0.0)
    assert by[1][0] == "en" and 0 < by[1][1] <= 1


def test_mixing_defined(docs):
    rows = mixing.mix_plan(docs).collect()
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert {r["size"] for r in rows if r["record"]["doc_id"] in (3, 4, 5)} == {0}


def test_shuffle_defined(docs):
    rows = sharding.external_shuffle(docs, shards=5).collect()
    sizes = [sum(r["shard"] == s for r in rows) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s])) for s in range(5))
    assert sorted(str(r["record"]) for r in rows) == sorted(str(r) for r in docs.collect())


def test_scores_without_features(docs, labels):
    model = toxicity.fit(docs, labels, always())
    by = {r["record"]["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert by[3] == by[4] and all(0 <= s <= 1 for s in by.values())


def test_vectors_defined(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0], 0), (9, [nan, 1.0], 0), (10, [inf, 1.0], 0), (11, [None, 1.0], 0), (12, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0),
        (13, [0.0, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as n_links", "2 as rep", "3 as id", "4 as record")
    out = {r["record"]["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()}
    assert out[1] == (2, 1, True) and out[2] == (2, 1, False) and out[3] == (2, 1, False)
    assert all(out[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13))
    assert out[None][0] == 0
    assert vectors.near_vectors(df.limit(0)).collect() == []
