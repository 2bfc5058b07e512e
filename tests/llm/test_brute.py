"""The operators against plain versions on small data, round trips and held-out accuracy."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from compare import compare, connect
from rowsmith.llm import cotraining, language, near_dup, pieces, queries, substrings, toxicity, vectors, words
from rowsmith.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r[0]: r[1] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) is None


def test_words_as_by_pattern(texts):
    some = [*texts.values()][:50] + [None, "", " \x0b\x0c\r\n", "a\x00b  c\x85d", "é ü" * 3]
    w = words.words_of(pa.array(some))
    raw = w.data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(w.start[i:j], w.end[i:j])] for i, j in zip(w.first[:-1], w.first[1:])]
    assert got == [WORD.findall(t or "") for t in some]
    flat = [x for t in got for x in t]
    assert len(set(zip(flat, w.hash.tolist()))) == len(set(flat)) == len(set(w.hash.tolist()))


def edited(text, rng, share):
    w = text.split()
    for i in rng.choice(len(w), max(1, int(len(w) * share)), replace=False):
        w[i] = w[i] + "x"
    return " ".join(w)


def test_near_duplicates_as_by_all_pairs(spark):
    rng = np.random.default_rng(2)
    docs, n = [], 0
    for g in range(12):
        base = " ".join(f"{g}w{x}" for x in rng.integers(0, 400, 120))
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1):
            docs.append((n, edited(base, rng, share) if share else base))
            n += 1
    passage = " ".join(f"common{i}" for i in range(60))
    docs += [(n + i, passage + " " + " ".join(f"own{i}x{j}" for j in range(50))) for i in range(60)]
    labels = {}
    for i, text in docs:
        found = near_dup.labelled_shingles(words.words_of(pa.array([text])))[0]
        labels[i] = (found >> np.uint64(32)).astype(np.uint32)
    root = {i: i for i, _ in docs}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, _ in docs:
        for j, _ in docs[:i]:
            if near_dup.aligned(labels[i], labels[j]) > 0:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    got = {r["id"]: r["class_id"] for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: top(i) for i, _ in docs}


def test_short_near_duplicates_as_by_all_pairs(spark):
    docs = []
    for n in range(5, 30):
        for g in range(4):
            w = [f"n{n}g{g}w{i}" for i in range(n)]
            kinds = [w, w[1:], w[:-1], w[1:-1], w[2:], w[:-2], [*w, "end"], ["begin", *w], [*w[:-1], "other"], ["other", *w[1:]], w[3:], [*w, w[0]],
                     [*w[: n // 2], "middle", *w[n // 2 :]], w[n // 2 :] + w[: n // 2]]
            docs += [" ".join(x) for x in kinds if g < 3] or [" ".join(w), " ".join(w[1:])]
    docs = [(i, x) for i, x in enumerate(docs)]
    labels = [(near_dup.labelled_shingles(words.words_of(pa.array([x])))[0] >> np.uint64(32)).astype(np.uint32) for _, x in docs]
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    met = [{*near_dup.picks(near_dup.labelled_shingles(words.words_of(pa.array([x])))[0], words.mix(np.arange(1, 21, dtype=np.uint64))).tolist()} for _, x in docs]
    pairs = 0
    for i in range(len(docs)):
        for j in range(max(0, i - 40), i):
            if near_dup.aligned(labels[i], labels[j]) > 0:
                pairs += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
                assert met[i] & met[j] or docs[i][1] == docs[j][1] or min(len(labels[i]), len(labels[j])) > near_dup.SHORT
    assert pairs > 500
    got = {r["id"]: r["class_id"] for r in near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: top(i) for i, _ in docs}


def test_alignment_is_the_longest_common_order():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = rng.permutation(60)[: rng.integers(30, 60)].astype(np.uint32)
        b = np.sort(a)[: rng.integers(25, len(a))] if rng.random() < 0.3 else np.delete(a, rng.integers(0, len(a), 3))
        if rng.random() < 0.5:
            i, j = rng.integers(0, len(b), 2)
            b[i], b[j] = b[j], b[i]
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        same = table[-1, -1]
        share = same / (len(a) + len(b) - same)
        assert near_dup.aligned(a, b) == pytest.approx(share if share >= 0.8 else 0.0)


def test_pieces_as_the_model_and_as_one_agenda(texts):
    vocab = pieces.vocabulary(pieces.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    some = [t for t in texts.values() if "▁" not in t][:80] + ["", " ", "a  b", "\x00ü𝄞", "x" * 200 + " " + "ab" * 100]
    keys = np.arange(len(some)).astype(np.uint64)
    ids, first = pieces.encode_texts(pa.array(some), keys, vocab, 0.0, 7, 16)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [model.encode(t) for t in some]
    ids, first = pieces.encode_texts(pa.array(some), keys, vocab, 0.2, 7, 16)
    assert [x.decode() for x in pieces.decode_ids(ids, first, vocab)] == some
    again, _ = pieces.encode_texts(pa.array(some), keys, vocab, 0.2, 7, 16, pieces.Known())
    assert (ids == again).all()
    other, _ = pieces.encode_texts(pa.array(some), keys, vocab, 0.2, 8, 16)
    assert len(ids) != len(other) or (ids != other).any()
    chunk = [vocab.symbol[np.frombuffer((" " + w).encode("utf-32-le"), "<u4")] for w in some[3].split()[:100]]
    grid = np.full((len(chunk), max(map(len, chunk))), -1, np.int32)
    for i, c in enumerate(chunk):
        grid[i, : len(c)] = c
    draw = words.mix(np.arange(len(chunk)).astype(np.uint64))
    many = pieces.merge_many(grid.copy(), draw, vocab, 0.3)
    assert [m[m != -1].tolist() for m in many] == [pieces.merge_agenda(c.tolist(), d, vocab, 0.3) for c, d in zip(chunk, draw)]


def test_occurrences_vary_and_share_draws():
    vocab = pieces.vocabulary(pieces.MODEL)
    ids, first = pieces.encode_texts(pa.array(["international " * 400]), np.array([5], np.uint64), vocab, 0.3, 1, 16)
    starts = np.flatnonzero(np.isin(ids, [i for i in range(vocab.size) if vocab.text[vocab.text_start[i]] == 0x20 and vocab.text_size[i]]))
    kinds = {tuple(x) for x in np.split(ids, starts[1:])}
    assert 3 < len(kinds) <= 18


def test_base_counts_as_by_loops(spark, small, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_tokenizer_fertility"](spark, small).collect()}
    for i, text in texts.items():
        w = WORD.findall(text)
        grams = collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        repeated = {j + k for j in range(len(w) - 4) if grams[tuple(w[j : j + 5])] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)
        assert tuple(got[i][c] for c in "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()) == want
        assert not (failed and got[i]["kept"])


def test_fertility_of_rare_languages(spark):
    from rowsmith.llm.fertility import fertility_rules

    rng = np.random.default_rng(5)
    letters = {"en": "abcdefghijklmnoprstuw", "ru": "абвгдежзиклмнопрстуя", "el": "αβγδεζηθικλμνοπρστυ"}
    text = lambda c: " ".join("".join(rng.choice([*letters[c]], rng.integers(3, 9))) for _ in range(60))
    rare = [(i, text(c), c) for i, c in enumerate(["ru"] * 150 + ["el"] * 15)]
    most = [(1000 + i, text("en"), "en") for i in range(300)]
    for some in (rare, rare[100:], rare[135:], rare[149:]):
        docs = spark.createDataFrame(some + most, "doc_id long, text string, lang string")
        got = fertility_rules(docs).select("record.doc_id", "record.lang", "kept").collect()
        assert all(r["kept"] for r in got if r["lang"] != "en") and sum(r["kept"] for r in got) > 0.98 * len(got)
    broken = (5000, "ab cd " + " ".join("".join(rng.choice([*"𐍈𐍉𝄞𝄢𝄫"], 6)) for _ in range(40)), "en")
    docs = spark.createDataFrame([*rare, *most, broken], "doc_id long, text string, lang string")
    assert not fertility_rules(docs).where("record.doc_id = 5000").first()["kept"]


def test_fertility_against_quality_labels(spark, sf):
    got = queries.QUERIES["op4_tokenizer_fertility"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    sound = got.where("not base_failed").groupBy("quality").agg({"kept": "count"}).count()
    good = got.where("not base_failed and quality = 1")
    assert sound and good.where("kept").count() > 0.98 * good.count()


def test_shards_are_rerun_alike(spark, small):
    once = {(r["doc_id"], r["shard"], r["slot"]) for r in queries.QUERIES["op5_external_shuffle"](spark, small).collect()}
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in queries.QUERIES["op5_external_shuffle"](spark, small).collect()}
    assert once == again
    ids = [i for i, s, _ in sorted(once, key=lambda x: (x[1], x[2]))]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.3


def test_shard_files(spark, small, tmp_path):
    from rowsmith.llm.sharding import external_shuffle, write_shards

    docs = spark.read.parquet(f"{small}/documents.parquet")
    path = write_shards(external_shuffle(docs, shards=7, bucket_bytes=20_000), str(tmp_path / "shards"))
    back = spark.read.parquet(path)
    assert back.select("shard").distinct().count() == 7
    assert back.select("record.*").exceptAll(docs).count() == 0 and back.count() == docs.count()


def test_smallest_window():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 20, 500).astype(np.uint64)
    for width in (1, 2, 3, 7, 15):
        got = substrings.leftmost_smallest(x, width)
        assert got.tolist() == [i + int(np.argmin(x[i : i + width])) for i in range(len(x) - width + 1)]


def test_repeats_across_tasks_and_flushes(spark, monkeypatch):
    passage = [f"p{i}" for i in range(64)]
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(i % 7)] + passage[i % 5 : 40 + i % 20] + [f"b{i}x{j}" for j in range(9)])) for i in range(300)]
    rows.append((1000, " ".join(passage * 3)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["record"]["doc_id"]: r["n_removed"] for r in substrings.drop_repeats(df).collect()}
    seen, want = set(), {}
    for i, text in rows:
        w, gone = text.split(), set()
        for s in range(len(w) - 19):
            window = tuple(w[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        want[i] = len(gone)
    assert got == want


def test_windows_that_agree_in_half_a_hash(spark):
    line = [f"line{i}" for i in range(19)]
    texts = pa.array([" ".join([*line, f"own{i}"]) for i in range(400_000)])
    w = words.words_of(texts)
    hashes, inside = words.window_hashes(w, 20)
    half = hashes[np.flatnonzero(inside)] >> np.uint64(32)
    order = np.argsort(half, kind="stable")
    at = np.flatnonzero(half[order][1:] == half[order][:-1])
    picked = sorted({int(i) for a in at for i in order[a : a + 2]})
    assert len(picked) >= 4
    rows = [(i, texts[i].as_py()) for i in picked]
    got = substrings.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["n_removed"] for r in got] == [0] * len(rows)


def test_windows_of_a_hot_anchor_spread(spark):
    line = [f"line{i}" for i in range(12)]
    own = lambda i, n: [f"own{i}x{j}" for j in range(n)]
    rows = [(i, " ".join(own(i % 150, 15) + line + own(i % 200, 15) + own(i, 25))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    base = df.selectExpr("doc_id AS d", "0L AS t", "text")
    hot = substrings.hot_anchors(base, 6, 20, 60)
    assert len(hot)
    most = []
    for some in (hot[:0], hot):
        seeds = base.mapInArrow(substrings._seeds(6, 20, 40, some), substrings._SEEDS).toArrow()
        sizes = collections.Counter()
        for task, content in zip(seeds["task"].to_pylist(), seeds["content"].to_pylist()):
            sizes[task] += len(content) // 8
        most.append(max(sizes.values()) / np.mean([*sizes.values()]))
    assert most[0] > 3 and most[1] < 2
    seen, want = set(), {}
    for i, text in rows:
        w, gone = text.split(), set()
        for s in range(len(w) - 19):
            window = tuple(w[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        want[i] = len(gone)
    assert any(want.values())
    for runs in (0, 60, substrings.HOT_RUNS):
        assert {r["record"]["doc_id"]: r["n_removed"] for r in substrings.drop_repeats(df, hot_runs=runs).collect()} == want


def test_posteriors_as_by_one_sequence():
    rng = np.random.default_rng(1)
    first = np.concatenate([[0], np.cumsum([0, 1, 63, 64, 65, 200, 0, 129])])
    score, change = rng.normal(size=(first[-1], 3)) * 2, rng.normal(size=(3, 3))
    got = language.posteriors(score, change, first)
    t = np.exp(change)
    for a, b in zip(first[:-1], first[1:]):
        e, forward, now = np.exp(score[a:b]), [], np.ones(3) / 3
        for x in e:
            now = (now @ t) * x
            now /= now.sum()
            forward.append(now)
        back = np.ones(3)
        for i in range(b - a - 1, -1, -1):
            p = forward[i] * back
            assert np.allclose(got[a + i], p / p.sum())
            back = t @ (e[i] * back)
            back /= back.sum()


def test_language_of_switching_words(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    field = language.fit(docs, F.col("doc_id") % 2 == 0)
    some = {c: docs.where(f"lang = '{c}' and doc_id % 2 = 1 and n_chars > 500").orderBy("doc_id").first()["text"].split()[:30] for c in ("en", "de")}
    p = language.posteriors(*_scores(field, " ".join(some["en"] + some["de"])))
    en, de = field.languages.index("en"), field.languages.index("de")
    n = len(p)
    assert p[: n // 3, en].mean() > 0.9 and p[-n // 3 :, de].mean() > 0.9


def _scores(field, text):
    w = words.words_of(pa.array([text.lower()]), language._LETTERS)
    _, pick, of = np.unique(w.hash, return_index=True, return_inverse=True)
    return language.emissions(field, w, pick)[of], field.change, w.first


def test_held_out_language(spark, sf):
    got = queries.QUERIES["op8_crf_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_held_out_toxicity(spark, sf):
    got = queries.QUERIES["op3_char_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    clean = got.where("held_out and toxic = 0")
    assert clean.where("predicted = 0").count() >= 0.95 * clean.count()
    auc(got.where("held_out").select("score", "toxic").collect(), 0.75)


def test_held_out_quality(spark, sf):
    got = queries.QUERIES["op9_cotrained_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    auc(got.where("held_out").select("score", "quality").collect(), 0.95)


def auc(rows, least):
    high, low = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low]) >= least


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(50)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}


@pytest.mark.parametrize("shard_rows", [100_000, 150])
def test_vectors_as_by_all_pairs(spark, shard_rows):
    rng = np.random.default_rng(6)
    rows, n = [], 0
    for label in (0, 1):
        for g in range(40):
            centre = rng.normal(size=32)
            for _ in range(int(rng.integers(1, 12)) if g else 200):
                v = centre + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.2, 0.3])
                rows.append((n, [float(np.float32(x)) for x in v], label))
                n += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["record"]["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(df, shard_rows=shard_rows, block_rows=90).collect()}
    x, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    found, true = sum(a for a, _ in got.values()), int(near.sum())
    assert 0.99 * true <= found <= true
    top = np.arange(n)
    for _ in range(n):
        new = np.array([min(top[i], top[near[i]].min(initial=n)) for i in range(n)])
        if (new == top).all():
            break
        top = new
    assert sum(got[i][1] == top[i] for i in range(n)) >= 0.99 * n


def test_registered(spark):
    import __spark_entry__ as e

    names = list(e.queries())
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1
    assert "pipeline" in names and set(e.oracle_sql()) <= set(names)


def test_pipeline_keeps_clean_documents(spark, sf, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    left = p.drop_toxic(spark, docs, sf)
    clean = labels.where("toxic = 0").join(docs, "doc_id")
    assert clean.join(left, "doc_id", "left_semi").count() >= 0.97 * clean.count()
    left.write.parquet(str(tmp_path / "1"))
    left = spark.read.parquet(str(tmp_path / "1"))
    once = p.drop_near_duplicates(spark, left, sf)
    assert left.select("text").distinct().count() >= once.count() == once.select("text").distinct().count()
    once.write.parquet(str(tmp_path / "2"))
    once = spark.read.parquet(str(tmp_path / "2"))
    cut = {r["doc_id"]: r["text"] for r in p.cut_repeats(spark, once, sf).collect()}
    seen = set()
    for i, text in sorted((r["doc_id"], r["text"]) for r in once.collect()):
        w, gone = text.split(), set()
        for s in range(len(w) - 19):
            window = tuple(w[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        rest = [x for k, x in enumerate(w) if k not in gone]
        assert cut.get(i, "").split() == rest and (i in cut) == bool(rest or not w)


def test_rare_language_is_learned(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    russian = "Сегодня вечером мы читали старую книгу о реке и о людях которые жили на её берегу много лет назад "
    words = russian.split()
    rare = [(10_000_000 + i, " ".join(words[i:] + words[:i]) * 3, "ru") for i in range(4)]
    docs = docs.unionByName(spark.createDataFrame(rare, docs.schema))
    field = language.fit(docs, (F.col("doc_id") < 10_000_000) | (F.col("doc_id") % 2 == 0))
    got = language.label_languages(docs.where("doc_id >= 10000000"), field).collect()
    assert [r["lang_pred"] for r in got] == ["ru"] * 4


def test_language_quotas():
    assert language.quotas({"a": 10_000, "b": 2}, 1500) == {"a": 1498, "b": 2}
    assert language.quotas({"a": 500, "b": 500, "c": 500}, 300) == {"a": 100, "b": 100, "c": 100}
    assert language.quotas({"a": 3, "b": 1}, 1500) == {"a": 3, "b": 1}


def test_repeated_labelled_key_is_one_row(spark):
    docs = spark.range(3000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    labels = spark.createDataFrame([(7, 0), (7, 1)], "doc_id int, toxic int")
    rows = toxicity.labelled_sample(docs, labels, "toxic", F.lit(True), 10, "doc_id", "text").collect()
    assert [(r["text"], r["label"]) for r in rows] == [("t999", 1)]


def test_every_sure_document_counts(spark):
    rng = np.random.default_rng(4)
    n = 3000
    t, p = rng.normal(size=(n, 3)).astype(np.float32), rng.normal(size=(n, 2)).astype(np.float32)
    text, page = (cotraining.Linear(np.zeros(k), np.ones(k), 3 * rng.normal(size=k), 0.1) for k in (3, 2))
    model = cotraining.Model(text, page, (1.0, 0.0), (1.0, 0.0), 0.0)
    rows = [(a.tolist(), b.tolist()) for a, b in zip(t, p)]
    seen = spark.createDataFrame(rows, "text_view array<float>, page_view array<float>").repartition(7)
    got = cotraining.sure_sums(seen, model, [text, page])
    by_text, by_page, _ = model.scores(t.astype(float), p.astype(float))
    for side, x, sure, linear in ((0, t, by_page, text), (1, p, by_text, page)):
        for label, some in ((1, sure >= cotraining.SURE), (0, sure <= 1 - cotraining.SURE)):
            count, slope, bend = got[side, label]
            want_slope, want_bend = np.zeros(x.shape[1] + 1), np.zeros((x.shape[1] + 1,) * 2)
            for row in x[some].astype(float):
                z = np.append(row, 1.0)
                q = 1 / (1 + np.exp(-(row @ linear.weight + linear.bias)))
                want_slope += (q - label) * z
                want_bend += q * (1 - q) * np.outer(z, z)
            assert count == some.sum() > 0
            assert np.allclose(slope, want_slope) and np.allclose(bend, want_bend)


def test_newton_steps_reach_the_optimum():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=400) > 0).astype(float)
    linear = cotraining.Linear(np.zeros(3), np.ones(3), np.zeros(3), 0.0)
    for _ in range(12):
        linear = cotraining.learned(linear, x, y, {})
    slope, _ = cotraining.newton_sums(x, y, linear)
    assert np.abs(slope + np.append(linear.weight, 1e-6 * linear.bias)).max() < 1e-8
