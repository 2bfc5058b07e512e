"""Periodic runs against a search of all periods, and extensions against a comparison word by word."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import periodic, queries
from rowsmith.llm.words import words_of
from rowsmith.sources.tables import table


def brute(ws):
    """(start, length, period) of all runs, by stretches of equal words q apart."""
    n, best = len(ws), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapsed(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def made(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(200))]
    if kind == 1:
        return ["x"] * rng.randrange(300)
    ws = []
    for _ in range(rng.randrange(1, 6)):
        unit = [rng.choice("abcd" if kind < 4 else [f"w{i}" for i in range(500)]) for _ in range(rng.randrange(1, 30))]
        ws += (unit * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        if kind == 5:  # runs of runs
            ws = ws * rng.randrange(1, 6)
    return ws[:3000]


def test_runs_as_by_all_periods():
    rng = random.Random(5)
    texts = [made(rng) for _ in range(400)]
    row, start, length, period = periodic.runs_of(words_of(pa.array([" ".join(t) for t in texts])))
    got = [[] for _ in texts]
    for r, *run in zip(row, start.tolist(), length.tolist(), period.tolist()):
        got[r].append(tuple(run))
    want = [brute(t) for t in texts]
    assert got == want and sum(len(w) > 1 for w in want) > 50


@pytest.mark.parametrize("letters", [1, 2, 5, 1000])
def test_extensions_as_word_by_word(letters):
    rng = np.random.default_rng(letters)
    part = rng.integers(0, letters, 300)
    s = np.concatenate([[-1], part, part[:100], part, np.repeat(part[:40], rng.integers(1, 9, 40)), [-2]])
    levels = periodic.recompressed(s)
    a = rng.integers(1, len(s) - 1, 2000)
    b = rng.integers(1, len(s) - 1, 2000)
    a, b = a[a != b], b[a != b]
    ahead, back = (periodic.common_extension(levels, a, b, w).tolist() for w in (True, False))
    for i, j, n, m in zip(a.tolist(), b.tolist(), ahead, back):
        k = 0
        while max(i, j) + k < len(s) and s[i + k] == s[j + k]:
            k += 1
        assert k == n
        k = 0
        while min(i, j) - k >= 0 and s[i - k] == s[j - k]:
            k += 1
        assert k == m


def test_long_texts():
    """Sections, long blocks and large periods: texts of 150 000 words, whose runs are known."""
    n = 150_000
    same = ["a"] * n
    cycle = [f"w{i % 20_011}" for i in range(n)]
    fibonacci = ["a"], ["a", "b"]
    while len(fibonacci[1]) < n:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    words = words_of(pa.array([" ".join(same), " ".join(cycle), " ".join(fibonacci[1][:n])]))
    row, start, length, period = periodic.runs_of(words)
    assert list(zip(row, start, length, period)) == [(0, 0, n, 1), (1, 0, n, 20_011)]  # its exponents stay below 4


def planted(key, ws):
    h = zlib.crc32(str(key).encode())
    n, g = len(ws), h // 10
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def test_query_as_by_loops(spark, small):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_recompression_runs"](spark, small).collect()}
    docs = table(spark, small, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for doc in docs:
        ws = planted(doc.doc_id, [w.decode() for w in (doc.text or "").encode().split()])
        if len(ws) > 3000:
            continue
        runs, r = brute(ws), rows[doc.doc_id]
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(ws, runs))
        some += bool(runs)
    assert some > 10


def test_odd_rows(spark, tmp_path):
    key = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    rows = [(key, None), (key, ""), (key, " \n\t"), (key, "solo"), (None, "a b " * 9), (None, "a b " * 9), (200, "ü\x85v w " * 8 + "\x00"), (201, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("record", F.lit(1)).withColumn("n_words", F.lit(2)).withColumn("ws", F.lit(3))
    got = periodic.periodic_runs(docs).collect()
    assert [(r.n_words, len(r.runs)) for r in got] == [(0, 0), (0, 0), (0, 0), (1, 0), (18, 1), (18, 1), (9, 1), (1, 0)]
    assert got[4].collapsed == "a b" and got[6].collapsed == "ü\x85v w \x00" and got[0].collapsed == ""
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op11_recompression_runs"](spark, str(tmp_path)).collect()
    assert len(out) == 8 and all(r.runs_sha256 and r.collapsed_sha256 for r in out)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def chance(n=40, q=10):
    """Two texts without runs: the last word of one comes again one, two and three periods on in the other, and so do the halves."""
    first, second = [f"a{i}" for i in range(n)], [f"b{i}" for i in range(n)]
    first[-1] = "x"
    for i in (1, 2, 3):
        second[i * q - 2], second[i * q - q // 2 - 2] = "x", "y"
    return first, second


def test_words_that_agree_over_two_texts_are_no_candidates():
    first, second = chance()
    row, *_ = periodic.runs_of(words_of(pa.array([" ".join(first), " ".join(second)])))
    assert len(row) == 0


def test_chain_that_begins_in_the_text_before_loses_no_run():
    last = [f"w{i % 10}" for i in range(40)]
    for at in range(40):
        first = [f"a{i}" for i in range(40)]
        first[at] = last[8]
        runs = periodic.runs_of(words_of(pa.array([" ".join(first), " ".join(last), " ".join(last)])))
        assert [v.tolist() for v in runs] == [[1, 2], [0, 0], [40, 40], [10, 10]]
