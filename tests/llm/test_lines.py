"""Line removal against a plain loop, on ranges that cut through keys and on odd rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import lines

BLANKS = " \t\n\x0b\x0c\r"
HOT = "This very common line stands in nearly every document of the table"


def brute(rows, chars=40, documents=5):
    """rows: (key, text) with distinct keys or repeated rows."""
    ident = [k if k is not None else f"text {t}" for k, t in rows]
    order = {k: (0, k) if isinstance(k, str) else (1, k) for k in ident}
    holders = defaultdict(set)
    split = [(t or "").split("\n") for _, t in rows]

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    for k, ls in zip(ident, split):
        for line in ls:
            if len(key(line)) >= chars:
                holders[key(line)].add(k)
    out = []
    for (given, text), k, ls in zip(rows, ident, split):
        gone = [len(holders[key(x)]) >= documents and k != max(holders[key(x)], key=order.get) if key(x) in holders else False for x in ls]
        out.append((given, len(ls), sum(gone), None if text is None else "\n".join(x for x, g in zip(ls, gone) if not g)))
    return sorted(out, key=repr)


def made(seed, n=400):
    rng = random.Random(seed)
    shared = [f"Shared line number {i} that is certainly long enough ü" for i in range(30)]
    rows = []
    for d in range(n):
        ls = [rng.choice(shared) for _ in range(rng.randrange(4))]
        ls += ["".join(rng.choice("ab ") for _ in range(45)) for _ in range(2)] + ["short line"] * rng.randrange(3)
        if rng.random() < 0.7:
            ls += [rng.choice(["", " ", "\t\r"]) + (HOT if rng.random() < 0.5 else HOT.upper()) + rng.choice(["", "\x0b ", "\r"])] * rng.randrange(1, 3)
        rng.shuffle(ls)
        rows.append((d, "\n".join(ls)))
    # Four and five holders; 39 and 40 code points; a non-ASCII blank and letter that are no blank and stay as they are.
    for d in range(5):
        rows.append((1000 + d, "\n".join(["x" * 40, "y" * 39, "é" * 20, ("Ä" if d % 2 else "ä") * 40, " " * (d % 2) + "z" * 40])))
    for d in range(4):
        rows.append((2000 + d, "v" * 50))
    return rows


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_lines_as_by_loops(spark, partitions):
    rows = made(int(partitions))
    rows += [(5000, None), (5001, ""), (5002, "\n\n"), (None, HOT + "\nno key"), (None, HOT + "\nno key"), rows[7], rows[7]]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).withColumn("record", F.lit(1)).withColumn("lines", F.lit(2))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = [(r.record.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in lines.drop_lines(docs).collect()]
        maps = lines.line_bitmaps(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert sorted(got, key=repr) == brute(rows)
    assert sorted([(r.record.doc_id, r.n_lines, r.n_dropped) for r in maps], key=repr) == sorted([x[:3] for x in brute(rows)], key=repr)
    assert all(r.n_dropped == r.n_lines - lines.kept_lines(r.n_lines, r.keep).sum() for r in maps)
    assert sum(r.n_dropped for r in maps) > 500
    texts, want = dict(rows), {k: t for k, _, _, t in brute(rows)}
    for r in maps:
        k = r.record.doc_id
        if k is not None and texts[k] is not None:
            keep = lines.kept_lines(r.n_lines, r.keep)
            assert "\n".join(x for x, y in zip(texts[k].split("\n"), keep) if y) == want[k]


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.drop_lines(empty).collect() == [] and lines.line_bitmaps(empty).collect() == []


def test_known_drops_of_a_stretch(spark):
    """A task passes a hot key's largest documents on and marks the others at once, whatever the length of its stretches."""
    import pyarrow as pa

    texts = pa.array([HOT] * 50)
    batch = pa.record_batch([pa.array(range(50)), pa.array([0] * 50), texts], names=["d", "t", "text"])
    out = pa.Table.from_batches(list(lines._found(40, 5)(iter([batch])))).to_pylist()
    assert [r["d"] for r in out if not r["known"]] == [49, 48, 47, 46, 45] and len(out) == 50
