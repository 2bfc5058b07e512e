"""Near-duplicate documents by Order MinHash and banded alignment.

A text is the sequence of its five-word shingles, each labelled with its occurrence number. Each of ``sketches`` hash
functions picks the ``picks`` smallest labelled shingles and keeps them in text order; two texts that agree on one such
ordered pick are candidates. In a short text picks would seldom agree; it gives ordered triples of its first shingles
by one hash instead, so many that no similar pair is missed. A candidate pair is verified by aligning both sequences inside the band that the threshold
allows; the similarity is aligned shingles over all shingles.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.llm.components import components
from rowsmith.llm.words import Words, mix, slices, span_hashes, window_hashes, words_of
from rowsmith.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 20
PICKS = 5
SHORT = 20  # pairs whose smaller text has at most so many shingles are found without exception
TRIPLE = 3


def labelled_shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles with their occurrence number in the text, and where each text's begin. A text of fewer
    than ``k`` words is one shingle."""
    counts = words.counts
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    hashes = np.zeros(first[-1], np.uint64)
    windows, inside = window_hashes(words, k)
    long = counts >= k
    at = np.flatnonzero(inside)
    row = words.row[at]
    hashes[first[row] + at - words.first[row]] = windows[at]
    short = np.flatnonzero(~long & (counts > 0))
    hashes[first[short]] = span_hashes(words.hash, words.first[short], words.first[short + 1])
    of = np.repeat(np.arange(len(counts)), sizes)
    order = np.lexsort((hashes, of))  # stable: equal shingles stay in text order
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else np.zeros(0, int)
    number = np.empty(len(order), np.uint64)
    number[order] = (np.arange(len(order)) - lead).astype(np.uint64)
    return mix(hashes + number * np.uint64(0xC2B2AE3D27D4EB4F)), first


def order_minhash(labels: np.ndarray, seeds: np.ndarray, picks: int) -> np.ndarray:
    """One value per seed: the ``picks`` labels of smallest keyed hash, in text order."""
    n, out = len(labels), np.empty(len(seeds), np.uint64)
    step = max(1, (1 << 18) // max(n, 1))
    for i in range(0, len(seeds), step):
        part = seeds[i : i + step]
        if n > picks:
            keyed = mix(labels[None, :] ^ part[:, None])
            chosen = np.sort(np.argpartition(keyed, picks - 1, axis=1)[:, :picks], axis=1)
            ordered = labels[chosen]
        else:
            ordered = np.broadcast_to(labels, (len(part), n))
        value = part.copy()
        for j in range(ordered.shape[1]):
            value = mix(value * np.uint64(31) + ordered[:, j])
        out[i : i + step] = value
    return out


@lru_cache(maxsize=64)
def _triples(n: int) -> np.ndarray:
    return np.array([*combinations(range(n), TRIPLE)], np.int64).reshape(-1, TRIPLE)


def short_picks(labels: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """One value per ordered triple of the shingles of smallest hash; similar texts share one for certain.

    A similar text has at least ``need`` of the n shingles in the same order. The three of them of smallest hash are
    among the n - need + 3 smallest of both texts. A text of up to three shingles is similar to its copies only.
    """
    n = len(labels)
    need = int(np.ceil(threshold * n - 1e-6))
    if need < TRIPLE:
        return np.empty(0, np.uint64)
    least = np.sort(np.argsort(mix(labels ^ np.uint64(0xA0761D6478BD642F)), kind="stable")[: n - need + TRIPLE])
    ordered = labels[least][_triples(len(least))]
    value = np.full(len(ordered), 0xE7037ED1A0B428DB, np.uint64)
    for j in range(TRIPLE):
        value = mix(value * np.uint64(31) + ordered[:, j])
    return value


def picks(labels: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All values by which a text meets others."""
    n = len(labels)
    if n <= SHORT:
        return short_picks(labels)
    values = order_minhash(labels, seeds, PICKS)
    return np.concatenate([values, short_picks(labels)]) if n <= SHORT / THRESHOLD + 1e-6 else values


def _sketches(batches):
    seeds = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for batch in slices(batches, "text"):
        words = words_of(batch.column("text"))
        labels, first = labelled_shingles(words)
        low, high = words.first[:-1], words.first[1:]
        keys = [span_hashes(words.hash, low, high), span_hashes(mix(words.hash + np.uint64(77)), low, high)]
        values = [picks(labels[a:b], seeds) for a, b in zip(first[:-1], first[1:])]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int32)
        flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(words.counts),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            names=["id", "k1", "k2", "n_words", "picks"])


def _label_batches(batches):
    for batch in slices(batches, "text"):
        labels, first = labelled_shingles(words_of(batch.column("text")))
        low = (labels >> np.uint64(32)).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([low[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
            names=["id", "labels"])


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Share of shingles aligned in order, within the diagonals that the threshold leaves open; 0.0 below it."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < threshold * max(n, m) - 1e-6:
        return 0.0
    need = threshold * (n + m) / (1 + threshold) - 1e-6
    order = np.argsort(b, kind="stable")
    place = np.searchsorted(b[order], a)
    place[place == m] = 0
    j = order[place]
    i = np.flatnonzero(b[j] == a)
    j = j[i]
    near = np.abs(i - j) <= max(n, m) - need
    j = j[near]
    if len(j) < need:
        return 0.0
    if np.all(j[1:] > j[:-1]):
        same = len(j)
    else:  # longest increasing sequence of positions
        ends: list[int] = []
        for x in j.tolist():
            at = bisect_left(ends, x)
            ends[at : at + 1] = [x]
        same = len(ends)
    share = same / (n + m - same)
    return share if share >= threshold - 1e-9 else 0.0


def _compare(batches):
    """Verdict on each pair, with the size of ``b``, its shingles in ``a`` and those that ``a`` lacks."""
    for batch in batches:
        linked, sizes, common, extra = [], [], [], []
        for x, y in zip(batch.column("left"), batch.column("right")):
            x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
            inside = np.isin(y, x)
            linked.append(aligned(x, y) > 0)
            sizes.append(len(y))
            common.append(int(inside.sum()))
            extra.append(y[~inside].view(np.int32))
        flat = np.concatenate(extra) if extra else np.zeros(0, np.int32)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in extra])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(common, pa.int64()),
             pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))],
            names=["a", "b", "linked", "size", "common", "extra"])


def compared(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) aligned. The side with fewer distinct texts is joined last."""
    left = labels.select(F.col("id").alias("b"), F.col("labels").alias("right"))
    right = labels.select(F.col("id").alias("a"), F.col("labels").alias("left"))
    both = pairs.join(left, "b").join(right, "a").select("a", "b", "left", "right")
    return both.mapInArrow(_compare, "a long, b long, linked boolean, size long, common long, extra array<int>")


def _unseen_pairs(stars: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of one leader's group in different components that can still be similar.

    Let o not be similar to its leader c, and m another member. If o and m are similar, they share a shingle that c
    lacks, or all they share lies in c, which bounds the size of m by what o has in common with c.
    """
    of = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    known = (
        stars.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .withColumn("a_root", F.coalesce("a_root", "a")).withColumn("b_root", F.coalesce("b_root", "b"))
    )
    outside = F.col("a_root") != F.col("b_root")
    divided = known.groupBy("a").agg(F.max(outside).alias("divided"), F.min("size").alias("least")).where("divided")
    known = materialise(known.join(divided.select("a", "least"), "a").drop("linked"), "groups")
    out = known.where(outside)
    keyed = known.select("a", F.explode("extra").alias("shingle"), F.col("b").alias("m"), F.col("b_root").alias("m_root"),
                         F.col("size").alias("m_size"), F.col("common").alias("m_common"))
    spread = keyed.groupBy("a", "shingle").agg(F.count(F.lit(1)).alias("times"))
    rare = Window.partitionBy("a", "o").orderBy("times", "shingle")
    listed = (
        out.select("a", F.explode("extra").alias("shingle"), F.col("b").alias("o"), F.col("b_root").alias("o_root"),
                   F.col("size").alias("o_size"), F.col("common").alias("o_common"), F.size("extra").alias("extras"))
        .join(spread, ["a", "shingle"]).withColumn("place", F.row_number().over(rare)).where("times > 1")
    )
    # So many shingles outside the leader a similar pair shares at least; o's rarest ones but for one less must show it.
    least = F.ceil(F.lit(THRESHOLD / (1 + THRESHOLD)) * (F.col("o_size") + F.col("m_size")) - 1e-6) - F.least("o_common", "m_common")
    shared = (
        listed.join(keyed, ["a", "shingle"])
        .where((F.col("o_root") != F.col("m_root")) & (F.col("place") <= F.col("extras") - F.greatest(least, F.lit(1)) + 1)).select("o", "m")
    )
    room = F.floor(F.col("common") * ((1 + THRESHOLD) / THRESHOLD) + 1e-6) - F.col("size")
    inner = (
        out.select("a", F.col("b").alias("o"), F.col("b_root").alias("o_root"), room.alias("room"), "least").where("room >= least")
        .join(known.select("a", F.col("b").alias("m"), F.col("b_root").alias("m_root"), "size"), "a")
        .where("size <= room and o_root <> m_root").select("o", "m")
    )
    pairs = shared.union(inner).select(F.least("o", "m").alias("a"), F.greatest("o", "m").alias("b")).distinct()
    seen = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(seen, ["a", "b"], "left_anti")


def identity(key: str = "doc_id", text: str = "text") -> Column:
    """The key, or for a row without one a negative number from its text."""
    return F.coalesce(F.col(f"`{key}`").cast("bigint"), -F.abs(F.shiftright(F.xxhash64(F.col(f"`{text}`")), 1)) - 1)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, ``class_id`` (smallest id among the documents that links reach), ``n_words``.

    Texts of equal words are one class from the start. Every pick groups classes into a bucket, whose leader is the
    member that meets the most others. All members are verified against their leader; of the pairs that are then in
    different components, those are verified that can be similar at all (``_unseen_pairs``). So a bucket of many alike
    documents costs one comparison each, and no pair that shares a bucket is lost. Texts without words (null, empty,
    blank) stay alone. Rows of one key are one document; a row without a key gets a negative id from its text. An empty
    table gives no rows. Other columns of ``docs`` are not read.

    No similar pair is missed whose smaller text has at most ``SHORT`` shingles. Of others with s aligned shingles of N
    in both, a pick agrees with probability C(s, 5) / C(N, 5); at similarity 0.8, 20 picks miss 0.10 % of the pairs with
    20 of 25, 0.06 % with 40 of 50 and 0.04 % of long ones.
    """
    base = docs.select(identity(key, text).alias("id"), F.col(f"`{text}`").alias("text"))
    sketched = materialise(
        base.mapInArrow(_sketches, "id long, k1 long, k2 long, n_words long, picks array<long>"), "sketches")
    with_words = sketched.where("n_words > 0")
    classes = with_words.groupBy("k1", "k2").agg(
        F.min(F.struct("id", "picks")).alias("x"), F.min("id").alias("rep"), F.max("id").alias("last"))
    buckets = materialise(classes.select("rep", F.explode("x.picks").alias("bucket")).distinct(), "buckets")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(buckets.join(sizes, "bucket"), "shared")
    met = shared.groupBy("rep").agg(F.sum("n").alias("met"))
    leaders = shared.join(met, "rep").groupBy("bucket").agg(F.max(F.struct("met", -F.col("rep"), "rep"))["rep"].alias("leader"))
    stars = shared.join(leaders, "bucket").where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    nodes = materialise(shared.select(F.col("rep").alias("id")).distinct(), "nodes")  # few; the texts of the others stay where they are
    texts = base.join(nodes, "id", "left_semi").dropDuplicates(["id"])
    labels = materialise(texts.mapInArrow(_label_batches, "id long, labels binary"), "labels")
    stars = materialise(compared(stars, labels), "stars")
    links = stars.where("linked").select("a", "b")
    rest = materialise(_unseen_pairs(stars, materialise(components(links), "roots")), "rest")
    late = compared(rest, labels).where("linked").select("a", "b")
    roots = materialise(components(links.union(late)), "roots")
    # Only classes of several documents are looked up by content; a document that is alone goes by its id.
    several = classes.where("rep < last").select("k1", "k2", F.col("rep").alias("node")).join(roots, "node", "left").select(
        "k1", "k2", F.coalesce("root", "node").alias("of_class"))
    several = materialise(several, "classes")
    roots = roots.select(F.col("node").alias("id"), "root")
    return (
        with_words.drop("picks").join(several, ["k1", "k2"], "left").join(roots, "id", "left")
        .select("id", F.coalesce("of_class", "root", "id").alias("class_id"), "n_words")
        .union(sketched.where("n_words = 0").select("id", F.col("id").alias("class_id"), "n_words"))
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each near-duplicate class, with all its columns; of repeated rows one."""
    found = materialise(near_duplicates(docs, key, text).select("id", "class_id"), "found")
    gone = materialise(found.where("id <> class_id").select("id").distinct(), "gone")
    rows = docs.select(F.struct("*").alias("record"), identity(key, text).alias("id")).join(gone, "id", "left_anti")
    if found.groupBy("id").count().where("count > 1").take(1):
        rows = rows.dropDuplicates(["id"])
    return rows.select("record.*")
