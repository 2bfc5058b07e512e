"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed lower-case byte n-gram. Its value is the log ratio of the two classes' document
frequencies, and a logistic regression on these values is fitted to labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.words import slices, text_bytes
from rowsmith.session import materialise

LENGTHS = (3, 4, 5, 6)
BITS = 19
SAMPLE = 10_000  # labelled rows that the classifier is fitted on, at most
Z_SCORE = 4.0  # features whose classes differ by fewer standard deviations are left out
MOST_FEATURES = 10_000
PIECE = 1 << 18


@dataclass
class Model:
    """``weight`` of each hashed n-gram (0: no feature) and the intercept."""

    weight: np.ndarray
    bias: float


def feature_hits(texts: pa.Array, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct features of each text, only ``chosen`` ones if given."""
    data, offset = text_bytes(pc.utf8_lower(texts))
    found = []
    for low in range(0, len(data), PIECE):  # a piece at a time, with the bytes that its last n-grams reach into
        part = data[low : low + PIECE + max(LENGTHS) - 1].astype(np.uint64)
        size = min(PIECE, len(data) - low)
        row = np.searchsorted(offset, np.arange(low, low + size), "right") - 1 if chosen is None else None
        packed = np.zeros(len(part), np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            packed = packed[: len(part) - n + 1] | (part[n - 1 :] << np.uint64(8 * (n - 1)))
            if n not in LENGTHS or not len(packed):
                continue
            mark = packed[:size] + (np.uint64(n) << np.uint64(56))
            feature = ((mark * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
            at = np.arange(len(feature)) if chosen is None else np.flatnonzero(chosen[feature])
            of = row[: len(at)] if chosen is None else np.searchsorted(offset, low + at, "right") - 1
            whole = low + at + n <= offset[of + 1]
            found.append(np.unique((of[whole].astype(np.int64) << BITS) | feature[at[whole]]))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, (pairs & ((1 << BITS) - 1)).astype(np.int32)


def _count(batches):
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in slices(batches, "text", PIECE):  # all n-grams of a stretch are held at once
        label = batch.column("label").to_numpy()
        row, feature = feature_hits(batch.column("text"))
        for y in (0, 1):
            counts[y] += np.bincount(feature[label[row] == y], minlength=1 << BITS)
    used = np.flatnonzero(counts.sum(0))
    for i in range(0, len(used), 100_000):
        at = used[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], names=["feature", "n0", "n1"])


def _chosen_features(chosen: np.ndarray):
    def run(batches):
        for batch in slices(batches, "text", PIECE):
            row, feature = feature_hits(batch.column("text"), chosen)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(feature, pa.int32()))], names=["label", "features"])

    return run


def fit_logistic(row: np.ndarray, col: np.ndarray, value: np.ndarray, label: np.ndarray, n_cols: int,
                 penalty: float = 1.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression over (row, col, value) triples; full-batch steps."""
    n = len(label)
    share = (label.sum() + 0.5) / (n + 1.0)
    w, b = np.zeros(n_cols), float(np.log(share / (1 - share)))
    # Adam with a falling step: each step is two sparse products.
    m, v, mb, vb = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[col], minlength=n) + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        g = np.bincount(col, value * error[row], minlength=n_cols) + penalty * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = 0.1 * (1 - t / (rounds + 1))
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        b -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-9)
    return w, float(b)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, sample: int, key: str, text: str) -> DataFrame:
    """(text, label) of at most ``sample`` labelled rows, picked by a hash of the key. Several labels of a key: the largest;
    several texts: the last in order.

    The picked keys are bounded by ``sample``, so they are broadcast and the texts stay where they are.
    """
    picked = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & allowed)
        .groupBy(key).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64(key), key).limit(sample)
    )
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(picked), key)
    return rows.groupBy(key, "label").agg(F.max("text").alias("text")).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", sample: int = SAMPLE,
        key: str = "doc_id", text: str = "text") -> Model:
    """Fits on the labelled rows for which ``allowed`` (over ``labels``) holds, at most ``sample`` of them.

    With one class only, or no labelled row, the model is the smoothed share of label 1.
    """
    rows = materialise(labelled_sample(docs, labels, label, allowed, sample, key, text), "labelled")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    weight = np.zeros(1 << BITS, np.float32)
    if not n0 or not n1:
        share = (n1 + 0.5) / (n0 + n1 + 10.0)
        return Model(weight, float(np.log(share / (1 - share))))
    counted = rows.mapInArrow(_count, "feature long, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share = (F.col("n0") + F.col("n1")) / (n0 + n1)
    score = F.abs(F.col("n1") - n1 * share) / F.sqrt(F.greatest(n1 * share * (1 - share) * n0 / (n0 + n1), F.lit(1e-9)))
    table = (
        counted.withColumn("z", score).where(F.col("z") >= Z_SCORE)
        .orderBy(F.desc("z"), "feature").limit(MOST_FEATURES).toPandas()
    )
    feature = table["feature"].to_numpy().astype(np.int64)
    ratio = np.log((table["n1"].to_numpy() + 1.0) / (n1 + 2.0)) - np.log((table["n0"].to_numpy() + 1.0) / (n0 + 2.0))
    chosen = np.zeros(1 << BITS, bool)
    chosen[feature] = True
    place = np.zeros(1 << BITS, np.int32)
    place[feature] = np.arange(len(feature))
    # Bounded: sample rows times their chosen features.
    fitted = rows.mapInArrow(_chosen_features(chosen), "label int, features array<int>").toArrow()
    lists = fitted.column("features").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    col = place[lists.flatten().to_numpy()]
    y = fitted.column("label").to_numpy().astype(float)
    w, bias = fit_logistic(row.astype(np.int32), col, ratio[col].astype(np.float32), y, max(len(feature), 1))
    weight[feature] = (w[: len(feature)] * ratio).astype(np.float32)
    return Model(weight, bias)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``record`` (all columns of ``docs`` but the text), ``text`` and ``score`` in 0..1.

    Null and empty texts have no feature and get the intercept's score. Repeated rows get equal scores.
    """
    chosen = model.weight != 0
    weight, bias = model.weight, model.bias

    def run(batches):
        for batch in slices(batches, "text"):
            row, feature = feature_hits(batch.column("text"), chosen)
            z = np.bincount(row, weight[feature].astype(np.float64), minlength=batch.num_rows) + bias
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=[*batch.schema.names, "score"])

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(F.struct(*rest).alias("record"), F.col(f"`{text}`").alias("text"))
    return base.mapInArrow(run, f"record {base.schema['record'].dataType.simpleString()}, text string, score double")
