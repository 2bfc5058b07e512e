"""Quality of documents by co-training.

Two logistic classifiers see separate views: the text itself, and what is known about its page (language, source, size,
address and markup). Over some rounds each labels documents that it is sure of for the other one; then both are
calibrated on labelled rows that neither was fitted on and combined into one score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.fertility import base_measures
from rowsmith.llm.toxicity import fit_logistic
from rowsmith.llm.words import Words, slices, words_of
from rowsmith.session import materialise

SAMPLE = 10_000  # labelled rows, at most
ROUNDS = 3
STEPS = 4  # Newton steps of a round, one pass over the documents each
REACH = 4.0  # largest change of a labelled row's logit in one step
SURE = 0.95
SHAPES = 32
SOURCES, HOSTS, LANGUAGES = 32, 16, 16


def _share(of: np.ndarray, words: Words) -> np.ndarray:
    """Share of a text's bytes that a table marks."""
    size = np.diff(words.offset)
    return np.diff(np.concatenate([[0], np.cumsum(of[words.data])])[words.offset]) / np.maximum(size, 1)


def text_view(words: Words) -> np.ndarray:
    """One row of content features per text; zeros for texts without words."""
    base, n = base_measures(words), np.maximum(words.counts, 1)
    mark = {}
    for name, members in {"upper": range(0x41, 0x5B), "digit": range(0x30, 0x3A), "stop": b".,;:!?", "loud": b"!", "bar": b"|",
                          "symbol": b"#*$%&<>", "wide": range(0x80, 0x100), "break": b"\n", "quote": b"\"'()[]{}/\\=_-+@"}.items():
        mark[name] = np.zeros(256, bool)
        mark[name][list(members)] = True
    size = words.end - words.start
    first, last = words.data[words.start] if len(size) else words.data[:0], words.data[words.end - 1] if len(size) else words.data[:0]
    upper = np.concatenate([[0], np.cumsum(mark["upper"][words.data])])
    digit = np.concatenate([[0], np.cumsum(mark["digit"][words.data])])
    loud = (upper[words.end] - upper[words.start]) * 2 > size
    shape = (
        mark["upper"][first] * 1 + loud * 2 + (digit[words.end] > digit[words.start]) * 4 + mark["stop"][last] * 8
        + (mark["symbol"] | mark["bar"])[last] * 16
    )
    shapes = np.bincount(words.row * SHAPES + shape, minlength=len(n) * SHAPES).reshape(len(n), SHAPES) / n[:, None]
    again = np.zeros(len(size), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    repeats = np.bincount(words.row[again], minlength=len(n)) / n
    order = np.lexsort((words.hash, words.row))
    new = np.ones(len(order), bool)
    new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.row[order][1:] != words.row[order][:-1])
    distinct = np.bincount(words.row[order][new], minlength=len(n)) / n
    spread = np.bincount(words.row, size.astype(float) ** 2, minlength=len(n)) / n
    mean = np.bincount(words.row, size.astype(float), minlength=len(n)) / n
    columns = [
        np.log1p(words.counts), mean, np.sqrt(np.maximum(spread - mean**2, 0)), base["n_symbols"] / n, base["n_dup_lines"] / n,
        base["n_repeat_words"] / n, repeats, distinct, *(_share(m, words) for m in mark.values()),
    ]
    return np.nan_to_num(np.column_stack([*columns, shapes])).astype(np.float32)


def _text_features(batches):
    for batch in slices(batches, "text"):
        view = text_view(words_of(batch.column("text")))
        lists = pa.ListArray.from_arrays(np.arange(0, view.size + 1, view.shape[1], dtype=np.int32), pa.array(view.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("record"), lists], names=["record", "text_view"])


def _one_hot(value: Column, size: int) -> list[Column]:
    place = F.pmod(F.xxhash64(value), F.lit(size))
    return [F.when(value.isNotNull() & (place == i), 1.0).otherwise(0.0) for i in range(size)]


def _times(text: Column, part: str) -> Column:
    return F.coalesce((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part), F.lit(0.0))


# Markup whose frequency describes a page.
MARKUP = ("<p", "<a ", "<li", "<div", "<br", "<h", "<table", "<script", "<img", "class=\"ad\"", "<!--")


def page_view(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    """``id`` and ``page`` (array of numbers): address and markup of the pages of a document, averaged.

    The document's number is the last number in the path of the address; pages without one are left out.
    """
    url, body = F.col(key), F.col(html)
    host = F.regexp_extract(url, r"^\w+://([^/?#]+)", 1)
    path = F.regexp_extract(url, r"^\w+://[^/?#]+([^?#]*)", 1)
    numbers = [
        F.lit(1.0), F.startswith(url, F.lit("https")).cast("double"), host.startswith("www.").cast("double"),
        host.startswith("m.").cast("double"), host.startswith("blog.").cast("double"), _times(path, "/"),
        F.contains(url, F.lit("?")).cast("double"), F.contains(url, F.lit("#")).cast("double"), F.length(url) / 50.0,
        F.log1p(F.length(body).cast("double")), *[F.log1p(_times(body, m)) for m in MARKUP],
        *[1000.0 * _times(body, m) / F.greatest(F.length(body), F.lit(1)) for m in MARKUP],
        *_one_hot(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), HOSTS),
    ]
    flat = pages.select(
        F.regexp_extract(path, r"(\d+)(?:\.\w+)?/?$", 1).try_cast("bigint").alias("id"),
        *[F.coalesce(x.cast("double"), F.lit(0.0)).alias(f"p{i}") for i, x in enumerate(numbers)],
    ).where("id is not null")
    return flat.groupBy("id").agg(*[F.avg(f"p{i}").alias(f"p{i}") for i in range(len(numbers))]).select(
        "id", F.array(*[F.col(f"p{i}") for i in range(len(numbers))]).cast("array<float>").alias("page"))


def views(docs: DataFrame, pages: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``record`` (all columns but the text), ``id``, ``text_view`` and ``page_view``. Documents without a page have
    zeros for it."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(F.struct(*rest).alias("record"), F.col(f"`{text}`").alias("text"))
    kind = base.schema["record"].dataType.simpleString()
    found = base.mapInArrow(_text_features, f"record {kind}, text_view array<float>").withColumn("id", F.col(f"record.`{key}`").cast("bigint"))
    joined = found.join(page_view(pages), "id", "left")
    known = F.array(*_one_hot(F.col(f"record.`{lang}`"), LANGUAGES), *_one_hot(F.col(f"record.`{source}`"), SOURCES)).cast("array<float>")
    empty = F.array_repeat(F.lit(0.0).cast("float"), 10 + 2 * len(MARKUP) + HOSTS)
    return joined.select("record", "id", "text_view", F.concat(known, F.coalesce("page", empty)).alias("page_view"))


@dataclass
class Linear:
    """Standardising logistic classifier of one view."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Linear:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = cls(mean, scale, np.zeros(x.shape[1]), 0.0).scaled(x)
        row, col = np.divmod(np.arange(z.size), z.shape[1])
        weight, bias = fit_logistic(row, col, z.ravel(), y.astype(float), z.shape[1], penalty=1.0, rounds=200)
        return cls(mean, scale, weight, bias)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.weight + self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn logits into probabilities on labelled rows."""
    x = logit / 10.0
    w, b = fit_logistic(np.arange(len(x)), np.zeros(len(x), int), x, y.astype(float), 1, penalty=1e-3, rounds=400)
    return max(float(w[0]), 0.0) / 10.0, b


@dataclass
class Model:
    text: Linear | None
    page: Linear | None
    text_scale: tuple[float, float]
    page_scale: tuple[float, float]
    prior: float

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of both views and of both together, taken as independent given the class."""
        if self.text is None:
            flat = np.full(len(text), sigmoid(np.array([self.prior]))[0])
            return flat, flat, flat
        a = np.clip(self.text_scale[0] * self.text.logit(text) + self.text_scale[1], -20, 20)
        b = np.clip(self.page_scale[0] * self.page.logit(page) + self.page_scale[1], -20, 20)
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _scored(model: Model, columns: list[str]):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = model.scores(_matrix(batch.column("text_view")), _matrix(batch.column("page_view")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *(pa.array(x) for x in found)], names=[*columns, "text_score", "page_score", "score"])

    return run


def score(seen: DataFrame, model: Model) -> DataFrame:
    """``seen`` (from ``views``) with ``text_score``, ``page_score`` and ``score``."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in seen.schema.fields)
    return seen.mapInArrow(_scored(model, seen.columns), f"{schema}, text_score double, page_score double, score double")


def newton_sums(x: np.ndarray, label: np.ndarray | float, linear: Linear) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss over the rows of ``x``; the intercept comes last."""
    z = np.column_stack([linear.scaled(x), np.ones(len(x))])
    share = sigmoid(z[:, :-1] @ linear.weight + linear.bias)
    return z.T @ (share - label), (z * (share * (1 - share))[:, None]).T @ z


def sure_sums(pool: DataFrame, model: Model, linears: list[Linear]) -> dict[tuple[int, int], tuple[float, np.ndarray, np.ndarray]]:
    """(documents, gradient, curvature) by (view, label) over all documents that the other view of ``model`` is sure of.

    ``linears`` are the classifiers of text and page that learn. A task sends one sum of each cell, added up by key.
    """
    sizes = [len(x.weight) + 1 for x in linears]

    def run(batches):
        total = {(side, label): np.zeros(1 + sizes[side] * (1 + sizes[side])) for side in (0, 1) for label in (0, 1)}
        for batch in batches:
            seen = [_matrix(batch.column("text_view")), _matrix(batch.column("page_view"))] if batch.num_rows else []
            sure = model.scores(*seen)[:2] if seen else ()
            for side, x in enumerate(seen):
                for label, some in ((1, sure[1 - side] >= SURE), (0, sure[1 - side] <= 1 - SURE)):
                    if some.any():
                        slope, bend = newton_sums(x[some], label, linears[side])
                        total[side, label] += np.concatenate([[some.sum()], slope, bend.ravel()])
        for (side, label), sums in total.items():
            if sums[0]:
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, side)), pa.array(np.full(n, label)), pa.array(np.arange(n)), pa.array(sums)], names=["side", "label", "at", "v"])

    cells = pool.select("text_view", "page_view").mapInArrow(run, "side long, label long, at long, v double")
    # Bounded: four cells of (columns + 1) squared numbers.
    rows = cells.groupBy("side", "label", "at").agg(F.sum("v").alias("v")).toArrow()
    side, label, at, v = (rows.column(c).to_numpy() for c in ("side", "label", "at", "v"))
    out = {}
    for cell in set(zip(side.tolist(), label.tolist())):
        mine = (side == cell[0]) & (label == cell[1])
        flat, size = np.zeros(int(mine.sum())), sizes[cell[0]]
        flat[at[mine]] = v[mine]
        out[cell] = flat[0], flat[1 : 1 + size], flat[1 + size :].reshape(size, size)
    return out


def learned(linear: Linear, x: np.ndarray, y: np.ndarray, given: dict[int, tuple[float, np.ndarray, np.ndarray]], penalty: float = 1.0) -> Linear:
    """One Newton step over labelled rows and the sums of the documents that the other view labels.

    The documents of a class weigh one each, and together no more than the labelled rows of that class.
    """
    slope, bend = newton_sums(x, y, linear)
    for label, (n, g, h) in given.items():
        weight = min(1.0, float((y == label).sum()) / n)
        slope, bend = slope + weight * g, bend + weight * h
    ridge = np.append(np.full(len(linear.weight), penalty), 1e-6)
    step = np.linalg.solve(bend + np.diag(ridge), slope + ridge * np.append(linear.weight, linear.bias))
    moved = np.abs(linear.scaled(x) @ step[:-1] + step[-1]).max()
    step *= min(1.0, REACH / max(moved, 1e-300))
    return Linear(linear.mean, linear.scale, linear.weight - step[:-1], linear.bias - float(step[-1]))


def cotrain(seen: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", sample: int = SAMPLE,
            rounds: int = ROUNDS, key: str = "doc_id") -> Model:
    """Fits on at most ``sample`` labelled rows for which ``allowed`` (over ``labels``) holds, and on all other documents
    that the views then label for each other. A quarter of the labelled rows is kept for calibration.

    With one class only, or no labelled row, every document gets the smoothed share of label 1.
    """
    picked = materialise(
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & allowed)
        .groupBy(F.col(key).cast("bigint").alias("id")).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample), "picked")
    rows = seen.join(F.broadcast(picked), "id").select("id", "text_view", "page_view", "label").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    y = rows.column("label").to_numpy().astype(float)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    prior = float(np.log(share / (1 - share)))
    empty = Model(None, None, (1.0, 0.0), (1.0, 0.0), prior)
    kept = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[~kept])) < 2 or len(np.unique(y[kept])) < 2:
        return empty
    t, p = _matrix(rows.column("text_view")), _matrix(rows.column("page_view"))
    y_fit, views_fit = y[~kept], [t[~kept], p[~kept]]
    pool = seen.join(F.broadcast(picked.select("id")), "id", "left_anti")

    def calibrated(text: Linear, page: Linear) -> Model:
        return Model(text, page, platt(text.logit(t[kept]), y[kept]), platt(page.logit(p[kept]), y[kept]), prior)

    model = calibrated(*(Linear.fit(x, y_fit) for x in views_fit))
    for _ in range(rounds):
        linears = [model.text, model.page]
        for _ in range(STEPS):
            sums = sure_sums(pool, model, linears)
            linears = [
                learned(linear, x, y_fit, {label: sums[side, label] for label in (0, 1) if (side, label) in sums})
                for side, (linear, x) in enumerate(zip(linears, views_fit))]
        model = calibrated(*linears)
    return model


def quality(docs: DataFrame, pages: DataFrame, labels: DataFrame, allowed: Column, **options) -> DataFrame:
    """``record`` (all columns but the text), ``text_score``, ``page_score`` and ``score`` of every document, 0 to 1.

    Null and empty texts have zero content features; null languages and sources and missing pages have zero page
    features. Repeated rows get equal scores. An empty table gives no rows.
    """
    seen = materialise(views(docs, pages), "views")
    return score(seen.select("record", "text_view", "page_view"), cotrain(seen, labels, allowed, **options)).drop("text_view", "page_view")
