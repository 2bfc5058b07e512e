"""Removal of word passages that occurred earlier in the corpus, by seed and extend.

Seeds are winnowed anchors: each window of ``window`` words elects its smallest ``gram``-word hash, so two equal
windows elect the same anchor at the same place. An anchor is joined with all its other occurrences and extended both
ways over exactly the windows that elected it; windows found earlier are covered, and neighbouring covered windows
merge into maximal repeats of at least ``window`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rowsmith.llm.common import text_bytes
from rowsmith.llm.words import mix, slices, window_hashes, words_of
from rowsmith.session import materialise

GRAM = 6
WINDOW = 20
FLUSH_WINDOWS = 1_000_000  # windows that a task holds before it passes them on
HOT_RUNS = 50_000  # an anchor with more runs is spread over the tasks
SAMPLED = 8  # one in so many documents is read to find such anchors

_SEEDS = "task int, places binary, content binary"
_SEED_FIELDS = pa.schema([("task", pa.int32()), ("places", pa.binary()), ("content", pa.binary())])
_PLACE = np.dtype([("d", np.int64), ("t", np.int64), ("start", np.int32), ("n", np.int16), ("known", np.int16)])
_SPANS = "d long, t long, first int, last int"


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of the ``width`` values from each place on; the leftmost of equal ones."""
    place = np.arange(len(values))
    best, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(best) - step
        keep = best[:n] <= best[step:]
        place = np.where(keep, place[:n], place[step:])
        best = np.where(keep, best[:n], best[step:])
        reach += step
    return place


def elected_runs(texts: pa.Array, gram: int, window: int) -> dict[str, np.ndarray]:
    """Runs of neighbouring windows with one anchor. ``row``, ``start`` of the first window, ``n`` windows, ``h`` the
    anchor, ``key`` the content of the whole run, ``content`` the hash of each window."""
    words = words_of(texts)
    grams, _ = window_hashes(words, gram)
    whole, inside = window_hashes(words, window)
    at = np.flatnonzero(inside)
    if not len(at):
        return {}
    anchor = leftmost_smallest(grams, window - gram + 1)[: len(whole)][at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    lead = np.flatnonzero(new)
    n = np.diff(np.append(lead, len(at)))
    row = words.row[at[lead]]
    content = whole[at]
    return {
        "row": row, "start": at[lead] - words.first[row], "n": n, "h": grams[anchor[lead]],
        "key": mix(content[lead] + np.uint64(3) * mix(content[lead + n - 1]) + n.astype(np.uint64)),
        "content": content,
    }


def split_hot(found: dict[str, np.ndarray], hot: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of a hot anchor as single windows, each going its own way by the hash of its words (``h``)."""
    at = np.minimum(np.searchsorted(hot, found["h"]), max(len(hot) - 1, 0))
    single = hot[at] == found["h"] if len(hot) else np.zeros(len(at), bool)
    if not single.any():
        return found
    pieces = np.where(single, found["n"], 1)
    of = np.repeat(np.arange(len(pieces)), pieces)
    step = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    out = {k: v[of] for k, v in found.items() if k != "content"}
    out["start"] = out["start"] + step
    lone = single[of]
    out["n"] = np.where(lone, 1, out["n"])
    first = np.cumsum(out["n"]) - out["n"]  # windows keep their order
    word = found["content"][first]
    out["h"] = np.where(lone, mix(word), out["h"])
    out["key"] = np.where(lone, mix(word + np.uint64(1)), out["key"])
    return out | {"content": found["content"]}


def _packed(task: np.ndarray, places: np.ndarray, content: np.ndarray | None, first: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """One row per task with all its runs: places column by column and compressed, then the hashes of their windows."""
    order = np.argsort(task, kind="stable")
    task, places = task[order], places[order]
    edge = np.flatnonzero(np.diff(task, prepend=-1))
    ends = np.append(edge[1:], len(task))
    rows: list[tuple] = []
    size = 0
    for a, b in zip(edge.tolist(), ends.tolist()):
        part = places[a:b]
        columns = b"".join(np.ascontiguousarray(part[c]).tobytes() for c in _PLACE.names)
        body = b""
        if content is not None:
            n = part["n"].astype(np.int64)
            at = np.repeat(first[order[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            body = content[at].tobytes()
        rows.append((task[a], np.int32(len(part)).tobytes() + pa.compress(columns, "zstd", asbytes=True), body))
        size += len(rows[-1][1]) + len(body)
        if size > 1 << 20 or b == len(task):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _SEED_FIELDS)], schema=_SEED_FIELDS)
            rows, size = [], 0


def unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of all runs, and the hashes of the windows of those that are not known as repeats."""
    places, content = [np.zeros(0, _PLACE)], [np.zeros(0, np.uint64)]
    for packed, body in zip(rows.column("places").to_pylist(), rows.column("content").to_pylist()):
        n = int(np.frombuffer(packed, np.int32, 1)[0])
        raw, at = pa.decompress(packed[4:], n * _PLACE.itemsize, "zstd", asbytes=True), 0
        part = np.empty(n, _PLACE)
        for c in _PLACE.names:
            part[c] = np.frombuffer(raw, _PLACE[c], n, at)
            at += n * _PLACE[c].itemsize
        places.append(part)
        content.append(np.frombuffer(body, np.uint64))
    return np.concatenate(places), np.concatenate(content)


def _combined(held: list[dict], tasks: int) -> Iterator[pa.RecordBatch]:
    """Of equal runs in one task only the earliest goes on as a seed; the others are known repeats already."""
    x = {k: np.concatenate([r[k] for r in held]) for k in held[0]}
    order = np.lexsort((x["start"], x["t"], x["d"], x["key"]))
    key, d, t, s = x["key"][order], x["d"][order], x["t"][order], x["start"][order]
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(lead, np.arange(len(key)), 0))
    later = (d != d[head]) | (t != t[head]) | (s != s[head])
    seed, known = np.sort(order[~later & lead]), np.sort(order[later])
    places = np.empty(len(x["d"]), _PLACE)
    for c in ("d", "t", "start", "n"):
        places[c] = x[c]
    places["known"] = 0
    places["known"][known] = 1
    first = np.cumsum(x["n"]) - x["n"]
    yield from _packed(task_of(x["h"][seed], tasks), places[seed], x["content"], first[seed])
    if len(known):
        # Known repeats go by their place; neighbours stay together.
        spread = mix(x["d"][known].view(np.uint64) + (x["start"][known] >> 6).astype(np.uint64))
        yield from _packed(task_of(spread, tasks), places[known], None, None)


def task_of(h: np.ndarray, tasks: int) -> np.ndarray:
    return (mix(h) % np.uint64(tasks)).astype(np.int32)


def _runs(batches, gram: int, window: int, hot: np.ndarray) -> Iterator[list[dict]]:
    """Runs of the windows of the texts, by stretches of ``FLUSH_WINDOWS``."""
    held, windows = [], 0
    for batch in slices(batches, "text"):
        found = elected_runs(batch.column("text"), gram, window)
        if not found:
            continue
        row = found.pop("row")
        found["d"] = batch.column("d").to_numpy()[row]
        found["t"] = batch.column("t").to_numpy()[row]
        found = split_hot(found, hot)
        held.append(found)
        windows += len(found["content"])
        if windows > FLUSH_WINDOWS:
            yield held
            held, windows = [], 0
    if held:
        yield held


def _seeds(gram: int, window: int, tasks: int, hot: np.ndarray):
    def run(batches):
        for held in _runs(batches, gram, window, hot):
            yield from _combined(held, tasks)

    return run


def _anchor_counts(gram: int, window: int):
    def run(batches):
        for held in _runs(batches, gram, window, np.zeros(0, np.uint64)):
            _, pick = np.unique(np.concatenate([x["key"] for x in held]), return_index=True)
            h, n = np.unique(np.concatenate([x["h"] for x in held])[pick], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return run


def hot_anchors(base: DataFrame, gram: int, window: int, runs: int) -> np.ndarray:
    """Anchors that more than about ``runs`` runs of different content elect, ascending.

    Estimated from one in ``SAMPLED`` documents; it decides only where windows meet. At most one anchor per ``runs``
    runs of the corpus.
    """
    some = base.where(F.pmod(F.xxhash64("d", "t"), F.lit(SAMPLED)) == 0)
    counts = some.select("d", "t", "text").mapInArrow(_anchor_counts(gram, window), "h long, n long")
    found = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") * SAMPLED > runs).select("h").toArrow()
    return np.sort(found.column("h").to_numpy().view(np.uint64))


def repeated_windows(places: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, t, start) of the windows that a smaller (d, t, start) holds too, among those of some runs."""
    order = np.argsort(content, kind="stable")
    key = content[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    pick = np.sort(order[same[1:] | same[:-1]])
    n = places["n"].astype(np.int64)
    ends = np.cumsum(n)
    of = np.searchsorted(ends, pick, "right")
    d, t, start = places["d"][of], places["t"][of], places["start"][of] + pick - (ends[of] - n[of])
    key = content[pick]
    order = np.lexsort((start, t, d, key))
    key, d, t, start = key[order], d[order], t[order], start[order]
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(lead, np.arange(len(key)), 0)) if len(key) else np.zeros(0, int)
    later = (d != d[head]) | (t != t[head]) | (start != start[head])
    return d[later], t[later], start[later]


def _matched(window: int):
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        places, content = unpacked(pa.Table.from_batches(held))
        known = places["known"] == 1
        spans = [(places["d"][known], places["t"][known], places["start"][known], places["start"][known] + places["n"][known] - 1)]
        d, t, start = repeated_windows(places[~known], content)
        spans.append((d, t, start, start))
        d, t, first, last = (np.concatenate(x).astype(np.int64) for x in zip(*spans))
        order = np.lexsort((first, t, d))
        d, t, first, last = d[order], t[order], first[order], last[order]
        if not len(d):
            return
        # Windows that follow one another are one span.
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (first[1:] > last[:-1] + 1)
        lead = np.flatnonzero(new)
        last = np.maximum.reduceat(last, lead) + window
        for i in range(0, len(lead), 100_000):
            at = lead[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[at]), pa.array(t[at]), pa.array(first[at], pa.int32()), pa.array(last[i : i + len(at)], pa.int32())],
                names=["d", "t", "first", "last"])

    return run


def cut(texts: pa.Array, spans: list) -> tuple[np.ndarray, np.ndarray, list[bytes], list[list]]:
    """Words, removed words, remaining text and maximal spans of each text; a removed word takes the blanks behind it."""
    words = words_of(texts)
    removed, kept, merged = np.zeros(len(texts), np.int64), [], []
    raw = words.data.tobytes()
    for i, found in enumerate(spans):
        low, high = int(words.offset[i]), int(words.offset[i + 1])
        if not found:
            kept.append(raw[low:high])
            merged.append([])
            continue
        base, end = int(words.first[i]), int(words.first[i + 1])
        joined: list[list[int]] = []
        for first, last in sorted((s["first"], s["last"]) for s in found):
            if joined and first <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], last)
            else:
                joined.append([first, last])
        parts, at = [], low
        for first, last in joined:
            removed[i] += last - first
            parts.append(raw[at : int(words.start[base + first])])
            at = int(words.start[base + last]) if base + last < end else high
        kept.append(b"".join(parts) + raw[at:high])
        merged.append([{"first": a, "last": b} for a, b in joined])
    return words.counts, removed, kept, merged


_SPAN_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _cut_batches(batches):
    for batch in slices(batches, "text", 2 << 20):
        texts = batch.column("text")
        n, removed, kept, merged = cut(texts, batch.column("spans").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(n), pa.array(removed), pc.if_else(pc.is_valid(texts), pa.array(kept, pa.binary()).cast(pa.string()), None), pa.array(merged, _SPAN_TYPE)],
            names=[*batch.schema.names[:-2], "n_words", "n_removed", "kept_text", "repeats"])


def drop_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, task_bytes: int = 8 << 20, key: str = "doc_id", text: str = "text",
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """Finds in every text the words covered by a window that also starts earlier in the corpus.

    Returns the columns of ``docs`` without ``text`` in ``record``, and ``n_words``, ``n_removed``, ``kept_text`` (the
    text without those words, its other characters unchanged) and ``repeats`` (maximal spans, ``first`` inclusive,
    ``last`` exclusive). Earlier means a smaller key, or the same document and an earlier start. Null keys come last;
    rows with one key are ordered by a hash of their text, and rows equal in both count as one document. Null and
    empty texts have no words and stay as they are. An empty table gives no rows.

    Windows that meet at an anchor are compared by a 64-bit hash of all their words. Of equal runs only the first
    of a task is shuffled, so a passage that all documents share arrives at its anchor once per task. Windows of an
    anchor with more than about ``hot_runs`` different runs meet by the hash of their words instead, in all tasks.
    """
    spark = docs.sparkSession
    size, rows, ids = docs.agg(F.sum(text_bytes(F.col(text))), F.count(F.lit(1)), F.count(key)).first()
    repeated = rows != ids or bool(docs.groupBy(key).count().where("count > 1").take(1))
    mark = F.xxhash64(F.col(text)) if repeated else F.lit(0).cast("bigint")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(
        F.struct(*rest).alias("record"), F.col(text).alias("text"),
        F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1)).alias("d"), mark.alias("t"),
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // task_bytes))
    hot = hot_anchors(base, gram, window, hot_runs)
    seeds = base.select("d", "t", "text").mapInArrow(_seeds(gram, window, tasks, hot), _SEEDS)
    spans = seeds.repartitionById(tasks, F.col("task")).mapInArrow(_matched(window), _SPANS)
    # Stored, so that the texts are moved only if the spans are too many to be sent to them.
    of_doc = materialise(spans.groupBy("d", "t").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")
    joined = base.join(of_doc, ["d", "t"], "left").select("record", F.col("text"), F.coalesce("spans", F.array().cast(
        "array<struct<first:int,last:int>>")).alias("spans"))
    record = joined.schema["record"].dataType.simpleString()
    out = f"record {record}, n_words long, n_removed long, kept_text string, repeats array<struct<first:int,last:int>>"
    return joined.mapInArrow(_cut_batches, out)
