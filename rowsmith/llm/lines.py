"""Removal of lines that many documents hold, decided on hashes and returned as bitmaps instead of text.

Every long line becomes a 128-bit hash of its key with its document and position. The hashes are cut into ranges and
sorted by document (largest first) and position, so a task streams each key's occurrences and knows the first document
at once. Range bounds may fall inside a key, so a key that many documents hold spans many tasks; what such a key leaves
undecided at a bound is at most ``documents`` documents a task, settled by a small aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.llm.words import slices, text_bytes
from rowsmith.session import materialise

CHARS = 40
DOCUMENTS = 5
FLUSH_LINES = 500_000  # occurrences that a task holds before it passes them on
RANGE_ROWS = 1_000_000  # occurrences in a range, about

_FOUND = "h1 long, h2 long, d long, t long, line int, known boolean"
_JUDGED = "h1 long, h2 long, d long, t long, line int"


def long_lines(texts: pa.Array, chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, line number and key hash (two numbers) of the lines whose key has ``chars`` code points or more."""
    data, offset = text_bytes(texts)
    breaks = np.flatnonzero(data == 10)
    of = np.searchsorted(offset, breaks, "right") - 1
    counts = np.bincount(of, minlength=len(texts)) + 1
    lead = np.cumsum(counts) - counts
    start, end = np.empty(counts.sum(), np.int64), np.empty(counts.sum(), np.int64)
    at = np.arange(len(breaks)) + of
    start[lead], start[at + 1] = offset[:-1], breaks + 1
    end[lead + counts - 1], end[at] = offset[1:], breaks
    raw, places, digests = data.tobytes(), [], []
    for i in np.flatnonzero(end - start >= chars).tolist():
        key = raw[start[i] : end[i]].strip().lower()  # of bytes: blanks and letters of ASCII only
        if len(key) >= chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= chars):
            places.append(i)
            digests.append(xxhash.xxh3_128_digest(key))
    places = np.array(places, np.int64)
    row = np.repeat(np.arange(len(texts)), counts)[places]
    return row, places - lead[row], np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def document_ranks(h1: np.ndarray, h2: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of occurrences sorted by key and falling document: the key's number, how many larger documents of the key stand
    before, and how many documents each key has."""
    new = np.ones(len(d), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    other = new.copy()
    other[1:] |= d[1:] != d[:-1]
    group, documents = np.cumsum(new) - 1, np.cumsum(other)
    lead = np.flatnonzero(new)
    ends = np.append(lead[1:], len(d)) - 1
    return group, documents - documents[lead][group], documents[ends] - documents[lead] + 1 if len(d) else lead


def _batch(columns, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _found(chars: int, documents: int):
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def flush(held: list[tuple]) -> pa.RecordBatch:
        h, d, t, line = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((line, t, -d, h[:, 1], h[:, 0]))
        h, d, t, line = h[order], d[order], t[order], line[order]
        _, rank, _ = document_ranks(h[:, 0], h[:, 1], d)
        return _batch((h[:, 0], h[:, 1], d, t, line.astype(np.int32), rank >= documents), names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, lines = [], 0
        for batch in slices(batches, "text"):
            row, line, h = long_lines(batch.column("text"), chars)
            d, t = (batch.column(c).to_numpy()[row] for c in ("d", "t"))
            held.append((h, d, t, line))
            lines += len(line)
            if lines > FLUSH_LINES:
                yield flush(held)
                held, lines = [], 0
        if lines:
            yield flush(held)

    return run


def _judged(documents: int):
    names = [f.split()[0] for f in _JUDGED.split(", ")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        """Streams a sorted range. Without a hash: an occurrence that goes. With one: it belongs to the first or the
        last key of the range, which may go on in the neighbouring ones, and is among its largest documents here."""
        first, carried = None, None

        def settled(part: np.ndarray, gone: np.ndarray, open_: np.ndarray):
            for pick, known in ((gone, True), (open_, False)):
                rows = part[:, pick]
                if rows.shape[1]:
                    keys = [pa.nulls(rows.shape[1], pa.int64())] * 2 if known else [rows[0], rows[1]]
                    yield _batch((*keys, rows[2], rows[3], rows[4].astype(np.int32)), names)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
            if first is None:
                first = part[:2, 0].copy()
            if carried is not None:
                part = np.concatenate([carried, part], axis=1)
            group, rank, held = document_ranks(part[0], part[1], part[2])
            last = group == group[-1]
            leading = (part[0] == first[0]) & (part[1] == first[1]) & ~last
            inner = ~last & ~leading
            gone = (inner & (held[group] >= documents) & (rank > 0)) | (~inner & (rank >= documents))
            yield from settled(part, gone, leading & (rank < documents))
            carried = part[:, last & (rank < documents)]
        if carried is not None:
            none = np.zeros(carried.shape[1], bool)
            yield from settled(carried, none, ~none)

    return run


def _bitmaps(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = batch.column("lines")
        keeps, dropped = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), lines):
            keep = np.ones(n, bool)
            if gone.is_valid:
                keep[gone.values.to_numpy()] = False
            dropped.append(n - int(keep.sum()))
            keeps.append(pa.compress(np.packbits(keep).tobytes(), "zstd", asbytes=True) if dropped[-1] else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(dropped, pa.int64()), pa.array(keeps, pa.binary())],
            names=[*batch.schema.names[:-1], "n_dropped", "keep"])


def kept_lines(n_lines: int, keep: bytes | None) -> np.ndarray:
    """The bitmap of a document, one value per line."""
    if keep is None:
        return np.ones(n_lines, bool)
    bits = pa.decompress(keep, -(-n_lines // 8), "zstd", asbytes=True)
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n_lines).astype(bool)


def _keyed(docs: DataFrame, key: str, text: str) -> tuple[Column, Column]:
    mark = F.xxhash64(F.col(f"`{text}`"))
    return F.coalesce(F.col(f"`{key}`").cast("bigint"), -F.abs(F.shiftright(mark, 1)) - 1).alias("d"), mark.alias("t")


def dropped_lines(docs: DataFrame, chars: int = CHARS, documents: int = DOCUMENTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, t, lines) of the documents that lose lines; ``d`` is the key, ``t`` a hash of the text."""
    spark = docs.sparkSession
    base = docs.select(*_keyed(docs, key, text), F.col(f"`{text}`").alias("text"))
    found = materialise(base.mapInArrow(_found(chars, documents), _FOUND), "lines")
    rows = found.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))
    order = [F.col("h1"), F.col("h2"), F.col("d").desc(), F.col("t"), F.col("line")]
    ranged = found.where("not known").drop("known").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    judged = materialise(ranged.mapInArrow(_judged(documents), _JUDGED), "judged")
    open_ = judged.where("h1 is not null")
    spread = open_.groupBy("h1", "h2").agg(F.max("d").alias("top"), F.count_distinct("d").alias("n")).where(F.col("n") >= documents)
    late = open_.join(spread, ["h1", "h2"]).where("d < top")
    gone = found.where("known").select("d", "t", "line")
    for part in (judged.where("h1 is null"), late):
        gone = gone.union(part.select("d", "t", "line"))
    return gone.groupBy("d", "t").agg(F.collect_set("line").alias("lines"))


def line_bitmaps(docs: DataFrame, chars: int = CHARS, documents: int = DOCUMENTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Which lines of every document stay: a line goes if its key stands in at least ``documents`` documents, but for
    the largest of them, where all its lines stay.

    Lines are split at ``\\n``; the key of a line is the line without blanks (space, tab to carriage return) at both ends
    and with A to Z in lower case; keys of fewer than ``chars`` code points always stay. Returns the columns of ``docs``
    but for ``text`` in ``record`` (names cannot clash), ``n_lines``, ``n_dropped`` and ``keep``, a zstd-compressed
    bitmap, first line in the highest bit, null if all lines stay; ``kept_lines`` reads it.

    Null and empty texts have one empty line. Rows of one key are one document; a row without a key is a document by its
    text, smaller than all keys of 0 and more. Repeated rows get equal bitmaps. A very long text is one record, read in
    one task, and its lines are spread like all others. An empty table gives no rows. Keys are compared by a 128-bit hash.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    lines = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit("\n")).cast("bigint") + 1
    base = docs.select(F.struct(*rest).alias("record"), lines.alias("n_lines"), *_keyed(docs, key, text))
    gone = materialise(dropped_lines(docs, chars, documents, key, text), "dropped")
    joined = base.join(gone, ["d", "t"], "left").select("record", "n_lines", "lines")
    record = joined.schema["record"].dataType.simpleString()
    return joined.mapInArrow(_bitmaps, f"record {record}, n_lines long, n_dropped long, keep binary")


def _cut(batches) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2 << 20):
        texts, counts, dropped, kept = batch.column("text"), [], [], []
        for text, gone in zip(texts, batch.column("lines")):
            raw = (text.as_buffer().to_pybytes() if text.is_valid else b"")
            counts.append(raw.count(b"\n") + 1)
            dropped.append(len(gone.values) if gone.is_valid else 0)
            if gone.is_valid:
                out = set(gone.values.to_pylist())
                raw = b"\n".join([x for i, x in enumerate(raw.split(b"\n")) if i not in out])
            kept.append(raw)
        whole = pc.if_else(pc.is_valid(texts), pa.array(kept, pa.binary()).cast(pa.string()), None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("record"), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), whole],
            names=["record", "n_lines", "n_dropped", "kept_text"])


def drop_lines(docs: DataFrame, chars: int = CHARS, documents: int = DOCUMENTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts without the lines that ``line_bitmaps`` drops: ``record``, ``n_lines``, ``n_dropped``, ``kept_text``.

    Cases as there; a null text stays null. Only documents that lose lines are on the other side of the join.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(F.struct(*rest).alias("record"), F.col(f"`{text}`").alias("text"), *_keyed(docs, key, text))
    gone = materialise(dropped_lines(docs, chars, documents, key, text), "dropped")
    joined = base.join(gone, ["d", "t"], "left").select("record", "text", "lines")
    record = joined.schema["record"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"record {record}, n_lines long, n_dropped long, kept_text string")
