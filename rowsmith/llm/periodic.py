"""Runs of a repeated period in the words of a text, by recompression.

A grammar is built over the words: rounds of block compression (equal neighbours become one symbol with a count) and
pair compression (a symbol of the left class and one of the right class behind it become one symbol) until no symbol
occurs twice. Equal stretches get equal symbols but for a few at their ends, so a longest common extension climbs the
grammar and comes down again, a few steps a level. A run of period q and exponent 4 or more holds four neighbouring
multiples of q, so the candidates are the points of the grids of all q, of which there are n * log n; points whose
words differ from those one, two or three periods on go at once, the others are extended both ways by the grammar.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsmith.llm.words import Words, mix, slices, words_of

EXPONENT = 4
LEAST_WORDS = 6
_SECTION = 1 << 20  # grid points looked at together


@dataclass
class Level:
    """``symbol`` of each place; ``first``: where its children begin in the level below (and the end); ``parent`` in the
    level above; ``blocks``: whether the level above was made by block compression."""

    symbol: np.ndarray
    first: np.ndarray | None
    parent: np.ndarray | None = None
    blocks: bool = False


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number per distinct pair of small numbers."""
    return np.unique(left.astype(np.int64) * (int(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int32)


def recompressed(symbols: np.ndarray, seed: int = 11) -> list[Level]:
    """The levels of the grammar of a sequence, lowest first."""
    symbols = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    levels = [Level(symbols, None)]
    for turn in range(400):
        symbols = levels[-1].symbol
        if len(symbols) < 2 or int(symbols.max()) + 1 == len(symbols):
            break
        lead = np.ones(len(symbols), bool)
        blocks = turn % 2 == 0
        if blocks:
            lead[1:] = symbols[1:] != symbols[:-1]
        else:
            right = (mix(symbols.astype(np.uint64) + np.uint64((seed << 40) + (turn << 32))) & np.uint64(1)).astype(bool)
            lead[1:] = right[:-1] | ~right[1:]
        if lead.all():
            continue
        at = np.flatnonzero(lead)
        first = np.append(at, len(symbols)).astype(np.int32)
        size = np.diff(first)
        second = size if blocks else np.where(size == 2, symbols[np.minimum(at + 1, len(symbols) - 1)] + 1, 0)
        levels[-1].parent = np.repeat(np.arange(len(at), dtype=np.int32), size)
        levels[-1].blocks = blocks
        levels.append(Level(_named(symbols[at], second), first))
    return levels


def common_extension(levels: list[Level], a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
    """How many symbols of the lowest level agree from ``a`` and ``b`` on (``ahead``), or up to them and backwards.

    The first and the last symbol of the sequence, and any that must not be crossed, occur once; ``a`` is not ``b``.
    """
    x, y = a.astype(np.int64), b.astype(np.int64)
    sign = 1 if ahead else -1
    stopped: list[np.ndarray] = []

    def advance(i: int, todo: np.ndarray) -> None:
        level, step = levels[i], 1
        if level.blocks:  # equal symbols stand in blocks, of which the shorter rest is passed at once
            bounds, up, vp = levels[i + 1].first, level.parent[x[todo]], level.parent[y[todo]]
            step = np.minimum(bounds[up + 1] - x[todo], bounds[vp + 1] - y[todo]) if ahead else np.minimum(x[todo] - bounds[up], y[todo] - bounds[vp]) + 1
        x[todo] += sign * step
        y[todo] += sign * step

    live = np.arange(len(x))
    for i, level in enumerate(levels):
        rising, stops, todo = [], [], live
        while len(todo):
            if level.parent is not None:
                up, vp, bounds = level.parent[x[todo]], level.parent[y[todo]], levels[i + 1].first
                edge = (bounds[up] == x[todo]) & (bounds[vp] == y[todo]) if ahead else (bounds[up + 1] == x[todo] + 1) & (bounds[vp + 1] == y[todo] + 1)
                rise = todo[edge]
                x[rise], y[rise] = up[edge], vp[edge]
                rising.append(rise)
                todo = todo[~edge]
            same = level.symbol[x[todo]] == level.symbol[y[todo]]
            stops.append(todo[~same])
            todo = todo[same]
            advance(i, todo)
        stopped.append(np.concatenate(stops) if stops else live[:0])
        live = np.concatenate(rising) if rising else live[:0]
    falling = live[:0]
    for i in range(len(levels) - 1, 0, -1):
        falling = np.concatenate([falling, stopped[i]])
        first = levels[i].first
        x[falling], y[falling] = (first[x[falling]], first[y[falling]]) if ahead else (first[x[falling] + 1] - 1, first[y[falling] + 1] - 1)
        todo = falling
        while len(todo):
            todo = todo[levels[i - 1].symbol[x[todo]] == levels[i - 1].symbol[y[todo]]]
            advance(i - 1, todo)
    return np.abs(x - a)


def grid_chains(codes: np.ndarray, reach: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Candidates (period, first point, number of points), points of one chain a period apart.

    ``reach[q - 1]`` is how far texts that may hold period ``q`` extend, ``text`` the number of the text of each place. A
    point stays if its word and the word half a period behind it come again one and two periods on, and its word a third
    time, all in one text.
    """
    periods = np.arange(1, len(reach) + 1)
    counts = np.maximum(-(-(reach - 3 * periods) // periods), 0)
    ends = np.cumsum(counts)
    out = [np.zeros((3, 0), np.int64)]
    for low in range(0, int(ends[-1]) if len(ends) else 0, _SECTION):
        number = np.arange(low, min(low + _SECTION, int(ends[-1])))
        which = np.searchsorted(ends, number, "right")
        q = periods[which]
        i = (number - (ends[which] - counts[which])) * q
        for shift in (0, 1, 2):
            same = codes[i + shift * q] == codes[i + (shift + 1) * q]
            i, q = i[same], q[same]
        half = i + q // 2
        same = (codes[half] == codes[half + q]) & (codes[half + q] == codes[half + 2 * q])
        same &= text[i] == text[i + 3 * q]  # words of the texts behind it may agree by chance
        i, q = i[same], q[same]
        if len(i):
            new = np.ones(len(i), bool)
            new[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1] + q[1:])
            lead = np.flatnonzero(new)
            out.append(np.stack([q[lead], i[lead], np.diff(np.append(lead, len(i)))]))
    return np.concatenate(out, axis=1)


def extended_runs(codes: np.ndarray, chains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs that the candidates belong to.

    Periods are taken by powers of two, so that a period and its multiples come in different turns: points inside a run
    already found whose period divides theirs need no extension.
    """
    levels = recompressed(codes)
    cover = np.full(len(codes), -1, np.int32)
    starts, ends, periods = [], [], []
    power = np.floor(np.log2(np.maximum(chains[0], 1))).astype(int)
    for turn in range(int(power.max(initial=-1)) + 1):
        q, i, left = chains[:, power == turn]
        while len(q):
            if starts:
                of = cover[i]
                end, period = np.array(ends)[of], np.array(periods)[of]
                skip = np.where((of >= 0) & (q % period == 0), np.maximum(-(-(end - 3 * q - i) // q), 0), 0)
                i, left = i + skip * q, left - skip
                q, i, left = q[left > 0], i[left > 0], left[left > 0]
            if not len(q):
                break
            start = i - common_extension(levels, i - 1, i + q - 1, False)
            end = i + q + common_extension(levels, i, i + q, True)
            sound = np.flatnonzero(end - start >= np.maximum(LEAST_WORDS, EXPONENT * q))
            for s, e, p in zip(start[sound].tolist(), end[sound].tolist(), q[sound].tolist()):
                now = cover[(s + e) // 2]
                if now < 0 or ends[now] - starts[now] < e - s:
                    cover[s:e] = len(starts)
                starts.append(s)
                ends.append(e)
                periods.append(p)
            # All points up to one period before the end of the stretch belong to it.
            skip = np.maximum(-(-(end - q - i) // q), 1)
            i, left = i + skip * q, left - skip
            q, i, left = q[left > 0], i[left > 0], left[left > 0]
    s, e, p = (np.array(v, np.int64) for v in (starts, ends, periods))
    order = np.lexsort((p, e, s))
    s, e, p = s[order], e[order], p[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return s[new], e[new], p[new]


def _bounded(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another with a code of its own before, between and behind them, and where each begins."""
    begin = np.cumsum(counts + 1) - counts
    codes = mix(np.arange(len(counts) + int(counts.sum()) + 1, dtype=np.uint64) + np.uint64(1 << 62))
    of = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
    codes[begin[of] + inside] = values[first[of] + inside]
    return codes, begin


def runs_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of the runs of all texts, by text, start and period."""
    counts = words.counts.astype(np.int64)
    order = np.argsort(-counts, kind="stable")  # long texts first: those that may hold a period are the foremost
    order = order[counts[order] >= LEAST_WORDS]
    if not len(order):
        return (np.zeros(0, np.int64),) * 4
    codes, begin = _bounded(words.hash, words.first[order], counts[order])
    fits = np.searchsorted(-counts[order], -EXPONENT * np.arange(1, int(counts[order[0]]) // EXPONENT + 1), "right")
    text = np.repeat(np.arange(-1, len(order), dtype=np.int32), np.append(1, counts[order] + 1))
    chains = grid_chains(codes, (begin + counts[order])[fits - 1], text)
    # The grammar is that of the texts with candidates alone.
    held, of = np.unique(text[chains[1]], return_inverse=True)
    codes, place = _bounded(words.hash, words.first[order[held]], counts[order[held]])
    chains[1] += (place - begin[held])[of]
    start, end, period = extended_runs(codes, chains)
    at = np.searchsorted(place, start, "right") - 1
    row, start, length = order[held[at]], start - place[at], end - start
    by = np.lexsort((period, start, row))
    return row[by], start[by], length[by], period[by]


def _collapsed(raw: bytes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    pieces = raw.split()  # of bytes: at blanks of ASCII only
    if len(start):
        change = np.zeros(len(pieces) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        pieces = [pieces[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
    return b" ".join(pieces)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batches(batches) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = words_of(batch.column("text"))
        row, start, length, period = runs_of(words)
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
        raw, offset = words.data.tobytes(), words.offset.tolist()
        kept = []
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            kept.append(_collapsed(raw[offset[i] : offset[i + 1]], start[a:b], length[a:b], period[a:b]))
        runs = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], fields=list(_RUN))
        yield pa.RecordBatch.from_arrays(
            [batch.column("record"), pa.array(words.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), runs),
             pa.array(kept, pa.binary()).cast(pa.string())],
            names=["record", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The runs of every text and the text without their repetitions.

    A run is a stretch of at least six words that repeats its smallest period at least four times and cannot be made
    longer. Returns the columns of ``docs`` but for ``text`` in ``record`` (names cannot clash), ``n_words``, ``runs``
    (start as word number, length, period; by start and period) and ``collapsed``: the words joined by one space, without
    those that a run holds after its first period. Null and empty texts have no words, no runs and an empty ``collapsed``.
    Each row is judged alone, so repeated rows get equal results; an empty table gives no rows. A very long text is read
    in one task, in memory that grows with its words. Words are compared by a 64-bit hash within a text.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*rest).alias("record"), F.col(f"`{text}`").alias("text"))
    record = rows.schema["record"].dataType.simpleString()
    return rows.mapInArrow(
        _batches, f"record {record}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
