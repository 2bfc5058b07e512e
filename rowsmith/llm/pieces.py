"""SentencePiece encoding with seeded merge dropout, and decoding.

A text is cut before each run of blanks, where no piece can reach across, and every chunk is merged from characters by
the vocabulary's scores. Before a candidate merge is carried out, a keyed hash of the chunk's draw and the candidate
decides whether it is skipped, so a chunk has several segmentations and each decodes to the same text. Many chunks are
merged at once, one merge of each per step.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from rowsmith.llm.words import mix, slices, span_hashes, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
FIRST_BYTE = 3  # id of the piece for byte 0; those of the other bytes follow
NO_MERGE = np.int32(2**31 - 1)
WIDTHS = (8, 16, 32, 64)  # longer chunks are merged one by one
_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class Vocabulary:
    """Pieces, scores and all merges of a BPE model. Ids from ``size`` on are characters that are no piece themselves."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        plain = {}
        for i in range(self.size):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                plain[model.id_to_piece(i)] = i
        symbols = dict(plain)
        for piece in plain:
            for c in piece:
                symbols.setdefault(c, len(symbols) - len(plain) + self.size)
        scores = sorted({model.get_score(i) for i in plain.values()}, reverse=True)
        order = {s: r for r, s in enumerate(scores)}
        self.rank = np.full(self.size, NO_MERGE, np.int32)
        for i in plain.values():
            self.rank[i] = order[model.get_score(i)]
        pairs = {}
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.bits = int(4 * len(pairs)).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.probes = 1
        for key, i in pairs.items():
            at, n = (key * int(_C1) % (1 << 64)) >> (64 - self.bits), 1
            while self.keys[at] != -1:
                at, n = (at + 1) % (1 << self.bits), n + 1
            self.keys[at], self.values[at], self.probes = key, i, max(self.probes, n)
        # Character to symbol; a character of no piece becomes -2 - code point, and a literal blank mark stays one.
        self.symbol = -2 - np.arange(0x110000, dtype=np.int32)
        for s, i in symbols.items():
            if len(s) == 1 and s != BLANK:
                self.symbol[ord(s)] = i
        self.symbol[0x20] = symbols[BLANK]
        self.character = np.zeros(self.size + len(symbols) - len(plain), np.int32)
        self.length = np.ones(len(self.character), np.int32)
        text = [b""] * self.size
        for s, i in symbols.items():
            self.length[i] = len(s)
            if i >= self.size:
                self.character[i] = ord(s)
            else:
                text[i] = s.replace(BLANK, " ").encode()
        for b in range(256):
            text[FIRST_BYTE + b] = bytes([b])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.text_size = np.array([len(x) for x in text])
        self.text_start = np.cumsum(self.text_size) - self.text_size

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two neighbouring symbols form, or -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        at = ((key.view(np.uint64) * _C1) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[at] == key, self.values[at], np.int32(-1))
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != -1) & (key != -2))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % (1 << self.bits)
            same = self.keys[at[open_]] == key[open_]
            out[open_[same]] = self.values[at[open_[same]]]
            open_ = open_[~same & (self.keys[at[open_]] != -1)]
        return out

    def ranks(self, merged: np.ndarray) -> np.ndarray:
        return np.where(merged < 0, NO_MERGE, self.rank[merged])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Known:
    """Segmentations of chunks that a worker met repeatedly, at most ``most`` of them; saves merging them again."""

    def __init__(self, most: int = 600_000):
        self.most = most
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of sorted ``keys``, and which of them are known."""
        place = np.searchsorted(self.keys, keys)
        return place, np.append(self.keys, np.uint64(0))[place] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def add(self, keys: np.ndarray, at: np.ndarray, n: np.ndarray, pool: np.ndarray) -> None:
        room = self.most - len(self.keys)
        keys, at, n = keys[:room], at[:room], n[:room]
        if not len(keys):
            return
        ends = np.cumsum(n)
        flat = pool[np.repeat(at - (ends - n), n) + np.arange(ends[-1])]
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, self.used + ends - n)
        self.n = np.insert(self.n, place, n)
        self.used += len(flat)


@lru_cache(maxsize=4)
def known_chunks(path: str, dropout: float, seed: int, variants: int) -> Known:
    return Known()


def skipped(draw, offset, left, merged, dropout: float):
    """Whether the keyed hash drops a candidate: its chunk's draw, first character, left symbol and result decide."""
    with np.errstate(over="ignore"):
        u = mix(draw + np.asarray(offset).astype(np.uint64) * _C1 + np.asarray(left).astype(np.uint64) * _C2
                + np.asarray(merged).astype(np.uint64) * _C3)
    return (u >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


def merge_agenda(symbols: list[int], draw: int, vocab: Vocabulary, dropout: float) -> list[int]:
    """One chunk by an agenda of candidates, best score first, leftmost of equal ones."""
    n = len(symbols)
    symbol, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    key = np.array([draw], np.uint64)
    agenda: list[tuple] = []

    def offer(lefts, rights):
        merged = vocab.merge(np.array([symbol[i] for i in lefts], np.int32), np.array([symbol[j] for j in rights], np.int32))
        for i, j, m in zip(lefts, rights, merged.tolist()):
            if m >= 0:
                heapq.heappush(agenda, (int(vocab.rank[m]), i, j, symbol[i], symbol[j], m))

    if n > 1:
        offer(list(range(n - 1)), list(range(1, n)))
    while agenda:
        _, i, j, left, right, m = heapq.heappop(agenda)
        if symbol[i] != left or symbol[j] != right or after[i] != j:
            continue
        if dropout and skipped(key, [i], [left], [m], dropout)[0]:
            continue
        symbol[i], symbol[j] = m, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        near = ([(before[i], i)] if before[i] >= 0 else []) + ([(i, after[i])] if after[i] < n else [])
        if near:
            offer([a for a, _ in near], [b for _, b in near])
    out, i = [], 0
    while i < n:
        out.append(symbol[i])
        i = after[i]
    return out


def _shifted(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each row without the entry ``at``; the last column becomes empty."""
    place = np.arange(x.shape[1] - 1)
    out = x.copy()
    out[:, :-1] = np.where(place[None, :] >= at[:, None], x[:, 1:], x[:, :-1])
    return out


def merge_many(s: np.ndarray, draw: np.ndarray, vocab: Vocabulary, dropout: float) -> np.ndarray:
    """The same for many chunks, one per row of ``s`` (-1 beyond the end)."""
    done = np.full_like(s, -1)
    row = np.arange(len(s))
    merged = vocab.merge(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(len(s), -1)
    rank = vocab.ranks(merged)
    while len(row):
        at = rank.argmin(axis=1)
        here = np.arange(len(row))
        open_ = rank[here, at] != NO_MERGE
        done[row[~open_]] = s[~open_]
        row, s, merged, rank, draw, at = row[open_], s[open_], merged[open_], rank[open_], draw[open_], at[open_]
        if not len(row):
            break
        here = np.arange(len(row))
        piece = merged[here, at]
        if dropout:
            before = np.arange(s.shape[1])[None, :] < at[:, None]
            offset = np.where(before, vocab.length[np.maximum(s, 0)], 0).sum(axis=1)
            skip = skipped(draw, offset, s[here, at], piece, dropout)
        else:
            skip = np.zeros(len(row), bool)
        rank[here[skip], at[skip]] = NO_MERGE
        go = np.flatnonzero(~skip)
        if not len(go):
            continue
        c, p = at[go], piece[go]
        t = _shifted(s[go], c + 1)
        t[:, -1] = -1
        i = np.arange(len(go))
        t[i, c] = p
        r, m = _shifted(rank[go], c), _shifted(merged[go], c)
        r[:, -1], m[:, -1] = NO_MERGE, -1
        right = np.where(c + 1 < t.shape[1], t[i, np.minimum(c + 1, t.shape[1] - 1)], -1)
        new = vocab.merge(p, right)
        fits = c < r.shape[1]
        r[i[fits], c[fits]], m[i[fits], c[fits]] = vocab.ranks(new)[fits], new[fits]
        has = c > 0
        new = vocab.merge(t[i[has], c[has] - 1], p[has])
        r[i[has], c[has] - 1], m[i[has], c[has] - 1] = vocab.ranks(new), new
        s[go], rank[go], merged[go] = t, r, m
    return done


def _utf8(symbols: np.ndarray, sizes: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols with what is no piece as its bytes, and the sizes of the chunks in these ids."""
    odd = np.flatnonzero((symbols < 0) | (symbols >= vocab.size))
    if not len(odd):
        return symbols, sizes
    x = symbols[odd]
    points = np.where(x < 0, -2 - x, vocab.character[np.maximum(x, 0)]).astype("<u4")
    raw = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)
    widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    width = np.ones(len(symbols), np.int64)
    width[odd] = widths
    out = np.repeat(symbols, width)
    start = np.cumsum(width) - width
    place = np.repeat(start[odd] - (np.cumsum(widths) - widths), widths) + np.arange(len(raw))
    out[place] = FIRST_BYTE + raw.astype(np.int32)
    return out, np.add.reduceat(width, np.cumsum(sizes) - sizes)


def encode_texts(texts: pa.Array, keys: np.ndarray, vocab: Vocabulary, dropout: float, seed: int, variants: int,
                 known: Known | None = None):
    """(ids of all texts one after another, where each text's begin). ``keys``: a 64-bit number per text."""
    known = known or Known(0)
    seeded = mix(np.array([seed], np.uint64) * _C1)
    data, offset = text_bytes(texts)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offset]
    filled = np.flatnonzero(np.diff(heads) > 0)
    if not len(filled):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    points = np.insert(points, heads[filled], 0x20)  # every text starts with a blank, as the model was trained
    begins = heads[filled] + np.arange(len(filled))
    blank = points == 0x20
    starts = blank.copy()
    starts[1:] &= ~blank[:-1]
    starts[begins] = True
    start = np.flatnonzero(starts)
    end = np.append(start[1:], len(points))
    row = filled[np.searchsorted(begins, start, "right") - 1]
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    ordinal = np.arange(len(start)) - first[row]
    draw = mix(mix(keys[row] + seeded) + ordinal.astype(np.uint64) * _C2) % np.uint64(variants)
    chunk = span_hashes(points.astype(np.uint64) + np.uint64(1), start, end)
    marks, pick, of, times = np.unique(mix(chunk + draw * _C3), return_index=True, return_inverse=True, return_counts=True)
    begin, size = start[pick], (end - start)[pick]
    key = mix(chunk[pick] + mix(draw[pick] + seeded))
    symbols = vocab.symbol[points]
    at, counts = np.zeros(len(pick), np.int64), np.zeros(len(pick), np.int64)
    place, hit = known.find(marks)
    at[hit], counts[hit] = known.at[place[hit]], known.n[place[hit]]
    parts, total, low = [known.pool[: known.used]], known.used, 0
    size = np.where(hit, 0, size)
    for width in WIDTHS:
        group = np.flatnonzero((size > low) & (size <= width))  # known chunks have size 0 here
        low = width
        for g in range(0, len(group), 1 << 15):
            part = group[g : g + (1 << 15)]
            column = np.arange(width)
            inside = column[None, :] < size[part][:, None]
            s = np.where(inside, symbols[np.minimum(begin[part][:, None] + column, len(symbols) - 1)], np.int32(-1))
            out = merge_many(s, key[part], vocab, dropout)
            used = out != -1
            flat, n = _utf8(out[used], used.sum(1), vocab)
            parts.append(flat)
            counts[part] = n
            at[part] = total + np.cumsum(n) - n
            total += len(flat)
    for i in np.flatnonzero(size > low):
        out = np.array(merge_agenda(symbols[begin[i] : begin[i] + size[i]].tolist(), key[i], vocab, dropout), np.int32)
        flat, n = _utf8(out, np.array([len(out)]), vocab)
        parts.append(flat)
        counts[i], at[i] = n[0], total
        total += len(flat)
    pool = np.concatenate(parts)
    often = np.flatnonzero((times > 1) & ~hit)
    known.add(marks[often], at[often], counts[often], pool)
    n = counts[of]
    ends = np.cumsum(n)
    ids = pool[np.repeat(at[of] - (ends - n), n) + np.arange(ends[-1])]
    return ids.astype(np.int32), np.concatenate([[0], ends])[first]


def decode_ids(ids: np.ndarray, first: np.ndarray, vocab: Vocabulary) -> list[bytes]:
    """The texts of lists of ids; the blank that encoding put in front is taken off."""
    size = vocab.text_size[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    raw = vocab.text[np.repeat(vocab.text_start[ids] - (ends - size), size) + np.arange(total)].tobytes()
    edge = np.concatenate([[0], ends])[first]
    return [raw[a + 1 : b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def encode(docs: DataFrame, model: str = MODEL, dropout: float = 0.1, seed: int = 7, variants: int = 16,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``record`` (all columns but the text), ``text`` and ``ids`` (array of int).

    Each occurrence of a chunk draws one of ``variants`` segmentations by a keyed hash of seed, document key and place;
    with ``dropout`` 0 the ids are those of the model itself. Null and empty texts have no ids. Control characters and
    characters of no piece become byte pieces, so every text decodes to itself. Rows equal in key and text get equal
    ids. An empty table gives no rows.
    """

    def run(batches):
        vocab, known = vocabulary(model), known_chunks(model, dropout, seed, variants)
        for batch in slices(batches, "text"):
            keys = batch.column("key").to_numpy().view(np.uint64)
            ids, first = encode_texts(batch.column("text"), keys, vocab, dropout, seed, variants, known)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("record"), batch.column("text"), lists], names=["record", "text", "ids"])

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(F.struct(*rest).alias("record"), F.xxhash64(F.col(f"`{key}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    return base.mapInArrow(run, f"record {base.schema['record'].dataType.simpleString()}, text string, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` to a table with a column of ids; null and empty lists give the empty text."""

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                column = part.column(ids)
                first = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy())])
                texts = decode_ids(column.flatten().to_numpy(), first, vocab)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*part.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, decoded string")
