"""Language of the words of a text by a linear-chain conditional random field.

The words are runs of letters. A word's features are the byte n-grams of its bounded lower-case form (those at a bound
are its affixes) and the languages its entry in a learned lexicon speaks for; transitions between the languages of
neighbouring words are learned with them. Forward-backward gives each word's language distribution, and a text's
language is the one with the largest share of its words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsmith.llm.words import slices, words_of

UNKNOWN = "und"
GRAMS = (2, 3, 4)
BITS = 16
SAMPLE = 1500  # texts that the field is fitted on, at most
MOST_LANGUAGES = 1000  # more are refused
BLOCK = 64

_LETTERS = np.ones(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass
class Field:
    """``weight``: (hashed n-gram, language); ``change``: log transition weights; lexicon as sorted word hashes with
    their log shares per language, taken ``trust`` times."""

    languages: list[str]
    weight: np.ndarray
    change: np.ndarray
    words: np.ndarray
    shares: np.ndarray
    trust: float


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each n-gram, where each word's begin)."""
    size = end - start + 2
    ends = np.cumsum(size)
    head = ends - size
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(head, size)
    wide = np.repeat(size, size)
    inner = (place > 0) & (place < wide - 1)
    body = np.full(len(place), 0x5E, np.uint64)  # bounds
    body[place == wide - 1] = 0x24
    body[inner] = data[np.repeat(start - 1, size)[inner] + place[inner]]
    marks, owner = [], []
    packed, word = body, np.repeat(np.arange(len(size)), size)
    for n in range(2, max(GRAMS) + 1):
        packed = packed[: len(body) - n + 1] | (body[n - 1 :] << np.uint64(8 * (n - 1)))
        if n in GRAMS:
            whole = np.flatnonzero(place[: len(packed)] + n <= wide[: len(packed)])
            mark = packed[whole] + (np.uint64(n) << np.uint64(56))
            marks.append(((mark * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64))
            owner.append(word[whole])
    feature, owner = np.concatenate(marks), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return feature[order], np.searchsorted(owner[order], np.arange(len(size)))


def lexicon_shares(field_words: np.ndarray, shares: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Log shares of each word, 0 for a word that the lexicon lacks."""
    out = np.zeros((len(hashes), shares.shape[1]))
    if len(field_words):
        at = np.minimum(np.searchsorted(field_words, hashes), len(field_words) - 1)
        known = field_words[at] == hashes
        out[known] = shares[at[known]]
    return out


def emissions(field: Field, words, pick: np.ndarray) -> np.ndarray:
    """Score of each language for the words ``pick``."""
    feature, first = word_features(words.data, words.start[pick], words.end[pick])
    out = np.add.reduceat(field.weight[feature], first, axis=0).astype(np.float64) if len(pick) else np.zeros((0, len(field.languages)))
    return out + field.trust * lexicon_shares(field.words, field.shares, words.hash[pick])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def posteriors(score: np.ndarray, change: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Forward-backward over many sequences at once: ``first`` says where each begins in ``score``.

    Sequences are cut into blocks. The products of all blocks are formed side by side, carried from block to block, and
    then the words inside the blocks are filled in, again side by side: exact, in steps of a block's length.
    """
    n, k = score.shape
    size = np.diff(first)
    blocks = -(-size // BLOCK)
    seq = np.repeat(np.arange(len(size)), blocks)
    head = np.cumsum(blocks) - blocks
    number = np.arange(len(seq)) - head[seq]
    start = first[seq] + number * BLOCK
    length = np.minimum(size[seq] - number * BLOCK, BLOCK)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    active = [int(np.searchsorted(-length, -j, "left")) for j in range(BLOCK)]  # blocks longer than j
    e, t = np.exp(score - score.max(axis=1, keepdims=True)), np.exp(change - change.max())
    product = np.broadcast_to(np.eye(k), (len(start), k, k)).copy()
    for j in range(BLOCK):
        a = active[j]
        if not a:
            break
        step = (product[:a].reshape(a * k, k) @ t).reshape(a, k, k) * e[start[:a] + j][:, None, :]
        product[:a] = step / np.maximum(step.max(axis=(1, 2), keepdims=True), 1e-300)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    into, out = np.full((len(start), k), 1.0 / k), np.ones((len(start), k))
    by_size = np.argsort(-blocks, kind="stable")
    counts = -blocks[by_size]
    for b in range(1, int(blocks.max()) if len(blocks) else 0):
        some = by_size[: np.searchsorted(counts, -b, "left")]
        now, last = place[head[some] + b], place[head[some] + b - 1]
        into[now] = _unit(np.einsum("bi,bij->bj", into[last], product[last]))
    for b in range(int(blocks.max()) - 1 if len(blocks) else 0, 0, -1):
        some = by_size[: np.searchsorted(counts, -b, "left")]
        now, last = place[head[some] + b], place[head[some] + b - 1]
        out[last] = _unit(np.einsum("bij,bj->bi", product[now], out[now]))
    forward = np.empty((n, k))
    for j in range(BLOCK):
        a = active[j]
        into[:a] = _unit((into[:a] @ t) * e[start[:a] + j])
        forward[start[:a] + j] = into[:a]
    for j in range(BLOCK - 1, -1, -1):
        a = active[j]
        at = start[:a] + j
        forward[at] *= out[:a]
        out[:a] = _unit((e[at] * out[:a]) @ t.T)
    return _unit(forward)


def fit_field(texts: pa.Array, language: np.ndarray, languages: list[str], rounds: int = 40, seed: int = 5) -> Field:
    """Fits on texts labelled as a whole. Their words are cut into passages and dealt anew, so that languages switch."""
    words = words_of(pc.utf8_lower(texts), _LETTERS)
    k, n = len(languages), len(words.hash)
    empty = Field(languages, np.zeros((1 << BITS, k), np.float32), np.eye(k), np.zeros(0, np.uint64), np.zeros((0, k)), 0.0)
    if n < 2 or k < 2:
        return empty
    rng = np.random.default_rng(seed)
    marks, pick, of = np.unique(words.hash, return_index=True, return_inverse=True)
    label = language[words.row]
    counts = np.stack([np.bincount(of[label == c], minlength=len(marks)) for c in range(k)], axis=1)
    often = np.flatnonzero(counts.sum(axis=1) >= 3)
    shares = np.log((counts[often] + 0.5) / (counts[often].sum(axis=1, keepdims=True) + 0.5 * k)) + np.log(k)
    # Passages of 1 to 60 words of one text, in random order, as sequences of BLOCK words.
    cuts = np.unique(np.concatenate([words.first[:-1], np.flatnonzero(rng.random(n) < 1 / 30)]))
    passages = np.split(np.arange(n), cuts[1:])
    stream = np.concatenate([passages[i] for i in rng.permutation(len(passages))])
    width = min(BLOCK, n)
    stream = np.resize(stream, (-(-n // width), width))  # the last sequence is filled up from the first
    word, y = of[stream], label[stream]
    feature, first = word_features(words.data, words.start[pick], words.end[pick])
    owner = np.repeat(np.arange(len(pick)), np.diff(np.append(first, len(feature))))
    lex = lexicon_shares(marks[often], shares, marks)
    weight, change, trust = np.zeros((1 << BITS, k)), np.zeros((k, k)), 0.1
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weight, change, np.zeros(1))]
    truth = np.zeros((k, k))
    np.add.at(truth, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    for r in range(1, rounds + 1):
        score = np.add.reduceat(weight[feature], first, axis=0) + trust * lex
        e = np.exp(score - score.max(axis=1, keepdims=True))
        t = np.exp(change)
        alpha = np.empty((width, len(stream), k))
        now = np.full((len(stream), k), 1.0 / k)
        for j in range(width):
            now = _unit((now @ t) * e[word[:, j]])
            alpha[j] = now
        beta = np.ones((len(stream), k))
        left = np.zeros((len(pick), k))
        pairs = np.zeros((k, k))
        for j in range(width - 1, -1, -1):
            p = _unit(alpha[j] * beta)
            p[np.arange(len(p)), y[:, j]] -= 1.0
            for c in range(k):
                left[:, c] += np.bincount(word[:, j], p[:, c], minlength=len(pick))
            near = e[word[:, j]] * beta
            if j:
                joint = alpha[j - 1][:, :, None] * t[None] * near[:, None, :]
                pairs += (joint / np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-300)).sum(axis=0)
            beta = _unit(near @ t.T)
        slope = [
            np.stack([np.bincount(feature, left[owner, c], minlength=1 << BITS) for c in range(k)], axis=1) + 1.0 * weight,
            pairs - truth + change,
            np.array([(left * lex).sum()]),
        ]
        step = 0.15 * (1 - (r - 1) / rounds)
        moved = []
        for g, s in zip(slope, state):
            s[0] = 0.8 * s[0] + 0.2 * g
            s[1] = 0.95 * s[1] + 0.05 * g * g
            moved.append(step * (s[0] / (1 - 0.8**r)) / (np.sqrt(s[1] / (1 - 0.95**r)) + 1e-6))
        weight -= moved[0]
        change -= moved[1]
        trust = max(0.0, trust - float(moved[2][0]))
    return Field(languages, weight.astype(np.float32), change, marks[often], shares, trust)


def quotas(counts: dict[str, int], sample: int) -> dict[str, int]:
    """Texts to take of each language: half the sample is dealt evenly, the rest by size. At least one of each."""
    even = {c: min(n, max(sample // (2 * len(counts)), 1)) for c, n in counts.items()}
    left, others = max(sample - sum(even.values()), 0), max(sum(counts.values()) - sum(even.values()), 1)
    return {c: min(n, even[c] + left * (n - even[c]) // others) for c, n in counts.items()}


def fit(docs: DataFrame, allowed: Column, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Field:
    """Fits on at most ``sample`` texts with a language for which ``allowed`` holds, picked by a hash of the key.

    Each language gives a share of the sample, so that rare ones are learned too. Of several texts of a key and language
    the last in order counts. More than ``MOST_LANGUAGES`` languages are refused.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull() & allowed).select(
        F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    keys = known.select("id", "lang").distinct()
    counts = {r["lang"]: r["n"] for r in keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    wanted = quotas(counts, sample) if counts else {}
    # A hash below the bound holds for a few more keys than wanted, so the rank below is over few rows of each language.
    bounds = docs.sparkSession.createDataFrame(
        [(c, q, (q + 6 * q**0.5 + 20) / counts[c]) for c, q in wanted.items()], "lang string, wanted int, bound double")
    place = F.xxhash64("id").cast("double") / 2.0**64 + 0.5
    near = keys.join(F.broadcast(bounds), "lang").where(place <= F.col("bound"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    picked = near.withColumn("rank", rank).where("rank <= wanted").select("id", "lang")
    rows = known.join(F.broadcast(picked), ["id", "lang"]).groupBy("id", "lang").agg(F.max("text").alias("text")).orderBy(
        F.xxhash64("id"), "id", "lang").select("text", "lang").toArrow()
    code = {c: i for i, c in enumerate(languages)}
    label = np.array([code[c] for c in rows.column("lang").to_pylist()], np.int64)
    return fit_field(rows.column("text").combine_chunks(), label, languages)


def shares_of(texts: pa.Array, field: Field) -> np.ndarray:
    """Share of each language among the words of each text; zeros without words."""
    words = words_of(pc.utf8_lower(texts), _LETTERS)
    if not len(words.hash):
        return np.zeros((len(texts), len(field.languages)))
    _, pick, of = np.unique(words.hash, return_index=True, return_inverse=True)
    p = posteriors(emissions(field, words, pick)[of], field.change, words.first)
    sums = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])[words.first]
    return np.diff(sums, axis=0) / np.maximum(words.counts, 1)[:, None]


def label_languages(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``record`` (all columns but the text), ``text``, ``lang_pred``, ``score`` and ``shares`` (map by language).

    ``score`` is the winning share of words, 0 to 1. A text that is null or without a letter is ``und`` with score 0.
    Ties take the first language by name. Repeated rows get equal results. An empty table gives no rows.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            share = shares_of(batch.column("text"), field)
            best = share.argmax(axis=1) if len(field.languages) else np.zeros(batch.num_rows, int)
            none = pc.invert(pc.fill_null(batch.column("letters"), False)).to_numpy(zero_copy_only=False)
            none |= share.sum(axis=1) == 0
            label = [UNKNOWN if x else field.languages[b] for x, b in zip(none, best)]
            value = np.where(none, 0.0, np.minimum(share.max(axis=1, initial=0.0), 1.0))
            rows = [[] if x else list(zip(field.languages, s)) for x, s in zip(none, share.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("record"), batch.column("text"), pa.array(label), pa.array(value), pa.array(rows, pa.map_(pa.string(), pa.float64()))],
                names=["record", "text", "lang_pred", "score", "shares"])

    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(
        F.struct(*rest).alias("record"), F.col(f"`{text}`").alias("text"), F.col(f"`{text}`").rlike(r"\p{L}").alias("letters"))
    schema = f"record {base.schema['record'].dataType.simpleString()}, text string, lang_pred string, score double, shares map<string,double>"
    return base.mapInArrow(run, schema)
