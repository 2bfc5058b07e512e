"""Quality rules from the fertility of public tokenizers.

Every word is encoded by two public vocabularies. Characters per token, the share of byte pieces and the entropy of the
tokens say how far a text is from what the vocabularies were made for; per language (else script) the corpus gives the
band outside which a text is rejected.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowsmith.llm.pieces import FIRST_BYTE, Known
from rowsmith.llm.words import Words, byte_hashes, slices, window_hashes, words_of
from rowsmith.session import materialise

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SYMBOLS = b"#*$%&|<>"
FENCE = 3.0  # quartile distances beyond the quartiles that a band allows
PRIOR = 100  # the band of its script counts for a language as much as so many sound texts of its own
#: Measure: bins of the corpus histogram per unit.
MEASURES = {"piece_chars": 100, "piece_bytes": 1000, "piece_entropy": 500, "byte_chars": 100, "byte_parts": 1000, "byte_entropy": 500}


@lru_cache(maxsize=4)
def piece_vocabulary(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path), Known(), _marked(range(FIRST_BYTE, FIRST_BYTE + 256), 1 << 17)


@lru_cache(maxsize=4)
def byte_vocabulary(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoder, Known(), _marked((i for b, i in ranks.items() if len(b) == 1 and b[0] >= 0x80), 1 << 17)


def _marked(ids, size: int) -> np.ndarray:
    out = np.zeros(size, bool)
    out[list(ids)] = True
    return out


def base_measures(words: Words) -> dict[str, np.ndarray]:
    """Counts of each text that need no vocabulary."""
    data, first, n = words.data, words.first, words.counts
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    of_word = np.concatenate([[0], np.cumsum(chars[words.end] - chars[words.start])])
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    symbols = np.concatenate([[0], np.cumsum(table[data])])[words.offset]
    breaks = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([words.offset[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, words.offset[1:]]))
    word = np.searchsorted(words.start, start)
    filled = np.searchsorted(words.start, end) > word
    start, end, row = start[filled], end[filled], words.row[word[filled]]
    lines = byte_hashes(data, start, end)
    order = np.lexsort((lines, row))
    again = (lines[order][1:] == lines[order][:-1]) & (row[order][1:] == row[order][:-1])
    windows, inside = window_hashes(words, 5)
    at = np.flatnonzero(inside)
    place = np.lexsort((windows[at], words.row[at]))
    h, r = windows[at][place], words.row[at][place]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    twice = at[place][same[1:] | same[:-1]]
    step = np.zeros(len(words.hash) + 6, np.int64)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + 5, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step)[: len(words.hash)] > 0)])
    return {
        "n_words": n,
        "word_chars": np.diff(of_word[first]),
        "n_symbols": np.diff(symbols),
        "n_dup_lines": np.bincount(row[order][1:][again], minlength=len(n)),
        "n_repeat_words": np.diff(covered[first]),
    }


def token_measures(words: Words, raw: bytes, word_chars: np.ndarray, encode, known: Known, odd: np.ndarray):
    """Characters per token, share of ``odd`` tokens and entropy over its greatest value; NaN for texts without words."""
    marks, pick, of, times = np.unique(words.hash, return_index=True, return_inverse=True, return_counts=True)
    place, hit = known.find(marks)
    at, n = np.zeros(len(marks), np.int64), np.zeros(len(marks), np.int64)
    at[hit], n[hit] = known.at[place[hit]], known.n[place[hit]]
    new = np.flatnonzero(~hit)
    lists = encode([raw[a:b].decode() for a, b in zip(words.start[pick[new]].tolist(), words.end[pick[new]].tolist())])
    n[new] = np.fromiter(map(len, lists), np.int64, len(lists))
    at[new] = known.used + np.cumsum(n[new]) - n[new]
    pool = np.concatenate([known.pool[: known.used], np.fromiter(chain.from_iterable(lists), np.int32, int(n[new].sum()))])
    often = new[times[new] > 1]
    known.add(marks[often], at[often], n[often], pool)
    size = n[of]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    tokens = pool[np.repeat(at[of] - (ends - size), size) + np.arange(total)]
    first = np.concatenate([[0], ends])[words.first]
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    strange = np.bincount(row[odd[tokens]], minlength=len(count))
    packed = np.sort(row.astype(np.int64) << 20 | tokens)
    edge = np.flatnonzero(np.diff(packed, prepend=-1))
    times = np.diff(np.append(edge, len(packed)))
    bits = np.bincount(packed[edge] >> 20, times * np.log2(np.maximum(times, 1)), minlength=len(count))
    with np.errstate(divide="ignore", invalid="ignore"):
        most = np.log2(count)
        entropy = np.where(count > 1, (most - bits / count) / most, 1.0)
        entropy[count == 0] = np.nan
        return word_chars / count, strange / count, entropy


def scripts(words: Words) -> list[str]:
    """The script that most non-blank bytes of a text belong to, by the lead bytes of its characters."""
    # Lead bytes of UTF-8 per block of scripts.
    blocks = {"latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)], "greek": [0xCD, 0xCE, 0xCF],
              "cyrillic": [0xD0, 0xD1, 0xD2, 0xD3], "semitic": [0xD6, 0xD7, 0xD8, 0xD9, 0xDA, 0xDB], "indic": [0xE0],
              "east": [*range(0xE1, 0xF0)]}
    counts = []
    for leads in blocks.values():
        mark = np.zeros(256, bool)
        mark[leads] = True
        counts.append(np.diff(np.concatenate([[0], np.cumsum(mark[words.data])])[words.offset]))
    best, names = np.argmax(counts, axis=0), [*blocks]
    empty = np.sum(counts, axis=0) == 0
    return ["none" if e else names[b] for b, e in zip(best, empty)]


def _measure(pieces: str, ranks: str):
    def run(batches):
        model, model_known, model_odd = piece_vocabulary(pieces)
        encoder, encoder_known, encoder_odd = byte_vocabulary(ranks)
        for batch in slices(batches, "text", 2 << 20):
            words = words_of(batch.column("text"))
            base, raw = base_measures(words), words.data.tobytes()
            p = token_measures(words, raw, base["word_chars"], model.encode, model_known, model_odd)
            b = token_measures(words, raw, base["word_chars"], lambda ws: [encoder.encode_ordinary(" " + w) for w in ws], encoder_known, encoder_odd)
            script = scripts(words)
            groups = [g if g is not None else f"script {s}" for g, s in zip(batch.column("band").to_pylist(), script)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("record"), pa.array(groups, pa.string()), pa.array(script, pa.string()), *(pa.array(x) for x in base.values()), *(pa.array(x, from_pandas=True) for x in (*p, *b))],
                names=["record", "band", "script", *base, *MEASURES])

    return run


def bands(measured: DataFrame) -> DataFrame:
    """One row per band name: ``low`` and ``high`` of each measure.

    Quartiles come from a histogram of fixed bins over every text that passed the base rules. The limits of a band are
    drawn towards those of its most frequent script, the less the more texts it has, but only outwards: what its own
    texts allow is not rejected by others. The same rule holds for any number of texts.
    """
    sound = measured.where(~F.col("base_failed"))
    bins = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) * per).alias("bin"), F.lit(per).alias("per")) for m, per in MEASURES.items()
    ])).alias("x")
    keys = ["measure", "per", "bin"]
    counted = sound.select("band", "script", bins).select("band", "script", "x.*").groupBy("band", "script", *keys).agg(F.count(F.lit(1)).alias("n"))
    counted = materialise(counted, "histogram")

    def edges(group: str) -> DataFrame:
        of = counted.groupBy(group, *keys).agg(F.sum("n").alias("n"))
        so_far, total = Window.partitionBy(group, "measure").orderBy("bin"), Window.partitionBy(group, "measure")
        ranked = of.withColumn("upto", F.sum("n").over(so_far)).withColumn("total", F.sum("n").over(total))
        quartile = [F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))).alias(name) for q, name in ((0.25, "q1"), (0.75, "q3"))]
        found = ranked.groupBy(group, "measure", "per").agg(*quartile, F.max("total").alias("texts"))
        # Quartiles of few texts are uncertain: their band is wider.
        wide = F.greatest(F.col("q3") - F.col("q1"), F.lit(2)) * FENCE * (1 + 1 / F.sqrt("texts"))
        return found.select(group, "measure", "texts", ((F.col("q1") - wide) / F.col("per")).alias("low"), ((F.col("q3") + 1 + wide) / F.col("per")).alias("high"))

    script = counted.groupBy("band", "script").agg(F.sum("n").alias("n")).groupBy("band").agg(F.max(F.struct("n", "script"))["script"].alias("script"))
    prior = edges("script").select("script", "measure", F.col("low").alias("script_low"), F.col("high").alias("script_high"))
    both = edges("band").join(script, "band").join(prior, ["script", "measure"])
    rest = PRIOR / (F.col("texts") + PRIOR)
    low = F.col("low") + rest * F.least(F.col("script_low") - F.col("low"), F.lit(0.0))
    high = F.col("high") + rest * F.greatest(F.col("script_high") - F.col("high"), F.lit(0.0))
    return both.groupBy("band").agg(
        F.map_from_entries(F.collect_list(F.struct("measure", low))).alias("least"),
        F.map_from_entries(F.collect_list(F.struct("measure", high))).alias("most"),
    )


def fertility_rules(docs: DataFrame, band: str = "lang", pieces: str = PIECES, ranks: str = RANKS, text: str = "text") -> DataFrame:
    """``record`` (all columns but the text), the base counts and measures, ``base_failed`` and ``kept``.

    The band of a text is its language, else its script; few texts widen it, towards the band of their script too.
    Shares of byte pieces have no lower limit. Bands widen by the scatter of a measure over few tokens. Null and empty texts have no words and fail the base rules; their
    measures are null. Repeated rows get equal results and count as often as they occur. An empty table gives no rows.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = docs.select(F.struct(*rest).alias("record"), F.col(f"`{band}`").cast("string").alias("band"), F.col(f"`{text}`").alias("text"))
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    schema = f"record {base.schema['record'].dataType.simpleString()}, band string, script string, {counts}, " + ", ".join(f"{m} double" for m in MEASURES)
    measured = base.mapInArrow(_measure(pieces, ranks), schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    measured = materialise(measured.withColumn("base_failed", failed), "measured")
    found = materialise(bands(measured), "bands")
    judged = measured.join(found, "band", "left")
    inside = ~F.col("base_failed")
    for m in MEASURES:
        # A measure over n tokens scatters by about 1 / sqrt(n): few tokens need a clearer miss.
        scatter = F.sqrt(F.col("piece_chars" if m.startswith("piece") else "byte_chars") / F.col("word_chars"))
        if m.endswith("chars"):
            inside &= F.col(m) <= F.col("most")[m] * (1 + scatter)
            inside &= F.col(m) >= F.col("least")[m] * (1 - scatter)
        else:
            inside &= F.col(m) <= F.col("most")[m] + scatter
        if m.endswith("entropy"):
            inside &= F.col(m) >= F.col("least")[m] - scatter
    return judged.withColumn("kept", F.coalesce(inside, F.lit(False))).drop("band", "script", "least", "most")
