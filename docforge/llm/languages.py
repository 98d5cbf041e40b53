"""Problem 7: the language of each record, and of each line of a record that mixes languages.

N-grams of the labelled samples are kept in one bit-sliced Bloom filter: a slot is a bit mask of languages,
and the AND of an n-gram's slots names all languages that may contain it, in one lookup for all of them.
Per line the set bits are counted by language, the share expected from false positives (the filter's fill
to the power of its hashes) is taken off, and the largest corrected count decides. All characters of a
batch are hashed and looked up as arrays. Any number of languages and all scripts take part; in scripts
that write a syllable or word in a character, one character stands for an n-gram. Whether a text mixes
languages is decided by all lines together, so that several short lines count like a long one.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.llm import garbled as g
from docforge.llm.arrow import codepoints, slices

GRAM = 4
HASHES = 3
#: Share of n-grams unknown to a language that the filter may take for one of its own; the slots follow from it.
FALSE_RATE = 1e-4
#: The filter has 2 to the power of so many slots at least and at most (with more n-grams, false positives rise, and are taken off).
LEAST_BITS, MOST_BITS = 12, 26
#: Labelled samples used to fill the filter, at most; all of the fixed table here.
MOST_SAMPLES = 20_000
#: Languages of one plane of the filter, a bit each.
PLANE = 64
#: A second language is in a text if, over the lines that it leads, it has so many n-grams more than the text's first one.
SECOND_GRAMS = 6.0
#: A line is taken as evidence of a second language if that leads all others by such a share of the line's n-grams.
LEAST_LEAD = 0.15
_fold: list[np.ndarray] = []

# Spellings of the eight languages' names, besides the two-letter codes.
SPELLINGS = {
    "en": "eng english anglais englisch",
    "fr": "fra fre french français francais",
    "de": "deu ger german deutsch",
    "es": "spa spanish español espanol castellano",
    "it": "ita italian italiano",
    "pt": "por portuguese português portugues",
    "ru": "rus russian русский",
    "hi": "hin hindi हिन्दी हिंदी",
}


def fold_table() -> np.ndarray:
    """Lower-case letter or mark of each code point; a blank for everything else."""
    if not _fold:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if unicodedata.category(x)[0] in "LM":
                low = x.lower()
                out[c] = ord(low) if len(low) == 1 else c
        out[10] = 10
        _fold.append(out)
    return _fold[0]


def wide(cp: np.ndarray) -> np.ndarray:
    """Characters of scripts whose one character says as much as an n-gram of others: kana, Han and Hangul."""
    return (cp >= 0x3040) & (cp <= 0x9FFF) | (cp >= 0xAC00) & (cp <= 0xD7A3) | (cp >= 0x20000) & (cp <= 0x3FFFF) | (cp >= 0xF900) & (cp <= 0xFAFF)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each n-gram, the line it lies in, lines of each text); lines are numbered through all texts."""
    joined = "\n".join(texts) + "\n" + " " * (GRAM - 1)
    cp = fold_table()[codepoints(joined)]
    blank = cp == 32
    before = np.empty_like(blank)
    before[0] = True
    before[1:] = blank[:-1] | (cp[:-1] == 10)
    before[1 - GRAM :] = False
    cp = cp[~(blank & before)].astype(np.uint64)  # one blank between words, none at a line's start
    breaks = cp == 10
    line = np.cumsum(breaks) - breaks
    n = len(cp) - GRAM + 1
    key = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            key = key * np.uint64(0x100000001B3) + cp[k : k + n]
        one = wide(cp[:n])
        if one.any():
            key = np.where(one, cp[:n], key)
        key *= np.uint64(0x9E3779B97F4A7C15)
    inside = (line[:n] == line[GRAM - 1 :]) & ~breaks[GRAM - 1 :] | one
    return key[inside], line[:n][inside], np.array([t.count("\n") + 1 for t in texts])


def slots(key: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th slot of each n-gram."""
    with np.errstate(over="ignore"):
        step = (key * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(29) | np.uint64(1)
        mixed = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + step * np.uint64(k)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64) if k == 0 else ((mixed ^ (mixed >> np.uint64(33))) & np.uint64((1 << bits) - 1)).astype(np.int64)


class LanguageFilter:
    """The bit-sliced filter over any number of languages: planes of slots, a slot the bit mask of up to 64 languages."""

    def __init__(self, languages: list[str], planes: list[np.ndarray]):
        self.languages, self.planes = languages, planes
        self.bits = int(len(planes[0])).bit_length() - 1 if planes else LEAST_BITS
        fill = [((planes[i // PLANE] >> planes[i // PLANE].dtype.type(i % PLANE)) & 1).mean() for i in range(len(languages))]
        self.false = np.array(fill) ** HASHES

    @classmethod
    def fit(cls, samples: list[tuple[str, str]]) -> LanguageFilter:
        """The filter over (language, text) pairs, as large as the language with most n-grams needs for ``FALSE_RATE``."""
        languages = sorted({lang for lang, _ in samples})
        keys = [np.unique(grams([t for x, t in samples if x == lang and t] or [""])[0]) for lang in languages]
        need = HASHES * max([len(k) for k in keys], default=1) / -math.log1p(-(FALSE_RATE ** (1 / HASHES)))
        bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(need, 1)))))
        planes = []
        for first in range(0, len(languages), PLANE):
            some = languages[first : first + PLANE]
            kind = next(t for n, t in ((8, np.uint8), (16, np.uint16), (32, np.uint32), (64, np.uint64)) if len(some) <= n)
            masks = np.zeros(1 << bits, dtype=kind)
            for i in range(len(some)):
                for k in range(HASHES):
                    masks[np.unique(slots(keys[first + i], k, bits))] |= kind(1 << i)
            planes.append(masks)
        return cls(languages, planes)

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(corrected count by line and language, n-grams of each line, lines of each text)."""
        key, line, lines = grams(texts)
        total = int(lines.sum())
        n = np.bincount(line, minlength=total).astype(np.float64)
        out = np.zeros((total, len(self.languages)))
        starts = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, int)
        at = [slots(key, k, self.bits) for k in range(HASHES)]
        for p, masks in enumerate(self.planes):
            mask = masks[at[0]]
            for k in range(1, HASHES):
                mask &= masks[at[k]]
            for i in range(p * PLANE, min(len(self.languages), (p + 1) * PLANE)):
                counts = np.zeros(total)
                if len(starts):
                    counts[line[starts]] = np.add.reduceat((mask >> mask.dtype.type(i - p * PLANE)) & mask.dtype.type(1), starts, dtype=np.int64)
                out[:, i] = np.maximum(counts - n * self.false[i], 0) / (1 - self.false[i])
        return out, n, lines


def assign(model: LanguageFilter, texts: list[str]) -> list[list[tuple[int, str, float]]]:
    """For each text its segments (first line, language, confidence): one from line 0 if it has one language, else one for each non-blank line."""
    broken = g.garbled(texts)
    if broken.any():
        texts = [g.restore(t) if b else t for t, b in zip(texts, broken)]
    score, n, lines = model.score(texts)
    if not model.languages:
        return [[] for _ in texts]
    padded = np.concatenate((score, np.zeros((len(score), 1))), axis=1)  # a lone language leads nothing
    order = np.sort(padded, axis=1)
    lead = (order[:, -1] - order[:, -2]) / np.maximum(n, 1)
    best = score.argmax(axis=1)
    owner = np.repeat(np.arange(len(texts)), lines)
    whole = np.zeros((len(texts), len(model.languages)))
    np.add.at(whole, owner, score)
    # what the lines led by another language than the text's first one say for it, all such lines together
    more = score[np.arange(len(score)), best] - score[np.arange(len(score)), whole.argmax(axis=1)[owner]]
    second = np.zeros((len(texts), len(model.languages)))
    sure = (lead >= LEAST_LEAD) & (more > 0)
    np.add.at(second, (owner[sure], best[sure]), more[sure])
    mixed = second.max(axis=1) >= SECOND_GRAMS
    total = np.bincount(owner, weights=n, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(lines)))
    out: list[list[tuple[int, str, float]]] = []
    for i, text in enumerate(texts):
        if total[i] == 0 or not whole[i].any():
            out.append([])
            continue
        if not mixed[i]:
            two = np.sort(np.append(whole[i], 0))
            out.append([(0, model.languages[int(whole[i].argmax())], float((two[-1] - two[-2]) / total[i]))])
            continue
        rows, last = [], None
        for k, line in enumerate(text.split("\n")):
            j = first[i] + k
            if not line.strip():
                continue
            if score[j].any() or last is None:
                last = model.languages[int(best[j])]
            rows.append((k + 1, last, float(lead[j])))
        out.append(rows)
    return out


def label_code(label: Column) -> Column:
    """The two-letter code that a delivered label means; null if it names no language."""
    short = F.lower(F.regexp_extract(F.trim(label), r"^(\p{L}[\p{L}\p{M}]*)", 1))
    names = F.create_map(*(F.lit(x) for code, words in SPELLINGS.items() for w in words.split() for x in (w, code)))
    return F.when(short == "", None).otherwise(F.coalesce(F.try_element_at(names, short), short))


def fit(samples: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageFilter:
    """The filter over the labelled samples; at most ``MOST_SAMPLES`` rows are used, in the order of their text."""
    rows = samples.select(lang_col, text_col).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).orderBy(text_col, lang_col).limit(MOST_SAMPLES).collect()
    return LanguageFilter.fit([(r[0], r[1]) for r in rows])


def languages(df: DataFrame, model: LanguageFilter, id_col: str = "doc_id", text_col: str = "clean_text", lang_col: str = "lang") -> DataFrame:
    """(id, line_no, lang, confidence, label): line 0 for a text in one language, else a row for each non-blank line.

    Confidence is the share of n-grams by which the language leads the next one. A line without evidence
    goes with the line before. Null and blank texts and texts without letters have no row; repeated rows
    are kept; other columns are left out. A scan and one Arrow stage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            found = assign(model, part.column("t").to_pylist())
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = [y for x in found for y in x]
            idx = pa.array(at, type=pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("k").take(idx), pa.array([y[0] for y in flat], type=pa.int32()), pa.array([y[1] for y in flat], type=pa.string()), pa.array([y[2] for y in flat], type=pa.float64()), part.column("l").take(idx)], ["k", "line_no", "lang", "confidence", "label"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(F.col("t").rlike(r"\S"))
    return picked.mapInArrow(run, f"k {kind}, line_no int, lang string, confidence double, label string").withColumnRenamed("k", id_col)


def wrong_labels(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, line_no, lang) of records in one language with no or another label, and of all lines of mixed records."""
    right = F.coalesce(label_code(F.col("label")) == F.col("lang"), F.lit(False))
    return found.where((F.col("line_no") > 0) | ~right).select(id_col, "line_no", "lang").distinct()
