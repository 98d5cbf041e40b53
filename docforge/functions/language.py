"""A language guess from function words and scripts: all scores of a text in one pass over Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT_CHARS = 20

# Function words of languages in Latin script (one named twice counts twice), and characters that speak for the
# others, in order of preference.
WORDS = {
    "en": "the and or of to a in is that for on with as by at from this that have has had will would could should may might must",
    "de": "der die das und oder in den von zu mit sich des auf für ist im dem nicht ein eine als so mehr",
    "fr": "le la les un une des et ou de à en du au aux est pour sur avec dans par son sa ses ce cet cette ces qui que dont où si mais donc car ni or",
    "es": "el la los las un una unos unas y o de a en del al es por para con sin sobre entre desde hasta durante mediante según contra tras bajo ante cabe",
    "it": "il lo la gli le un uno una e o di a da in con su per tra fra che chi ma perché quando come dove cosa quale quanto quanti quante",
    "pt": "o a os as um uma uns umas e ou de em do da dos das no na nos nas por para com sem sobre entre desde até durante mediante segundo conforme contra trás abaixo acima ante após através bem como",
}
CHARACTERS = {
    "hi": "[ऀ-ॿ]",
    "bn": "[ঀ-৿।॥]",
    "ta": "[஀-௿「『]",
    "te": "[ఀ-౿『']",
    "mr": "[ऀ-ॿ。]",
    "gu": "[઀-૿'　-〿]",
    "kn": "[ಀ-೿'　-〿]",
    "ml": "[ഀ-ൿ『』]",
    "pa": "[਀-੿'　-〿]",
    "ur": "[؀-ۿ.!?]",
    "zh": "[一-鿿.!?,、。]",
    "ja": "[぀-ヿ.!?、。]",
    "ko": "[가-힣.!?,]",
    "ar": "[؀-ۿ.!?]",
    "fa": "[؀-ۿ.!?]",
    "ru": "[Ѐ-ӿ.!?]",
}
ORDER = ("en", "hi", "bn", "ta", "te", "mr", "gu", "kn", "ml", "pa", "ur", "zh", "ja", "ko", "ar", "fa", "ru", "de", "fr", "es", "it", "pt")


# Marks that two of a language's patterns match count twice.
DOUBLED = {"hi": "।॥", "mr": "॥"}

#: Arabic and Persian have the score of Urdu and come after it, so they can't be the best.
_WINNERS = tuple(x for x in ORDER if x not in ("ar", "fa"))
#: Characters handled at once; a longer text is handled by itself, whole.
_SLICE = 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15)
_tables: list = []


def _hash(cp: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(start), size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ (out >> np.uint64(29))) * _P + cp[start + k].astype(np.uint64)
    return out


def _built() -> tuple:
    """Tables over code points and words: part of a word, class of each character, scores of a class and of a word by language."""
    if not _tables:
        column = {lang: i for i, lang in enumerate(_WINNERS)}
        letter = np.fromiter((unicodedata.category(chr(c))[0] in "LN" or c == 95 for c in range(0x110000)), dtype=bool, count=0x110000)
        marks: dict[int, list[int]] = {}
        for lang in _WINNERS:
            for first, last in re.findall(r"(.)(?:-(.))?", CHARACTERS.get(lang, "[]")[1:-1], re.S):
                for c in range(ord(first), ord(last or first) + 1):
                    marks.setdefault(c, [0] * len(_WINNERS))[column[lang]] = 1
        for lang, chars in DOUBLED.items():
            for c in chars:
                marks.setdefault(ord(c), [0] * len(_WINNERS))[column[lang]] += 1
        kinds = [tuple([0] * len(_WINNERS)), *sorted({tuple(v) for v in marks.values()})]
        number = {v: i for i, v in enumerate(kinds)}
        kind = np.zeros(0x110000, dtype=np.uint8)
        for c, v in marks.items():
            kind[c] = number[tuple(v)]
        words: dict[str, list[int]] = {}
        for lang, known in WORDS.items():
            for w in known.split():
                words.setdefault(w, [0] * len(_WINNERS))[column[lang]] += 1
        hashes = {}
        for w, v in words.items():
            cp = np.array([ord(c) for c in w], dtype=np.uint32)
            hashes[int(_hash(cp, np.zeros(1, np.int64), len(w))[0])] = v
        keys = np.array(sorted(hashes), dtype=np.uint64)
        _tables.extend((letter, kind, np.array(kinds), keys, np.array([hashes[int(k)] for k in keys]), max(map(len, words))))
    return tuple(_tables)


def scores(texts: list[str | None]) -> np.ndarray:
    """(text, language) scores in the order of the languages that can win: function words, or characters of the script."""
    letter, kind, kinds, keys, weights, longest = _built()
    out = np.zeros((len(texts), len(_WINNERS)), dtype=np.int64)
    first = 0
    while first < len(texts):
        last, room = first + 1, _SLICE - len(texts[first] or "")
        while last < len(texts) and room > 0:
            room -= len(texts[last] or "")
            last += 1
        part = [t or "" for t in texts[first:last]]
        cp = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(part)), np.fromiter(map(len, part), dtype=np.int64, count=len(part)))
        k = kind[cp]
        seen = np.flatnonzero(k)
        out[first:last] += np.bincount(owner[seen] * len(kinds) + k[seen], minlength=len(part) * len(kinds)).reshape(len(part), -1) @ kinds
        low = [t.lower() for t in part]
        cp = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in low), dtype=np.int64, count=len(low)))
        inside = letter[cp]
        change = np.diff(inside.astype(np.int8), prepend=0)
        start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        for size in range(1, longest + 1):
            at = start[stop - start == size]
            if len(at):
                key = _hash(cp, at, size)
                i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[i] == key
                np.add.at(out, first + np.searchsorted(ends, at[hit], side="right"), weights[i[hit]])
        first = last
    return out


def detect(text: Column, fallback: str = "en") -> Column:
    """Struct of language and confidence. Null, blank and short text, and text without evidence, give the fallback at 0.1.

    The highest score wins, the earlier language among equals; confidence is the score for each hundred
    characters, at most 1.
    """

    def guess(column: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else None for t in column]
        found = scores(texts)
        best, most = found.argmax(axis=1), found.max(axis=1)
        short = np.fromiter((t is None or len(t.strip(" ")) < SHORT_CHARS for t in texts), dtype=bool, count=len(texts))
        chars = np.fromiter((max(len(t), 1) if t else 1 for t in texts), dtype=np.float64, count=len(texts))
        none = short | (most == 0)
        return pd.DataFrame({"language": np.where(none, fallback, np.array(_WINNERS, dtype=object)[best]), "confidence": np.where(none, 0.1, np.minimum(most / (chars / 100.0), 1.0))})

    return F.pandas_udf(guess, "language string, confidence double")(text)
