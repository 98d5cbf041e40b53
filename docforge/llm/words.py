"""Words as the operators of this subpackage compare them."""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np

_drop: dict[bool, re.Pattern] = {}


def dropped(digits: bool) -> re.Pattern:
    """Matches what is removed from words: punctuation, format characters, and digits unless they are kept."""
    if digits not in _drop:
        spans: list[list[int]] = []
        for c in range(sys.maxunicode + 1):
            kind = unicodedata.category(chr(c))
            if kind[0] == "P" or kind == "Cf" or (kind == "Nd" and not digits):
                if spans and spans[-1][1] == c - 1:
                    spans[-1][1] = c
                else:
                    spans.append([c, c])
        _drop[digits] = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in spans) + "]+")
    return _drop[digits]


def bare_words(text: str, digits: bool = True) -> list[str]:
    """Words split at white space, without case and punctuation (and digits, if so asked); empty ones are left out."""
    return dropped(digits).sub("", text.casefold()).split()


_STEP = np.uint64(0x9E3779B97F4A7C15)
_tables: dict[bool, tuple[np.ndarray, np.ndarray]] = {}
_powers = np.ones(1, dtype=np.uint64)


def _character_tables(digits: bool) -> tuple[np.ndarray, np.ndarray]:
    """(kind, random value) of each code point: 0 removed from words, 1 white space, 2 part of a word."""
    if digits not in _tables:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        kind = np.full(0x110000, 2, dtype=np.uint8)
        kind[[ord(c) for c in every if c.isspace()]] = 1
        for m in dropped(digits).finditer(every):
            kind[[ord(c) for c in m[0]]] = 0
        x = np.arange(1, 0x110001, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for _ in range(2):
                x = (x ^ (x >> np.uint64(31))) * _STEP
        _tables[digits] = kind, x ^ (x >> np.uint64(29))
    return _tables[digits]


def word_hashes(texts: list[str | None], digits: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, letters, text) of each word of ``bare_words``, in order; the same on every machine."""
    global _powers
    joined = [t.casefold() if t else "" for t in texts]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in joined), dtype=np.int64, count=len(joined)))
    cp = np.frombuffer(("\n".join(joined) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds, values = _character_tables(digits)
    kind = kinds[cp]
    kept = np.flatnonzero(kind)
    cp, space = cp[kept], kind[kept] == 1
    starts = ~space
    starts[1:] &= space[:-1]
    starts = np.flatnonzero(starts)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    size = stops - starts
    inside = np.flatnonzero(~space)
    first = np.cumsum(size) - size
    place = np.arange(len(inside)) - np.repeat(first, size)
    if (most := int(size.max())) > len(_powers):
        _powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * most, _STEP))))
    with np.errstate(over="ignore"):
        out = np.add.reduceat(values[cp[inside]] * _powers[place], first)
        out = (out ^ (out >> np.uint64(32))) * _STEP
    return out ^ (out >> np.uint64(29)), size, np.searchsorted(ends, kept[starts], side="right")
