"""Content-defined chunks of a text's words: array code of problem 2."""

from __future__ import annotations

import numpy as np

from docforge.llm.words import word_hashes

#: A chunk ends where the rolling hash of the last two words has its low bits zero, on average once in so many words.
WINDOW = 2
DIVISOR = 2
#: A chunk is known by its words and those of the chunks after it, so many together: about six words, of which chunks
#: of short and long reach have less in number than if a boundary were set once in six words.
TOGETHER = 3
SHINGLE = 3
#: The low bits of a chunk's number hold its bytes (longer ones count as this many), the others its hash.
BYTES = 255
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _A
        x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def unique_in(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) in order, each pair once."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    return owner[new], key[new]


class Words:
    """Word hashes of several texts in one array."""

    def __init__(self, texts: list[str | None]):
        self.hash, self.size, self.owner = word_hashes(texts)
        self.count = np.bincount(self.owner, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of each run of ``n`` words inside one text."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = np.zeros(m, dtype=np.uint64)
        for k in range(n):
            with np.errstate(over="ignore"):
                out = mix(out + self.hash[k : k + m] + _A)
        start = np.flatnonzero(self.owner[:m] == self.owner[n - 1 :])
        return out[start], start

    def whole(self) -> np.ndarray:
        """A hash of each text's words in their order."""
        place = np.arange(len(self.hash)) - self.first[self.owner] if len(self.hash) else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            each = mix(self.hash + mix(place.astype(np.uint64) + _B))
            upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)))
            return mix(upto[self.first[1:]] - upto[self.first[:-1]] + self.count.astype(np.uint64) * _A)

    def chunks(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, number) of each different chunk of each text, in order; a number is a hash and, in its low bits, the bytes."""
        n = len(self.hash)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        end = np.zeros(n, dtype=bool)
        roll, start = self.runs(WINDOW)
        end[start + WINDOW - 1] = roll % np.uint64(DIVISOR) == 0
        end[self.first[1:][self.count > 0] - 1] = True
        stop = np.flatnonzero(end)
        begin = np.concatenate(([0], stop[:-1] + 1))
        place = np.arange(n) - np.repeat(begin, stop - begin + 1)
        with np.errstate(over="ignore"):
            each = mix(self.hash + mix(place.astype(np.uint64) + _A))
            key = mix(np.add.reduceat(each, begin) + (stop - begin + 1).astype(np.uint64) * _B)
        size = np.minimum(np.add.reduceat(self.size, begin), BYTES).astype(np.uint64)
        own, alone = self.owner[begin], key.copy()
        full = np.ones(len(own), dtype=bool)
        for j in range(1, min(TOGETHER, len(own))):
            same = np.zeros(len(own), dtype=bool)
            same[:-j] = own[j:] == own[:-j]
            with np.errstate(over="ignore"):
                key[:-j] = np.where(same[:-j], mix(key[:-j] + alone[j:] * np.uint64(j + 2)), key[:-j])
            full &= same
        full[np.flatnonzero(np.diff(own, prepend=-1))] = True  # a text of fewer chunks has one number, of them all
        return unique_in(own[full], ((key & ~np.uint64(BYTES)) | size)[full])


def weight(chunk: np.ndarray) -> np.ndarray:
    """The bytes of chunks."""
    return (chunk & np.uint64(BYTES)).astype(np.int64)


#: Powers of two between which the number of counters lies: chunks are ordered and weighted by what their counter holds.
#: A table has as many as its first batch has chunks, within these bounds.
LEAST_COUNTERS, MOST_COUNTERS = 14, 20
#: A chunk weighs its bytes times the logarithm of how rare it is, to this power.
POWER = 4


def counter(chunk: np.ndarray, counters: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((chunk * _A) >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def rarity(often: np.ndarray, counted: float, counters: int) -> np.ndarray:
    """What a byte of a chunk weighs, by its counter, less what other chunks add to a counter on average."""
    texts = max(2.0, counted / 50)  # about so many texts; only differences between chunks count
    return np.maximum(np.log(2 * texts / np.maximum(often - counted / counters, 1)), 0.5) ** POWER


def bits(chunk: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a chunk in a filter of ``size`` bits (a power of two)."""
    x = mix(chunk)
    return (x & np.uint64(size - 1)).astype(np.int64), ((x >> np.uint64(34)) & np.uint64(size - 1)).astype(np.int64)


def prefix(owner: np.ndarray, chunk: np.ndarray, rest: np.ndarray, frequency: np.ndarray, counted: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(indices of the chunks that decide, their weights, weight of each text, weight left out of it, counter of its last chunk that decides).

    Of each text the rarest chunks, until what is left over is less than the share ``rest`` of its weight. The order
    is that of the counters, then of the hash: the same for a chunk in every text.
    """
    often = frequency[counter(chunk, len(frequency))]
    order = np.lexsort((chunk, often, owner))
    own, size = owner[order], (weight(chunk) * rarity(often, counted, len(frequency)))[order]
    total = np.bincount(own, weights=size, minlength=len(rest))
    upto = np.cumsum(size)
    base = np.concatenate(([0.0], np.cumsum(total)))
    taken = upto - size - base[own] <= total[own] * (1 - rest[own])
    left = np.maximum(total - np.bincount(own[taken], weights=size[taken], minlength=len(rest)), 0)
    edge = np.zeros(len(rest), dtype=np.int64)
    edge[own[taken]] = often[order[taken]]  # in order, so the last one stays
    return order[taken], size[taken], total, left, edge
