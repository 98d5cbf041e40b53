"""Problem 8: encode whole texts with a public byte-level BPE vocabulary.

Pre-tokenisation works on arrays, not on a regular expression: every code point is mapped to a class
(letter, number, space, other), runs of equal class come from one comparison of neighbours, and the
hand-over of a last blank to the next run and the English contractions are transitions that look at
most three places ahead, so that all positions are decided at once. Adjacent documents are kept apart
by a sentinel of a class of its own. The slices between boundaries go through a cache of pair merging.

Ids: a null and an empty text give an empty list; strings that look like special tokens are text.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docforge.llm.arrow import codepoints, list_array, slices

#: Where the vocabulary files lie; a parameter of every function that needs one.
TOKENIZER_DIR = "/opt/tokenizers"
#: Slices whose ids a worker keeps; beyond that the cache starts anew (ids don't change by it).
CACHE_ENTRIES = 400_000
#: Pieces up to this many bytes are merged by scanning, longer ones through a heap.
SCAN_BYTES = 40

LETTER, NUMBER, OTHER, SPACE, EDGE = range(5)
_workers: dict = {}
_classes: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The class of each code point: letter, number, white space or other."""
    if not _classes:
        import regex

        every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
        out = np.full(0x110000, OTHER, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                a, b = (ord(m[0][0]), ord(m[0][-1]) + 1)
                out[a:b] = kind
        out[0xD800:0xE000] = OTHER
        _classes.append(out)
    return _classes[0]


def boundaries(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """True where a slice starts. ``cls`` has EDGE at the sentinels; the last position must be one."""
    n = len(cp)
    after = np.append(cls[1:], np.uint8(EDGE))
    starts = np.ones(n, dtype=bool)
    starts[1:] = cls[1:] != cls[:-1]
    last_space = (cls == SPACE) & (after < SPACE)
    starts |= last_space  # white space leaves its last character to what follows
    joined = np.flatnonzero(last_space & (cp == 32)) + 1
    starts[joined] = False  # a blank goes with the run after it
    quote = np.flatnonzero((cp == 39) & starts & (after == LETTER))
    if len(quote):
        padded = np.append(cp, np.zeros(2, cp.dtype))
        one, two = padded[quote + 1], padded[quote + 2]
        single = np.isin(one, [ord(x) for x in "sdmt"])
        double = ((one == 108) & (two == 108)) | ((one == 118) & (two == 101)) | ((one == 114) & (two == 101))
        for hit, width in ((single, 2), (double & ~single, 3)):
            at = quote[hit]
            starts[at + 1] = False
            starts[at + width] = True
    return starts


class ByteBPE:
    """Pair merging over a rank file in the public ``base64 rank`` form."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.words = {i: w for w, i in self.ranks.items()}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.native = None
        try:  # the same merging in native code, where the library is there
            import tiktoken

            self.native = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=self.ranks, special_tokens={})._core_bpe.encode_single_piece
        except (ImportError, AttributeError):
            pass

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Repeatedly join the neighbouring pair of lowest rank, the leftmost first."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > SCAN_BYTES:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        far = len(ranks) + 1
        pair = [ranks.get(parts[i] + parts[i + 1], far) for i in range(len(parts) - 1)]
        while pair:
            least = min(pair)
            if least == far:
                break
            i = pair.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], far)
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], far)
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same result in n log n: spans in a linked list, candidate pairs in a heap."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        prev = list(range(-1, n - 1))
        alive = bytearray(b"\x01") * n
        heap = []

        def push(i: int) -> None:
            j = end[i]
            if j < n:
                r = ranks.get(piece[i : end[j]])
                if r is not None:
                    heap.append((r, i, end[j]))

        for i in range(n - 1):
            push(i)
        heapq.heapify(heap)
        while heap:
            r, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = 0
            end[i] = stop
            if stop < n:
                prev[stop] = i
            for k in (prev[i], i):
                if k >= 0 and end[k] < n:
                    x = ranks.get(piece[k : end[end[k]]])
                    if x is not None:
                        heapq.heappush(heap, (x, k, end[end[k]]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def _miss(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "replace")
        ids = tuple(self.native(data)) if self.native else self.merge(data)
        if len(piece) <= 64:
            self.cache[piece] = ids
        return ids

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(offsets of each text's ids, ids, offsets of each text's slices, first character of each slice)."""
        joined = "\0".join([t or "" for t in texts]) + "\0"
        cp = codepoints(joined)
        cls = class_table()[cp]
        lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), dtype=np.int64, count=len(texts))
        edges = np.cumsum(lengths) - 1
        cls[edges] = EDGE
        starts = np.flatnonzero(boundaries(cp, cls))
        keep = cls[starts] != EDGE
        ends = np.append(starts[1:], len(cp))[keep]
        starts = starts[keep]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        get, miss = self.cache.get, self._miss
        found = [get(p) or miss(p) for p in [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(counts.sum()))
        upto = np.concatenate(([0], np.cumsum(counts)))
        slice_offsets = np.concatenate(([0], np.searchsorted(starts, edges)))
        first = starts - np.repeat(edges - lengths + 1, np.diff(slice_offsets))
        return upto[slice_offsets], ids, slice_offsets, first

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.words[i] for i in ids).decode("utf-8", "replace")


def bpe(name: str, tokenizer_dir: str) -> ByteBPE:
    """One per Python worker and file."""
    path = os.path.join(tokenizer_dir, f"{name}.tiktoken")
    if path not in _workers:
        _workers[path] = ByteBPE(path)
    return _workers[path]


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", tokenizer_dir: str = TOKENIZER_DIR, out: str = "ids") -> DataFrame:
    """One row per row of ``df``: ``id_col`` and the token ids of ``text_col`` as array<int>.

    Null and empty texts give an empty list, repeated rows are kept, other columns are left out (so
    names can't clash), and an empty table gives an empty result. No shuffle: a scan and one Arrow stage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(tokenizer, tokenizer_dir)
        for part in slices(batches, "t"):
            offsets, ids, _, _ = coder.encode_many(part.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("k"), list_array(offsets, ids, pa.int32())], ["k", out])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.selectExpr(f"`{id_col}` AS k", f"`{text_col}` AS t")
    return picked.mapInArrow(run, f"k {kind}, `{out}` array<int>").withColumnRenamed("k", id_col)


def token_counts(df: DataFrame, id_col: str, text_col: str, tokenizers: list[str], tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """``id_col`` and, for each tokenizer, a column ``n_<tokenizer>`` with the number of tokens (0 for null and empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [counter(t, tokenizer_dir) for t in tokenizers]
        for part in slices(batches, "t"):
            texts = part.column("t").to_pylist()
            yield pa.RecordBatch.from_arrays([part.column("k"), *(pa.array(c(texts), type=pa.int64()) for c in counters)], ["k", *(f"n_{t}" for t in tokenizers)])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.selectExpr(f"`{id_col}` AS k", f"`{text_col}` AS t")
    return picked.mapInArrow(run, f"k {kind}, " + ", ".join(f"`n_{t}` bigint" for t in tokenizers)).withColumnRenamed("k", id_col)


class PieceCounter:
    """Token counts of a piece model. Pieces don't reach over the mark of a word's start, so counts of words are kept and added up."""

    MARK = "\u2581"
    _UNITS = re.compile(f"{MARK}+[^{MARK}]*")

    def __init__(self, model):
        self.model = model
        self.cache: dict[str, int] = {}
        # a model that puts marks elsewhere, or joins words, is asked for whole texts
        self.by_word = model.normalize("a b") == f"{self.MARK}a{self.MARK}b" and not any(self.MARK in model.id_to_piece(i)[1:].strip(self.MARK) for i in range(model.get_piece_size()))

    def _count(self, unit: str) -> int:
        """The tokens of a unit without its first mark, which the model puts there itself."""
        n = len(self.model.encode(unit)) if unit else 1
        if len(unit) <= 64:
            self.cache[unit] = n
        return n

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if not self.by_word:
            return np.array([len(x) for x in self.model.encode([t or "" for t in texts], num_threads=1)], dtype=np.int64)
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        get, count, out = self.cache.get, self._count, np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                s = self.model.normalize(t)
                units = s.split(self.MARK)[1:] if self.MARK * 2 not in s and s[:1] == self.MARK else [u[1:] for u in self._UNITS.findall(s)]
                out[i] = sum([get(u) or count(u) for u in units])
        return out


def counter(tokenizer: str, tokenizer_dir: str):
    """A function from a list of texts to their token counts."""
    if os.path.exists(os.path.join(tokenizer_dir, f"{tokenizer}.tiktoken")):
        coder = bpe(tokenizer, tokenizer_dir)
        return lambda texts: np.diff(coder.encode_many(texts)[0])
    if os.path.exists(model := os.path.join(tokenizer_dir, f"{tokenizer}.model")):
        import sentencepiece

        if model not in _workers:
            _workers[model] = PieceCounter(sentencepiece.SentencePieceProcessor(model_file=model))
        return _workers[model]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(os.path.join(tokenizer_dir, f"{tokenizer}.json"))
    tok.encode_special_tokens = True
    return lambda texts: np.array([len(x.ids) for x in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)], dtype=np.int64)
