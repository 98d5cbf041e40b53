"""Problem 10: the share of repeated words inside one text.

A logistic regression over hashed word and character n-grams says how likely a text's repeated share is above the
threshold: of the hashed runs of one to ten words, and of hashed character n-grams, it takes how much of them comes
again in the same text. It is fitted on a bounded sample of rows that the exact count labels, and on the same texts
with a part said again, so that both classes are there; its probabilities are calibrated on rows held out, and all
rows are scored in Arrow batches against a fixed threshold.

What the score lets through is counted exactly: words become 64-bit hashes, a run of ten is one polynomial hash, and
one sort of (text, run hash, position) per Arrow slice shows every run that has an earlier start. Positions covered
by such runs come from a prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.arrow import slices
from docforge.llm.words import word_hashes

RUN_WORDS = 10
LEAST_SHARE = 0.3
#: Rows that the regression is fitted on, at most; those with the smallest hashes of their ids.
MOST_LABELLED = 4000
#: Of these, so many texts are also taken with a part said again.
SAID_AGAIN = 500
#: A text is counted exactly if its probability is at least this.
LEAST_PROBABILITY = 0.01
#: Lengths of the word runs, of the character n-grams, and places of a character n-gram's hash.
WORD_RUNS = (1, 2, 3, 5, 10)
CHARACTERS = 6
PLACES = 1 << 12
_STEP = np.uint64(0x9E3779B97F4A7C15)


def run_hashes(words: np.ndarray, run: int) -> np.ndarray:
    """A hash of each run of ``run`` consecutive word hashes."""
    n = len(words) - run + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(run):
            out = (out ^ (out >> np.uint64(31))) * _STEP + words[k : k + n]
    return out


def _again(flat: np.ndarray, owner: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of each run inside one text, whether the same run starts earlier in it)."""
    runs = run_hashes(flat, run)
    inside = np.flatnonzero(owner[: len(runs)] == owner[run - 1 :]) if len(runs) else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        key = runs[inside] + owner[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(order), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]  # stable: the first start comes first
    return inside, again


def repeated_counts(texts: list[str | None], run: int = RUN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(repeated words, all words) of each text."""
    flat, _, owner = word_hashes(texts, digits=False)
    n = np.bincount(owner, minlength=len(texts))
    inside, again = _again(flat, owner, run)
    cover = np.zeros(len(flat) + run + 1, dtype=np.int64)
    begins = inside[again]
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + run, -1)
    hit = np.cumsum(cover)[: len(flat)] > 0
    return np.bincount(owner, weights=hit, minlength=len(texts)).astype(np.int64), n


def features(texts: list[str | None]) -> np.ndarray:
    """For each text, of its hashed word runs of each length the share that comes again, and of its hashed character
    n-grams the share beyond the first in each place; products of neighbours let the regression bend."""
    flat, _, owner = word_hashes(texts, digits=False)
    columns = []
    for run in WORD_RUNS:
        inside, again = _again(flat, owner, run)
        n = np.bincount(owner[inside], minlength=len(texts))
        columns.append(np.bincount(owner[inside], weights=again, minlength=len(texts)) / np.maximum(n, 1))
    lengths = np.fromiter((len(t) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
    cp = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), lengths)
    m = max(0, len(cp) - CHARACTERS + 1)
    place = np.zeros(m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(CHARACTERS):
            place = place * np.uint64(0x100000001B3) + cp[k : k + m]
        place = (place * _STEP) >> np.uint64(52)
    same = text[:m] == text[CHARACTERS - 1 :] if m else np.zeros(0, bool)
    used = np.bincount(text[:m][same] * PLACES + place[same].astype(np.int64), minlength=len(texts) * PLACES).reshape(len(texts), PLACES)
    count, taken = used.sum(axis=1), (used > 0).sum(axis=1)
    # of hashes without repetition so many places would be taken
    free = PLACES * -np.expm1(-count / PLACES)
    columns.append(1 - taken / np.maximum(free, 1))
    x = np.stack(columns, axis=1)
    return np.concatenate((x, x[:, 1:] * x[:, :-1]), axis=1)


class Quality:
    """A calibrated logistic regression over ``features``."""

    def __init__(self, weights: np.ndarray, slope: float = 1.0, offset: float = 0.0):
        self.weights, self.slope, self.offset = weights, slope, offset

    @staticmethod
    def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + ridge * w
            hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(x.shape[1])
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return w

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Quality:
        """Weights from two of three rows, calibration from the third."""
        z = np.concatenate((np.ones((len(x), 1)), x), axis=1)
        held = np.arange(len(x)) % 3 == 2
        w = cls._newton(z[~held], y[~held].astype(float), 0.05)
        s = np.stack((z[held] @ w, np.ones(held.sum())), axis=1)
        if 0 < y[held].sum() < held.sum():
            slope, offset = cls._newton(s, y[held].astype(float), 0.05)
        else:
            slope, offset = 1.0, 0.0
        return cls(w, float(max(slope, 1e-3)), float(offset))

    def probability(self, x: np.ndarray) -> np.ndarray:
        s = self.slope * (self.weights[0] + x @ self.weights[1:]) + self.offset
        return 1 / (1 + np.exp(-np.clip(s, -60, 60)))


def labelled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN_WORDS, least: float = LEAST_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """(features, label) of the rows that the regression is fitted on."""
    h = F.xxhash64(F.col(id_col))
    edge = df.select(h.alias("h")).orderBy("h").limit(MOST_LABELLED).agg(F.max("h")).first()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            own = part.column("t").to_pylist()
            more = [t + " " + t[: len(t) * (2 + i % 7) // 10] for i, (t, a) in enumerate(zip(own, part.column("again").to_pylist())) if a and t]
            texts = own + more
            rep, n = repeated_counts(texts, run)
            x = features(texts)
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array((rep >= least * n) & (n > 0))], ["x", "y"])

    if edge is None:
        return np.zeros((0, 2 * len(WORD_RUNS) + 1)), np.zeros(0, bool)
    picked = df.where(h <= edge).select(F.col(text_col).alias("t"), (F.pmod(F.xxhash64(F.lit(1), F.col(id_col)), F.lit(MOST_LABELLED)) < SAID_AGAIN).alias("again"))
    rows = picked.limit(2 * MOST_LABELLED).mapInArrow(work, "x array<double>, y boolean").collect()  # rows alike in their id are few
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=bool)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN_WORDS, least: float = LEAST_SHARE) -> Quality | None:
    """The regression fitted on a table; None for a table without rows."""
    x, y = labelled(df, id_col, text_col, run, least)
    return Quality.fit(x, y) if len(x) else None


def repetition(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN_WORDS) -> DataFrame:
    """(id, repeated_words, words, repeated_share) for each row, counted exactly.

    Words are split at white space and compared without case, digits and punctuation; one with nothing
    left is no word. A null, empty or wordless text has 0 words and share 0.0. Repeated rows are kept,
    other columns left out, an empty table gives an empty result. A scan and one Arrow stage, no shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            rep, n = repeated_counts(part.column("t").to_pylist(), run)
            yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(rep), pa.array(n), pa.array(rep / np.maximum(n, 1))], ["k", "repeated_words", "words", "repeated_share"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.selectExpr(f"`{id_col}` AS k", f"`{text_col}` AS t")
    return picked.mapInArrow(work, f"k {kind}, repeated_words bigint, words bigint, repeated_share double").withColumnRenamed("k", id_col)


def scored(df: DataFrame, model: Quality | None, id_col: str = "doc_id", text_col: str = "text", run: int = RUN_WORDS, least: float = LEAST_PROBABILITY) -> DataFrame:
    """(id, probability, repeated_words, words) of the texts whose probability is at least ``least``: the counts are exact."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            texts = part.column("t").to_pylist()
            p = model.probability(features(texts))
            at = np.flatnonzero(p >= least)
            rep, n = repeated_counts([texts[i] for i in at], run)
            yield pa.RecordBatch.from_arrays([part.column("k").take(pa.array(at)), pa.array(p[at]), pa.array(rep), pa.array(n)], ["k", "probability", "repeated_words", "words"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.selectExpr(f"`{id_col}` AS k", f"`{text_col}` AS t")
    if model is None:
        picked = picked.limit(0)
    return picked.mapInArrow(work, f"k {kind}, probability double, repeated_words bigint, words bigint").withColumnRenamed("k", id_col)


def repeated_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SHARE) -> DataFrame:
    """The ids of texts whose repeated share is at least ``least``: those that the score lets through, counted exactly.

    Repeated rows are kept; null, empty and wordless texts are no case; an empty table gives an empty result.
    """
    model = fit(df, id_col, text_col, least=least)
    found = scored(df, model, id_col, text_col)
    return found.where((F.col("words") > 0) & (F.col("repeated_words") / F.col("words") >= least)).select(id_col)
