"""Character n-grams that recur within a site, and texts with them masked.

``confirmed`` counts over all documents (two passes: learn, then mask). ``running`` gives the state before
each document, in order. The masks cover every character of a confirmed n-gram and put one blank in place
of each covered stretch, so that the result doesn't depend on the order of n-grams.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from docforge.io import materialise

SIZE, LEAST, LEAST_CHARS = 4, 3, 50
#: Documents of one bucket over all sites, about.
BUCKET_DOCUMENTS = 4096
#: Stretches that documents are cut into for running sums, at least and at most, and rows of a stretch, about.
PARTS, MOST_PARTS, PART_ROWS = 16, 2048, 2_000_000


def ngrams(df: DataFrame, site_col: str, id_col: str, text_col: str, size: int = SIZE) -> DataFrame:
    """(site, id, ngram, n) with n occurrences in the text; shorter texts than ``size`` have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, grams, counts = [], [], []
            for i, t in enumerate(b.column("t").to_pylist()):
                found: dict[str, int] = {}
                for k in range(len(t) - size + 1):
                    g = t[k : k + size]
                    found[g] = found.get(g, 0) + 1
                at += [i] * len(found)
                grams += found
                counts += found.values()
            idx = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("site").take(idx), b.column("id").take(idx), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], ["site", "id", "ngram", "n"])

    picked = df.select(F.col(site_col).alias("site"), F.col(id_col).alias("id"), F.col(text_col).alias("t")).where(F.length("t") >= size)
    kinds = {c: picked.schema[c].dataType.simpleString() for c in ("site", "id")}
    return picked.mapInArrow(run, f"site {kinds['site']}, id {kinds['id']}, ngram string, n bigint")


def totals(df: DataFrame, site_col: str, text_col: str, size: int = SIZE, mode: str = "occurrence") -> DataFrame:
    """(site, ngram, n): occurrences, or documents (mode ``document``), in a site; counted by batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count: dict = {}
            for site, t in zip(b.column("site").to_pylist(), b.column("t").to_pylist()):
                own = count.setdefault(site, Counter())
                grams = (t[k : k + size] for k in range(len(t) - size + 1))
                own.update(set(grams) if mode == "document" else grams)
            rows = [(s, g, n) for s, own in count.items() for g, n in own.items()]
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field("site").type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], ["site", "ngram", "n"])

    picked = df.select(F.col(site_col).alias("site"), F.col(text_col).alias("t")).where(F.length("t") >= size)
    return picked.mapInArrow(run, f"site {picked.schema['site'].dataType.simpleString()}, ngram string, n bigint").groupBy("site", "ngram").agg(F.sum("n").alias("n"))


def confirmed(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(site, ngram, n) of totals of at least ``least``."""
    return counts.where(F.col("n") >= least)


def top(counts: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent n-grams overall, ties in the order of the n-gram."""
    return counts.groupBy("ngram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "ngram").limit(most)


def site_stats(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """By site: different n-grams and how many of them are confirmed."""
    return counts.groupBy("site").agg(F.count("*").alias("ngrams"), F.count_if(F.col("n") >= least).alias("confirmed"))


def running(counts: DataFrame, order_col: str = "id", parts: int | None = None) -> DataFrame:
    """(site, id, ngram, n, before): occurrences in the site's documents before this one, in the order of ``order_col``.

    A number as order is cut at approximate quantiles into ``parts`` stretches, by default as many as the rows need: sums of whole stretches come
    from a window over at most ``parts`` rows, the rest from one within the stretch, so that no task sees
    all documents of a hot site's common n-gram. Any other order is one stretch.
    """
    key = ["site", "ngram"]
    numeric = isinstance(counts.schema[order_col].dataType, NumericType)
    if numeric and parts != 1:
        counts = materialise(counts, "ngrams")  # read three times below
        parts = parts or min(MOST_PARTS, max(PARTS, counts.count() // PART_ROWS))
    bounds = sorted(set(counts.approxQuantile(order_col, [i / parts for i in range(1, parts)], min(0.01, 0.25 / parts)))) if numeric and parts != 1 else []
    inside = Window.partitionBy(*key, "__p").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    if not bounds:
        return counts.withColumn("__p", F.lit(0)).withColumn("before", F.coalesce(F.sum("n").over(inside), zero)).drop("__p")
    x = counts.withColumn("__p", F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(order_col))))
    whole = Window.partitionBy(*key).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sums = x.groupBy(*key, "__p").agg(F.sum("n").alias("__s")).withColumn("__before", F.coalesce(F.sum("__s").over(whole), zero)).drop("__s")
    out = x.join(sums, [*key, "__p"]).withColumn("before", F.col("__before") + F.coalesce(F.sum("n").over(inside), zero))
    return out.select(*counts.columns, "before")


def masked(df: DataFrame, found: DataFrame, site_col: str, id_col: str, text_col: str, size: int = SIZE, least_chars: int = LEAST_CHARS, rows: int | None = None) -> DataFrame:
    """(id, text): texts with the confirmed n-grams of their site masked; null, blank and short texts stay as they are.

    Documents are grouped by site and bucket, so that a hot site is spread; each bucket gets its site's
    confirmed n-grams, of which a task keeps 8 bytes each (their number is that of different n-grams in use,
    not of documents).
    """
    buckets = max(1, -(-(df.count() if rows is None else rows) // BUCKET_DOCUMENTS))
    docs = df.select(F.col(site_col).alias("site"), F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int").alias("bucket"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    whole = docs.where(F.coalesce(F.length("t") < least_chars, F.lit(True)) | F.col("site").isNull()).select("id", F.col("t").alias("text"))
    long = docs.where((F.length("t") >= least_chars) & F.col("site").isNotNull())
    # only for the buckets that a site has documents in: a small site is in few of many
    present = long.groupBy("site").agg(F.collect_set("bucket").alias("buckets"))
    lists = found.join(present, "site").select("site", F.explode("buckets").alias("bucket"), "ngram")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.unique(gram_hashes("".join(right.column("ngram").to_pylist()), size)[::size]) if right.num_rows else np.zeros(0, np.uint64)
        texts = [mask(t, known, size) for t in left.column("t").to_pylist()]
        return pa.table({"id": left.column("id"), "text": pa.array(texts, pa.string())})

    kind = docs.schema["id"].dataType.simpleString()
    done = long.groupBy("site", "bucket").cogroup(lists.groupBy("site", "bucket")).applyInArrow(run, f"id {kind}, text string")
    return whole.unionByName(done).withColumnsRenamed({"id": id_col, "text": text_col})


def gram_hashes(text: str, size: int = SIZE) -> np.ndarray:
    """A 64-bit hash of each n-gram of a text."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(cp) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + cp[k : k + len(out)]
    return out


def mask(text: str, known: np.ndarray, size: int = SIZE) -> str:
    """``text`` with every character of a known n-gram blanked; ``known`` has their hashes in order."""
    if not len(known) or len(text) < size:
        return text
    keys = gram_hashes(text, size)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    if not hit.any():
        return text
    cover = np.zeros(len(text) + 1, dtype=np.int64)
    start = np.flatnonzero(hit)
    cover[start] += 1
    np.subtract.at(cover, start + size, 1)
    hidden = np.cumsum(cover[:-1]) > 0
    return " ".join("".join(" " if h else c for c, h in zip(text, hidden.tolist())).split())
