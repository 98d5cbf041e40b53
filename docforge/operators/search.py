"""Chunks, deterministic embeddings and vector search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS, OVERLAP_CHARS, DIMENSIONS = 800, 100, 64
#: Query vectors that are sent to the tasks at a time.
BLOCK_QUERIES = 2048


def chunks(docs: DataFrame, id_col: str, text_col: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(id, ord, start, text, char_count): windows of ``size`` characters that overlap; null and empty texts have none."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be less than the size")
    n = F.length(text_col)
    last = F.greatest(F.lit(0), F.ceil((n - overlap) / F.lit(size - overlap)).cast("int") - 1)
    x = docs.where(n > 0).select(id_col, F.col(text_col).alias("__t"), F.explode(F.sequence(F.lit(0), last)).alias("ord"))
    start = F.col("ord") * (size - overlap)
    piece = F.substring(F.col("__t"), start + 1, F.lit(size))
    return x.select(id_col, "ord", start.alias("start"), piece.alias("text"), F.length(piece).alias("char_count"))


def sentence_chunks(docs: DataFrame, id_col: str, text_col: str, size: int = CHUNK_CHARS) -> DataFrame:
    """(id, ord, text, char_count): whole sentences put together up to ``size`` characters; a longer sentence is a chunk of its own."""
    sentences = F.filter(F.split(F.regexp_replace(F.col(text_col), r"([.!?।])\s+", "$1\u0001"), "\u0001"), lambda s: F.trim(s) != "")
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc, s):
        fits = (acc["open"] == "") | (F.length(acc["open"]) + F.length(s) + 1 <= size)
        joined = F.when(acc["open"] == "", s).otherwise(F.concat(acc["open"], F.lit(" "), s))
        return F.struct(F.when(fits, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))).alias("done"), F.when(fits, joined).otherwise(s).alias("open"))

    packed = F.aggregate(sentences, empty, step, lambda a: F.when(a["open"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))
    x = docs.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(packed).alias("ord", "text"))
    return x.select(id_col, "ord", "text", F.length("text").alias("char_count"))


def hash_embedding(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """A vector of ``dimensions`` values in [-1, 1) that depends on the text alone; null for null."""
    one = lambda i: F.conv(F.substring(F.md5(F.concat(i.cast("string"), F.lit("|"), text)), 1, 8), 16, 10).cast("double") / F.lit(2147483648.0) - 1
    return F.when(text.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), one))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector is null or has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return dot(a, b) / F.nullif(norm, F.lit(0.0))


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 10, least: float | None = None, same: str | None = None) -> DataFrame:
    """(query_id, id, score, rank): for each query the k rows of greatest cosine, itself left out; ties by id.

    ``queries`` has the same columns as ``vectors`` and stands against all rows, in blocks of ``BLOCK_QUERIES``:
    a block is collected (its size is bounded), sent to the tasks, and each task keeps its own k best before
    the shuffle. ``same`` names a column in which query and row must agree. Null vectors match nothing.
    """
    spark = vectors.sparkSession
    cols = [id_col, vector_col, *([same] if same else [])]
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(*cols).where(F.col(vector_col).isNotNull())
    asked = queries.select(*cols).where(F.col(vector_col).isNotNull())
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    out = None
    for n in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == n)
        got = part.collect()
        if not got:
            continue
        ids = np.array([r[0] for r in got], dtype=object)
        q = np.array([r[1] for r in got], dtype=np.float64)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        groups = np.array([r[2] for r in got], dtype=object) if same else None
        sent = spark.sparkContext.broadcast((ids, q, groups))

        def best(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            ids, q, groups = sent.value
            top: dict = {}
            for f in frames:
                v = np.array(f[vector_col].tolist(), dtype=np.float64)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                own = f[id_col].to_numpy()
                score = q @ v.T
                for i in range(len(ids)):
                    ok = own != ids[i]
                    if groups is not None:
                        ok &= f[same].to_numpy() == groups[i]
                    if least is not None:
                        ok &= score[i] >= least
                    at = np.flatnonzero(ok)
                    if len(at) > 4 * k:
                        edge = np.partition(score[i][at], -k)[-k]
                        at = at[score[i][at] >= edge]
                    found = top.get(i, []) + [(-float(score[i][j]), own[j]) for j in at]
                    top[i] = sorted(found)[:k]
            flat = [(ids[i], x, -s) for i, found in top.items() for s, x in found]
            yield pd.DataFrame(flat, columns=["query_id", "id", "score"]).astype({"score": "float64"})

        some = rows.mapInPandas(best, f"query_id {kind}, id {kind}, score double")
        out = some if out is None else out.unionByName(some)
    if out is None:
        return spark.createDataFrame([], f"query_id {kind}, id {kind}, score double, rank int")
    listed = out.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k).alias("best"))
    return listed.select("query_id", F.posexplode("best").alias("at", "x")).select("query_id", F.col("x.id").alias("id"), (-F.col("x.s")).alias("score"), (F.col("at") + 1).alias("rank"))


#: Rows that the centres of an index are fitted on, at most (those with the smallest hashes of their ids), rounds of
#: fitting, rows a cell holds about, and cells at most. Cells of more rows than a share are split among tasks.
FITTED_ROWS, ROUNDS, CELL_ROWS, MOST_CELLS, SHARE_ROWS = 20_000, 10, 200, 4096, 50_000
#: Cells that a query looks into.
PROBES = 24


def unit(rows: list) -> np.ndarray:
    v = np.array(rows, dtype=np.float64)
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-300)


def centres(vectors: DataFrame, id_col: str, vector_col: str, cells: int | None = None) -> np.ndarray:
    """The centres of an index's cells, by spherical k-means on a bounded sample; an empty table has none."""
    rows = vectors.where(F.col(vector_col).isNotNull())
    n = rows.count()
    sample = [r[0] for r in rows.orderBy(F.xxhash64(id_col)).limit(FITTED_ROWS).select(vector_col).collect()]
    if not sample:
        return np.zeros((0, 0))
    x = unit(sample)
    c = x[: max(1, min(MOST_CELLS, cells or n // CELL_ROWS, len(x)))].copy()
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        full = np.bincount(own, minlength=len(c)) > 0
        c[full] = unit(sums[full])
    return c


def indexed(vectors: DataFrame, model: np.ndarray, id_col: str, vector_col: str, probes: int = 1) -> DataFrame:
    """(id, vector, cell) of every row: the nearest cells, one for rows that are stored, several for queries. Null vectors have none.

    Stored with ``partitionBy("cell")``, rows are found without reading the cells that no query looks into.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    rows = vectors.select(id_col, vector_col).where(F.col(vector_col).isNotNull())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = sent.value
        for f in frames:
            if not len(f):
                continue
            score = unit(f[vector_col].tolist()) @ c.T
            most = min(probes, len(c))
            cell = np.argpartition(-score, most - 1, axis=1)[:, :most]
            f = f.loc[f.index.repeat(most)].assign(cell=cell.ravel().astype(np.int32))
            yield f

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    return rows.mapInPandas(run, f"{kinds}, cell int") if len(model) else rows.limit(0).withColumn("cell", F.lit(0))


def nearest_indexed(stored: DataFrame, queries: DataFrame, model: np.ndarray, id_col: str, vector_col: str, k: int = 10, probes: int = PROBES) -> DataFrame:
    """(query_id, id, score, rank) as ``nearest``, from the ``probes`` cells nearest to each query: approximate, without a scan for each block of queries.

    ``stored`` is the result of ``indexed`` for all rows. Large cells are split into shares, to each of which their
    queries go; a share's k best of each query are ranked at the end.
    """
    kind = stored.schema[id_col].dataType.simpleString()
    shares = stored.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(SHARE_ROWS)).cast("int").alias("shares"))
    rows = stored.join(shares, "cell").withColumn("share", F.pmod(F.xxhash64(id_col), F.col("shares")).cast("int")).drop("shares")
    asked = indexed(queries, model, id_col, vector_col, probes).join(shares, "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, own, v = left[id_col].to_numpy(), right[id_col].to_numpy(), unit(right[vector_col].tolist())
            for start in range(0, len(ids), 512):
                part = ids[start : start + 512]
                score = unit(left[vector_col].iloc[start : start + 512].tolist()) @ v.T
                for i, q in enumerate(part):
                    at = np.flatnonzero(own != q)
                    if len(at) > k:
                        at = at[score[i][at] >= np.partition(score[i][at], -k)[-k]]
                    out += [(q, x, s) for s, x in sorted(((float(score[i][j]), own[j]) for j in at), key=lambda y: (-y[0], y[1]))[:k]]
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype({"score": "float64"})

    found = asked.groupBy("cell", "share").cogroup(rows.groupBy("cell", "share")).applyInPandas(best, f"query_id {kind}, id {kind}, score double")
    listed = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k).alias("best"))
    return listed.select("query_id", F.posexplode("best").alias("at", "x")).select("query_id", F.col("x.id").alias("id"), (-F.col("x.s")).alias("score"), (F.col("at") + 1).alias("rank"))
