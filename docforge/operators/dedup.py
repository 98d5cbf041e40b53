"""Exact and near duplicates by fingerprints, and classes of linked texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.io import materialise

BITS, MOST_DISTANCE = 64, 3
#: Parts a fingerprint is cut into. Two that differ in d bits agree in all but d parts, so each choice of the
#: other parts is a key; more parts make longer keys and smaller groups, and more of them.
PARTS = 5
MOST_ROUNDS = 60


def exact_groups(docs: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(hash, first id, documents) of each different text; null hashes have no group."""
    return docs.where(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.min(id_col).alias("first_id"), F.count("*").alias("documents"))


def _md5_bits(words: list[str]) -> np.ndarray:
    raw = b"".join(hashlib.md5(w.encode("utf-8", "replace")).digest()[:8] for w in words)
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, BITS).astype(np.int32) * 2 - 1


def simhash(docs: DataFrame, id_col: str, text_col: str, out: str = "simhash") -> DataFrame:
    """(id, fingerprint as bigint): by bit, whether more words have it set in the first 8 bytes of their md5 than not.

    Words are lower-cased and split at white space; null, and text without words, give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        known: dict[str, int] = {}
        table = np.zeros((0, BITS), np.int32)
        for b in batches:
            values = []
            for t in b.column("t").to_pylist():
                words = t.lower().split() if t else None
                if not words:
                    values.append(None)
                    continue
                new = [w for w in dict.fromkeys(words) if w not in known]
                if new:
                    if len(known) > 200_000:
                        known, table, new = {}, np.zeros((0, BITS), np.int32), list(dict.fromkeys(words))
                    if len(known) + len(new) > len(table):
                        table = np.concatenate([table, np.zeros((max(len(new), len(table), 1024), BITS), np.int32)])
                    at = len(known)
                    table[at : at + len(new)] = _md5_bits(new)
                    known.update(zip(new, range(at, at + len(new))))
                total = table[[known[w] for w in words]].sum(axis=0)
                values.append(int(weights[total > 0].sum(dtype=np.uint64).astype(np.int64)) if (total > 0).any() else 0)
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(values, pa.int64())], ["k", out])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    return picked.mapInArrow(run, f"k {kind}, `{out}` bigint").withColumnRenamed("k", id_col)


def near_fingerprints(prints: DataFrame, col: str = "simhash", distance: int = MOST_DISTANCE, parts: int = PARTS) -> DataFrame:
    """(a, b, distance): pairs of different fingerprints, a < b, that differ in up to ``distance`` bits. None is missed.

    Equal fingerprints are one row, so copies don't make pairs. Of all keys in which a pair agrees only the
    first is used, so each pair is met once.
    """
    if parts <= distance:
        raise ValueError("more parts than bits of distance are needed")
    x = prints.select(F.col(col).alias("v")).where(F.col("v").isNotNull()).distinct()
    edges = [BITS * i // parts for i in range(parts + 1)]
    part = [F.shiftrightunsigned(F.shiftleft(F.col("v"), edges[i]), BITS - (edges[i + 1] - edges[i])) for i in range(parts)]
    choices = list(combinations(range(parts), parts - distance))
    keys = F.array(*(F.struct(F.lit(n).alias("choice"), F.xxhash64(*(part[i] for i in c)).alias("key")) for n, c in enumerate(choices)))
    rows = x.select("v", F.inline(keys))
    left, right = rows.select(F.col("v").alias("a"), "choice", "key"), rows.select(F.col("v").alias("b"), "choice", "key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    same = [F.shiftrightunsigned(F.shiftleft(differ, edges[i]), BITS - (edges[i + 1] - edges[i])) == 0 for i in range(parts)]
    first = F.coalesce(*(F.when(reduce(lambda x, y: x & y, (same[i] for i in c)), F.lit(n)) for n, c in enumerate(choices)))
    met = left.join(right, ["choice", "key"]).where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & (F.col("choice") == first))
    return met.select("a", "b", F.bit_count(differ).cast("int").alias("distance"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that each linked node is connected with.

    Alternating large-star and small-star steps; every round is written to the shared folder and the driver
    sees only a checksum of it.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = materialise(edges, "links"), None
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = materialise(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components didn't settle")
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    centres = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.union(centres).groupBy("node").agg(F.min("component").alias("component"))


def near_duplicate_classes(docs: DataFrame, id_col: str, text_col: str, distance: int = MOST_DISTANCE) -> DataFrame:
    """(id, simhash, class_id, links): each document once, the least fingerprint of its class and how many different ones are near its own."""
    prints = materialise(simhash(docs, id_col, text_col), "prints").where("simhash IS NOT NULL")
    pairs = materialise(near_fingerprints(prints, distance=distance), "pairs")
    ends = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))).groupBy("v").agg(F.count("*").alias("links"))
    cls = components(pairs).withColumnRenamed("node", "v")
    x = prints.withColumnRenamed("simhash", "v").join(ends, "v", "left").join(cls, "v", "left")
    return x.select(id_col, F.col("v").alias("simhash"), F.coalesce("component", "v").alias("class_id"), F.coalesce("links", F.lit(0).cast("bigint")).alias("links"))
