"""Problem 2: duplicates and near-duplicates of new batches against everything accepted before.

A text's words are cut where a rolling hash says so, hence equally in equal stretches. The chunk table keeps,
for each accepted record, the numbers of its chunks with their bytes; it is computed once per record and appended
to, and so are the counters of how often chunks occur. A batch is cut, counted and appended; then its chunks are
looked up in the table, the bytes that pairs share are added up, weighted by how rare a chunk is, and the coverage
decides on candidates, which are compared exactly.

Only chunks that decide are looked up: of each text the rarest ones, until what is left over could not reach the
coverage alone (prefix filtering). Chunks that stand in a large part of all texts come last in that order, as
counted over all that is accepted with the batch, and no pair that reaches the coverage is missed by it.

Of the history a batch costs one narrow pass over the kept numbers, in which only rows that share a deciding chunk with
the batch (a bit filter of a bounded size tells) leave their task, and for the exact check a scan of the records for
the texts of the pairs left: one text for each class, told by a bit filter of its id; no other text is looked at.
Exact copies are one class; a task keeps the chunks of a class once, so that a hot group of copies is no hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.io import materialise, shared_dir
from docforge.llm import chunks as c
from docforge.llm import garbled as g
from docforge.llm.arrow import list_array, slices

LEAST_JACCARD = 0.6
#: Rows of kept chunks handled at once.
ROWS = 2048
#: The bit filter has 2 to the power of so many bits at least and at most (beyond, it lets more rows through, and none is lost).
LEAST_BITS, MOST_BITS = 16, 28
#: Counters or bits travel in blocks of so many bytes, and so many tasks' blocks are merged at once.
BLOCK, FAN = 1 << 16, 64
#: Bits of a text's signature, one set for each of its shingles.
SIGNATURE = 1024
CHUNKS = "k {kind}, cls bigint, shingles int, chunks array<bigint>, signature array<bigint>"


def coverage(shingles):
    """Share of the larger text's weight that a candidate pair has in common, by the shingles of the smaller one (arrays or Columns).

    Measured on records with edits all over, at a Jaccard similarity of 0.60 to 0.68: the share of 99.3 % of pairs is
    at least 0.20 from 60 to 200 words, and 0.22 beyond; where all chunks are alike rare, it is 0.15 at 40 words, 0.27 at 80.
    """
    least = 0.22 - 3.5 / shingles
    return F.greatest(F.lit(0.02), least) if not isinstance(shingles, np.ndarray) else np.maximum(0.02, least)


#: A similar text has at least this share of the other's shingles.
FEWER = 0.6
#: Share of the coverage that may be left out of the look-up; the less, the more is looked up and the fewer candidates remain.
REST = 0.9


def kept_chunks(records: DataFrame, id_col: str = "doc_id", text_col: str = "clean_text") -> DataFrame:
    """(k, cls, shingles, chunks, signature): the rows that are kept for records.

    Null and blank texts, garbled ones and texts of under three words have no row. Of copies in one task the first
    has the chunks and the signature, the others have none. Shingles is the number of different runs of three words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "t"):
            texts = part.column("t").to_pylist()
            bad = g.garbled(texts)
            words = c.Words([None if b else t for t, b in zip(texts, bad)])
            whole = words.whole().view(np.int64)
            some = words.count >= c.SHINGLE
            carries = np.zeros(len(texts), dtype=bool)
            for i in np.flatnonzero(some):
                if (h := int(whole[i])) not in seen:
                    seen.add(h)
                    carries[i] = True
            owner, chunk = words.chunks()
            kept = carries[owner]
            owner, chunk = owner[kept], chunk[kept]
            rows = np.flatnonzero(some)
            offsets = np.append(np.searchsorted(owner, rows), len(owner))
            key, start = words.runs(c.SHINGLE)
            text, key = c.unique_in(words.owner[start], key)
            marks = np.zeros((len(texts), SIGNATURE), dtype=np.uint8)
            marks[text, (key % np.uint64(SIGNATURE)).astype(np.int64)] = 1
            signature = np.packbits(marks[carries], axis=1, bitorder="little").view(np.int64)
            ends = np.concatenate(([0], np.cumsum(carries[rows]))) * (SIGNATURE // 64)
            yield pa.RecordBatch.from_arrays(
                [part.column("k").take(pa.array(rows, type=pa.int64())), pa.array(whole[rows]), pa.array(np.bincount(text, minlength=len(texts))[rows].astype(np.int32)), list_array(offsets, chunk.view(np.int64), pa.int64()), list_array(ends, signature.ravel(), pa.int64())],
                ["k", "cls", "shingles", "chunks", "signature"],
            )

    kind = records.schema[id_col].dataType.simpleString()
    picked = records.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(F.col("t").rlike(r"\S") & F.col("k").isNotNull())
    return picked.mapInArrow(run, CHUNKS.format(kind=kind))


def gathered(df: DataFrame, fill: Callable[[np.ndarray, pa.RecordBatch], None], size: int, kind: type, merge: Callable) -> DataFrame:
    """(block, data): an array of ``size`` numbers to which each task adds by ``fill``, merged over the tasks block by block."""
    per = BLOCK // np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = None
        for batch in batches:
            own = np.zeros(size, dtype=kind) if own is None else own
            fill(own, batch)
        some = [i for i in range(-(-size // per)) if own[i * per : (i + 1) * per].any()] if own is not None else []
        if some:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array([own[i * per : (i + 1) * per].tobytes() for i in some], pa.binary())], ["part", "block", "data"])

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        out = np.frombuffer(frame["data"].iloc[0], dtype=kind).copy()
        for x in frame["data"].iloc[1:]:
            merge(out, np.frombuffer(x, dtype=kind), out=out)
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "block": [int(frame["block"].iloc[0])], "data": [out.tobytes()]})

    tasks = df.rdd.getNumPartitions()
    blocks = df.mapInArrow(run, "part int, block int, data binary")
    while True:
        tasks = -(-tasks // FAN)
        blocks = blocks.withColumn("part", F.expr(f"part div {FAN}").cast("int")).groupBy("block", "part").applyInPandas(together, "part int, block int, data binary")
        if tasks <= 1:
            return blocks.select("block", "data")


def as_array(blocks: DataFrame, size: int, kind: type, merge: Callable) -> np.ndarray:
    """The array of ``gathered`` blocks (of a fixed size) on the driver."""
    out, per = np.zeros(size, dtype=kind), BLOCK // np.dtype(kind).itemsize
    for r in blocks.collect():
        x = np.frombuffer(bytes(r["data"]), dtype=kind)
        at = slice(r["block"] * per, r["block"] * per + len(x))
        merge(out[at], x, out=out[at])
    return out


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of the numbers in a list column."""
    lengths = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def counters_of(spark: SparkSession, path: str) -> int | None:
    """The number of counters of the table at ``path``; None if there is no table yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/counters")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(f"{path}/counters").select("size").first()[0]


def accept(records: DataFrame, path: str, batch: int, id_col: str = "doc_id", text_col: str = "clean_text") -> None:
    """Cut and count a batch, and add it to the table at ``path``; a batch written again replaces itself."""
    spark = records.sparkSession
    kept_chunks(records, id_col, text_col).write.mode("overwrite").parquet(f"{path}/chunks/batch={batch}")
    added = spark.read.parquet(f"{path}/chunks/batch={batch}").select("chunks")
    size = counters_of(spark, path)
    if size is None:
        many = added.agg(F.sum(F.size("chunks"))).first()[0] or 0
        size = 1 << min(c.MOST_COUNTERS, max(c.LEAST_COUNTERS, many.bit_length()))

    def count(own: np.ndarray, part: pa.RecordBatch) -> None:
        own += np.bincount(c.counter(_flat(part.column(0))[1], size), minlength=size).astype(np.uint32)

    blocks = gathered(added, count, size, np.uint32, np.add)
    # one block at least, so that the number of counters is known of a table of no text, too
    empty = spark.range(1).select(F.lit(0).alias("block"), F.lit(bytes(4)).alias("data"))
    blocks.unionByName(empty).withColumn("size", F.lit(size)).write.mode("overwrite").parquet(f"{path}/counters/batch={batch}")


def deciding(rows: DataFrame, frequency: Broadcast, filter_bits: np.ndarray | None = None) -> DataFrame:
    """(chunk, weight, cls, shingles, total, left_out, edge) of the chunks that decide, or of those among them that the filter has.

    Edge is how often the last one that decides occurs: all rarer chunks of the text decide, too.
    """
    sent = rows.sparkSession.sparkContext.broadcast(filter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (often, counted), wanted = frequency.value, sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                part = whole.slice(start, ROWS)
                owner, chunk = _flat(part.column("chunks"))
                cls, shingles = (part.column(x).to_numpy(zero_copy_only=False) for x in ("cls", "shingles"))
                at, weight, total, left, edge = c.prefix(owner, chunk, REST * coverage(shingles * FEWER), often, counted)
                if wanted is not None:
                    kept = inside(wanted, chunk[at])
                    at, weight = at[kept], weight[kept]
                own = owner[at]
                yield pa.RecordBatch.from_arrays([pa.array(chunk[at].view(np.int64)), pa.array(weight), pa.array(cls[own]), pa.array(shingles[own]), pa.array(total[own].astype(np.float32)), pa.array(left[own].astype(np.float32)), pa.array(edge[own])], ["chunk", "weight", "cls", "shingles", "total", "left_out", "edge"])

    return rows.where(F.size("chunks") > 0).select("cls", "shingles", "chunks").mapInArrow(run, "chunk bigint, weight double, cls bigint, shingles int, total float, left_out float, edge bigint")


def candidates(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """(a, b): pairs of classes, a < b, of a record of the batch and one accepted before or with it, whose chunks may cover enough of the larger text."""
    table = spark.read.parquet(f"{path}/chunks")
    counters = spark.read.parquet(f"{path}/counters").where(F.col("batch") <= batch).select("block", "data")
    often = as_array(counters, counters_of(spark, path), np.uint32, np.add)
    frequency = spark.sparkContext.broadcast((often, float(often.sum(dtype=np.float64))))
    fresh = materialise(deciding(table.where(F.col("batch") == batch), frequency), "fresh")
    wanted = filled(fresh.select("chunk"), filter_size(fresh.count()))
    old = deciding(table.where(F.col("batch") < batch), frequency, wanted)
    # one side is the batch: pairs of two old texts are never made
    names = ["cls", "shingles", "total", "left_out", "edge"]
    a = fresh.select("chunk", "weight", *(F.col(x).alias(f"{x}_a") for x in names))
    b = old.withColumn("new", F.lit(False)).unionByName(fresh.withColumn("new", F.lit(True))).select("chunk", "new", *(F.col(x).alias(f"{x}_b") for x in names))
    fewest = F.least("shingles_a", "shingles_b")
    near = fewest >= F.greatest("shingles_a", "shingles_b") * (FEWER - 1e-6)  # texts of too different size can't reach the similarity
    met = a.join(b, "chunk").where(((F.col("cls_a") < F.col("cls_b")) | (~F.col("new") & (F.col("cls_a") != F.col("cls_b")))) & near)
    # what two texts share beyond the chunks that decide for both is left out by the one that ends at the rarer chunk
    beyond = F.when(F.col("edge_a") < F.col("edge_b"), F.col("left_out_a")).when(F.col("edge_a") > F.col("edge_b"), F.col("left_out_b")).otherwise(F.greatest("left_out_a", "left_out_b"))
    lack = coverage(fewest) * F.greatest("total_a", "total_b") * (1 - 1e-5) - beyond
    pairs = met.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b"), "weight", lack.alias("lack"))
    found = materialise(pairs.groupBy("a", "b").agg(F.sum("weight").alias("weight"), F.max("lack").alias("lack")).where(F.col("weight") >= F.col("lack")).select("a", "b"), "candidates")
    frequency.destroy()
    return found


def class_filter(pairs: DataFrame) -> np.ndarray:
    """A bit filter of the classes in pairs."""
    return filled(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), filter_size(2 * pairs.count()))


def filter_size(keys: int) -> int:
    """Bits of a filter for so many numbers, within its bounds."""
    return 1 << min(MOST_BITS, max(LEAST_BITS, (16 * keys).bit_length()))


def filled(keys: DataFrame, size: int) -> np.ndarray:
    """The bytes of a filter of ``size`` bits with the numbers of the only column."""

    def mark(own: np.ndarray, part: pa.RecordBatch) -> None:
        for x in c.bits(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size):
            np.bitwise_or.at(own, x >> 3, np.left_shift(np.uint8(1), (x & 7).astype(np.uint8)))

    return as_array(gathered(keys, mark, size // 8, np.uint8, np.bitwise_or), size // 8, np.uint8, np.bitwise_or)


def inside(wanted: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each number, whether the filter has it."""
    one, two = c.bits(keys, len(wanted) * 8)
    return ((wanted[one >> 3] >> (one & 7)) & (wanted[two >> 3] >> (two & 7)) & 1) == 1


def signatures(table: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(cls, k, shingles, signature) of the classes that the filter has, each once, with one record of it."""
    sent = table.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            yield part.filter(pa.array(inside(sent.value, part.column("cls").to_numpy(zero_copy_only=False).view(np.uint64))))

    rows = table.where(F.size("signature") > 0).select("cls", "k", "shingles", "signature")
    return rows.mapInArrow(run, rows.schema).dropDuplicates(["cls"])


def shingle_sets(records: DataFrame, id_col: str, text_col: str, wanted: np.ndarray, size: int = c.SHINGLE) -> DataFrame:
    """(cls, shingles): the distinct hashes of the runs of ``size`` words of the texts whose id the bit filter has."""
    sent = records.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.filter(pa.array(inside(sent.value, batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64))))
            for part in slices(iter([asked]), "t"):
                words = c.Words(part.column("t").to_pylist())
                key, start = words.runs(size)
                owner, key = c.unique_in(words.owner[start], key)
                offsets = np.searchsorted(owner, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([pa.array(words.whole().view(np.int64)), list_array(offsets, key.view(np.int64), pa.int64())], ["cls", "shingles"])

    picked = records.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    return picked.mapInArrow(run, "cls bigint, shingles array<bigint>").dropDuplicates(["cls"])


def similar_classes(pairs: DataFrame, table: DataFrame, records: DataFrame, id_col: str, text_col: str, least: float) -> DataFrame:
    """The candidate pairs of classes whose Jaccard similarity is at least ``least``.

    A shingle whose bit the other text's signature doesn't have isn't in that text. So signatures bound what two texts
    share from above, and only texts of pairs that can reach the similarity are compared as a whole.
    """
    known = materialise(signatures(table, class_filter(pairs)), "signatures")
    both = pairs.join(known.select(F.col("cls").alias("a"), F.col("shingles").alias("na"), F.col("signature").alias("sa")), "a").join(known.select(F.col("cls").alias("b"), F.col("shingles").alias("nb"), F.col("signature").alias("sb")), "b")
    missing = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, n: s + n)
    most = F.least(F.col("na") - missing("sa", "sb"), F.col("nb") - missing("sb", "sa"))
    near = materialise(both.where(most * (1 + least) >= (F.col("na") + F.col("nb")) * least - 1e-6).select("a", "b"), "near")
    needed = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    ids = known.join(needed, "cls", "left_semi").select(F.xxhash64("k").alias("h"))
    sets = materialise(shingle_sets(records, id_col, text_col, filled(ids, filter_size(2 * near.count()))), "shingles")
    both = near.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("n", common).where(F.col("n") >= least * (F.size("sa") + F.size("sb") - F.col("n"))).select("a", "b")


def members(spark: SparkSession, path: str) -> DataFrame:
    """(cls, k, batch) of all records of a table, each once."""
    return spark.read.parquet(f"{path}/chunks").select("cls", "k", "batch").groupBy("cls", "k").agg(F.max("batch").alias("batch"))


def similar_records(close: DataFrame, who: DataFrame, newer_than: int = 0) -> DataFrame:
    """(ka, kb): the pairs of records of close classes, and of copies, with a record in them whose batch is above ``newer_than``.

    This writes out all pairs of copies; ``close`` and ``who`` are the same links as class pairs and membership.
    """
    new = who.where(F.col("batch") > newer_than)
    links = close.select("a", "b").unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b")))
    fresh = new.select(F.col("cls").alias("a"), F.col("k").alias("ka"))
    every = who.select(F.col("cls").alias("b"), F.col("k").alias("kb"), (F.col("batch") > newer_than).alias("new"))
    # a pair of two new records is met from both sides and kept once
    across = fresh.join(links, "a").join(every, "b")
    within = fresh.join(every, F.col("a") == F.col("b"))
    once = lambda df: df.where((~F.col("new") & (F.col("ka") != F.col("kb"))) | (F.col("ka") < F.col("kb"))).select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"))
    return once(across).unionByName(once(within))


def near_duplicates(records: DataFrame, id_col: str = "doc_id", text_col: str = "clean_text", batch_col: str = "batch_no", least: float = LEAST_JACCARD, path: str | None = None) -> DataFrame:
    """(``id_a``, ``id_b``), the smaller first: each pair with a new record in it whose texts are equal or close.

    The history (batch 0 or null) is accepted into the chunk table at ``path`` (a new one by default), then each batch
    in order of its number is checked against it and added; the candidates of all batches are compared exactly
    together. Close means a Jaccard similarity of the runs of three words of at least ``least``. Null, blank and
    garbled texts form no pair, two records of the history neither; a record delivered twice counts once, in its
    latest batch. An empty table gives no pairs; other columns are left out.
    """
    spark = records.sparkSession
    path = path or shared_dir(spark)
    slim = records.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"), F.coalesce(F.col(batch_col).cast("int"), F.lit(0)).alias("b"))
    accept(slim.where("b <= 0"), path, 0, "k", "t")
    batches = sorted(r[0] for r in slim.where("b > 0").select("b").distinct().collect())
    pairs = []
    for n in batches:
        accept(slim.where(F.col("b") == n), path, n, "k", "t")
        pairs.append(candidates(spark, path, n))
    who = members(spark, path)
    pairs = reduce(DataFrame.unionByName, pairs).distinct() if pairs else spark.createDataFrame([], "a bigint, b bigint")
    close = materialise(similar_classes(pairs, spark.read.parquet(f"{path}/chunks"), slim, "k", "t", least), "close")
    return similar_records(close, who).select(F.col("ka").alias(f"{id_col}_a"), F.col("kb").alias(f"{id_col}_b"))


def new_batch(records: DataFrame, path: str, new: DataFrame, batch: int, id_col: str = "doc_id", text_col: str = "clean_text", least: float = LEAST_JACCARD) -> DataFrame:
    """(``id_a``, ``id_b``): pairs of the batch ``new`` with itself and with the table at ``path``, to which it is added.

    Only the new texts are cut; of the history the kept numbers are read, and of its texts (``records``) those of
    candidates are compared. The batch number must be above those in the table.
    """
    spark = new.sparkSession
    accept(new, path, batch, id_col, text_col)
    pairs = candidates(spark, path, batch)
    texts = records.select(id_col, text_col).unionByName(new.select(id_col, text_col))
    close = materialise(similar_classes(pairs, spark.read.parquet(f"{path}/chunks"), texts, id_col, text_col, least), "close")
    return similar_records(close, members(spark, path).where(F.col("batch") <= batch), batch - 1).select(F.col("ka").alias(f"{id_col}_a"), F.col("kb").alias(f"{id_col}_b"))
