"""Documents, their chunks and the audit log as tables: upsert, replace, append, look up.

Each step gives the new state as a DataFrame; ``save`` writes it beside the old one and swaps the folders,
as a table must not be overwritten while it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(stored: DataFrame, new: DataFrame, now: Column, key: str = "doc_id") -> DataFrame:
    """Stored rows with those of ``new`` put over them by key: all columns replaced but created_at; updated_at is now.

    Of several new rows with one key the one that is greatest in all columns is taken. Columns that ``new`` lacks are null in added rows
    and kept in replaced ones.
    """
    cols = [c for c in stored.columns if c != key]
    given = [c for c in new.columns if c != key and c in cols and c not in ("created_at", "updated_at")]
    maps = {f.name for f in new.schema.fields if f.dataType.typeName() in ("map", "variant")}
    last = new.groupBy(key).agg(F.max_by(F.struct(*given), F.struct(*[F.to_json(c) if c in maps else F.col(c) for c in given])).alias("__new"))
    both = stored.withColumn("__old", F.lit(True)).join(last, key, "full_outer")
    out = []
    for c in cols:
        if c == "created_at":
            out.append(F.when(F.col("__old"), F.col(c)).otherwise(now).alias(c))
        elif c == "updated_at":
            out.append(F.when(F.col("__new").isNotNull(), now).otherwise(F.col(c)).alias(c))
        elif c in given:
            out.append(F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*[F.col(key) if c == key else out[cols.index(c)] for c in stored.columns])


def replace_chunks(stored: DataFrame, changed_ids: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """Stored chunks without those of changed documents, and the new ones; a changed document without new chunks loses all."""
    return stored.join(changed_ids.select(key).distinct(), key, "left_anti").select(*stored.columns).unionByName(new.select(*stored.columns))


def with_chunks(docs: DataFrame, chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with the array of their chunks in order; an empty one if there are none."""
    fields = [c for c in chunks.columns if c not in (key, "ord")]
    lists = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", *fields))).alias("chunks"))
    x = docs.join(lists, key, "left")
    kind = lists.schema["chunks"].dataType
    return x.withColumn("chunks", F.coalesce("chunks", F.array().cast(kind)))


def orphans_removed(chunks: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return chunks.join(docs.select(key), key, "left_semi").select(*chunks.columns)


def by_hash(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(content_hash, doc_id, documents): for each hash the document created first, ties by id."""
    return docs.where(F.col("content_hash").isNotNull()).groupBy("content_hash").agg(F.min_by(key, F.struct("created_at", key)).alias(key), F.count("*").alias("documents"))


def page(docs: DataFrame, order: list[str], limit: int = 100, offset: int = 0, where: Column | None = None) -> DataFrame:
    """A page of a listing."""
    x = docs if where is None else docs.where(where)
    return x.orderBy(*order).offset(offset).limit(limit)


def append_events(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with the new events; the query fails if an event id is there already or comes twice."""
    twice = new.groupBy("event_id").agg(F.count("*").alias("__n"))
    old = log.select("event_id", F.lit(True).alias("__old"))
    x = new.join(twice, "event_id").join(old, "event_id", "left")
    bad = F.coalesce("__old", F.lit(False)) | (F.col("__n") > 1)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("duplicate event id: "), F.col("event_id").cast("string")))).otherwise(F.col("event_id")).cast(log.schema["event_id"].dataType)
    return log.unionByName(x.withColumn("event_id", checked).select(*log.columns))


def conflicts(log: DataFrame, new: DataFrame) -> DataFrame:
    """The ids for which ``append_events`` would fail."""
    twice = new.groupBy("event_id").count().where("count > 1").select("event_id")
    return new.select("event_id").join(log.select("event_id"), "event_id", "left_semi").union(twice).distinct()


def save(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write beside ``path`` and put the new folder in the old one's place (Hadoop file system of the path)."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old = f"{path.rstrip('/')}.__new", f"{path.rstrip('/')}.__old"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(new)
    to = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = to(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(to(old), True)
    if fs.exists(to(path)):
        fs.rename(to(path), to(old))
    fs.rename(to(new), to(path))
    fs.delete(to(old), True)
