"""Stateful steps of a crawl as Structured Streaming queries over append-only file sources."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from docforge.io import shared_dir

RATE_PER_MINUTE, BURST = 30.0, 5


def read_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the parquet files under a path, with the schema they have now."""
    pattern = f"{path[:-1]}[{path[-1]}]"  # a stream takes one file by a pattern only
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(pattern)


def run_to_table(stream: DataFrame, mode: str = "append", keys: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Process all there is, into a table at ``path`` (a new one in the shared folder by default), and give that table.

    Run again with the same path, a stream goes on where it stopped. Mode ``update`` writes only rows that a batch has
    changed, a folder a batch, so that a batch done again replaces itself; of the rows of ``keys`` the latest is the
    table's. Mode ``complete`` rewrites the whole result with each batch: for small results, or where a stream allows no other.
    """
    spark = stream.sparkSession
    base = path or shared_dir(spark)
    out, state = f"{base}/out", f"{base}/state"
    if mode == "append":
        stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", out).trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    if mode == "update" and not keys:
        raise ValueError("mode update needs the keys of a row")

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}" if mode == "update" else out)

    stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    if mode != "update":
        return spark.read.schema(stream.schema).parquet(out)
    every = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(out)
    latest = every.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "batch").alias("__row"))
    return latest.select("__row.*")


def first_seen(entries: DataFrame, by: list[str], time_col: str | None = None, ttl: str | None = None) -> DataFrame:
    """Each key once; with a time column and a TTL, again once the watermark has passed the time since."""
    if time_col and ttl:
        return entries.withWatermark(time_col, ttl).dropDuplicatesWithinWatermark(by)
    return entries.dropDuplicates(by)


def windowed_counts(events: DataFrame, time_col: str, by: list[str], size: str = "1 hour", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Counts by window of event time; in update mode, rows later than ``late`` are dropped once the watermark has passed."""
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return events.withWatermark(time_col, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, time_col: str, by: list[str], gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Runs of events with no pause longer than ``gap``."""
    return events.withWatermark(time_col, late).groupBy(F.session_window(time_col, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def ngram_counts(docs: DataFrame, site_col: str, text_col: str, size: int = 4) -> DataFrame:
    """Running counts of each site's n-grams (update or complete mode); a new path of the table starts them anew."""
    n = F.length(text_col)
    grams = F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(F.col(text_col), i, F.lit(size)))
    return docs.where(n >= size).select(F.col(site_col).alias("site"), F.explode(grams).alias("ngram")).groupBy("site", "ngram").agg(F.count("*").alias("n"))


def latest_validators(fetched: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """For each URL the etag and last_modified of its latest answer (complete mode): the state of conditional requests."""
    return fetched.groupBy(url_col).agg(F.max_by(F.struct("etag", "last_modified"), F.struct(time_col, "etag", "last_modified")).alias("v"), F.max(time_col).alias("seen_at")).select(url_col, "v.etag", "v.last_modified", "seen_at")


def check_bucket(rate: float, burst: int, jitter: float = 0.0, timeout: float | None = None) -> None:
    if rate <= 0 or burst <= 0:
        raise ValueError("rate and burst must be positive")
    if jitter < 0 or (timeout is not None and timeout <= 0):
        raise ValueError("jitter can't be negative, and a timeout must be positive")


def bucket_times(times: list[float], tokens: float, last: float | None, rate: float, burst: int) -> tuple[list[float], float, float | None]:
    """When requests made at ``times`` (seconds, in order) are let through, and the state after them."""
    out = []
    for t in times:
        now = t if last is None else max(t, last)
        if last is not None:
            tokens = min(float(burst), tokens + (now - last) * rate / 60)
        if tokens < 1:
            now += (1 - tokens) * 60 / rate
            tokens = 1.0
        tokens -= 1
        last = now
        out.append(now)
    return out, tokens, last


def jittered(host: str, at: float, jitter: float) -> float:
    """Seconds between 0 and ``jitter``, the same each time a request is looked at."""
    return jitter * (zlib.crc32(f"{host}|{at!r}".encode()) / 2**32)


def token_bucket(requests: DataFrame, host_col: str, time_col: str, rate: float = RATE_PER_MINUTE, burst: int = BURST, jitter: float = 0.0, timeout: float | None = None) -> DataFrame:
    """(host, requested_at, granted_at) in seconds: one bucket for each host, kept from batch to batch.

    Within a batch a host's requests are taken in the order of their time. Up to ``jitter`` seconds are added to each; a
    request that would wait longer than ``timeout`` is not granted (null) and takes no token.
    """
    check_bucket(rate, burst, jitter, timeout)

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tokens, last = state.get if state.exists else (float(burst), None)
        times = sorted(t for f in frames for t in f["at"].tolist())
        granted: list[float | None] = []
        for t in times:
            (at,), left, now = bucket_times([t], tokens, last, rate, burst)
            at += jittered(key[0], t, jitter)
            if timeout is not None and at - t > timeout:
                granted.append(None)
                continue
            tokens, last = left, now
            granted.append(at)
        state.update((tokens, last))
        yield pd.DataFrame({"host": [key[0]] * len(times), "requested_at": times, "granted_at": granted})

    slim = requests.select(F.col(host_col).cast("string").alias("host"), F.unix_micros(F.col(time_col).cast("timestamp")).cast("double").alias("us")).select("host", (F.col("us") / 1e6).alias("at"))
    return slim.groupBy("host").applyInPandasWithState(step, "host string, requested_at double, granted_at double", "tokens double, last double", "append", GroupStateTimeout.NoTimeout)
