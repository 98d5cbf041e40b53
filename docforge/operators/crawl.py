"""Steps of a crawl as transforms: cutoffs, first-seen URLs, routing by content, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docforge.sources.fetch import outcome
from docforge.sources.listings import since


def not_before(entries: DataFrame, cutoff: Column, date_col: str = "published_date") -> DataFrame:
    """Entries on or after the cutoff, and those without a date."""
    return entries.where(since(F.col(date_col), cutoff))


def first_items(entries: DataFrame, most: int, by: list[str], order: list[str]) -> DataFrame:
    """The first ``most`` rows of each group; ties are cut by the order given, so give a total one."""
    w = Window.partitionBy(*by).orderBy(*order)
    return entries.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= most).drop("__n")


def first_seen(entries: DataFrame, order: list[str], by: tuple[str, ...] = ("source_id", "url")) -> DataFrame:
    """The first row of each source and URL.

    An aggregate, not a window: it is combined before the shuffle, so that a hot URL is no hot task.
    """
    rest = [c for c in entries.columns if c not in by]
    key = F.struct(*order)
    best = entries.groupBy(*by).agg(F.min_by(F.struct(*rest), key).alias("__row"))
    return best.select(*[F.col(c) if c in by else F.col(f"__row.{c}").alias(c) for c in entries.columns])


def unseen(entries: DataFrame, history: DataFrame, by: tuple[str, ...] = ("source_id", "url")) -> DataFrame:
    """Entries whose source and URL aren't in the history."""
    return entries.join(history.select(*by).distinct(), list(by), "left_anti").select(*entries.columns)


def content_type(headers: Column, content: Column) -> Column:
    """pdf, html or unknown, by the content-type header (any case), else by the first bytes."""
    named = F.map_values(F.map_filter(headers, lambda k, v: F.lower(k) == "content-type"))
    said = F.lower(F.coalesce(F.try_element_at(named, F.lit(1)), F.lit("")))
    start = F.lower(F.decode(F.substring(content, 1, 100), "ISO-8859-1"))
    return (
        F.when(said.contains("pdf"), "pdf")
        .when(said.rlike("html|xml|rss|atom"), "html")
        .when(F.decode(F.substring(content, 1, 4), "ISO-8859-1") == "%PDF", "pdf")
        .when(start.startswith("<!doctype html") | start.startswith("<html") | start.startswith("<?xml"), "html")
        .when(start.contains("<rss") | start.contains("<feed") | start.contains("xmlns="), "html")
        .otherwise("unknown")
    )


def crawl_stats(fetched: DataFrame, source_col: str = "source_id", status_col: str = "http_status", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """By source: entries found (different URLs), fetched, skipped, errors and the seconds from first to last."""
    o = outcome(F.col(status_col))
    return fetched.groupBy(source_col).agg(
        F.count_distinct(url_col).alias("entries_found"),
        F.count_if(o == "fetched").alias("entries_fetched"),
        F.count_if(o == "skipped").alias("entries_skipped"),
        F.count_if(o == "error").alias("errors"),
        (F.max(F.unix_micros(F.col(time_col).cast("timestamp"))) - F.min(F.unix_micros(F.col(time_col).cast("timestamp")))).alias("duration_us"),
    )


def batch_stats(results: DataFrame, ok: Column, error: Column, by: list[str]) -> DataFrame:
    """By group: rows, successes, failures, and the distinct error texts in order (their kinds are few, rows aren't)."""
    return results.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(ok).alias("ok"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"), F.array_sort(F.collect_set(F.when(~F.coalesce(ok, F.lit(False)), error))).alias("errors"))
