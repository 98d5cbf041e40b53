"""The registry of sources: read from YAML, looked up and filtered."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.schemas import JURISDICTIONS, SOURCE

_FIELDS = ("id", "jurisdiction", "name", "listing_url", "feed_url", "adapter", "crawl_policy")


def load_sources(spark: SparkSession, path: str) -> DataFrame:
    """The list under ``sources`` of a YAML file. FileNotFoundError without the file, ValueError without the list or with an unknown jurisdiction."""
    import yaml

    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(path)
    rows = (yaml.safe_load(file.read_text(encoding="utf-8")) or {}).get("sources")
    if rows is None:
        raise ValueError("the file has no list named sources")
    for r in rows:
        if r.get("jurisdiction") not in JURISDICTIONS:
            raise ValueError(f"unknown jurisdiction: {r.get('jurisdiction')}")
    return spark.createDataFrame([tuple((r.get(f) or {}) if f == "crawl_policy" else r.get(f) for f in _FIELDS) for r in rows], SOURCE)


def get(sources: DataFrame, source_id: str) -> DataFrame:
    return sources.where(F.col("id") == source_id)


def by_adapter(sources: DataFrame, adapter: str) -> DataFrame:
    return sources.where(F.col("adapter") == adapter)


def by_jurisdiction(sources: DataFrame, jurisdiction: str) -> DataFrame:
    return sources.where(F.col("jurisdiction") == jurisdiction)


def allowed(sources: DataFrame, source_ids: list[str] | None = None, adapters: list[str] | None = None) -> DataFrame:
    """Sources whose id and adapter are listed; an empty or missing list lets all pass."""
    if source_ids:
        sources = sources.where(F.col("id").isin(*source_ids))
    if adapters:
        sources = sources.where(F.col("adapter").isin(*adapters))
    return sources


def one(sources: DataFrame, source_id: str) -> DataFrame:
    """As ``get``, but a query that finds no such source fails."""
    spark = sources.sparkSession
    wanted = spark.createDataFrame([(source_id,)], "id string")
    hit = wanted.join(sources.withColumn("__hit", F.lit(True)), "id", "left")
    checked = F.when(F.col("__hit"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("unknown source: "), F.col("id"))))
    return hit.withColumn("id", checked).drop("__hit")


def listing_pages(sources: DataFrame, default_pages: int = 3) -> DataFrame:
    """(source_id, adapter, page, page_url): page 1 is the listing itself, later ones ``?page=n``, or ``page/n/`` of the newsroom."""
    most = F.coalesce(F.try_element_at("crawl_policy", F.lit("max_pages")), F.when(F.col("adapter") == "sebi", 5).otherwise(default_pages))
    x = sources.where(F.col("listing_url").isNotNull() & (most >= 1)).select(F.col("id").alias("source_id"), "adapter", "listing_url", F.explode(F.sequence(F.lit(1), most)).alias("page"))
    n = F.col("page").cast("string")
    later = F.when(F.col("adapter") == "eu_ai_act", F.concat("listing_url", F.lit("page/"), n, F.lit("/"))).otherwise(F.concat("listing_url", F.lit("?page="), n))
    return x.select("source_id", "adapter", "page", F.when(F.col("page") == 1, F.col("listing_url")).otherwise(later).alias("page_url"))


def feed_kind(feed_url: Column) -> Column:
    """rss, json or null, by what the feed's URL contains."""
    low = F.lower(feed_url)
    return F.when(low.contains("rss") | low.contains("xml"), "rss").when(low.contains("federalregister") | low.contains("api"), "json")
