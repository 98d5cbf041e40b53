"""Fetched pages: answers replayed from a table, conditional requests, robots rules, and an HTTP data source.

Spark's own task retry repeats whole partitions; within a request the reader retries with exponential
back-off, as a page that fails is a row with its status, not a failed job.
"""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.robotparser import RobotFileParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docforge.functions.text import conditional_headers, site_key
from docforge.schemas import FETCH_RESULT

ATTEMPTS, LEAST_WAIT_S, MOST_WAIT_S, TIMEOUT_S = 3, 1.0, 30.0, 30.0


def is_success(status: Column) -> Column:
    return (status >= 200) & (status < 300)


def outcome(status: Column) -> Column:
    """fetched, skipped (304) or error."""
    return F.when(is_success(status), "fetched").when(status == 304, "skipped").otherwise("error")


def replay(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers to ``requests`` (url, etag, last_modified of an earlier answer) from a table with the fields of a fetch result.

    A request whose validator equals the stored one gives 304 without content; an unknown url gives 404.
    """
    stored = answers.select("url", "status", "content", "headers", F.col("etag").alias("new_etag"), F.col("last_modified").alias("new_modified"))
    x = requests.select("url", "etag", "last_modified").join(stored, "url", "left")
    same = F.coalesce(F.col("etag") == F.col("new_etag"), F.col("last_modified") == F.col("new_modified"), F.lit(False))
    status = F.when(F.col("status").isNull(), 404).when(same & is_success(F.col("status")), 304).otherwise(F.col("status"))
    return x.select(
        "url", status.cast("int").alias("status"), F.when(status != 304, F.col("content")).alias("content"), "headers",
        F.coalesce("new_etag", "etag").alias("etag"), F.coalesce("new_modified", "last_modified").alias("last_modified"), (status == 304).alias("from_cache"),
        conditional_headers(F.col("etag"), F.col("last_modified")).alias("sent_headers"),
    )


def robots_rules(files: DataFrame, agent: str = "*") -> DataFrame:
    """(host, prefix, allow) of robots files (host, text): the rules of the group for ``agent``, else of ``*``."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for host, text in zip(frame["host"], frame["text"]):
                parser = RobotFileParser()
                parser.parse((text or "").splitlines())
                entry = next((e for e in parser.entries if e.applies_to(agent)), parser.default_entry)
                rows += [(host, r.path, r.allowance) for r in (entry.rulelines if entry else [])]
            yield pd.DataFrame(rows, columns=["host", "prefix", "allow"])

    return files.select("host", "text").mapInPandas(run, "host string, prefix string, allow boolean")


def permitted(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """Rows whose path no rule of their host forbids: the longest matching prefix decides. Hosts without rules permit all."""
    path = F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    x = urls.withColumn("__row", F.monotonically_increasing_id()).withColumn("__host", site_key(F.col(url_col))).withColumn("__path", F.when(path == "", "/").otherwise(path))
    r = rules.groupBy(F.col("host").alias("__host")).agg(F.collect_set(F.struct("prefix", "allow")).alias("__rules"))
    hits = F.filter("__rules", lambda y: (y["prefix"] != "") & F.startswith(F.col("__path"), y["prefix"]))
    ranked = F.array_max(F.transform(hits, lambda y: F.struct(F.length(y["prefix"]).alias("n"), y["allow"].alias("allow"))))
    return x.join(r, "__host", "left").where(F.coalesce(ranked["allow"], F.lit(True))).select(*urls.columns)


def fetched(requests: DataFrame, rules: DataFrame | None = None, agent: str = "docforge", per_minute: float = 30.0, tasks: int = 32) -> DataFrame:
    """Fetch results of a table of requests (url, and etag and last_modified of an earlier answer, where known).

    Validators are sent, and 304 is an answer without content from the cache. Urls that the robots ``rules`` forbid are
    left out. A host's urls are fetched by one task, at most ``per_minute`` of them in a minute.
    """
    import pandas as pd

    has = [c for c in ("etag", "last_modified") if c in requests.columns]
    x = requests.select("url", *has, *(F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified") if c not in has)).where(F.col("url").isNotNull())
    if rules is not None:
        x = permitted(x, rules)
    x = x.withColumn("host", F.coalesce(site_key(F.col("url")), F.lit("")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free: dict[str, float] = {}
        for frame in frames:
            rows = []
            for url, etag, modified, host in zip(frame["url"], frame["etag"], frame["last_modified"], frame["host"]):
                time.sleep(max(0.0, free.get(host, 0.0) - time.monotonic()))
                free[host] = time.monotonic() + 60.0 / per_minute
                rows.append(get_page(url, agent, etag, modified))
            yield pd.DataFrame(rows, columns=["url", "status", "content", "headers", "etag", "last_modified", "from_cache"])

    return x.repartition(tasks, "host").select("url", "etag", "last_modified", "host").mapInPandas(run, FETCH_RESULT)


def get_page(url: str, agent: str, etag: str | None = None, modified: str | None = None) -> tuple:
    """One fetch result; a failure after all attempts has status 0 or the answer's code."""
    sent = {"User-Agent": agent} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": modified} if modified else {})
    for attempt in range(ATTEMPTS):
        status, body, head = 0, None, {}
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=sent), timeout=TIMEOUT_S) as r:
                status, body, head = r.status, r.read(), dict(r.headers)
        except urllib.error.HTTPError as e:
            status, head = e.code, dict(e.headers)
        except (OSError, ValueError):
            pass
        if status and status != 429 and status < 500:
            break
        if attempt + 1 < ATTEMPTS:
            time.sleep(min(MOST_WAIT_S, random.uniform(LEAST_WAIT_S, LEAST_WAIT_S * 2 ** (attempt + 1))))
    head = {k.lower(): v for k, v in head.items()}
    return (url, status, body, head, head.get("etag", etag if status == 304 else None), head.get("last-modified", modified if status == 304 else None), status == 304)


class HttpSource(DataSource):
    """``spark.read.format("http_pages").option("urls", "...").load()``: one row for each URL, urls apart by blanks.

    Options: parallel (partitions, 10), agent. A failure after all attempts is a row with status 0 or the
    answer's code.
    """

    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return FETCH_RESULT

    def reader(self, schema) -> DataSourceReader:
        return _HttpReader(self.options)


class _HttpReader(DataSourceReader):
    def __init__(self, options):
        self.urls = (options.get("urls") or "").split()
        self.parallel = int(options.get("parallel") or 10)
        self.agent = options.get("agent") or "docforge"

    def partitions(self):
        n = max(1, min(self.parallel, len(self.urls)))
        return [InputPartition(self.urls[i::n]) for i in range(n)]

    def read(self, partition):
        for url in partition.value:
            yield get_page(url, self.agent)
