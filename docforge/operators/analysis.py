"""Lexicon topics and extractive summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keywords (regular expressions over lower-cased text) of each topic; a parameter, these are our own defaults.
TOPICS = {
    "disclosure": "disclos|report|notice",
    "capital": "capital|liquidity|exposure|margin",
    "safety": "safety|recall|dosage|stability",
    "outsourcing": "outsourc|vendor|third.party",
    "records": "record|ledger|register|audit",
}


def topics(text: Column, lexicon: dict[str, str] | None = None) -> Column:
    """The topics with a keyword in the text, in order; an empty array for null."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*(F.when(low.rlike(p), F.lit(t)) for t, p in (lexicon or TOPICS).items())))


def key_sentences(text: Column, most: int = 3, lexicon: dict[str, str] | None = None) -> Column:
    """Up to ``most`` sentences with the most keywords, in the order of the text; the earlier one of equals."""
    pattern = "|".join((lexicon or TOPICS).values())
    sentences = F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?।])\s+", "$1\u0001"), "\u0001"), lambda s: F.trim(s) != "")
    scored = F.transform(sentences, lambda s, i: F.struct((-F.regexp_count(F.lower(s), F.lit(pattern))).alias("s"), i.alias("i"), F.trim(s).alias("t")))
    best = F.slice(F.array_sort(scored), 1, most)
    return F.transform(F.array_sort(F.transform(best, lambda x: F.struct(x["i"].alias("i"), x["t"].alias("t")))), lambda x: x["t"])
