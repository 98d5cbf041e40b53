"""From parsed to normalised documents: encoding, counts, language, hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.functions import language, text


def normalized(parsed: DataFrame, text_col: str = "body_text") -> DataFrame:
    """``parsed`` with site_key, clean_text, language, confidence, char_count, word_count and content_hash.

    A null body counts as empty; text of white space alone keeps its length and has no words. Columns of
    these names are replaced.
    """
    clean = F.coalesce(text.repair_encoding(F.col(text_col)), F.lit(""))
    x = parsed.withColumns({"title": text.default_title(F.col("title")), "site_key": text.site_key(F.col("url")), "clean_text": clean})
    found = language.detect(F.col("clean_text"))
    x = x.withColumn("__lang", found)
    return x.withColumns(
        {
            "language": F.col("__lang.language"), "confidence": F.col("__lang.confidence"), "char_count": text.char_count(F.col("clean_text")),
            "word_count": text.word_count(F.col("clean_text")), "content_hash": text.content_hash(F.col("clean_text")),
        }
    ).drop("__lang")
