"""Word statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_RUN = r"[\p{L}\p{N}_]+"


def short_word_counts(df: DataFrame, text: str = "content_text", min_len: int = 1,
                      max_len: int = 2, top_k: int = 50) -> DataFrame:
    """Lower-cased word runs of length min_len..max_len, counted; the
    ``top_k`` most frequent (word breaks ties).  Counting is a partial
    aggregate; only the top-k report is a limit."""
    w = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_RUN), 0)).alias("word"))
    return (w.filter(F.length("word").between(min_len, max_len))
             .groupBy("word").agg(F.count("*").alias("freq"))
             .orderBy(F.desc("freq"), "word").limit(top_k))
