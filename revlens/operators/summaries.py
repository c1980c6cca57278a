"""Summaries of the merged fact (A1–A3, K2) and joins J1/J2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The names of the result columns, with the rows that each one counts.
ROW_COUNTS = {"spam_comments": "is_spam", "normal_comments": "NOT is_spam",
              "spam_count": "is_spam", "F3_count": "F3_flag", "F5_count": "F5_flag"}


def _summary(merged: DataFrame, keys: list[str], total: str, counted: list[str], extra: list[Column]) -> DataFrame:
    """Rows per ``keys``: their number as ``total``, the counts named, and ``extra`` aggregates."""
    counts = [F.count_if(F.expr(ROW_COUNTS[name])).alias(name) for name in counted]
    return merged.groupBy(*keys).agg(F.count("*").alias(total), *counts, *extra)


def _mean_rating() -> Column:
    return F.round(F.avg("rating"), 6).alias("avg_rating")


def overall_summary(merged: DataFrame) -> DataFrame:
    """A1: count, distinct products and customers, spam/normal, mean rating."""
    distinct = [F.countDistinct(c).alias(name) for name, c in (("total_products", "product_id"), ("total_customers", "customer_id"))]
    return _summary(merged, [], "total_comments", ["spam_comments", "normal_comments"], [*distinct, _mean_rating()])


def product_summary(merged: DataFrame) -> DataFrame:
    """A2: per product: comments, mean rating, spam count; most commented first."""
    per = _summary(merged, ["product_id", "product_name"], "comment_count", ["spam_count"], [_mean_rating()])
    return per.orderBy(F.desc("comment_count"), "product_id")


def customer_summary(merged: DataFrame) -> DataFrame:
    """A3: per customer: comments, F3, F5 and spam counts; most spam first."""
    per = _summary(merged, ["customer_id", "customer_name"], "comment_count", ["F3_count", "F5_count", "spam_count"], [])
    return per.orderBy(F.desc("spam_count"), F.desc("comment_count"), "customer_id")


def top_rows(summary: DataFrame, n: int = 20) -> DataFrame:
    """K2: first ``n`` rows of an ordered summary (TakeOrderedAndProject)."""
    return summary.limit(n)


def reviews_join_products(comments: DataFrame, products: DataFrame) -> DataFrame:
    """Inner equi-join on product_id.  The product dimension is joined by
    key; AQE turns it into a broadcast join only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold``."""
    return comments.join(products, "product_id", "inner")


def attach_similarity_flags(merged: DataFrame, similarity: DataFrame) -> DataFrame:
    """Left join the per-customer similarity columns."""
    cols = ["customer_id", "mean_similarity", "max_similarity", "F4_Flag"]
    return merged.join(similarity.select(*cols), "customer_id", "left")
