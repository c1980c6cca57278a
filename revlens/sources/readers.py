"""Scans (S1–S6).

Paths may carry any Hadoop scheme (``hdfs://``, ``s3a://``, ``file:``); Spark
resolves them itself, so there is no local/remote dispatch code (S3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.sources.schemas import (
    LISTING_JSON_SCHEMA, PRODUCT_JSON_SCHEMA, REVIEW_JSON_SCHEMA,
)

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             **options) -> DataFrame:
    """Header CSV, multi-line quoted fields, ``"`` quote and escape.

    With a schema there is no inference job; without one the header decides
    the columns and every value is read as text.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_part_dir(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every ``part-*.csv`` of a job's output folder, malformed rows skipped."""
    return read_csv(spark, f"{path.rstrip('/')}/part-*.csv", schema, mode="DROPMALFORMED")


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Stopword file: one word per line, blanks ignored -> (word)."""
    return (spark.read.text(path)
            .select(F.trim("value").alias("word"))
            .filter(F.col("word") != "")
            .distinct())


def _json_frame(src, schema: T.StructType, spark: SparkSession | None) -> DataFrame:
    if isinstance(src, DataFrame):
        # a column of JSON text: parse in place
        return src.select(F.from_json(F.col(src.columns[0]), schema).alias("j")).select("j.*")
    return spark.read.schema(schema).json(src)


def flatten_reviews(src, spark: SparkSession | None = None, product_id: Column | None = None) -> DataFrame:
    """Nested review JSON -> flat comment rows; null ``created_by``/``seller`` safe.

    ``src`` is a path (JSON lines) or a one-column DataFrame of JSON text.
    ``product_id`` overrides the document's product id (crawl by product).
    """
    j = _json_frame(src, REVIEW_JSON_SCHEMA, spark)
    return j.select(
        F.col("id").alias("comment_id"),
        (product_id if product_id is not None else F.col("product_id")).alias("product_id"),
        F.col("customer_id"),
        F.col("created_by.name").alias("customer_name"),
        F.col("rating"),
        F.col("title"),
        F.col("content"),
        F.col("created_at"),
        F.col("created_by.purchased_at").alias("purchased_at"),
        F.col("seller.id").alias("seller_id"),
        F.col("seller.name").alias("seller_name"),
    )


def flatten_products(src, spark: SparkSession | None = None) -> DataFrame:
    """Nested product JSON -> flat product rows (``brand.name`` etc.)."""
    j = _json_frame(src, PRODUCT_JSON_SCHEMA, spark)
    return j.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"),
        "price", "original_price", "rating_average", "review_count",
        F.col("brand.name").alias("brand_name"), "short_description", "url_key",
    )


def flatten_product_ids(src, spark: SparkSession | None = None, dedup: bool = True) -> DataFrame:
    """Listing JSON ``data[]`` -> product ids; falsy ids dropped, optional dedup."""
    j = _json_frame(src, LISTING_JSON_SCHEMA, spark)
    ids = (j.select(F.explode("data").alias("d"))
           .select(F.col("d.id").alias("product_id"))
           .filter(F.col("product_id").isNotNull() & (F.col("product_id") != 0)))
    return ids.distinct() if dedup else ids


def parse_json_column(df: DataFrame, col: str, schema, keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> typed columns (``from_json`` with a fixed schema;
    malformed text gives nulls)."""
    parsed = F.from_json(F.col(col), schema)
    return df.select(*(keep or []), parsed.alias("_j")).select(*(keep or []), "_j.*")
