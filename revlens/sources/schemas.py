"""Explicit schemas: no inference pass over the input."""

from pyspark.sql import types as T

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("original_price", T.DoubleType()),
    T.StructField("rating_average", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("brand_name", T.StringType()),
    T.StructField("short_description", T.StringType()),
    T.StructField("url_key", T.StringType()),
])

# Raw comment rows keep the dirty columns as text; typing happens in
# ``operators.clean.epoch_to_timestamp`` with try_cast (dirty -> null).
COMMENT_SCHEMA = T.StructType([
    T.StructField("comment_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("purchased_at", T.StringType()),
    T.StructField("seller_id", T.LongType()),
    T.StructField("seller_name", T.StringType()),
])

REVIEW_JSON_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("created_by", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("purchased_at", T.LongType()),
    ])),
    T.StructField("seller", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ])),
])

PRODUCT_JSON_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("original_price", T.DoubleType()),
    T.StructField("rating_average", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("brand", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("short_description", T.StringType()),
    T.StructField("url_key", T.StringType()),
])

LISTING_JSON_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("id", T.LongType())]))),
])
