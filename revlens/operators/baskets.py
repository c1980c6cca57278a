"""Baskets, transactions, product names and the item catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import cut_lineage


def customer_baskets(df: DataFrame, rating_threshold: float | None = 4, customer: str = "customer_id",
                     product: str = "product_id", rating: str = "rating") -> DataFrame:
    """(customer_id, items) – sorted distinct products rated at least
    ``rating_threshold``.  ``collect_set`` de-duplicates map-side, so a
    basket is bounded by the catalogue, not by the customer's row count."""
    x = df if rating_threshold is None else df.filter(F.col(rating) >= rating_threshold)
    return (x.filter(F.col(product).isNotNull())
             .groupBy(F.col(customer).alias("customer_id"))
             .agg(F.array_sort(F.collect_set(F.col(product))).alias("items")))


def transactions(baskets: DataFrame) -> DataFrame:
    """Non-empty baskets."""
    return baskets.filter(F.size("items") > 0)


def basket_rows(baskets: DataFrame) -> DataFrame:
    """Baskets as (customer_id, product_id) rows."""
    return baskets.select("customer_id", F.explode("items").alias("product_id"))


def product_name_map(df: DataFrame, order: str = "comment_id") -> DataFrame:
    """One name per product: the non-null name of its first row by
    ``order`` (a partial aggregate)."""
    return (df.filter(F.col("product_name").isNotNull())
              .groupBy("product_id")
              .agg(F.min_by("product_name", F.col(order)).alias("product_name")))


def item_catalog(baskets: DataFrame) -> DataFrame:
    """Sorted distinct items with a dense 0-based index (both lookup
    directions are this one table).  The sort is ranged over partitions; an
    item's index is its place there after the items of the partitions before,
    so no single task holds the catalogue."""
    items = cut_lineage(baskets.select(F.explode("items").alias("item")).distinct().orderBy("item")
                        .withColumn("_part", F.spark_partition_id()))
    sizes = items.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select("_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("item")) - 1
    return (items.withColumn("_place", place).join(before, "_part")
            .select("item", (F.col("_before") + F.col("_place")).cast("bigint").alias("idx")))
