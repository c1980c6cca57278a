"""Monthly trend (A9) maintained over review files as they land.

Input: a streaming DataFrame of reviews (comment_id, customer_id,
purchased_at, rating), e.g. ``spark.readStream.schema(s).parquet(dir)``
joined to static dimensions.  Re-delivered reviews are dropped by id within
the event-time watermark.  A review older than the watermark when it lands is
dropped by Spark, so the caller must name a delay that covers the latest
arrival; only then do the counts equal those of the batch operator.  Streaming aggregation has no exact distinct count,
so ``so_khach`` is a HyperLogLog estimate (``approx_count_distinct``).
State holds one row per month (bounded by the time span), and the
de-duplication state is purged by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_trend_stream(reviews: DataFrame, watermark: str, ts: str = "purchased_at") -> DataFrame:
    uniq = reviews.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["comment_id"])
    return (uniq.withColumn("thang", F.date_format(ts, "yyyy-MM"))
                .groupBy("thang")
                .agg(F.count("*").alias("so_don"),
                     F.approx_count_distinct("customer_id").alias("so_khach"),
                     F.round(F.avg("rating"), 2).alias("diem_tb")))


def start_monthly_trend(reviews: DataFrame, watermark: str, sink: str, checkpoint: str, query_name: str | None = None,
                        available_now: bool = False):
    """Start the query in ``complete`` mode.  ``sink`` is a format name
    (``memory`` in tests) and ``checkpoint`` a folder on shared storage, so
    a restarted driver resumes from the recorded offsets and state."""
    w = (monthly_trend_stream(reviews, watermark).writeStream.outputMode("complete").format(sink)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
