import os

from pyspark.sql import functions as F

from revlens.operators import trends
from revlens.plans import fixtures as fx
from revlens.streaming import start_monthly_trend
from tests.conftest import SF001


def test_monthly_trend_stream_matches_batch(spark, tmp_dir):
    # land the orders twice (re-delivery): the stream must count each order once
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    land = os.path.join(tmp_dir, "landing")
    orders.write.parquet(os.path.join(land, "batch1"))
    orders.limit(50).write.parquet(os.path.join(land, "batch2"))
    stream = spark.readStream.schema(orders.schema).option("recursiveFileLookup", "true").parquet(land)
    cust = spark.read.parquet(f"{SF001}/customer.parquet").select("c_custkey", "c_name")
    reviews = (stream.join(cust, stream.o_custkey == cust.c_custkey, "left")
               .select(F.col("o_orderkey").alias("comment_id"), F.col("o_custkey").alias("customer_id"),
                       F.col("o_orderdate").cast("timestamp").alias("purchased_at"),
                       fx.rating_from_priority().alias("rating")))
    q = start_monthly_trend(reviews, "3650 days", "memory", os.path.join(tmp_dir, "ckpt"), "trend_out", available_now=True)
    q.awaitTermination(300)
    got = {r.thang: (r.so_don, r.diem_tb) for r in spark.sql("SELECT * FROM trend_out").collect()}
    batch = {r.thang: (r.so_don, r.diem_tb) for r in trends.monthly_trend(fx.reviews(spark, SF001)).collect()}
    assert got == batch
