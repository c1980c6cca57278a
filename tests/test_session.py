"""Written intermediates: what stays on disk."""

import os

from pyspark.sql import functions as F

from revlens.session import SHUFFLE_CLEANUP, cut_lineage


def shuffle_files(spark):
    """Shuffle files of this session, by the block managers' own folders."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return {f for top in env.blockManager().diskBlockManager().localDirs() for _, _, names in os.walk(top.getPath())
            for f in names if f.startswith("shuffle_")}


def test_a_written_intermediate_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(50_000).withColumn("k", F.col("id") % 1000)
    kept = cut_lineage(rows.groupBy("k").agg(F.sum("id").alias("s")).join(rows, "k").repartition("id"))
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        spark.sparkContext._jvm.Thread.sleep(100)
    assert not left and kept.count() == 50_000
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
