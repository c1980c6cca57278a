"""The cleaning job's intermediates: what is written step by step gives the same rows and leaves only the last."""

import os

from pyspark.sql import functions as F

from revlens.operators.dedup import dedup, dedup_written
from revlens.plans import cleaning, fixtures
from revlens.session import checkpoint_dir
from tests.conftest import SF001


def folders(spark):
    return {f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("lineage-")}


def test_rounds_of_dedup_give_the_rows_of_one(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("k"), F.when(F.col("id") % 700 > 3, F.col("id") % 7).alias("x"), F.col("id").alias("y"))
    rows = rows.withColumn("k", F.when(F.col("k") != 5, F.col("k")))  # one null key
    before = folders(spark)
    for keep in ("first", "last"):
        expected = sorted(map(tuple, dedup(rows, ["k"], keep=keep).collect()), key=str)
        got = dedup_written(rows, ["k"], keep, round_rows=1000)
        assert sorted(map(tuple, got.collect()), key=str) == expected and got.columns == rows.columns
    assert len(folders(spark) - before) == 4  # two rounds each; the rows they read are gone
    assert dedup_written(rows.limit(0), ["k"]).count() == 0


def test_cleaned_rows_are_the_only_ones_kept(spark):
    products, comments = fixtures.raw_products(spark, SF001), fixtures.dirty_comments(spark, SF001)
    before = folders(spark)
    rows = cleaning.cleaned(products, comments)
    assert len(folders(spark) - before) == 1
    lazy = cleaning.cleaned(products, comments, materialize=False)
    assert rows.columns == lazy.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, lazy.collect()))


def test_no_join_of_the_comments_carries_their_texts(spark):
    """Texts are put together above the last join."""
    plan = fixtures.dirty_comments(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join "):]
    assert "concat_ws" in plan and "concat_ws" not in below and "unix_seconds" not in below
