"""What the training-data operators share: table reading and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import checkpoint_dir, write_once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: lineage ends there, columns are pruned on each later read, and a lost
    executor loses nothing."""
    return write_once(df, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}")


ROW = "__row"


def with_rows(df: DataFrame) -> DataFrame:
    """``df`` with ROW, a number of its own for each row, written with the rows so that
    every later read sees the same."""
    return stored(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def full_text(column: str = "text"):
    """The whole text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-int(rows) // per_part))
