"""Spam/ham split and the balanced sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.quantiles import exact_quantiles
from revlens.session import cut_lineage

NOTEBOOK_FLAGS = ("F3_flag", "F4_Flag", "F5_flag")
# Hash ranges span 60 bits: three levels keep every bucket table under
# 2^22 rows.
HASH_SHIFTS = (44, 22, 0)


def spam_ham_label(df: DataFrame, flags: tuple[str, ...] = NOTEBOOK_FLAGS) -> DataFrame:
    """``label`` = 'spam' when any flag is true, 'ham' when all are
    false, null otherwise (a null flag keeps a row out of both classes)."""
    cols = [F.col(f) for f in flags if f in df.columns]
    any_true = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in cols])
    all_false = reduce(lambda a, b: a & b, [c == F.lit(False) for c in cols])
    return df.withColumn("label", F.when(any_true, "spam").when(F.coalesce(all_false, F.lit(False)), "ham"))


def seeded_hash(key: str, seed: int) -> Column:
    """60 bits of md5(key:seed) as a bigint, which any SQL engine can reproduce."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def balanced_sample(df: DataFrame, key: str, fraction: float = 0.1, seed: int = 42,
                    flags: tuple[str, ...] = NOTEBOOK_FLAGS, materialize: bool = True) -> DataFrame:
    """``int(fraction * rows) // 2`` rows from spam and from ham (each
    capped at the class size), chosen by a seeded hash of ``key``, returned
    in a seeded hash order.

    The k-th smallest hash of each class is located exactly with bounded
    histogram passes (``exact_quantiles``); rows below it are kept, and of those
    that share it the first by ``key``, so a class never exceeds its size: no
    window over a whole class and no driver round trip.
    """
    every = spam_ham_label(df, flags).withColumn("_h", seeded_hash(key, seed))
    if materialize:
        # the labelled rows are read by the row count, the class sizes, each histogram
        # level and the final filter: materialise them once
        every = cut_lineage(every)
    total = every.agg(F.count("*")).scalar()
    lab = every.filter(F.col("label").isNotNull())
    per_class = F.floor(F.lit(fraction) * total / 2)
    sizes = lab.groupBy(F.col("label").alias("g")).agg(F.count("*").alias("size"))
    ranks = sizes.select("g", F.least(per_class.cast("bigint"), F.col("size")).alias("k")).filter(F.col("k") >= 1)
    cut = exact_quantiles(lab, "_h", [], group="label", shifts=HASH_SHIFTS, ranks=ranks)
    cut = cut.join(ranks.select("g", F.col("k").alias("_k")), "g").select(F.col("g").alias("label"), F.col("value").alias("_cut"), "_k")
    cut = F.broadcast(cut)  # a row per class
    near = lab.join(cut, "label").filter(F.col("_h") <= F.col("_cut"))
    below = near.groupBy("label").agg(F.count_if(F.col("_h") < F.col("_cut")).alias("_below"))
    tied = Window.partitionBy("label", "_h").orderBy(key)
    ties = (near.filter(F.col("_h") == F.col("_cut")).withColumn("_place", F.row_number().over(tied))
            .join(F.broadcast(below), "label").filter(F.col("_below") + F.col("_place") <= F.col("_k")))
    picked = near.filter(F.col("_h") < F.col("_cut")).unionByName(ties.drop("_place", "_below"))
    return picked.orderBy(seeded_hash(key, seed + 1), key).drop("_h", "_cut", "_k")
