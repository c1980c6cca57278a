"""Exact discrete quantiles that scale.

``percentile_disc`` semantics: the q-quantile is the smallest value v with
count(x <= v) >= q * n, i.e. the value at sorted position k = max(1, ceil(q n)).

Spark's exact ``percentile_disc`` keeps every distinct value of a group in one
buffer, and ``percentile_approx`` is off by up to n / accuracy ranks.  Here
the k-th value is found by histogram refinement on integer values: at each
level values are bucketed by ``v >> shift``, bucket counts are aggregated
(partial aggregation, so no task sees more than its own rows), running
counts over the bucket table locate the bucket holding rank k, and the next
level only reads rows inside that bucket.  Bucket tables are bounded by
2^20 rows per located bucket, whatever the data size.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import cut_lineage

# Level shifts.  Level 1 groups values by v >> 20, so its table has at most
# (max - min) / 2^20 + 1 rows: under a million for any value below 2^40
# (durations in seconds, counts, amounts in cents).  Level 2 reads only the
# rows of the located buckets and has at most 2^20 rows per quantile.
SHIFTS = (20, 0)


def exact_quantiles(df: DataFrame, value: Column | str, qs: list[float],
                    group: Column | str | None = None, shifts: tuple[int, ...] = SHIFTS,
                    ranks: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Rows (g, qi, q, value) with the exact discrete q-quantiles of the
    integer-valued ``value`` (nulls ignored), per ``group`` if given.

    ``ranks`` (columns g, k) asks for the k-th smallest value per group
    instead (qi = 0, q = null); groups with k < 1 or k > n get no row.
    ``weight`` names a column: a row counts as that many.
    """
    value = F.col(value) if isinstance(value, str) else value
    g = F.lit(0) if group is None else (F.col(group) if isinstance(group, str) else group)
    held = F.lit(1) if weight is None else F.col(weight)
    v = (df.select(g.alias("g"), value.cast("bigint").alias("v"), held.cast("bigint").alias("w"))
           .filter(F.col("v").isNotNull()))
    qarr = F.array(*[F.lit(Decimal(str(q))).cast("decimal(20,10)") for q in qs])
    keys = ["g", "qi", "q", "k", "before"]
    run = Window.partitionBy("g", "qi").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    state, prev = None, None
    for s in shifts:
        if state is None:
            # level 1: bucket counts; n per group comes from the same table
            hist = v.groupBy("g", F.shiftright("v", s).alias("b")).agg(F.sum("w").alias("c"))
            if ranks is None:
                hist = (hist.withColumn("n", F.sum("c").over(Window.partitionBy("g")))
                            .select("*", F.posexplode(qarr).alias("qi", "q"))
                            .withColumn("k", F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n"))).cast("bigint")))
            else:
                hist = hist.join(F.broadcast(ranks.select("g", F.col("k").cast("bigint").alias("k"))), "g") \
                           .withColumn("qi", F.lit(0)).withColumn("q", F.lit(None).cast("decimal(20,10)"))
            hist = hist.withColumn("before", F.lit(0).cast("bigint"))
        else:
            # rows inside the located buckets only (one bucket per quantile)
            located = F.broadcast(state.withColumnRenamed("b", "p"))
            rows = v.withColumn("p", F.shiftright("v", prev)).join(located, ["g", "p"])
            hist = rows.groupBy(*keys, F.shiftright("v", s).alias("b")).agg(F.sum("w").alias("c"))
        hist = hist.withColumn("cum", F.col("before") + F.sum("c").over(run))
        state = (hist.filter((F.col("cum") >= F.col("k")) & (F.col("cum") - F.col("c") < F.col("k")))
                     .select("g", "qi", "q", "k", (F.col("cum") - F.col("c")).alias("before"), "b"))
        prev = s
    return state.select("g", "qi", F.col("q").cast("double").alias("q"), F.col("b").alias("value"))


def quantile_row(df: DataFrame, value: Column | str, qs: list[float], scale: float = 1.0, once: bool = False) -> DataFrame:
    """One row ``values``: array of the exact quantiles in ``qs`` order, each
    divided by ``scale`` (use scale 100 for values stored as cents).  With ``once``
    the rows of ``df`` are worked out once: each value is written with its count (a
    Spark job), and both levels read these counts."""
    if once:
        value = F.col(value) if isinstance(value, str) else value
        counts = df.select(value.cast("bigint").alias("v")).filter(F.col("v").isNotNull()).groupBy("v").agg(F.count("*").alias("c"))
        res = exact_quantiles(cut_lineage(counts), "v", qs, weight="c")
    else:
        res = exact_quantiles(df, value, qs)
    packed = res.agg(F.array_sort(F.collect_list(F.struct("qi", "value"))).alias("s"))
    return packed.select(F.transform("s", lambda x: x["value"] / F.lit(scale)).alias("values"))
