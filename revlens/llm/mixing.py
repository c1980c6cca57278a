"""Mixing sources to target weights by fractional repetition.

Tokens are aggregated per source, targets follow from the weights, and each
document is emitted floor(rate) times plus one Bernoulli copy whose coin is a
hash of its id and text and whose probability is the rate's fraction.  Rates are equal
within a source, so nothing but the per-source sums is needed: the document
pass is a join with that small table, and a source with a third of all rows
costs no more than any other (partial sums before the shuffle; the join side is
broadcast only when Spark's measured size allows, else AQE splits the source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import full_text, stored, table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size``: runs of characters other than space and U+0009-U+000D."""
    return docs.withColumn("size", F.regexp_count(full_text(text), F.lit(WORD)).cast("long"))


def _coin(key: str, text: str, seed: str):
    """A number in [0, 1) from the row's key and text."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":"), F.md5(full_text(text)))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0) by code point, null last.  The sort is ranged over
    partitions; offsets come from the per-partition counts, so no window holds
    all sources."""
    ordered = stored(sources.orderBy(F.col("source").asc_nulls_last())
                     .withColumn("part", F.spark_partition_id()), "sources")
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offset = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return (ordered.withColumn("within", within)
            .join(counts.select("part", offset.alias("before")), "part")
            .select("source", "source_size", (F.col("before") + F.col("within")).alias("rank")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, size) rows -> (source, source_size, target).

    All sizes are shared by weight; a target stops at ``max_repeat`` times its
    source's size and the excess is shared again by weight until none is above
    (water-filling: target = min(cap, level * weight)).  Each round is one
    aggregate over the per-source table; two numbers come back."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    rows = stored(_ranked(totals).select(
        "source", "source_size", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(max_repeat)).alias("cap")), "weights")
    total, all_weight = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(total or 0)
    level = total / all_weight if all_weight else 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, open_weight, n = rows.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))),
                                          F.count(F.when(full, 1))).first()
        raised = (total - (capped or 0.0)) / open_weight if open_weight else level
        if not open_weight or raised <= level * (1 + 1e-15):
            break
        level = raised
    return rows.select("source", "source_size", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def planned(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
            weights=WEIGHTS, max_repeat: float = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """(key, size, source_size, target, copies) for every row of ``docs``.

    Null text: size 0.  Null source: a source of its own, last in order.  A null
    key reads as the text 'null'.  The coin is of the row's key and text, so rows that share
    a key, or have none, fall each their own way; rows equal in both share
    their coin.  Sources without words have target 0 and no copies.  An empty table
    gives an empty table; other columns are not read.  Reruns agree: the coin is
    the first 32 bits of md5(seed:key:md5(text))."""
    rows = stored(sized(docs.select(F.col(key).alias("doc_key"), F.col(source).alias("source"), F.col(text).alias("text")))
                  .withColumn("coin", _coin("doc_key", "text", seed)).drop("text"), "sizes")
    targets = source_targets(rows.select("source", "size"), weights, max_repeat).withColumnRenamed("source", "their")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    coin = F.col("coin")
    return (rows.join(targets, F.col("source").eqNullSafe(F.col("their")))
            .withColumn("rate", rate)
            .select(F.col("doc_key").alias(key), "size", "source_size", "target",
                    (F.floor("rate") + F.when(coin < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long").alias("copies")))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_repeat: float = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs``, all its columns, emitted ``copies`` times.

    Same cases as :func:`planned`; the coin and the rate are computed in place, so
    texts are not shuffled unless the source table is too large to broadcast."""
    own = "__mix_"
    work = docs.withColumn(f"{own}size", F.regexp_count(full_text(text), F.lit(WORD)).cast("long"))
    targets = source_targets(work.select(F.col(source).alias("source"), F.col(f"{own}size").alias("size")), weights, max_repeat)
    rates = targets.select(F.col("source").alias(f"{own}source"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(f"{own}rate"))
    coin = _coin(key, text, seed)
    r = F.col(f"{own}rate")
    copies = (F.floor(r) + F.when(coin < r - F.floor(r), 1).otherwise(0)).cast("int")
    return (docs.join(rates, F.col(source).eqNullSafe(F.col(f"{own}source")))
            .withColumn(f"{own}copies", copies).where(F.col(f"{own}copies") > 0)
            .withColumn(f"{own}copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}copies"))))
            .select(*docs.columns))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = planned(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = f"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
o AS (SELECT *, 3.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS k FROM w),
c AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         sum(source_size) OVER () AS total FROM o),
lvl AS (SELECT arg_min((total - capped) / open_weight, k) AS level FROM c WHERE (total - capped) / open_weight <= cap / weight),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM lvl)) AS target FROM c),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.digest), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS coin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
