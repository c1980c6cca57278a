"""Connected components of a link table (distributed union-find).

Alternating large-star and small-star rounds (Kiveris et al., 2014): every
round is two joins of the edge table with its own per-node minima, so no
component, edge list or label table is ever gathered in one place.  A node with
very many edges is a skewed join key; only the minimum per node is aggregated,
which Spark combines before the shuffle, and the join back is a plain
sort-merge join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 60


def _min_neighbour(directed: DataFrame) -> DataFrame:
    return (directed.groupBy("u").agg(F.min("v").alias("low"))
            .select(F.col("u").alias("n"), F.least(F.col("u"), F.col("low")).alias("low")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _min_neighbour(both)
    return (both.where(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _min_neighbour(down)
    moved = (down.join(low, F.col("u") == F.col("n"))
             .select(F.col("v").alias("u"), F.col("low").alias("v")))
    roots = low.select(F.col("n").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(roots).where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of any orderable type -> (node, component), one row per
    node that has an edge; ``component`` is the smallest reachable node.

    Self-loops, repeated edges and either direction are accepted; rows with a
    null end are dropped; an empty table gives an empty table."""
    current = stored(edges.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL AND u != v")
                     .distinct(), "cc")
    seen = None
    for _ in range(MAX_ROUNDS):
        current = stored(_small_star(_large_star(current)), "cc")
        state = current.agg(F.count(F.lit(1)).alias("n"),
                            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            break
        seen = state
    else:
        raise RuntimeError("components did not converge")
    # converged: every edge runs from a node to its component's smallest node
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
