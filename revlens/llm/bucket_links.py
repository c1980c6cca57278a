"""Links inside buckets: shared by the set-similarity join and the vector join.

Both methods deal nodes (distinct texts or vectors) into buckets, several times
over, and then compare the members of a bucket.  This module does that second
half without ever listing pairs: a task receives the members of one bucket (or
of two blocks of a large one), finds the linked pairs as numpy matrices, and
returns per node the number of its links and a spanning forest of them.  A pair
that meets in several buckets is counted only in the first, which both members
can tell from their bucket lists.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

BLOCK = 256  # members of a bucket compared at once; larger buckets are compared block by block


def blocked(members: DataFrame, bucket: str, size: Column, block: int = BLOCK) -> DataFrame:
    """Members (node, bucket, ..) -> the same with ``left`` and ``right`` block numbers.

    A bucket of up to ``block`` members is one unit (0, 0).  A larger one is dealt
    into blocks by a hash of the node and each member goes to the units of its
    block with every block, so that every pair meets exactly once and no task holds
    more than about two blocks."""
    blocks = F.ceil(size / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node", bucket), blocks).cast("int")
    dealt = members.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (dealt.withColumn("left", F.least("__own", "__other")).withColumn("right", F.greatest("__own", "__other"))
            .withColumn("in_left", F.col("__own") == F.col("left")).drop("__own", "__other"))


Unit = dict[str, np.ndarray]  # columns of one unit's rows


def by_unit(units: DataFrame, compare: Callable[[Unit], pd.DataFrame | None], schema: str) -> DataFrame:
    """Run ``compare`` on the rows of each (bucket, left, right).

    Most buckets hold two or three nodes, so units are cut out of sorted batches
    rather than handed over one by one; a unit that runs over the end of a batch is
    carried to the next.  A task holds one batch and one unit."""
    key = ["bucket", "left", "right"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                if rest is None or not len(rest):
                    return
                frame, open_end = rest, False
            else:
                if not len(batch):
                    continue
                frame, open_end = batch if rest is None else pd.concat([rest, batch], ignore_index=True), True
            marks = frame[key].to_numpy(np.int64)
            bounds = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), len(frame)]
            columns = {c: frame[c].to_numpy() for c in frame.columns}
            found = []
            for low, high in zip(bounds[:-2] if open_end else bounds[:-1], bounds[1:]):
                if high - low > 1:
                    out = compare({c: x[low:high] for c, x in columns.items()})
                    if out is not None and len(out):
                        found.append(out)
            rest = frame.iloc[bounds[-2]:] if open_end else None
            if found:
                yield pd.concat(found, ignore_index=True)

    return units.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, schema)


def pair_mask(unit: Unit) -> np.ndarray:
    """Which ordered pairs (i < j) of a unit are compared there: all within one
    block, and only those across the two blocks of a mixed unit."""
    n = len(unit["node"])
    mask = np.triu(np.ones((n, n), bool), 1)
    if unit["left"][0] != unit["right"][0]:
        first = unit["in_left"].astype(bool)
        mask &= first[:, None] != first[None, :]
    return mask


def met_before(keys: np.ndarray, run: int) -> np.ndarray:
    """keys: (members, runs), 0 for no bucket.  Pairs sharing a bucket of an earlier run."""
    n = len(keys)
    met = np.zeros((n, n), bool)
    for r in range(run):
        column = keys[:, r]
        if (column != 0).sum() > 1:
            met |= (column[:, None] == column[None, :]) & (column[:, None] != 0)
    return met


def linked_rows(nodes: np.ndarray, sizes: np.ndarray, linked: np.ndarray) -> pd.DataFrame | None:
    """Upper-triangular link matrix -> count rows (u, links) and forest rows (u, v)."""
    if not linked.any():
        return None
    both = linked | linked.T
    links = both.astype(np.int64) @ sizes
    has = both.any(axis=1)
    label = np.arange(len(nodes))
    while True:
        lowest = np.minimum(label, np.where(both, label[None, :], len(nodes)).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == label).all():
            break
        label = lowest
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return pd.DataFrame({
        "u": np.concatenate([nodes[has], nodes[child]]),
        "v": np.concatenate([np.zeros(has.sum(), np.int64), nodes[label[child]]]),
        "links": np.concatenate([links[has], np.zeros(len(child), np.int64)]),
        "edge": np.concatenate([np.zeros(has.sum(), bool), np.ones(len(child), bool)])})


LINK_SCHEMA = "u long, v long, links long, edge boolean"


def gather(units: DataFrame, compare: Callable[[Unit], pd.DataFrame | None], name: str) -> tuple[DataFrame, DataFrame]:
    """Run ``compare`` per unit -> (links per node, component per linked node)."""
    found = stored(by_unit(units, compare, LINK_SCHEMA), name)
    links = found.where("NOT edge").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    return links, components(found.where("edge").select("u", "v"))


def per_class(classes: DataFrame, links: DataFrame, parts: DataFrame) -> DataFrame:
    """Classes (node, size, low) -> (.., links, component): ``links`` counts the
    class's other members too; ``component`` is the smallest ``low`` reachable."""
    joined = (classes.join(links, "node", "left").join(parts, "node", "left")
              .withColumn("component", F.coalesce("component", "node"))
              .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("size") - 1))
    lows = joined.groupBy("component").agg(F.min("low").alias("component_low"))
    return joined.join(lows, "component").drop("component")
