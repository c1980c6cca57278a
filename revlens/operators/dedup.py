"""De-duplication (A4) and duplicate counting (A5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.session import cut_lineage, discard

ROUND_ROWS = 2_000_000  # rows that one round of ``dedup_written`` takes, while that gives MOST_ROUNDS at most: each reads all written rows
MOST_ROUNDS = 2


def dedup(df: DataFrame, keys: list[str], order: list[str | Column] | None = None,
          keep: str = "first") -> DataFrame:
    """A4: one row per key, chosen deterministically.

    ``keep="first"`` keeps the row with the smallest ``order`` values (columns
    or expressions, such as a time read from text; then the remaining columns as
    tie-break), ``"last"`` the largest; nulls are smallest.  Written as
    ``min``/``max`` of a struct per key, which Spark aggregates partially on
    the map side: a key with millions of copies is reduced before the
    shuffle instead of being sorted whole in one task as a window would.
    """
    others = [c for c in df.columns if c not in keys]
    order = [c for c in (order or []) if not (isinstance(c, str) and c in keys)]
    rest = [F.col(c).alias(c) for c in others if not any(isinstance(o, str) and o == c for o in order)]
    by = [F.col(o).alias(o) if isinstance(o, str) else o.alias(f"_order{i}") for i, o in enumerate(order)]
    packed = F.struct(*by, *rest)
    pick = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedup_written(df: DataFrame, keys: list[str], keep: str = "first", round_rows: int = ROUND_ROWS) -> DataFrame:
    """``dedup``, written.  The rows are written first, so that the shuffles they come from are gone
    when theirs begins, and keys are dealt over rounds by hash: shuffle files of one round lie on
    disk at a time.  Each round reads the written rows once."""
    rows = cut_lineage(df)
    rounds = max(1, min(MOST_ROUNDS, -(-rows.count() // round_rows)))
    dealt = F.pmod(F.xxhash64(*keys), F.lit(rounds))
    parts = [cut_lineage(dedup(rows.filter(dealt == i) if rounds > 1 else rows, keys, keep=keep)) for i in range(rounds)]
    discard(rows)
    return reduce(DataFrame.unionByName, parts)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """A5: rows, distinct keys and surplus rows by key (one row)."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("total_rows"),
                       F.count("*").alias("distinct_keys"),
                       (F.sum("n") - F.count("*")).alias("duplicate_rows"))
