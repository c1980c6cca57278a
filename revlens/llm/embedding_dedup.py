"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised, so cosine c is Euclidean distance sqrt(2 - 2c).  A table
concatenates K quantised Gaussian projections floor((a.x + b) / w); vectors that
agree on all K share a bucket.  K follows from the number of vectors (unlike
vectors should rarely meet) and the number of tables from K (a pair at the
threshold meets in one of them with the target recall).  Members of a bucket are
compared by exact cosine in double precision.

Equal vectors are one node with a weight, whatever their number.  Only buckets
with two or more nodes fetch vectors; a large bucket is compared block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bucket_links import Unit, blocked, gather, linked_rows, met_before, pair_mask, per_class
from .common import stored, table

THRESHOLD = 0.9
RECALL = 0.95        # for a pair exactly at the threshold
WIDTH = 2.0
UNLIKE = 0.0         # cosine of vectors that should rarely share a bucket
MEET = 1 / 8         # unlike vectors expected in a vector's bucket
SEED = 20_240


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection agrees at this distance (Datar et al., 2004)."""
    if distance <= 0:
        return 1.0
    x = width / distance
    tail = 0.5 * math.erfc(x / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def parameters(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(projections per table, tables) for n vectors."""
    near = collision(math.sqrt(2 - 2 * threshold))
    far = collision(math.sqrt(2 - 2 * UNLIKE))
    k = max(1, math.ceil(math.log(max(n, 2) / MEET) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** k)))


class PStableHash:
    def __init__(self, dim: int, k: int, tables: int, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.k, self.tables = k, tables
        self.axes = rng.standard_normal((dim, k * tables))
        self.shift = rng.uniform(0, WIDTH, k * tables)
        self.mix = rng.integers(1, 2 ** 63, k, dtype=np.int64).astype(np.uint64) | np.uint64(1)

    def keys(self, unit: np.ndarray, tables: int | None = None) -> np.ndarray:
        """(n, dim) unit vectors -> (n, tables) keys of the buckets in the first ``tables``
        tables (None: all), the table folded in, never 0."""
        tables = self.tables if tables is None else tables
        used = tables * self.k
        cells = np.floor((unit @ self.axes[:, :used] + self.shift[:used]) / WIDTH).astype(np.int64).astype(np.uint64)
        cells = cells.reshape(len(unit), tables, self.k)
        h = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                            (len(unit), tables)).copy()
        for i in range(self.k):
            h = (h ^ (cells[:, :, i] * self.mix[i])) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        return (h | np.uint64(1)).view(np.int64)


@lru_cache(maxsize=4)
def hash_of(dim: int, k: int, tables: int) -> PStableHash:
    """The hash for vectors of one length, drawn once a worker."""
    return PStableHash(dim, k, tables)


def unit_rows(raw: Iterable[bytes], dim: int) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), "<f8").reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the norm
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dim, raw) with ``raw`` the components as doubles, null where the vector
    is null, empty, zero or holds a null, NaN or infinite component."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = []
            for x in batch["vector"]:
                v = None if x is None else np.array([np.nan if c is None else c for c in x] if getattr(x, "dtype", None) == object else x, "<f8")
                good = v is not None and v.ndim == 1 and len(v) > 0 and np.isfinite(v).all() and v.any()
                raw.append((v + 0.0).tobytes() if good else None)
            yield pd.DataFrame({"id": batch["id"], "raw": raw})

    slim = vectors.select(F.col(key).cast("string").alias("id"), F.col(vector).alias("vector"))
    return (slim.mapInPandas(pack, "id string, raw binary")
            .select(F.col("id").cast("long").alias("id"), "raw", (F.octet_length("raw") / 8).cast("int").alias("dim")))


def embedding_dedup(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: (key, n_links, component_id, kept).

    Linked: cosine >= threshold, in double precision; vectors of different length
    never link.  Null, empty, zero and non-finite vectors link with nothing and are
    their own component.  Equal vectors always link.  A null key counts as a vector
    and never names a component unless all of it is null.  Rows repeating a key are
    separate vectors.  Other columns, labels included, are not read; an empty table
    gives an empty table."""
    rows = stored(usable(vectors, key, vector), "vectors")
    classes = stored(rows.where("raw IS NOT NULL").groupBy("raw", "dim")
                     .agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    k, tables = parameters(n, threshold, recall)

    def hash_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                hasher = hash_of(int(dim), k, tables)
                for at in range(0, len(part), 512):
                    some = part.iloc[at:at + 512]
                    keys = hasher.keys(unit_rows(some["raw"], int(dim)))
                    yield pd.DataFrame({"node": np.repeat(some["node"].to_numpy(), tables),
                                        "run": np.tile(np.arange(tables, dtype=np.int32), len(some)),
                                        "bucket": keys.ravel()})

    entries = classes.select("node", "dim", "raw").mapInPandas(hash_all, "node long, run int, bucket long")
    entries = stored(entries, "entries")
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = entries.join(shared, "bucket").join(classes.select("node", "dim", "raw", "size"), "node")
    units = blocked(members, "bucket", F.col("n"))

    def compare(unit: Unit) -> pd.DataFrame | None:
        mask = pair_mask(unit)
        dims, run = unit["dim"], int(unit["run"][0])
        linked = np.zeros_like(mask)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            if len(at) < 2:
                continue
            x = unit_rows(unit["raw"][at], int(dim))
            near = (x @ x.T >= threshold) & mask[np.ix_(at, at)]
            if run and near.any():
                some = np.flatnonzero((near | near.T).any(axis=1))
                keys = hash_of(int(dim), k, tables).keys(x[some], run + 1)
                near[np.ix_(some, some)] &= ~met_before(keys, run)
            linked[np.ix_(at, at)] = near
        return linked_rows(unit["node"], unit["size"], linked)

    links, parts = gather(units, compare, "links")
    result = per_class(classes.drop("dim"), links, parts)
    joined = rows.join(result.select("raw", "links", "component_low"), "raw", "left")
    component = F.when(F.col("raw").isNull(), F.col("id")).otherwise(F.col("component_low"))
    return joined.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
