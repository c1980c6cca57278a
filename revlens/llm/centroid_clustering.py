"""Centroid clustering (Lloyd rounds on integer vectors) over a VA-file.

Every vector is compressed to a cell of BITS bits per dimension.  For each set of
centroids, lookup tables (centroid x dimension x cell) give the least and the
greatest distance that a vector in a cell can have to a centroid; the sums over
the dimensions bound its distance.  Distances are taken less the distance to the
centroids' mean, a term that all centroids share: the order stays, the intervals
get far narrower.  Where one interval lies below all others the cells alone
assign the vector; only where intervals overlap is the full vector taken and
compared exactly.

Sums are carried from round to round in whole numbers: a round adds and takes
away only the vectors that changed their centroid, and whether one did is read
from the cells under the old and the new centroids.  So a round is one narrow scan
without a shuffle of rows: each task gives one sum per centroid and dimension, which
are added before k * dim numbers come to the driver.  Nothing is kept
per vector between rounds, and no group of vectors is ever gathered: a cluster, or one
vector repeated in a third of all rows, costs no more than any other rows.  Full vectors
lie in the rows of the cells: a page of the file is read whole, so what the cells save is
their decoding and comparison, not the reading.

Bounds: the cells' edges are fitted on at most SAMPLE vectors (efficiency only, never
the result); tables hold k * dim * 2**BITS numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .int_vectors import SCALE, integer_vectors, matrix, products

CLUSTERS, ROUNDS, DIM, SEED = 8, 10, 64, "3"
BITS = 8
SAMPLE = 4096
STEP = 4096  # rows handled at once in a task


class Cells:
    """Cell edges per dimension: quantiles of a sample within the exact least and greatest values."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int):
        cut = np.quantile(sample, np.linspace(0, 1, 2 ** bits + 1)[1:-1], axis=0).astype(np.int64)
        self.edges = cut.T.copy()                                          # dim x (2**bits - 1)
        self.low = np.hstack([least[:, None], self.edges])
        self.high = np.hstack([self.edges - 1, greatest[:, None]])
        self.kind = np.uint8 if bits <= 8 else np.uint16

    def of(self, q: np.ndarray) -> np.ndarray:
        out = np.empty(q.shape, self.kind)
        for d, edges in enumerate(self.edges):
            out[:, d] = np.searchsorted(edges, q[:, d], side="right")
        return out


class Centroids:
    """k centroids with the lookup tables of their distance intervals."""

    def __init__(self, places: np.ndarray, cells: Cells):
        self.places = places
        mean = places.sum(0) // len(places)
        slope, middle = 2 * (mean - places)[:, :, None], (places + mean)[:, :, None]
        # (x - c)^2 - (x - mean)^2 is linear in x: its extremes lie at the ends of a cell
        a = slope * cells.low[None] - slope // 2 * middle
        b = slope * cells.high[None] - slope // 2 * middle
        self.least, self.greatest = np.minimum(a, b), np.maximum(a, b)

    def by_cells(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, sure): sure where only one interval reaches below the least upper bound."""
        dims = np.arange(cells.shape[1])
        least = np.stack([t[dims, cells].sum(1) for t in self.least], 1)
        bound = np.stack([t[dims, cells].sum(1) for t in self.greatest], 1).min(1)
        reach = least <= bound[:, None]
        return reach.argmax(1), reach.sum(1) == 1

    def exact(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance); ties go to the smaller number."""
        if int(np.abs(q).max(initial=0)) < 2 ** 22 and int(np.abs(self.places).max(initial=0)) < 2 ** 22:
            d = (q * q).sum(1)[:, None] - 2 * products(q, self.places) + (self.places ** 2).sum(1)[None]
        else:
            d = np.stack([((q - c) ** 2).sum(1) for c in self.places], 1)
        best = d.argmin(1)
        return best, d[np.arange(len(q)), best]


def _seeds(vectors: DataFrame, key: str, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hash of seed:key (null key: the text 'null'), ties by components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    rows = vectors.select(name.alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([r.q for r in rows], np.int64)


def _sums(index: DataFrame, dim: int, old: Centroids | None, new: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid: change of the component sums (k x dim) and of the counts from ``old`` to ``new``."""
    k, kind = len(new.places), np.uint8

    def scan(batches):
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                n = part.num_rows
                if old is None:
                    take, was = np.arange(n), None
                else:
                    cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), kind).reshape(n, -1)
                    if cells.shape[1] != dim:
                        cells = cells.view(np.uint16)
                    was, sure_was = old.by_cells(cells)
                    now, sure_now = new.by_cells(cells)
                    take = np.flatnonzero(~sure_was | ~sure_now | (was != now))
                q = matrix(part.column("q").take(pa.array(take)), dim)
                now = new.exact(q)[0]
                np.add.at(total, now, q)
                count += np.bincount(now, minlength=k)
                if old is not None:
                    was = old.exact(q)[0]
                    np.subtract.at(total, was, q)
                    count -= np.bincount(was, minlength=k)
        yield pa.RecordBatch.from_pydict({"c": np.arange(k), "n": count, "s": [row.tolist() for row in total]},
                                         schema=pa.schema([("c", pa.int64()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))]))

    parts = index.select("cells", "q").mapInArrow(scan, "c long, n long, s array<long>")
    # s: component sums by place, then the count as one more place
    rows = (parts.select("c", F.posexplode(F.concat("s", F.array("n"))).alias("d", "x"))
            .groupBy("c", "d").agg(F.sum("x").alias("x")).collect())
    total = np.zeros((k, dim + 1), np.int64)
    for r in rows:
        total[r.c, r.d] = r.x
    return total[:, :dim], total[:, dim]


def centroid_clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS,
                      rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED,
                      bits: int = BITS, sample: int = SAMPLE) -> DataFrame:
    """One row per clustered vector: (key, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Vectors of another length than ``dim``, null ones and those with a null or non-finite
    component are left out (see ``integer_vectors`` for components beyond its bound).
    Fewer than ``k`` vectors: that many clusters.  Repeated rows count each; equal
    seeds among them stay as equal centroids, the larger of which keep no vectors and
    do not move.  A null key is hashed as the text 'null'.  An empty table gives an empty
    table.  Other columns are not read."""
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, key, vector, scale, dim), "vectors")
    start = _seeds(rows, key, k, seed)
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, cluster int, distance long"
    if not len(start):
        return spark.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
    k = len(start)
    span = rows.agg(*[f(F.col("q")[d]).alias(f"{f.__name__}_{d}") for f in (F.min, F.max) for d in range(dim)]).first()
    drawn = np.array([r.q for r in rows.select("q").orderBy(F.xxhash64("q")).limit(sample).collect()], np.int64)
    cells = Cells(drawn, np.array(span[:dim], np.int64), np.array(span[dim:], np.int64), bits)

    def compress(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                packed = [c.tobytes() for c in cells.of(matrix(part.column("q"), dim))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column("q"), pa.array(packed, pa.binary())], [key, "q", "cells"])

    index = stored(rows.select(key, "q").mapInArrow(compress, rows.select(key, "q").schema.add("cells", "binary")), "va-file")
    old, new = None, Centroids(start, cells)
    total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    for _ in range(rounds):
        added, n = _sums(index, dim, old, new)
        total, count = total + added, count + n
        moved = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], new.places)
        old, new = new, Centroids(moved, cells)
        if (old.places == new.places).all():
            break  # every further round would repeat this one

    def final(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                best, distance = new.exact(matrix(part.column("q"), dim))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(best.astype(np.int32)), pa.array(distance)],
                                                 [key, "cluster", "distance"])

    out = stored(index.select(key, "q").mapInArrow(final, schema), "clusters")
    inertia = {r.cluster: int(r.d) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in new.places.tolist()]
    each = F.array(*[F.struct(F.lit(inertia.get(c, 0)).cast("long").alias("i"), F.lit(named[c]).alias("h")) for c in range(k)])
    own = F.element_at(each, F.col("cluster") + 1)
    return out.select(key, "cluster", "distance", own["i"].alias("cluster_inertia"),
                      F.lit(sum(inertia.values())).cast("long").alias("inertia"), own["h"].alias("centroid_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` with its cluster; cases as in :func:`centroid_clusters`."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = ROUNDS, k: int = CLUSTERS) -> str:
    def assign(r):
        return (f"a{r} AS MATERIALIZED (SELECT vec_id, c, dist FROM (SELECT v.vec_id, c.c, "
                "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS dist, "
                "row_number() OVER (PARTITION BY v.vec_id ORDER BY list_sum(list_transform(list_zip(v.q, c.q), "
                f"lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.c) AS place FROM v, c{r} c) WHERE place = 1)")

    parts = [f"""WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIM}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h) - 1)::INT AS c, q FROM
  (SELECT sha256('{SEED}:' || vec_id) AS h, q FROM v ORDER BY h LIMIT {k}))"""]
    for r in range(rounds):
        parts.append(assign(r))
        parts.append(f"""m{r} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS q FROM (
  SELECT c, d, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
    SELECT a.c, unnest(v.q) AS x, generate_subscripts(v.q, 1) AS d FROM a{r} a JOIN v USING (vec_id)) GROUP BY c, d) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.q, o.q) AS q FROM c{r} o LEFT JOIN m{r} m USING (c))""")
    parts.append(assign(rounds))
    return ",\n".join(parts) + f"""
SELECT a.vec_id, a.c AS cluster, a.dist AS distance, (sum(a.dist) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.dist) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)"""


SQL = _sql()
