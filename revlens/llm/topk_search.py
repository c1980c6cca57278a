"""Exact top-k search by inner product over a bit-sliced index.

Rows are dealt evenly into stripes of about STRIPE rows.  A stripe is one row of the
index table: for each dimension the components less their minimum are cut to BITS bits,
and each bit of a dimension is a bitmap over the stripe's rows.  A query adds the slices,
weighted by its own quantised components, with bitmap arithmetic (carry-save adders:
three bitmaps of one place become a sum and a carry); negative components add the
complement.  The result is the sum's own bit slices.  From the most significant slice
downward the k-th largest sum is found, then all rows whose sum reaches it less
the quantisation error: outside these no row can be among the k best.  These boundary
rows get their exact integer score from the full vectors, ties by smaller key.

The queries are compared with all rows in blocks: a grid of (stripe, group of
queries), each cell one bounded task unit (STRIPE rows, GROUP queries), joined by cell
number.  A cell returns k rows a query; the ranking over the stripes cuts to k before
its shuffle as well as after (Spark's window group limit).  Rows are dealt by row number,
so copies of one row or one key do not meet in a stripe.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, parts_for, stored, table, with_rows
from .int_vectors import SCALE, integer_vectors, products

K, EVERY = 10, 100
STRIPE, GROUP = 8192, 256
BITS, WEIGHT_BITS = 6, 6


def _words(bits: np.ndarray) -> np.ndarray:
    """(..., rows) booleans -> (..., words) uint64, the tail filled with zeros."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    fill = -packed.shape[-1] % 8
    return np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, fill)]).view(np.uint64)


class Slices:
    """The bit slices of one stripe: components = least + step * cut + rest, 0 <= rest < step."""

    def __init__(self, q: np.ndarray, bits: int):
        self.rows, self.least = len(q), q.min(0)
        span = int((q.max(0) - self.least).max(initial=0))
        self.bits, self.shift = bits, max(0, span.bit_length() - bits)
        cut = (q - self.least) >> self.shift
        self.maps = _words((cut[None] >> np.arange(bits)[:, None, None] & 1).astype(bool).transpose(0, 2, 1))  # bit, dim, words
        self.valid = _words(np.ones(self.rows, bool))

    def packed(self) -> bytes:
        head = np.array([self.rows, self.bits, self.shift, len(self.least)], np.int64)
        return head.tobytes() + self.least.astype(np.int64).tobytes() + self.maps.tobytes()

    @classmethod
    def read(cls, data: bytes) -> "Slices":
        self = cls.__new__(cls)
        self.rows, self.bits, self.shift, dim = (int(x) for x in np.frombuffer(data, np.int64, 4))
        self.least = np.frombuffer(data, np.int64, dim, 32)
        self.valid = _words(np.ones(self.rows, bool))
        self.maps = np.frombuffer(data, np.uint64, offset=32 + 8 * dim).reshape(self.bits, dim, -1)
        return self

    def weighted_sum(self, w: np.ndarray, weight_bits: int) -> tuple[list[np.ndarray], int]:
        """Bit slices (least significant first) of S, and the slack: rows whose S lies more
        than slack below another row's S have a smaller exact w.q.

        |w| = 2**cut * u + rest with rest in [-2**(cut-1), 2**(cut-1)]; S = sum of u * x with x the
        cut component, or its complement where w < 0.  Two rows' exact scores differ by
        2**(cut+shift) * (their S) and at most the slack from the two rests."""
        size, top = np.abs(w), (1 << self.bits) - 1
        cut = max(0, int(size.max(initial=0)).bit_length() - weight_bits)
        u = (size + ((1 << cut) >> 1)) >> cut
        rest = int(np.abs(size - (u << cut)).sum()) * top * (1 << self.shift) + int(size.sum()) * ((1 << self.shift) - 1)
        slack = -(-rest // (1 << (cut + self.shift)))
        places: dict[int, list[np.ndarray]] = {}
        for j in range(int(u.max(initial=0)).bit_length()):
            dims = np.flatnonzero(u >> j & 1)
            for i in range(self.bits):
                flip = np.where(w[dims] < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
                places.setdefault(i + j, []).append((self.maps[i, dims] ^ flip) & self.valid)
        return _added(places, self.maps.shape[2]), slack


def _added(places: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Bitmaps by binary place -> the bit slices of their sum, by carry-save addition."""
    out, at = [], 0
    while at <= max(places, default=-1):
        maps = np.concatenate(places.pop(at)) if at in places else np.zeros((0, words), np.uint64)
        while len(maps) > 1:
            third = len(maps) // 3
            if third:
                a, b, c = maps[:third], maps[third:2 * third], maps[2 * third:3 * third]
                half = a ^ b
                carry, maps = (a & b) | (half & c), np.concatenate([half ^ c, maps[3 * third:]])
            else:
                carry, maps = (maps[0] & maps[1])[None], (maps[0] ^ maps[1])[None]
            places.setdefault(at + 1, []).append(carry)
        out.append(maps[0] if len(maps) else np.zeros(words, np.uint64))
        at += 1
    return out


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _kth(slices: list[np.ndarray], valid: np.ndarray, k: int) -> int:
    """The k-th largest sum (the smallest of all rows if they are fewer), top slice first."""
    tied, sure, value = valid, 0, 0
    k = min(k, _count(valid))
    for p in range(len(slices) - 1, -1, -1):
        ones = tied & slices[p]
        n = _count(ones)
        if sure + n >= k:
            tied, value = ones, value | 1 << p
        else:
            tied, sure = tied & ~slices[p], sure + n
    return value


def _at_least(slices: list[np.ndarray], valid: np.ndarray, low: int) -> np.ndarray:
    """Bitmap of the rows whose sum is ``low`` or more."""
    if low <= 0:
        return valid
    if low >> len(slices):
        return np.zeros_like(valid)
    above, tied = np.zeros_like(valid), valid
    for p in range(len(slices) - 1, -1, -1):
        if low >> p & 1:
            tied = tied & slices[p]
        else:
            above, tied = above | (tied & slices[p]), tied & ~slices[p]
    return above | tied


def best_rows(index: Slices, q: np.ndarray, order: np.ndarray, w: np.ndarray, k: int, weight_bits: int,
              skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the k largest w.q of a stripe; ties by ``order``.  ``skip``: rows left out."""
    valid = index.valid if skip is None else index.valid & ~_words(skip)
    slices, slack = index.weighted_sum(w, weight_bits)
    near = _at_least(slices, valid, _kth(slices, valid, k) - slack)
    rows = np.flatnonzero(np.unpackbits(near.view(np.uint8), count=index.rows, bitorder="little"))
    scores = products(q[rows], w[None])[:, 0]
    first = np.lexsort((order[rows], -scores))[:k]
    return rows[first], scores[first]


def _index(rows: DataFrame, bits: int) -> DataFrame:
    """rows (dim, stripe, row, place, key, q) -> one row per stripe: its slices, full vectors and keys."""
    def build(part: pd.DataFrame) -> pd.DataFrame:
        q = np.array(part["q"].tolist(), np.int64).reshape(len(part), -1)
        return pd.DataFrame({"dim": [part["dim"].iloc[0]], "stripe": [part["stripe"].iloc[0]], "slices": [Slices(q, bits).packed()],
                             "q": [q.astype(np.int32).tobytes()], "row": [part["row"].to_numpy(np.int64).tobytes()],
                             "place": [part["place"].to_numpy(np.int64).tobytes()]})
    return rows.groupBy("dim", "stripe").applyInPandas(build, "dim int, stripe int, slices binary, q binary, row binary, place binary")


def top_k(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE,
          bits: int = BITS, weight_bits: int = WEIGHT_BITS, stripe: int = STRIPE, group: int = GROUP) -> DataFrame:
    """(query_id, rank, <key>, score): for each row with ``is_query`` (a condition on the key) its
    ``k`` best other rows by inner product, ties by smaller key, then by the row's place.

    Vectors null, empty or with a null or non-finite component take no part; vectors meet those of
    their own length only (components beyond the bound of ``integer_vectors`` are held at it).
    Integer keys; a null key is no query unless the condition says so, and comes last on ties.
    Repeated rows are queries and candidates each; only the query's own row is left out.
    Fewer rows than ``k``: all.  An empty table gives an empty table.  Other columns are not read."""
    spark = vectors.sparkSession
    ints = with_rows(integer_vectors(vectors, key, vector, scale).where(F.size("q") > 0))
    size = ints.groupBy(F.size("q").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("nq"))
    sizes = size.select("dim", F.ceil(F.col("n") / stripe).cast("int").alias("stripes"), F.ceil(F.col("nq") / group).cast("int").alias("groups"))
    # dealt evenly by the hash of the row number; ties by key, null last
    dealt = stored(ints.withColumn("dim", F.size("q")).join(sizes, "dim")
                   .select("dim", "stripes", "groups", F.col(ROW).alias("row"), "q", F.col(key).cast("long").alias("key"),
                           F.coalesce(F.col(key).cast("long"), F.lit(2 ** 63 - 1)).alias("place"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"), F.xxhash64(F.lit(13), ROW).alias("h")), "dealt")
    index = stored(_index(dealt.where("groups > 0").withColumn("stripe", F.pmod("h", F.col("stripes")).cast("int")), bits), "slices")
    asked = dealt.where("asks").withColumn("group", F.pmod("h", F.col("groups")).cast("int"))
    grid = sizes.where("groups > 0")
    left = index.join(grid.select("dim", "groups"), "dim").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    right = (asked.select("dim", "group", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)).alias("stripe"), "row", "q"))

    def cell(stripes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for s in stripes.itertuples():
            rows, place = np.frombuffer(s.row, np.int64), np.frombuffer(s.place, np.int64)
            q = np.frombuffer(s.q, np.int32).reshape(len(rows), -1).astype(np.int64)
            index, order = Slices.read(s.slices), np.lexsort((rows, place)).argsort()
            for row, w in zip(queries["row"], queries["q"]):
                own = rows == row
                found, scores = best_rows(index, q, order, np.asarray(w, np.int64), k, weight_bits, own if own.any() else None)
                out.append(pd.DataFrame({"asker": row, "row": rows[found], "place": place[found], "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"asker": [], "row": [], "place": [], "score": []}).astype("int64")

    cells = ["dim", "stripe", "group"]
    found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInPandas(cell, "asker long, row long, place long, score long")
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "place", "row")
    best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    named = dealt.select(F.col("row").alias("asker"), F.col("key").alias("query_id"))
    kind = vectors.schema[key].dataType
    return (best.join(named, "asker").join(dealt.select("row", "key"), "row")
            .select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("key").cast(kind).alias(key), "score"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of each row whose vec_id is divisible by EVERY; cases as in :func:`top_k`."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
