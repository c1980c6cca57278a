"""Vectors as integers: what centroid clustering and exact top-k search share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024
#: Components are held within this bound, so that squared distances and inner products of
#: up to 64 components, and sums over 2**36 vectors, fit in a long.
BOUND = 2 ** 27


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int = SCALE, dim: int | None = None) -> DataFrame:
    """(key, q): each component x as the integer floor(scale * x), x as double.

    Left out: null vectors, vectors with a null or non-finite component and, when ``dim``
    is given, those of another length.  Components beyond BOUND after scaling are held at
    it.  Null keys and repeated rows stay; other columns are not read."""
    x = F.col(vector).cast("array<double>")
    whole = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    held = F.transform(x, lambda c: F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), F.floor(c * float(scale)).cast("double"))).cast("int"))
    fits = whole if dim is None else whole & (F.size(x) == dim)
    return vectors.where(F.col(vector).isNotNull() & fits).select(F.col(key).alias(key), held.alias("q"))


def matrix(column, dim: int) -> np.ndarray:
    """Arrow list column -> (rows, dim) int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; in doubles (fast) when every partial sum is below 2**53."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T
