"""Exact de-duplication against a minimal perfect hash of historical digests.

History is reduced to one row per distinct SHA-256 digest (winner id, copies).
Digests are dealt into buckets by their first bytes; each bucket becomes a
minimal perfect hash: a displacement per group of digests sends its n digests to
the n slots without a gap or clash.  A slot holds the full 32-byte digest and
the locator of its winner.  An arriving digest is looked up by two hashes of
itself, then compared byte by byte with its slot: equal bytes make it a repeat
of history, all others are grouped among themselves.

Both sides are aggregated by digest before anything is dealt to buckets, so a
text that is a third of all rows is a single row there.  Texts are read once and
never shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import full_text, parts_for, stored, table

DIGEST = 32
PER_BUCKET = 20_000  # digests a bucket holds on average; a bucket is one task's unit
PER_GROUP = 4


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(digests).view("<u8")
    return words[:, 1], words[:, 2]


def _slot(second: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    seeded = _mix(second + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeded % np.uint64(n)).astype(np.int64)


def build_mph(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements per group and the slot of each of the n distinct digests.

    Groups of two or more search the first displacement that sends them to free,
    distinct slots, largest group first; single digests take the slots left over
    and store them directly as ``-slot - 1``."""
    n = len(digests)
    first, second = _halves(digests)
    groups = max(1, -(-n // PER_GROUP))
    group = (_mix(first) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    ends = np.cumsum(sizes)
    displacement = np.zeros(groups, np.int64)
    slots = np.full(n, -1, np.int64)
    used = np.zeros(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        size = sizes[g]
        if size < 2:
            break
        members = order[ends[g] - size:ends[g]]
        base = 0
        while True:
            tries = np.arange(base, base + 64)
            spots = _slot(second[members][None, :], tries[:, None], n)
            fits = ~used[spots].any(axis=1)
            fits &= (np.diff(np.sort(spots, axis=1), axis=1) > 0).all(axis=1)
            if fits.any():
                k = int(np.argmax(fits))
                displacement[g], slots[members] = base + k, spots[k]
                used[spots[k]] = True
                break
            base += 64
    free = np.flatnonzero(~used)
    for spot, member in zip(free, (order[ends[g] - 1] for g in np.flatnonzero(sizes == 1))):
        displacement[group[member]], slots[member] = -spot - 1, spot
    return displacement, slots


def lookup_mph(digests: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Candidate slot of each digest; only a comparison with the slot tells membership."""
    first, second = _halves(digests)
    moved = displacement[(_mix(first) % np.uint64(len(displacement))).astype(np.int64)]
    return np.where(moved < 0, -moved - 1, _slot(second, np.maximum(moved, 0), n))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in column), np.uint8).reshape(-1, DIGEST)


INDEX_SCHEMA = "bucket int, n long, displacement binary, digests binary, winners binary, sizes binary"
NO_ID = np.iinfo(np.int64).min  # a group whose rows all have a null id


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """Distinct (digest, winner, size) -> one minimal perfect hash row per bucket."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        digests = _matrix(rows["digest"])
        displacement, slots = build_mph(digests)
        place = np.argsort(slots)
        return pd.DataFrame({
            "bucket": [rows["bucket"].iloc[0]], "n": [len(rows)], "displacement": [displacement.tobytes()],
            "digests": [digests[place].tobytes()],
            "winners": [rows["winner"].to_numpy(np.int64)[place].tobytes()],
            "sizes": [rows["size"].to_numpy(np.int64)[place].tobytes()]})

    return _bucketed(history, buckets).groupBy("bucket").applyInPandas(build, INDEX_SCHEMA)


def merge_arrivals(index: DataFrame, arrivals: DataFrame, buckets: int) -> DataFrame:
    """Look distinct arriving digests up; (digest, winner, size, repeat) of every
    digest of history (with its repeats added) and of every nonmember."""

    def look(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(new):
            digests = _matrix(new["digest"])
            winner, size = new["winner"].to_numpy(np.int64).copy(), new["size"].to_numpy(np.int64).copy()
            member = np.zeros(len(new), bool)
        if len(old):
            entry = old.iloc[0]
            n = int(entry["n"])
            held = np.frombuffer(entry["digests"], np.uint8).reshape(n, DIGEST)
            winners, sizes = np.frombuffer(entry["winners"], np.int64).copy(), np.frombuffer(entry["sizes"], np.int64).copy()
            repeated = np.zeros(n, bool)
            if len(new):
                slot = lookup_mph(digests, np.frombuffer(entry["displacement"], np.int64), n)
                member = (held[slot] == digests).all(axis=1)
                hit = slot[member]
                winners[hit] = np.maximum(winners[hit], winner[member])
                sizes[hit] += size[member]
                repeated[hit] = True
            parts.append(pd.DataFrame({"digest": [x.tobytes() for x in held], "winner": winners,
                                       "size": sizes, "repeat": repeated}))
        if len(new):
            rest = ~member
            parts.append(pd.DataFrame({"digest": [x.tobytes() for x in digests[rest]], "winner": winner[rest],
                                       "size": size[rest], "repeat": False}))
        return pd.concat(parts, ignore_index=True)

    return (index.groupBy("bucket").cogroup(_bucketed(arrivals, buckets).groupBy("bucket"))
            .applyInPandas(look, "digest binary, winner long, size long, repeat boolean"))


def _groups(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(F.coalesce(F.max("id"), F.lit(int(NO_ID))).alias("winner"),
                                         F.count(F.lit(1)).alias("size"))


def exact_dedup(history: DataFrame, arrivals: DataFrame, key: str = "doc_id", text: str = "text",
                per_bucket: int = PER_BUCKET) -> DataFrame:
    """One row per row of both tables: (key, keep_id, group_size, kept, text_sha256, repeat).

    Rows are equal when their texts are byte for byte equal; a null text counts
    as empty.  The largest ``key`` of a group stays.  Null keys lose to any
    other; a group of null keys only keeps them (keep_id null).  Rows that repeat
    a key and a text are all counted and share one verdict.  ``repeat``: history
    holds the text and an arrival has it again.  Either table may be empty; other
    columns are not read."""
    def digested(df: DataFrame, old: bool) -> DataFrame:
        return df.select(F.col(key).cast("long").alias("id"), F.unhex(F.sha2(full_text(text).cast("binary"), 256)).alias("digest"),
                         F.lit(old).alias("old"))

    rows = stored(digested(history, True).unionAll(digested(arrivals, False)), "digests")
    old = stored(_groups(rows.where("old")), "history")
    new = stored(_groups(rows.where("NOT old")), "arrivals")
    # both sides of a bucket are held together, so the larger one sets their number
    buckets = parts_for(max(old.count(), new.count()), per_bucket)
    index = stored(build_index(old, buckets), "mph")
    merged = merge_arrivals(index, new, buckets)
    won = F.when(F.col("winner") != int(NO_ID), F.col("winner"))
    return rows.join(merged, "digest").select(
        F.col("id").alias(key), won.alias("keep_id"), F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(won).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "repeat")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the lower half of the id range is the history, the upper half arrives."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    span = docs.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    middle = ((span["a"] or 0) + (span["b"] or 0)) // 2
    early = F.coalesce(F.col("doc_id") <= middle, F.lit(True))
    return exact_dedup(docs.where(early), docs.where(~early)).drop("repeat")


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
