"""N-gram Jaccard join by chosen paths.

Documents become sets of five-word shingles, and each set a row of sampled
tokens: token *i* is the shingle that wins the *i*-th min-hash race, so two sets
share it with probability equal to their Jaccard similarity (Christiani, Pagh and
Sivertsen, 2018).  A run starts from one sampled position and splits all sets by
their token there; a part that is still large is split again by a position drawn
from the path so far.  Parts that are small, or DEPTH splits deep, are compared by
brute force.  A pair at the threshold stays together for the whole path with
probability threshold ** DEPTH at least, so the number of independent runs follows
from the target recall.

Where the bytes go: equal texts are one node; the split works on 8-byte path keys;
sampled tokens only travel for nodes that share a path with another, and whole
shingle sets only for those whose tokens then agree on ESTIMATE or more.  Similarity
is exact.  Links are counted in the tasks, pairs are never listed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bucket_links import Unit, blocked, by_unit, gather, linked_rows, met_before, pair_mask, per_class
from .common import full_text, stored, table

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
DEPTH = 3            # splits of a path at most
SMALL = 32           # a part of this size is compared without a further split
TOKENS = 64          # sampled tokens per set
ESTIMATE = 0.6       # share of agreeing tokens from which a pair is compared exactly; 64 independent
                     # draws at 0.8 fall below it once in 30,000
SEED = 97

_SEPARATORS = bytes(32 if x < 128 and not (48 <= x <= 57 or 97 <= x <= 122) else x for x in range(256))


def runs_for(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** depth)))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all non-ASCII characters."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def digest_of(words: list[bytes]) -> bytes | None:
    return hashlib.md5(b" ".join(words)).digest() if words else None


class _WordHash(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(words: list[bytes], cache: dict, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes.  Fewer than n words are one shingle; none, an empty set."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return np.unique(total)


class Sampler:
    """Sampled tokens and path keys of a set."""

    def __init__(self, runs: int, tokens: int = TOKENS, depth: int = DEPTH):
        rng = np.random.default_rng(SEED)
        self.factors = rng.integers(0, 2 ** 63, tokens, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.roots = rng.integers(1, 2 ** 62, runs, dtype=np.int64).astype(np.uint64)
        self.depth, self.tokens = depth, tokens

    def sample(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest product of a shingle and each odd factor, modulo 2 ** 64: a uniform
        choice, the same for two sets exactly when the union's choice lies in both.
        Multiplication carries every bit upwards, so the choices of different factors
        hardly depend on each other, also in small sets."""
        best = np.full(self.tokens, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            best = np.minimum(best, (shingles[None, at:at + 4096] * self.factors[:, None]).min(axis=1))
        return best

    def paths(self, tokens: np.ndarray) -> np.ndarray:
        """(sets, tokens) -> (sets, runs, depth) path keys; the position of a split is
        drawn from the path before it.  Keys are never 0."""
        key = np.broadcast_to(self.roots, (len(tokens), len(self.roots)))
        out = np.empty((len(tokens), len(self.roots), self.depth), np.int64)
        for level in range(self.depth):
            position = (_mixed(key) % np.uint64(self.tokens)).astype(np.int64)
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.take_along_axis(tokens, position, axis=1)) | np.uint64(1)
            out[:, :, level] = key.view(np.int64)
        return out


def sampled(docs: DataFrame, key: str, text: str, runs: int) -> DataFrame:
    """Rows -> (id, digest, tokens, paths); digest (of the word sequence), tokens and
    paths are null for a text without words."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, cache = Sampler(runs), _WordHash()
        for batch in batches:
            digests = []
            tokens = np.empty((len(batch), TOKENS), np.uint64)
            for i, content in enumerate(batch["text"]):
                words = words_of(content)
                digests.append(digest_of(words))
                tokens[i] = sampler.sample(shingle_set(words, cache))
            low, paths = tokens.astype("<u4"), sampler.paths(tokens)
            yield pd.DataFrame({
                "id": batch["id"], "digest": digests,
                "tokens": [t.tobytes() if d else None for d, t in zip(digests, low)],
                "paths": [p.ravel().tolist() if d else None for d, p in zip(digests, paths)]})

    slim = docs.select(F.col(key).cast("string").alias("id"), full_text(text).alias("text"))
    return (slim.mapInPandas(run, "id string, digest binary, tokens binary, paths array<long>")
            .withColumn("id", F.col("id").cast("long")))


def _leaves(nodes: DataFrame, runs: int, depth: int, small: int) -> DataFrame:
    """(node, run, bucket, n): the part of each run in which a node ends with others."""
    steps = [f"paths[r * {depth} + {level}]" for level in range(depth)]
    live = nodes.selectExpr("node", f"explode(sequence(0, {runs - 1})) AS r", "paths").selectExpr(
        "node", "r AS run", *[f"{s} AS p{level}" for level, s in enumerate(steps)])
    found = None
    for level in range(depth):
        sizes = live.groupBy(f"p{level}").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        live = stored(live.join(sizes, f"p{level}"), "paths")
        last = level == depth - 1
        done = live.where(F.lit(True) if last else F.col("n") <= small).select(
            "node", "run", F.col(f"p{level}").alias("bucket"), "n")
        found = done if found is None else found.unionAll(done)
        live = live.where(F.col("n") > small).drop("n")
    return found


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL, small: int = SMALL, block: int = 256) -> DataFrame:
    """One row per row of ``docs``: (key, class_id, n_links, kept).

    Linked: Jaccard similarity of the sets of five-word shingles >= threshold;
    rows whose lower-cased word sequences are equal always link.  ``n_links``
    counts the other rows linked directly, ``class_id`` is the smallest key
    reachable by links, ``kept`` marks it.  A text of one to four words is one
    shingle; null, empty and wordless texts link with nothing and are their own
    class.  A null key never names a class unless all of it is null.  Rows
    repeating a key are separate rows and share its verdict.  Other columns are
    not read; an empty table gives an empty table."""
    runs = runs_for(threshold, recall)
    rows = stored(sampled(docs, key, text, runs), "sets")
    classes = stored(rows.where("digest IS NOT NULL").groupBy("digest")
                     .agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.first("tokens").alias("tokens"),
                          F.first("paths").alias("paths"))
                     .withColumn("node", F.monotonically_increasing_id()), "nodes")
    leaves = stored(_leaves(classes, runs, DEPTH, small), "leaves")
    lists = leaves.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("run", "bucket"))).alias("m")).select(
        "node", F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.coalesce(F.try_element_at("m", r), F.lit(0))).alias("buckets"))
    carried = stored(lists.join(classes.select("node", "size", "tokens"), "node"), "carried")

    def candidates(unit: Unit) -> np.ndarray:
        mask = pair_mask(unit)
        tokens = np.frombuffer(b"".join(unit["tokens"]), "<u4").reshape(len(mask), -1)
        agree = np.stack([(tokens == t).sum(axis=1) for t in tokens])
        mask &= agree >= ESTIMATE * tokens.shape[1]
        if mask.any():
            mask &= ~met_before(np.stack(unit["buckets"]).astype(np.int64), int(unit["run"][0]))
        return mask

    def hopeful(unit: Unit) -> pd.DataFrame | None:
        mask = candidates(unit)
        some = (mask | mask.T).any(axis=1)
        return pd.DataFrame({c: unit[c][some] for c in ("node", "run", "bucket", "left", "right", "in_left")}) if some.any() else None

    units = blocked(leaves.join(carried, "node"), "bucket", F.col("n"), block)
    hopes = stored(by_unit(units, hopeful, "node long, run int, bucket long, left int, right int, in_left boolean"), "hopes")

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _WordHash()
        for batch in batches:
            nodes, shingles = [], []
            for node, digest, content in zip(batch["node"], batch["digest"], batch["text"]):
                words = words_of(content)
                if digest_of(words) == bytes(digest):  # rows may repeat a key
                    nodes.append(node)
                    shingles.append(shingle_set(words, cache).tobytes())
            yield pd.DataFrame({"node": nodes, "shingles": shingles})

    # the row with a class's smallest key stands for the class
    wanted = hopes.select("node").distinct().join(classes.select("node", "digest", "low"), "node")
    texts = (docs.select(F.col(key).cast("long").alias("id"), full_text(text).alias("text"))
             .join(wanted, F.col("id").eqNullSafe(F.col("low"))))
    sets = stored(texts.select("node", "digest", "text").mapInPandas(shingled, "node long, shingles binary")
                  .dropDuplicates(["node"]), "shingles")

    def exact(unit: Unit) -> pd.DataFrame | None:
        mask = candidates(unit)
        linked = mask & similar([np.frombuffer(x, np.uint64) for x in unit["shingles"]], threshold)
        return linked_rows(unit["node"], unit["size"], linked)

    links, parts = gather(hopes.join(carried, "node").join(sets, "node"), exact, "links")
    result = per_class(classes.drop("tokens", "paths"), links, parts)
    joined = rows.select("id", "digest").join(result.select("digest", "links", "component_low"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_low"))
    return joined.select(F.col("id").alias(key), component.alias("class_id"),
                         F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.col("id").eqNullSafe(component).alias("kept"))


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Exact Jaccard >= threshold for every pair of sorted distinct sets.  Intersections
    are products of 0/1 matrices over the elements that two or more sets hold."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    both = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(64, 2_000_000 // max(1, len(sets)))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, [at, at + width])
        held = np.zeros((len(sets), min(width, int(column[-1]) + 1 - at)), np.float32)
        held[owner[low:high], column[low:high] - at] = 1
        both += held @ held.T
    union = sizes[:, None] + sizes[None, :] - both
    return both >= threshold * union


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
