"""Best-fit packing of tokenised documents, improved by swaps.

Documents are tokenised where they lie; only (id, piece, length, checksum) rows
move.  Pieces are dealt by a hash to shards of bounded size.  A shard is packed
best-fit, longest piece first, and then improved by local search: a piece moves
to, or is exchanged one-for-one, one-for-two or two-for-one with, an underfull
bin whenever the sum of squared fills grows, which empties the emptiest bins.
Bins that stay poorly filled go, piece by piece, to a next round, dealt anew to
shards of the same bounded size, until one shard is left or a round closes too small
a share of its pieces: what then is open stays in the bins it has.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import full_text, parts_for, stored, table

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k"
PER_SHARD = 10_000
POOR_FILL = 0.97      # bins below this share of the capacity go to the next round
LEAST_CLOSED = 0.25   # share of its pieces that a round must close for another one to follow

#: Texts of these characters take the rank-file encoder, which has the same
#: vocabulary and gives the same ids several times faster (a test compares the two
#: over the whole range); all others take the JSON tokenizer itself.
PLAIN = re.compile("[\u0000-ɏ]*")
RUN = re.compile(r"\s\s")


class Encoder:
    """Text -> token ids of a public byte-level BPE tokenizer, as its plain
    ``encode(text, add_special_tokens=False)`` gives them: the string of a special
    token is that token."""

    def __init__(self, name: str = TOKENIZER):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self.fast = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # without two white-space characters in a row the look-ahead never decides
        self.faster = tiktoken.Encoding(f"{name}-runless", pat_str=pattern.replace(r"\s+(?!\S)|", ""),
                                        mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if not PLAIN.fullmatch(text) or self.special.search(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return (self.fast if RUN.search(text) else self.faster).encode_ordinary(text)


PIECES = "piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Rows -> pieces (key, piece, start, length, ids_crc32[, ids]).

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut into
    pieces of that length, the first of which takes the remainder.  ``ids``:
    little-endian unsigned 32-bit ids of the piece."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for doc, content in zip(batch["key"].tolist(), batch["text"]):
                ids = np.array(encode(content) + [end_id], "<u4")
                first = len(ids) % capacity or capacity
                at = 0
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    raw = ids[at:end].tobytes()
                    out.append((doc, piece, at, end - at, zlib.crc32(raw)) + ((raw,) if with_ids else ()))
                    at = end
            yield pd.DataFrame(out, columns=["key", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    # keys travel as text: pandas has no integer column with nulls
    rows = docs.select(F.col(key).cast("string").alias("key"), full_text(text).alias("text"))
    pieces = rows.mapInPandas(cut, f"key string, {PIECES}" + ", ids binary" * with_ids)
    return pieces.withColumn("key", F.col("key").cast(dict(docs.dtypes)[key])).withColumnRenamed("key", key)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit, longest first: bins as lists of item positions."""
    bins: list[list[int]] = []
    room: list[int] = []                  # distinct free spaces, ascending
    by_room: dict[int, list[int]] = {}
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        k = bisect_left(room, size)
        if k < len(room):
            space = room[k]
            target = by_room[space].pop()
            if not by_room[space]:
                del by_room[space]
                room.pop(k)
            bins[target].append(item)
            space -= size
        else:
            target, space = len(bins), capacity - size
            bins.append([item])
        if space:
            if space not in by_room:
                by_room[space] = []
                insort(room, space)
            by_room[space].append(target)
    return bins


class SwapSearch:
    """Local search over the underfull bins of one shard."""

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins = bins
        self.fill = np.array([sum(sizes[i] for i in b) for b in bins], np.int64)

    def run(self) -> list[list[int]]:
        least = -(-int(self.fill.sum()) // self.capacity)
        while True:
            improved = False
            for source in np.argsort(self.fill, kind="stable"):
                if np.count_nonzero(self.fill) <= least:
                    improved = False
                    break
                if 0 < self.fill[source] < self.capacity:
                    improved |= self.empty(int(source))
            if not improved:
                return [b for b in self.bins if b]

    def empty(self, source: int) -> bool:
        """Apply improving steps to ``source`` while there are any; True if it got emptied."""
        while self.bins[source] and self.step(source):
            pass
        return not self.bins[source]

    def step(self, source: int) -> bool:
        """One move or exchange that raises squared fill, best gain of the target first."""
        others = np.flatnonzero((self.fill < self.capacity) & (self.fill >= self.fill[source]))
        others = others[others != source]
        if not len(others):
            return False
        slack = self.capacity - self.fill[others]
        own = sorted(self.bins[source], key=lambda i: -self.sizes[i])
        give: list[tuple[int, ...]] = [(i,) for i in own] + self.pairs(source)
        weights = np.array([sum(self.sizes[i] for i in g) for g in give], np.int64)
        # moves: the give that leaves the least room in some bin
        by_slack = np.argsort(slack, kind="stable")
        for g in range(len(own)):
            k = int(np.searchsorted(slack[by_slack], weights[g]))
            if k < len(by_slack):
                return self.exchange(source, give[g], int(others[by_slack[k]]), ())
        roomy = [int(t) for t in others[np.argsort(-slack, kind="stable")]]
        best: tuple[int, tuple, int, tuple] | None = None
        for target in roomy:
            room = self.capacity - int(self.fill[target])
            if best and best[0] >= room:
                break
            held = self.bins[target]
            takes = [(i,) for i in held] + self.pairs(target)
            taken = np.array([sum(self.sizes[i] for i in t) for t in takes], np.int64)
            gain = weights[:, None] - taken[None, :]
            gain[(gain <= 0) | (gain > room)] = 0
            for g in range(len(own), len(give)):  # never two for two
                gain[g, len(held):] = 0
            g, t = divmod(int(np.argmax(gain)), gain.shape[1])
            if gain[g, t] > (best[0] if best else 0):
                best = (int(gain[g, t]), give[g], target, takes[t])
        return bool(best) and self.exchange(source, best[1], best[2], best[3])

    def pairs(self, number: int) -> list[tuple[int, int]]:
        """A pair of the bin's pieces for every pair of their lengths.  Pieces of one length do
        alike, and a bin of 1024 tokens holds at most 44 different lengths, so all
        exchanges are covered by under a thousand pairs."""
        first: dict[int, list[int]] = {}
        for i in self.bins[number]:
            first.setdefault(self.sizes[i], []).append(i)
        lengths = sorted(first)
        return ([(first[a][0], first[b][0]) for a, b in combinations(lengths, 2)]
                + [(first[a][0], first[a][1]) for a in lengths if len(first[a]) > 1])

    def exchange(self, source: int, give: tuple, target: int, take: tuple) -> bool:
        moved = sum(self.sizes[i] for i in give) - sum(self.sizes[i] for i in take)
        self.bins[source] = [i for i in self.bins[source] if i not in give] + list(take)
        self.bins[target] = [i for i in self.bins[target] if i not in take] + list(give)
        self.fill[source] -= moved
        self.fill[target] += moved
        return True


def packed_bins(sizes: list[int], capacity: int) -> list[list[int]]:
    return SwapSearch(sizes, best_fit(sizes, capacity), capacity).run()


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, per_shard: int = PER_SHARD) -> DataFrame:
    """Pieces (key, piece, start, length, ids_crc32, ..) -> the same rows with
    ``sequence_id`` and ``offset`` (place in the sequence, gapless from 0).

    Piece lengths must be 1 to ``capacity``.  Repeated rows are packed each.
    Deterministic: shards follow a hash of the round, the piece and, for equal rows,
    their copy number; rows are ordered within a shard.  A shard holds about
    ``per_shard`` pieces in every round.  An empty table gives an empty table."""
    kind = ", ".join(f"`{f.name}` {'string' if f.name == key else f.dataType.simpleString()}" for f in pieces.schema.fields)
    key_type = dict(pieces.dtypes)[key]
    # equal rows get copy numbers, else all of them would be dealt to one shard
    numbered = pieces.groupBy(*pieces.columns).agg(F.count(F.lit(1)).alias("__copies"))
    items = stored(numbered.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).drop("__copies")
                   .withColumn(key, F.col(key).cast("string")), "pieces")
    open_rows = items.where(F.col("length") < capacity)
    n = open_rows.count()
    done = []
    level = 0

    def place(round_no: int, last: bool):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            shard = int(rows["__shard"].iloc[0])
            order = [c for c in ("length", key, "piece", "start", "ids_crc32") if c in rows]
            rows = rows.sort_values(order, ascending=[False] + [True] * (len(order) - 1), kind="stable").reset_index(drop=True)
            sizes = rows["length"].astype(int).tolist()
            where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            closed = np.zeros(len(sizes), bool)
            for number, members in enumerate(packed_bins(sizes, capacity)):
                at = 0
                for i in members:
                    where[i], offset[i] = number, at
                    at += sizes[i]
                closed[members] = last or at >= POOR_FILL * capacity
            rows["sequence_id"] = (round_no << 52) + (shard << 26) + where
            rows["offset"], rows["__closed"] = offset, closed
            return rows.drop(columns="__shard")
        return run

    while n:
        shards = parts_for(n, per_shard)
        last = shards == 1
        dealt = open_rows.withColumn("__shard", F.pmod(F.xxhash64(F.lit(level), key, "piece", "start", "length", "ids_crc32", "__copy"),
                                                       F.lit(shards)).cast("int"))
        packed = stored(dealt.groupBy("__shard").applyInPandas(
            place(level, last), f"{kind}, __copy long, sequence_id long, offset long, __closed boolean"), "packed")
        left = 0 if last else packed.where("NOT __closed").count()
        if left > (1 - LEAST_CLOSED) * n:
            left = 0
            done.append(packed)
        else:
            done.append(packed.where("__closed"))
        open_rows = packed.where("NOT __closed").select(*pieces.columns, "__copy")
        n = left
        level += 1
    # full pieces are sequences of their own, numbered within the partitions they lie in
    full = (items.where(F.col("length") >= capacity)
            .withColumn("sequence_id", F.lit(1 << 62) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")))
    result = full
    for part in done:
        result = result.unionByName(part.drop("__closed"))
    return result.drop("__copy").withColumn(key, F.col(key).cast(key_type))


def best_fit_packing(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     end_id: int = END_ID, tokenizer: str = TOKENIZER, with_ids: bool = True) -> DataFrame:
    """Documents -> packed training sequences: (key, piece, start, length,
    ids_crc32, ids, sequence_id, offset), one row per piece.

    Null text counts as empty (its end id alone); a null key is kept as null;
    repeated rows are packed each; other columns are not read."""
    return pack(tokenized_pieces(docs, key, text, capacity, end_id, tokenizer, with_ids), key, capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), with_ids=False)
