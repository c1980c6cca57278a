"""Target-distribution importance resampling with hashed n-gram features.

Features are the runs of 1 to N words of a text.  Words are cut in blocks of about
BLOCK bytes; within a block each distinct feature is hashed once: the distinct
features are grouped by byte length, each group is a two-dimensional uint8 array, and
one pass over its columns updates the CRCs of all its rows at once; the buckets are then
scattered back to the places where the features stand.  Features longer than LONG bytes are
rows of several equal pieces, whose CRCs are joined by the linear shift of a CRC over
zero bytes.  One long text is cut like many short ones; the runs of words that cross a cut
are carried over it.

The bucket lists are written once (two bytes a feature up to 65536 buckets).  Counts are
summed per task and bucket before the shuffle; at most ``buckets`` gains come to the driver
and go out again with the weighing pass.  The draw is a range-partitioned sort with offsets
per partition: no window holds all documents, and equal rows are told apart by a number
of their own.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, full_text, stored, table

BUCKETS, NGRAM = 10_000, 2
MIN_WORDS, SHARE, SEED = 20, 25, "7"
BLOCK, LONG = 1 << 20, 512

#: bytes to words: A-Z lower-cased; digits, a-z and all bytes of non-ASCII characters kept; others blank
WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)  # reflected polynomial of CRC-32
    return t


TABLE = _crc_table()


def _columns(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of ``rows`` (m x length), column by column."""
    for column in rows.T:
        state = TABLE[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


#: register bit -> register after LONG zero bytes
SHIFT = _columns(np.uint32(1) << np.arange(32, dtype=np.uint32), np.zeros((32, LONG), np.uint8))


def _shifted(state: np.ndarray) -> np.ndarray:
    bits = (state[:, None] >> np.arange(32, dtype=np.uint32)) & 1
    return np.bitwise_xor.reduce(np.where(bits == 1, SHIFT[None], np.uint32(0)), axis=1)


def crc32_all(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each byte string, by matrices of equal length."""
    out = np.empty(len(features), np.uint32)
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    ends = np.flatnonzero(np.diff(sizes[order], append=-1)) + 1
    for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
        places = order[a:b]
        size = int(sizes[places[0]])
        rows = np.frombuffer(b"".join([features[i] for i in places]), np.uint8).reshape(len(places), size)
        head = size % LONG
        state = _columns(np.full(len(places), 0xFFFFFFFF, np.uint32), rows[:, :head])
        if size >= LONG:
            pieces = rows[:, head:].reshape(-1, LONG)
            raw = _columns(np.zeros(len(pieces), np.uint32), pieces).reshape(len(places), -1)
            for piece in raw.T:
                state = _shifted(state) ^ piece
        out[places] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _cut(text: bytes) -> list[bytes]:
    """Pieces of about BLOCK bytes that end between words (one word is never cut)."""
    out, at = [], 0
    while len(text) - at > BLOCK:
        end = text.find(b" ", at + BLOCK)
        if end < 0:
            break
        out.append(text[at:end])
        at = end
    return [*out, text[at:]] if out else [text]


def _hashed(words: list[bytes], joined: np.ndarray, fresh: int, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to n words that end at or after place ``fresh``, with the place of
    their last word.  joined[i]: word i follows word i - 1 of the same text."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    distinct, runs, ok = list(known), ids, np.ones(len(words), bool)
    names, places, found = [], [], []
    base = list(known)
    for size in range(1, n + 1):
        if size > 1:
            # the run of ``size`` words that ends here: the shorter run one place before, and this word
            ok = np.concatenate([[False], ok[:-1]]) & joined
            at = np.flatnonzero(ok)
            pairs, runs_at = np.unique(runs[at - 1] * len(base) + ids[at], return_inverse=True)
            distinct = [distinct[p] + b" " + base[w] for p, w in zip((pairs // len(base)).tolist(), (pairs % len(base)).tolist())]
            runs = np.zeros(len(words), np.int64)
            runs[at] = runs_at
        at = np.flatnonzero(ok)
        at = at[at >= fresh]
        names.append(distinct)
        places.append(at)
        found.append(runs[at])
    crc = crc32_all(list(chain(*names))) % np.uint32(buckets)
    offsets = np.cumsum([0] + [len(x) for x in names[:-1]])
    return np.concatenate([crc[f + o] for f, o in zip(found, offsets)]), np.concatenate(places)


def hashed_texts(texts: list[bytes | None], n: int, buckets: int) -> list[tuple[int, list[np.ndarray]]]:
    """(words, bucket arrays) of each text: its word count and the buckets of its features."""
    out: list[tuple[int, list[np.ndarray]]] = [(0, []) for _ in texts]
    words: list[bytes] = []
    owner: list[tuple[int, int]] = []   # (text, words) in order
    carried = 0                         # words at the start that only complete later runs
    held = 0

    def flush() -> None:
        nonlocal words, owner, carried, held
        if len(words) > carried:
            ids = np.repeat([t for t, _ in owner], [c for _, c in owner])
            joined = np.concatenate([[False], ids[1:] == ids[:-1]])
            crc, place = _hashed(words, joined, carried, n, buckets)
            by = ids[place]
            order = np.argsort(by, kind="stable")
            crc, by = crc[order], by[order]
            starts = np.flatnonzero(np.diff(by, prepend=-1))
            for a, b in zip(starts, np.append(starts[1:], len(by))):
                out[by[a]][1].append(crc[a:b])
        if owner:
            last = owner[-1][0]
            keep = min(n - 1, sum(c for t, c in owner if t == last))
            words, owner, carried = words[len(words) - keep:] if keep else [], [(last, keep)], keep
        held = 0

    for number, text in enumerate(texts):
        for piece in _cut((text or b"").translate(WORDS)):
            new = piece.split()
            words += new
            owner.append((number, len(new)))
            out[number] = (out[number][0] + len(new), out[number][1])
            held += len(piece)
            if held >= BLOCK:
                flush()
    flush()
    return out


def bucket_lists(rows: DataFrame, keep: list[str], text: str, n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(keep.., n_words, n_features, buckets): little-endian bucket numbers of all features of each text."""
    kind = np.dtype("<u2") if buckets <= 65536 else np.dtype("<u4")
    cols = rows.select(*keep, full_text(text).cast("binary").alias("__text"))
    schema = cols.drop("__text").schema.add("n_words", "long").add("n_features", "long").add("buckets", "binary")

    def hash_texts(batches):
        for batch in batches:
            got = hashed_texts(batch.column(len(keep)).to_pylist(), n, buckets)
            packed = [b"".join(a.astype(kind).tobytes() for a in arrays) for _, arrays in got]
            counts = [w for w, _ in got]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(counts, pa.int64()),
                                              pa.array([len(p) // kind.itemsize for p in packed], pa.int64()),
                                              pa.array(packed, pa.binary())], schema.names)
    return cols.mapInArrow(hash_texts, schema)


def bucket_counts(lists: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket, summed in each task first; ``buckets`` numbers come back."""
    kind = np.dtype("<u2") if buckets <= 65536 else np.dtype("<u4")

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    out = np.zeros(buckets, np.int64)
    for r in lists.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the target's over the source's smoothed share), per bucket."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weighed(lists: DataFrame, keep: list[str], gains: np.ndarray) -> DataFrame:
    """``keep`` and weight: the floored mean of the gains over a text's features (none: 0)."""
    kind = np.dtype("<u2") if len(gains) <= 65536 else np.dtype("<u4")
    cols = lists.select(*keep, "buckets")

    def weigh(batches):
        for batch in batches:
            found = [gains[np.frombuffer(b, kind)] for b in batch.column(len(keep)).to_pylist()]
            weight = [int(g.sum()) // len(g) if len(g) else 0 for g in found]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(weight, pa.int64())], [*keep, "weight"])
    return cols.mapInArrow(weigh, cols.drop("buckets").schema.add("weight", "long"))


def ranked(rows: DataFrame, order: list, name: str, limit: int) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3.. by ``order`` up to ``limit``, else null.  The sort is ranged over
    partitions; each row's number is its place in its partition plus the rows of those before."""
    part = "__part"
    laid = stored(rows.orderBy(*order).withColumn(part, F.spark_partition_id()), "ranked")
    counts = laid.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    place = F.col("__before") + F.col("__within")
    return (laid.withColumn("__within", within).join(F.broadcast(counts.select(part, before.alias("__before"))), part)
            .withColumn(name, F.when(place <= limit, place).cast("long")).drop(part, "__within", "__before"))


def importance_resampling(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
                          n: int = NGRAM, buckets: int = BUCKETS, min_words: int = MIN_WORDS, share: int = SHARE,
                          seed: str = SEED) -> DataFrame:
    """(key, n_features, weight, score, rank) for every row of ``docs``.

    Weight: the floored mean over the row's features of floor(1000 ln(target share / source
    share)) of their buckets, shares smoothed by one.  Score: weight plus a Gumbel draw from the
    hash of seed:key, so the ``share`` percent of the rows of ``min_words`` or more words
    with the highest scores, ties to the smaller key, are a draw without replacement in
    proportion to exp(weight / 1000); rank numbers them, others have none.

    Null and empty texts have no features and weight 0, and are never drawn if ``min_words`` is
    1 or more.  A null key draws as the text 'null' and comes last on ties.  Repeated rows are rows of
    their own with equal scores (ties among them by their place).  An empty target or
    an empty table of documents gives smoothed shares or no rows.  Other columns are not read."""
    # the rows get their numbers as the lists are written: texts are read once and never written
    numbered = docs.select(F.col(key).alias(key), F.col(text).alias("__t"), F.monotonically_increasing_id().alias(ROW))
    lists = stored(bucket_lists(numbered, [key, ROW], "__t", n, buckets), "buckets")
    wanted = stored(bucket_lists(target.select(F.col(target_text).alias("__t")), [], "__t", n, buckets), "target")
    gains = bucket_gains(bucket_counts(lists, buckets), bucket_counts(wanted, buckets))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(name, 1, 8), 16, 10).cast("double")
    rows = _weighed(lists, [key, ROW, "n_words", "n_features"], gains).withColumn(
        "score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long"))
    rows = stored(rows, "scored")
    able = F.col("n_words") >= min_words
    limit = share * rows.where(able).count() // 100
    drawn = ranked(rows.where(able).drop("n_words"), [F.desc("score"), F.col(key).asc_nulls_last(), F.col(ROW)], "rank", limit)
    rest = rows.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest, allowMissingColumns=True).select(key, "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` drawn towards ``benchmark``; cases as in :func:`importance_resampling`."""
    return importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 as a fold over bytes.  DuckDB has no CRC function: the byte table is built in ``tab``.
SQL = f"""
WITH RECURSIVE tb(i, c, k) AS (SELECT range::BIGINT, range::BIGINT, 0 FROM range(256) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM tb WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM tb WHERE k = 8),
x AS MATERIALIZED (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
f AS MATERIALIZED (SELECT side, r, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM x),
u AS MATERIALIZED (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
b AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket FROM u, tab),
n AS MATERIALIZED (SELECT side, r, bucket, count(*) AS n FROM f JOIN b USING (f) GROUP BY ALL),
c AS (SELECT range AS bucket, coalesce(s, 0)::DOUBLE AS s, coalesce(t, 0)::DOUBLE AS t, (SELECT sum(n) FROM n WHERE side = 'd')::DOUBLE AS s_all,
  coalesce((SELECT sum(n) FROM n WHERE side = 'b'), 0)::DOUBLE AS t_all FROM range({BUCKETS})
  LEFT JOIN (SELECT bucket, sum(n) FILTER (WHERE side = 'd') AS s, sum(n) FILTER (WHERE side = 'b') AS t FROM n GROUP BY bucket) ON bucket = range),
g AS MATERIALIZED (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::BIGINT AS gain FROM c),
w AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM n JOIN g USING (bucket) WHERE side = 'd' GROUP BY r),
sc AS (SELECT x.doc_id, len(x.w) AS n_words, coalesce(w.n_features, 0) AS n_features,
    coalesce((w.total - ((w.total % w.n_features) + w.n_features) % w.n_features) // w.n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{SEED}:' || coalesce(x.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT::DOUBLE AS h
  FROM x LEFT JOIN w USING (r) WHERE x.side = 'd'),
z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM sc),
o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
  {SHARE} * count(*) FILTER (WHERE n_words >= {MIN_WORDS}) OVER () // 100 AS most FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND place <= most THEN place END AS rank FROM o"""
