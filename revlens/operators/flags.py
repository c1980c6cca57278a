"""Fraud flags: review bursts (W1–W3, X1, X2), purchase->review delay
and the combined spam flag (X7).

Burst flag semantics (per user, rows ordered by time then id):
  delta_minutes  = seconds since the user's previous review / 60
  small_gap      = 0 < delta_minutes <= threshold  (5 % quantile of positive gaps)
  burst_group    = running count of rows that are not small gaps
  burst_count    = position of a small-gap row inside its run of consecutive
                   small gaps (0 for other rows); F3_flag = burst_count >= 4

Scale design.  A window partitioned by user alone sends a user who owns a
third of all rows to one task.  With ``bucket_seconds`` set, the row-level
window of a user with more than ``chunk_rows`` rows is partitioned by (user,
chunk) instead; all other users are dealt and sorted once, by user alone.  A chunk is a time bucket of a
user, and a bucket of more than ``chunk_rows`` rows is cut further, by row
count, at the seconds where its running count passes a multiple of
``chunk_rows``: a prefix scan over per-second counts.  The values that
cross chunk borders (previous timestamp, run length carried in, resets before
the chunk) come from a per-chunk summary table, whose run summaries are
combined by a window per user; there is one row per (user, chunk).  Every
row-level step stays partitioned by (user, chunk).  The cuts are few (at most
two per ``chunk_rows`` rows of the input, and only for buckets beyond it), so
they are broadcast.  Rows of one user and one second stay together.
``bucket_seconds=None`` gives the plain per-user window (same results).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.quantiles import quantile_row
from revlens.session import cut_lineage

BURST_QUANTILE = 0.05
BURST_MIN_RUN = 4
TIMEGAP_QUANTILE = 0.05
DEFAULT_BUCKET_SECONDS = 86400
DEFAULT_CHUNK_ROWS = 1_000_000

_RUN = Window.unboundedPreceding


def positive_quantile(df: DataFrame, col: str, q: float, accuracy: int | None = None,
                      seconds_col: str | None = None) -> DataFrame:
    """One-row frame ``threshold`` with the q-quantile of the positive
    values of ``col`` (0.0 when there are none).

    Exact by default: gaps are whole seconds / 60, so the quantile is taken
    exactly over the integer seconds (``operators.quantiles``).  With
    ``accuracy`` set, ``percentile_approx`` is used instead (one pass, rank
    error n / accuracy).
    """
    pos = df.filter(F.col(col) > 0)
    if accuracy is not None:
        return pos.agg(F.coalesce(F.percentile_approx(col, F.lit(q), accuracy).cast("double"),
                                  F.lit(0.0)).alias("threshold"))
    secs = F.col(seconds_col) if seconds_col else F.round(F.col(col) * 60).cast("bigint")
    row = quantile_row(pos, secs, [q], scale=60.0, once=True)
    # an empty input yields an aggregate row with an empty array -> 0.0
    return row.select(F.coalesce(F.get(F.col("values"), 0), F.lit(0.0)).alias("threshold"))


def _minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_seconds(later) - F.unix_seconds(earlier)) / 60.0


def chunk_cuts(df: DataFrame, user: str, ts: str, bucket_seconds: int, chunk_rows: int) -> DataFrame:
    """(user, _day, _cuts): for each time bucket of a user with more than ``chunk_rows`` rows the
    seconds, ascending, at which its next chunk begins."""
    second = F.unix_seconds(F.col(ts))
    rows = df.select(F.col(user).alias("_user"), second.alias("_s"), F.floor(second / bucket_seconds).cast("bigint").alias("_day"))
    hot = rows.groupBy("_user", "_day").agg(F.count("*").alias("_n")).filter(F.col("_n") > chunk_rows)
    per = (rows.join(hot, ["_user", "_day"], "left_semi").groupBy("_user", "_day", "_s").agg(F.count("*").alias("_n")))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_user", "_day").orderBy("_s").rowsBetween(_RUN, -1)), F.lit(0))
    part = per.withColumn("_part", F.floor(before / chunk_rows)).groupBy("_user", "_day", "_part").agg(F.min("_s").alias("_s"))
    return (part.filter(F.col("_part") > 0).groupBy("_user", "_day")
                .agg(F.array_sort(F.collect_list("_s")).alias("_cuts")))


def chunked(df: DataFrame, user: str, ts: str, bucket_seconds: int | None, cuts: DataFrame | None) -> DataFrame:
    """``df`` with ``_b``, the number of the row's chunk; chunks of a user are in order of time.
    ``cuts`` as from ``chunk_cuts``, or None if no bucket is cut."""
    if bucket_seconds is None:
        return df.withColumn("_b", F.lit(0).cast("bigint"))
    second = F.unix_seconds(F.col(ts))
    day = F.floor(second / bucket_seconds).cast("bigint")
    if cuts is None:
        return df.withColumn("_b", day)
    cuts = cuts.withColumnRenamed("_day", "_cut_day")
    laid = df.withColumn("_day", day)
    laid = laid.join(F.broadcast(cuts), (F.col(user) == F.col("_user")) & (F.col("_day") == F.col("_cut_day")), "left")
    later = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= second)), F.lit(0))
    # a bucket has at most one cut per second
    return (laid.withColumn("_b", F.col("_day") * (bucket_seconds + 1) + F.when(F.col("_cuts").isNull(), 0).otherwise(later))
                .drop("_day", "_cut_day", "_user", "_cuts"))


def found_cuts(df: DataFrame, user: str, ts: str, bucket_seconds: int | None, chunk_rows: int | None) -> DataFrame | None:
    """``chunk_cuts`` written once (a Spark job that counts rows per user and bucket), or None if
    there are none, so that ordinary data pays for the count alone."""
    if bucket_seconds is None or chunk_rows is None:
        return None
    cuts = cut_lineage(chunk_cuts(df, user, ts, bucket_seconds, chunk_rows))
    return None if cuts.isEmpty() else cuts


Part = tuple[DataFrame, int | None, DataFrame | None]  # rows, bucket_seconds or None for the plain window, cuts


def busy_users(df: DataFrame, user: str, chunk_rows: int) -> DataFrame | None:
    """The users with more than ``chunk_rows`` rows (at most one per so many rows of ``df``),
    written once, or None if there are none."""
    per = df.groupBy(F.col(user).alias("_busy")).agg(F.count("*").alias("_n"))
    busy = cut_lineage(per.filter(F.col("_n") > chunk_rows).select("_busy"))
    return None if busy.isEmpty() else busy


def _parts(df: DataFrame, user: str, ts: str, bucket_seconds: int | None, chunk_rows: int | None) -> list[Part]:
    """``df`` as the rows of ordinary users, under the plain window, and those of busy users, in chunks."""
    if bucket_seconds is None or chunk_rows is None:
        return [(df, bucket_seconds, None)]
    busy = busy_users(df, user, chunk_rows)
    if busy is None:
        return [(df, None, None)]
    same = F.col(user).eqNullSafe(F.col("_busy"))
    theirs = df.join(F.broadcast(busy), same, "left_semi")
    return [(df.join(F.broadcast(busy), same, "left_anti"), None, None),
            (theirs, bucket_seconds, found_cuts(theirs, user, ts, bucket_seconds, chunk_rows))]


def _united(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def review_gaps(df: DataFrame, user: str = "customer_id", ts: str = "created_at_ts",
                order_id: str = "comment_id",
                bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``previous_created_at_ts`` and ``delta_minutes`` per user.

    Helper columns ``_b`` (chunk) and ``_rn`` (row number in the chunk)
    are kept for ``burst_flags`` and dropped there.
    """
    return _united(_gaps(rows, user, ts, order_id, bucket, cuts)
                   for rows, bucket, cuts in _parts(df, user, ts, bucket_seconds, chunk_rows))


def _gaps(df: DataFrame, user: str, ts: str, order_id: str, bucket_seconds: int | None, cuts: DataFrame | None) -> DataFrame:
    df = chunked(df, user, ts, bucket_seconds, cuts)
    w = Window.partitionBy(user, "_b").orderBy(ts, order_id)
    rows = (df.withColumn("_rn", F.row_number().over(w))
              .withColumn("_prev", F.lag(ts).over(w)))
    if bucket_seconds is not None:
        last = df.groupBy(user, "_b").agg(F.max(ts).alias("_last"))
        last = last.select(user, "_b", F.lag("_last").over(Window.partitionBy(user).orderBy("_b"))
                           .alias("_prev_bucket"))
        rows = (rows.join(last, [user, "_b"], "left")
                    .withColumn("_prev", F.coalesce("_prev", "_prev_bucket")).drop("_prev_bucket"))
    return (rows.withColumnRenamed("_prev", "previous_created_at_ts")
                .withColumn("delta_minutes", _minutes_between(F.col(ts), F.col("previous_created_at_ts"))))


def burst_threshold(gaps: DataFrame, q: float = BURST_QUANTILE, accuracy: int | None = None) -> DataFrame:
    """One-row frame ``threshold``: q-quantile of positive ``delta_minutes``."""
    return positive_quantile(gaps, "delta_minutes", q, accuracy)


def all_gaps_threshold(gaps: DataFrame, q: float = BURST_QUANTILE) -> DataFrame:
    """X1, notebook form: one-row frame ``threshold``, the q-quantile of all gaps."""
    row = quantile_row(gaps.filter(F.col("delta_minutes").isNotNull()), F.round(F.col("delta_minutes") * 60).cast("bigint"), [q], scale=60.0, once=True)
    return row.select(F.coalesce(F.get(F.col("values"), 0), F.lit(0.0)).alias("threshold"))


def burst_flags(df: DataFrame, user: str = "customer_id", ts: str = "created_at_ts",
                order_id: str = "comment_id", threshold: Column | float | None = None,
                min_run: int = BURST_MIN_RUN,
                bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                zero_is_small: bool = False, chunk_rows: int | None = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W1–W3 + X2: adds previous_created_at_ts, delta_minutes, small_gap,
    burst_group, burst_count and F3_flag.

    ``df`` is read up to three times (rows per user, threshold, result), so it should be
    stored or cheap.  The threshold comes from a projection of (user, time, id) alone, the
    rows keep all their columns lazily.  ``zero_is_small`` is the notebook's form: the
    threshold is taken over all gaps, and a gap of zero counts as small.
    """
    parts = _parts(df, user, ts, bucket_seconds, chunk_rows)
    if threshold is None:
        narrow = _united(_gaps(rows.select(user, ts, order_id), user, ts, order_id, bucket, cuts) for rows, bucket, cuts in parts)
        threshold = (all_gaps_threshold(narrow) if zero_is_small else burst_threshold(narrow)).scalar()
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return _united(_runs(_gaps(rows, user, ts, order_id, bucket, cuts), user, ts, order_id, thr, min_run, bucket, zero_is_small)
                   for rows, bucket, cuts in parts)


def _runs(gaps: DataFrame, user: str, ts: str, order_id: str, thr: Column, min_run: int, bucket_seconds: int | None,
          zero_is_small: bool) -> DataFrame:
    """W2, W3 + X2 over rows with their gaps."""
    d = F.col("delta_minutes")
    w = Window.partitionBy(user, "_b").orderBy(ts, order_id)
    x = (gaps.withColumn("small_gap", ((d >= 0) if zero_is_small else (d > 0)) & (d <= thr))
             .withColumn("_reset", ~F.coalesce(F.col("small_gap"), F.lit(False)))
             .withColumn("_resets", F.sum(F.col("_reset").cast("int")).over(w.rowsBetween(_RUN, 0)))
             .withColumn("_last_reset", F.max(F.when(F.col("_reset"), F.col("_rn"))).over(w.rowsBetween(_RUN, 0))))
    local_run = F.col("_rn") - F.coalesce(F.col("_last_reset"), F.lit(0))
    if bucket_seconds is None:
        carry, prior = F.lit(0), F.lit(0)
    else:
        per = x.groupBy(user, "_b").agg(
            F.count("*").alias("_n"),
            F.max(F.when(F.col("_reset"), F.col("_rn"))).alias("_lr"),
            F.sum(F.col("_reset").cast("int")).alias("_nr"))
        wb = Window.partitionBy(user).orderBy("_b")
        contrib = F.col("_n") - F.coalesce(F.col("_lr"), F.lit(0))
        per = (per.withColumn("_contrib", contrib)
                  .withColumn("_S", F.sum("_contrib").over(wb.rowsBetween(_RUN, 0)))
                  .withColumn("_mark", F.max(F.when(F.col("_lr").isNotNull(), F.col("_S") - F.col("_contrib")))
                              .over(wb.rowsBetween(_RUN, 0)))
                  .withColumn("_end_run", F.col("_S") - F.coalesce(F.col("_mark"), F.lit(0)))
                  .withColumn("_carry", F.coalesce(F.lag("_end_run").over(wb), F.lit(0)))
                  .withColumn("_prior", F.coalesce(F.sum("_nr").over(wb.rowsBetween(_RUN, -1)), F.lit(0)))
                  .select(user, "_b", "_carry", "_prior"))
        x = x.join(per, [user, "_b"], "left")
        carry, prior = F.col("_carry"), F.col("_prior")
    run = local_run + F.when(F.col("_last_reset").isNull(), carry).otherwise(F.lit(0))
    out = (x.withColumn("burst_group", (F.col("_resets") + prior).cast("bigint"))
            .withColumn("burst_count", F.when(F.col("small_gap"), run).otherwise(F.lit(0)).cast("bigint"))
            .withColumn("F3_flag", F.col("burst_count") >= min_run))
    return out.drop("_b", "_rn", "_reset", "_resets", "_last_reset", "_carry", "_prior")


def timegap_minutes(df: DataFrame, created: str = "created_at_ts", purchased: str = "purchased_at_ts") -> DataFrame:
    """Minutes from purchase to review."""
    return df.withColumn("time_gap_minutes", _minutes_between(F.col(created), F.col(purchased)))


def timegap_threshold(df: DataFrame, q: float = TIMEGAP_QUANTILE, accuracy: int | None = None) -> DataFrame:
    """One-row frame ``threshold``: q-quantile of positive time gaps."""
    return positive_quantile(df, "time_gap_minutes", q, accuracy)


def timegap_flags(df: DataFrame, created: str = "created_at_ts", purchased: str = "purchased_at_ts",
                  threshold: Column | float | None = None) -> DataFrame:
    """``time_gap_minutes`` and ``F5_flag`` = 0 < gap <= threshold.
    Zero and negative delays are never flagged."""
    x = timegap_minutes(df, created, purchased)
    if threshold is None:
        threshold = timegap_threshold(x).scalar()
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    g = F.col("time_gap_minutes")
    return x.withColumn("F5_flag", (g > 0) & (g <= thr))


def is_spam(df: DataFrame, flags: tuple[str, ...] = ("F3_flag", "F5_flag")) -> DataFrame:
    """Any present flag true (F3|F5 in the job, F3|F4|F5 in the notebook)."""
    present = [f for f in flags if f in df.columns]
    cond = F.lit(False)
    for f in present:
        cond = cond | F.coalesce(F.col(f), F.lit(False))
    return df.withColumn("is_spam", cond)
