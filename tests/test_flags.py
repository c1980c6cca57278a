import datetime as dt

from pyspark.sql import functions as F

from revlens.operators import flags

T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    data = [(i, u, None if m is None else T0 + dt.timedelta(minutes=m)) for i, (u, m) in enumerate(rows)]
    return spark.createDataFrame(data, "comment_id long, customer_id long, created_at_ts timestamp")


def flagged(df, **kw):
    out = flags.burst_flags(df, threshold=10.0, **kw).orderBy("customer_id", "created_at_ts", "comment_id")
    return [(r["customer_id"], r["burst_count"], r["F3_flag"]) for r in out.collect()]


def test_runs_of_3_4_5_small_gaps(spark):
    # user 1: four gaps of 5 min (run of 4 -> flagged at the 4th)
    # user 2: three small gaps (not flagged); user 3: five (flagged at 4 and 5)
    rows = [(1, m) for m in (0, 5, 10, 15, 20)] + [(2, m) for m in (0, 5, 10, 15)] + \
           [(3, m) for m in (0, 1, 2, 3, 4, 5)]
    got = flagged(frame(spark, rows))
    assert [c for u, c, f in got if u == 1] == [0, 1, 2, 3, 4]
    assert not any(f for u, c, f in got if u == 2)
    assert [f for u, c, f in got if u == 3] == [False, False, False, False, True, True]


def test_zero_gap_threshold_gap_and_reset(spark):
    # gaps: 0 (not small), 10 (== threshold: small), 11 (reset), 3, 3
    rows = [(1, m) for m in (0, 0, 10, 21, 24, 27)]
    got = flagged(frame(spark, rows))
    assert [c for _, c, _ in got] == [0, 0, 1, 0, 1, 2]


def test_bucketed_equals_plain_window_across_bucket_borders(spark):
    # runs that cross day borders: bucket stitching must carry the run
    mins = [60 * 23 + 50 + 3 * i for i in range(12)] + [60 * 48 + i for i in range(0, 40, 7)]
    rows = [(7, m) for m in mins] + [(8, m) for m in range(0, 3000, 97)]
    df = frame(spark, rows)
    a = flags.burst_flags(df, threshold=10.0, bucket_seconds=3600)
    b = flags.burst_flags(df, threshold=10.0, bucket_seconds=None)
    cols = ["comment_id", "previous_created_at_ts", "delta_minutes", "small_gap", "burst_group", "burst_count", "F3_flag"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_user_with_all_rows_in_one_day_is_cut_by_row_count(spark):
    # user 7: 600 rows in one day, some in the same second; user 8: few rows; null user and time
    secs = [(i * 37) % 5000 + (i // 100) * 9000 for i in range(600)]
    data = [(i, 7, T0 + dt.timedelta(seconds=s)) for i, s in enumerate(secs)]
    data += [(1000 + i, 7, T0 + dt.timedelta(seconds=secs[5])) for i in range(40)]
    data += [(2000 + i, 8, T0 + dt.timedelta(days=i % 3, seconds=i)) for i in range(20)]
    data += [(3000, None, T0), (3001, 7, None), (3002, None, None)]
    df = spark.createDataFrame(data, "comment_id long, customer_id long, created_at_ts timestamp")
    cols = ["comment_id", "previous_created_at_ts", "delta_minutes", "small_gap", "burst_group", "burst_count", "F3_flag"]

    def rows(**kw):
        return sorted(map(str, flags.burst_flags(df.filter("customer_id IS NOT NULL AND created_at_ts IS NOT NULL"), threshold=1.0, **kw).select(cols).collect()))
    plain = rows(bucket_seconds=None)
    assert rows(chunk_rows=50) == plain and rows(chunk_rows=7) == plain and rows() == plain
    # the busy day is spread: no chunk holds much more than the row count asked for
    cuts = flags.found_cuts(df, "customer_id", "created_at_ts", 86400, 50)
    assert flags.found_cuts(df, "customer_id", "created_at_ts", 86400, 5000) is None
    sizes = [r["count"] for r in flags.chunked(df, "customer_id", "created_at_ts", 86400, cuts).groupBy("customer_id", "_b").count().collect()]
    assert max(sizes) <= 50 + 41 and sum(sizes) == len(data)
    assert flags.burst_flags(df, threshold=1.0, chunk_rows=50).count() == len(data)


def test_ties_broken_by_id(spark):
    rows = [(1, 0), (1, 0), (1, 5)]
    out = flags.review_gaps(frame(spark, rows)).orderBy("comment_id").collect()
    assert [r["delta_minutes"] for r in out] == [None, 0.0, 5.0]


def test_timegap_negative_and_zero_never_flagged(spark):
    data = [(1, T0, T0), (2, T0, T0 + dt.timedelta(minutes=5)), (3, T0 + dt.timedelta(minutes=5), T0),
            (4, T0 + dt.timedelta(minutes=500), T0)]
    df = spark.createDataFrame(data, "comment_id long, created_at_ts timestamp, purchased_at_ts timestamp")
    out = {r["comment_id"]: r["F5_flag"] for r in flags.timegap_flags(df).collect()}
    assert out == {1: False, 2: False, 3: True, 4: False}


def test_threshold_exact_quantile_of_positive_gaps(spark):
    df = spark.createDataFrame([(float(x),) for x in [-3, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "delta_minutes double")
    # 5 % of 10 positive values -> the smallest one
    assert flags.burst_threshold(df).first()["threshold"] == 1.0
    empty = df.filter(F.col("delta_minutes") > 100)
    assert flags.burst_threshold(empty).first()["threshold"] == 0.0


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_ordinary_users_are_dealt_once_and_busy_users_cut(spark, tmp_dir):
    data = [(i, u, T0 + dt.timedelta(seconds=(i * 7919) % 40000)) for i, u in enumerate([1] * 60 + [2] * 9 + [None] * 5 + [3] * 30)]
    spark.createDataFrame(data, "comment_id long, customer_id long, created_at_ts timestamp").write.parquet(f"{tmp_dir}/rows")
    df = spark.read.parquet(f"{tmp_dir}/rows")
    # no user is busy: one shuffle of the rows, no join; the threshold reads written counts
    out = flags.burst_flags(df)
    tree = plan_of(out).split("\n(1) ")[0].split("Subqueries")[0]
    assert tree.count("Exchange") == 1 and "Join" not in tree, tree
    cols = ["comment_id", "previous_created_at_ts", "delta_minutes", "small_gap", "burst_group", "burst_count", "F3_flag"]
    plain = sorted(map(str, flags.burst_flags(df, bucket_seconds=None).select(cols).collect()))
    assert sorted(map(str, out.select(cols).collect())) == plain
    # users 1 and 3 are busy, a null user is a user like others
    assert {r["_busy"] for r in flags.busy_users(df, "customer_id", 20).collect()} == {1, 3}
    assert flags.busy_users(df, "customer_id", 60) is None
    for rows in (20, 10):
        assert sorted(map(str, flags.burst_flags(df, bucket_seconds=3600, chunk_rows=rows).select(cols).collect())) == plain


def test_threshold_works_its_rows_out_once(spark):
    rows = spark.range(1000).select((F.col("id") % 10).cast("double").alias("time_gap_minutes"))
    threshold = flags.timegap_threshold(rows)
    assert "Range" not in plan_of(threshold)  # both levels read written counts
    assert threshold.first()["threshold"] == 1.0
