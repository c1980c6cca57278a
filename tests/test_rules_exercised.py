"""Rules on rows they change: support without a floor, time order, ties, large ids, blanks, zero gaps."""

import datetime as dt

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from revlens.operators import baskets, clean, dedup, flags, metrics, patterns, sampling


def test_support_is_passed_through(spark):
    rows = [(i, [i, i + 100, 1000]) for i in range(10)]
    tx = spark.createDataFrame(rows, "customer_id long, items array<long>")
    plain = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.5).fit(tx).freqItemsets
    ours = patterns.fit_fp_growth(tx, 0.05).freqItemsets
    as_set = lambda df: {(tuple(sorted(r["items"])), r["freq"]) for r in df.collect()}
    assert as_set(ours) == as_set(plain) and len(as_set(ours)) == 61
    assert as_set(patterns.fit_fp_growth(tx, 0.05, min_count=2).freqItemsets) == {((1000,), 10)}


def test_baskets_use_the_rating(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 3.0), (1, 10, 4.0), (2, 12, 1.0), (3, None, 5.0)],
                               "customer_id long, product_id long, rating double")
    assert [(r["customer_id"], r["items"]) for r in baskets.customer_baskets(df, 4).collect()] == [(1, [10])]


def test_item_catalog_is_dense_and_native(spark):
    df = spark.createDataFrame([(i, [i % 97, 3 * (i % 50)]) for i in range(300)], "customer_id long, items array<long>")
    out = baskets.item_catalog(df)
    rows = sorted((r["item"], r["idx"]) for r in out.collect())
    assert [i for _, i in rows] == list(range(len(rows)))
    assert "Python" not in out._jdf.queryExecution().toString()


def test_dedup_orders_by_the_number(spark):
    df = spark.createDataFrame([(1, "1000000000", "late"), (1, "999999999", "early"), (1, None, "none"), (2, "5", "only")],
                               "comment_id long, created_at string, content string")
    when = F.col("created_at").try_cast("double")
    first = dedup.dedup(df.where("created_at IS NOT NULL"), ["comment_id"], order=[when])
    last = dedup.dedup(df, ["comment_id"], order=[when], keep="last")
    assert {r.comment_id: r.content for r in first.collect()} == {1: "early", 2: "only"}
    assert {r.comment_id: r.content for r in last.collect()} == {1: "late", 2: "only"}
    assert first.columns == df.columns


def test_blank_content_is_unicode_white_space(spark):
    df = spark.createDataFrame([("\n\t",), ("  ",), ("",), (None,), (" x ",)], "content string")
    assert [r.content for r in clean.drop_blank_content(df).collect()] == [" x "]


def test_column_rules(spark):
    p = spark.createDataFrame([(1, "a")], "id long, name string")
    c = spark.createDataFrame([(1,)], "comment_id long")
    products, comments = clean.harmonise_columns(p, c)
    assert products.columns == ["product_id", "product_name"] and comments.columns == ["comment_id", "customer_name"]
    both = spark.createDataFrame([(1, 2)], "id long, product_id long")
    assert clean.harmonise_columns(both, c)[0].columns == ["id", "product_id", "product_name"]


def test_split_takes_large_and_text_ids(spark):
    big = spark.createDataFrame([(10 ** 13 + i, 10 ** 15 + 7 * i) for i in range(2000)], "customer_id long, product_id long")
    train, test = metrics.train_test_split(big)
    assert train.count() + test.count() == 2000 and 320 < test.count() < 480
    text = big.select(F.col("customer_id").cast("string").alias("customer_id"), F.col("product_id").cast("string").alias("product_id"))
    assert metrics.train_test_split(text)[1].count() == test.count()


def test_balanced_sample_is_exact_under_ties(spark):
    rows = [(i % 40, i % 3 == 0, False, False) for i in range(600)]  # each key fifteen times
    df = spark.createDataFrame(rows, "comment_id long, F3_flag boolean, F4_Flag boolean, F5_flag boolean")
    out = sampling.balanced_sample(df, "comment_id", 0.1)
    assert {r.label: r["count"] for r in out.groupBy("label").count().collect()} == {"spam": 30, "ham": 30}


def test_customer_coverage_counts_the_given_customers(spark):
    recs = spark.createDataFrame([(c, 1, 5) for c in range(10)], "customer_id long, rank int, product_id long")
    test = spark.createDataFrame([(1, 5), (2, 6), (77, 5)], "customer_id long, product_id long")
    cat = spark.createDataFrame([(5,), (6,)], "product_id long")
    assert abs(metrics.coverage_metrics(recs, cat, test).first().customer_coverage - 200 / 3) < 1e-5
    assert abs(metrics.holdout_evaluation(recs, test).first().coverage - 200 / 3) < 1e-5


def test_notebook_bursts_count_zero_gaps(spark):
    t0 = dt.datetime(2020, 1, 1)
    rows = [(i, 1, t0 + dt.timedelta(seconds=s)) for i, s in enumerate([0, 0, 0, 0, 0, 0, 86400, 200000])]
    df = spark.createDataFrame(rows, "comment_id long, customer_id long, created_at_ts timestamp")
    job = {r.comment_id: r.burst_count for r in flags.burst_flags(df).collect()}
    notebook = {r.comment_id: r.burst_count for r in flags.burst_flags(df, zero_is_small=True).collect()}
    assert notebook == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 0, 7: 0}
    assert all(n == 0 for i, n in job.items() if i < 6)


def test_dirty_epochs_do_not_fail(spark):
    df = spark.createDataFrame([("1e20", "5", "4"), ("NaN", "5", "4"), ("Infinity", "5", "4"), ("100", "7", "5")],
                               "created_at string, purchased_at string, rating string")
    assert [r.created_at_num for r in clean.convert_types(df).collect()] == [100]
