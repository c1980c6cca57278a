"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs a library operator over whole driver tables (via
``plans.fixtures``).  Parameters that differ from the reference's defaults
are stated next to the query with the reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import clean, dedup, rfm, trends
from revlens.plans import fixtures as fx
from revlens.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The fixture orders span 1995-2001; the reference's sanity window starts in
# 2000 (it exists to drop dirty years such as 1900).  RFM runs on the whole
# table with the window widened to 1990.
RFM_DATE_LOWER = "1990-01-01"


def created() -> F.Column:
    return F.col("created_at").try_cast("double")


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def clean_reviews(spark, d) -> DataFrame:
    """The RFM job's input chain: flag filter, null drop, date window."""
    r = fx.reviews(spark, d)
    r = clean.clean_flag_filter(r)
    r = clean.drop_missing_customer_or_date(r)
    return clean.date_range_filter(r, lower=RFM_DATE_LOWER)


def _segments(spark, d):
    return rfm.rfm_segments(rfm.rfm_table(clean_reviews(spark, d)))


def unflagged_reviews(spark, d) -> DataFrame:
    """The job chain: merged fact -> rows without a fraud flag -> RFM input."""
    m = merged(spark, d, text=False)
    r = m.select("comment_id", "customer_id", "customer_name", F.col("purchased_at_ts").alias("purchased_at"),
                 F.col("created_at_ts").alias("created_at"), "rating", "seller_name", "F3_flag", "F5_flag")
    r = clean.drop_missing_customer_or_date(clean.clean_flag_filter(r))
    return clean.date_range_filter(r, lower=RFM_DATE_LOWER)


@register("unflagged_segments")
def q_unflagged_segments(spark, d):
    return rfm.rfm_segments(rfm.rfm_table(unflagged_reviews(spark, d)))


@register("unflagged_monthly_trend")
def q_unflagged_monthly_trend(spark, d):
    return trends.monthly_trend(unflagged_reviews(spark, d))


@register("unflagged_seller_totals")
def q_unflagged_seller_totals(spark, d):
    return trends.seller_totals(unflagged_reviews(spark, d))


@register("clean_flag_filter")
def q_clean_flag_filter(spark, d):
    # flags true, false and null
    return clean.clean_flag_filter(fx.flagged_reviews(spark, d))


@register("drop_missing_customer_or_date")
def q_drop_missing_customer_or_date(spark, d):
    return clean.drop_missing_customer_or_date(fx.flagged_reviews(spark, d))


@register("drop_required_nulls")
def q_drop_required_nulls(spark, d):
    return clean.drop_required_nulls(fx.dirty_comments(spark, d))


@register("dropped_rows")
def q_dropped_rows(spark, d):
    # the cleaning chain over the dirty comments, then the RFM input's filters, counted while written
    report = clean.DroppedRows()
    rows = report.step("required nulls", fx.dirty_comments(spark, d), clean.drop_required_nulls)
    rows = report.step("timestamps and rating", rows, clean.convert_types)
    rows = report.step("customer or date", rows, clean.drop_missing_customer_or_date)
    rows = report.step("date range", rows, lambda df: clean.date_range_filter(df, "purchased_at_ts", "created_at_ts"))
    rows = report.step("rating", rows, clean.rating_filter)
    cut_lineage(rows)
    return report.report(spark)


def rfm_outputs(spark, d) -> dict[str, DataFrame]:
    """The RFM job's five output tables by name."""
    segments = cut_lineage(_segments(spark, d))
    reviews = clean_reviews(spark, d)
    return dict(zip(sinks.RFM_OUTPUTS, (segments, rfm.segment_summary(segments), trends.monthly_trend(reviews),
                                        trends.weekday_trend(reviews), trends.top_sellers(fx.seller_sales(spark, d), 10))))


@register("rfm_metrics")
def q_rfm_metrics(spark, d):
    return rfm.rfm_metrics(clean_reviews(spark, d))


@register("rfm_quantiles")
def q_rfm_quantiles(spark, d):
    q = rfm.rfm_quantiles(rfm.rfm_metrics(clean_reviews(spark, d)))
    return q.select(*[F.col(a)[i].cast("double").alias(f"{a[0]}_q{int(p * 100)}")
                      for a in ("r_q", "f_q", "m_q") for i, p in enumerate(rfm.QUANTILES)])


@register("rfm_segments")
def q_rfm_segments(spark, d):
    return _segments(spark, d)


@register("segment_summary")
def q_segment_summary(spark, d):
    return rfm.segment_summary(_segments(spark, d))


@register("segment_share")
def q_segment_share(spark, d):
    return rfm.segment_share(_segments(spark, d))


@register("date_range_filter")
def q_date_range_filter(spark, d):
    # the reference's own window (2000-01-01 .. 2035-12-31)
    return clean.date_range_filter(fx.reviews(spark, d))


@register("monthly_trend")
def q_monthly_trend(spark, d):
    return trends.monthly_trend(clean_reviews(spark, d))


@register("weekday_trend")
def q_weekday_trend(spark, d):
    return trends.weekday_trend(clean_reviews(spark, d))


@register("busiest_weekdays")
def q_busiest_weekdays(spark, d):
    return trends.busiest_weekdays(trends.weekday_trend(clean_reviews(spark, d)))


@register("recent_months")
def q_recent_months(spark, d):
    return trends.recent_months(trends.monthly_trend(clean_reviews(spark, d)), 18)


@register("seller_totals")
def q_seller_totals(spark, d):
    return trends.seller_totals(fx.seller_sales(spark, d))


@register("top_sellers")
def q_top_sellers(spark, d):
    return trends.top_sellers(fx.seller_sales(spark, d), 10)


@register("product_popularity")
def q_product_popularity(spark, d):
    return trends.product_popularity(fx.product_lines(spark, d), fx.products(spark, d))


@register("top5_products")
def q_top5_products(spark, d):
    pop = trends.product_popularity(fx.product_lines(spark, d), fx.products(spark, d))
    return trends.top_products(pop, 5)


@register("kpi_overview")
def q_kpi_overview(spark, d):
    summary = rfm.segment_summary(_segments(spark, d))
    return trends.kpi_overview(summary, trends.monthly_trend(clean_reviews(spark, d)))


@register("distinct_totals")
def q_distinct_totals(spark, d):
    return trends.distinct_totals(clean_reviews(spark, d))


@register("dedup_comments")
def q_dedup_comments(spark, d):
    # earliest by time, not by the text of the time
    return dedup.dedup(fx.dirty_comments(spark, d), ["comment_id"], order=[created(), "product_id"], keep="first")


@register("dedup_comments_last")
def q_dedup_comments_last(spark, d):
    return dedup.dedup(fx.dirty_comments(spark, d), ["comment_id"], order=[created(), "product_id"], keep="last")


@register("duplicate_count")
def q_duplicate_count(spark, d):
    return dedup.duplicate_count(fx.raw_comments(spark, d), ["comment_id"])


# ---------------------------------------------------------------- flags ----
from revlens.functions import html  # noqa: E402
from revlens.functions import text as tx  # noqa: E402
from revlens.operators import flags, summaries  # noqa: E402
from revlens.plans import cleaning  # noqa: E402


@register("burst_flags")
def q_burst_flags(spark, d):
    return flags.burst_flags(fx.burst_events(spark, d))


@register("burst_flags_plain_window")
def q_burst_flags_plain(spark, d):
    # same operator with the plain per-user window (no time buckets)
    return flags.burst_flags(fx.burst_events(spark, d), bucket_seconds=None)


@register("burst_threshold")
def q_burst_threshold(spark, d):
    return flags.burst_threshold(flags.review_gaps(fx.burst_events(spark, d)))


def merged(spark, d, text=True):
    return cleaning.build_merged(fx.raw_products(spark, d), fx.dirty_comments(spark, d), text=text)


@register("merged")
def q_merged(spark, d):
    return merged(spark, d)


@register("burst_flags_orders")
def q_burst_flags_orders(spark, d):
    # the job's comments: lines of urgent orders come in runs of small gaps
    return flags.burst_flags(cut_lineage(fx.comment_times(spark, d)))


@register("burst_flags_notebook")
def q_burst_flags_notebook(spark, d):
    # all gaps set the threshold, zero gaps are small
    return flags.burst_flags(cut_lineage(fx.comment_times(spark, d, 90)), zero_is_small=True)


@register("timegap_threshold")
def q_timegap_threshold(spark, d):
    conv = clean.convert_types(dedup.dedup(fx.dirty_comments(spark, d), ["comment_id"]))
    return flags.timegap_threshold(flags.timegap_minutes(conv))


@register("overall_summary")
def q_overall_summary(spark, d):
    return summaries.overall_summary(merged(spark, d, text=False))


@register("product_summary")
def q_product_summary(spark, d):
    return summaries.product_summary(merged(spark, d, text=False))


@register("customer_summary")
def q_customer_summary(spark, d):
    return summaries.customer_summary(merged(spark, d, text=False))


@register("top_products_by_comments")
def q_top_products_by_comments(spark, d):
    return summaries.top_rows(summaries.product_summary(merged(spark, d, text=False)), 20)


@register("top_customers_by_spam")
def q_top_customers_by_spam(spark, d):
    return summaries.top_rows(summaries.customer_summary(merged(spark, d, text=False)), 20)


HISTORY_COLS = ["customer_id", "created_at_ts", "purchased_at_ts", "delta_minutes", "burst_count", "F3_flag"]


@register("flagged_history_f3")
def q_flagged_history_f3(spark, d):
    return clean.flagged_user_history(merged(spark, d, text=False), "F3_flag", cols=HISTORY_COLS + ["comment_id"])


@register("flagged_history_f5")
def q_flagged_history_f5(spark, d):
    cols = ["customer_id", "comment_id", "created_at_ts", "purchased_at_ts", "time_gap_minutes", "F5_flag"]
    return clean.flagged_user_history(merged(spark, d, text=False), "F5_flag", cols=cols)


@register("null_profile")
def q_null_profile(spark, d):
    return clean.null_profile(fx.dirty_comments(spark, d))


@register("drop_blank_content")
def q_drop_blank_content(spark, d):
    return clean.drop_blank_content(fx.padded_conversations(spark, d))


@register("rating_filter")
def q_rating_filter(spark, d):
    return clean.rating_filter(fx.reviews(spark, d), 4)


# ----------------------------------------------------------------- text ----
@register("clean_text")
def q_clean_text(spark, d):
    return fx.documents(spark, d).select("doc_id", tx.clean_text(F.col("text")).alias("content_text"))


@register("clean_text_v2")
def q_clean_text_v2(spark, d):
    return fx.documents(spark, d).select("doc_id", tx.clean_text_v2(F.col("text")).alias("content_text"))


@register("unescape_html")
def q_unescape_html(spark, d):
    pages = readers.read_table(spark, d, "pages")
    return pages.select("page_id", html.unescape_html(F.col("html")).alias("html"))


@register("unescape_forms")
def q_unescape_forms(spark, d):
    return fx.escaped_conversations(spark, d).withColumn("text", html.unescape_html(F.col("text")))


@register("clean_escaped_text")
def q_clean_escaped_text(spark, d):
    return fx.escaped_conversations(spark, d).select("conv_id", "turn", tx.clean_text_v2(F.col("text")).alias("content_text"))


@register("normalize_text")
def q_normalize_text(spark, d):
    return fx.documents(spark, d).select(
        "doc_id", tx.normalize_text(tx.clean_text_v2(F.col("text"))).alias("content_text"))


# A stopword list for the four fixture languages (the reference reads a
# Vietnamese stopword file that it does not ship).
FIXTURE_STOPWORDS = ["the", "and", "of", "a", "to", "in", "is", "de", "la", "le", "les", "et",
                     "des", "du", "el", "los", "las", "y", "en", "der", "die", "das", "und"]


@register("remove_stopwords")
def q_remove_stopwords(spark, d):
    norm = tx.normalize_text(tx.clean_text_v2(F.col("text")))
    return fx.documents(spark, d).select(
        "doc_id", tx.remove_stopwords(norm, FIXTURE_STOPWORDS).alias("content_text"))


@register("safe_csv_text")
def q_safe_csv_text(spark, d):
    return fx.documents(spark, d).select("doc_id", tx.safe_csv_text(F.col("text")).alias("safe_text"))


@register("expand_abbreviations")
def q_expand_abbreviations(spark, d):
    return fx.conversations(spark, d).select(
        "customer_id", "comment_id",
        tx.expand_abbreviations(F.lower(F.col("content")), tx.ABBREVIATIONS_NOTEBOOK).alias("content_text"))


# ----------------------------------------------------------- similarity ----
from revlens.operators import sampling, similarity, words  # noqa: E402
from revlens.sources import readers  # noqa: E402


@register("text_similarity")
def q_text_similarity(spark, d):
    return similarity.similarity_flags(fx.conversations(spark, d))


@register("similarity_thresholds")
def q_similarity_thresholds(spark, d):
    sim = similarity.user_text_similarity(fx.conversations(spark, d))
    return similarity.similarity_thresholds(sim).select(
        F.round("threshold_mean", 6).alias("threshold_mean"), F.round("threshold_max", 6).alias("threshold_max"))


@register("attach_similarity")
def q_attach_similarity(spark, d):
    conv = fx.conversations(spark, d)
    return summaries.attach_similarity_flags(conv, similarity.similarity_flags(conv))


@register("comments_per_user")
def q_comments_per_user(spark, d):
    return similarity.comments_per_user(fx.conversations(spark, d))


def notebook_merged(spark, d):
    """The notebook's fact: job flags plus F4 from the reviews' own text."""
    rows = cleaning.cleaned(fx.raw_products(spark, d), fx.dirty_comments(spark, d))
    m = cleaning.flagged(rows)
    # the texts come from the written rows: no flag is worked out for them
    sim = similarity.similarity_flags(rows.select("customer_id", "comment_id", tx.safe_csv_text(F.col("content")).alias("content")))
    return flags.is_spam(summaries.attach_similarity_flags(m, sim), sampling.NOTEBOOK_FLAGS)


@register("notebook_merged")
def q_notebook_merged(spark, d):
    return notebook_merged(spark, d)


@register("spam_ham_split")
def q_spam_ham_split(spark, d):
    lab = sampling.spam_ham_label(notebook_merged(spark, d))
    return lab.groupBy("label").agg(F.count("*").alias("rows"),
                                    F.countDistinct("customer_id").alias("customers"))


@register("balanced_sample")
def q_balanced_sample(spark, d):
    rows = notebook_merged(spark, d).select("comment_id", "customer_id", *sampling.NOTEBOOK_FLAGS)
    s = sampling.balanced_sample(rows, "comment_id", 0.1, 42)
    return s.select("comment_id", "customer_id", "label", "F3_flag", "F4_Flag", "F5_flag")


@register("short_word_counts")
def q_short_word_counts(spark, d):
    docs = fx.documents(spark, d).select(tx.clean_text_v2(F.col("text")).alias("content_text"))
    return words.short_word_counts(docs, "content_text", 1, 2, 50)


@register("parse_event_props")
def q_parse_event_props(spark, d):
    ev = readers.read_table(spark, d, "events").select("event_id", "props")
    return readers.parse_json_column(ev, "props", "k BIGINT", keep=["event_id"])


@register("flatten_reviews")
def q_flatten_reviews(spark, d):
    return readers.flatten_reviews(fx.review_json(spark, d))


@register("flatten_products")
def q_flatten_products(spark, d):
    return readers.flatten_products(fx.product_json(spark, d))


@register("flatten_product_ids")
def q_flatten_product_ids(spark, d):
    return readers.flatten_product_ids(fx.listing_json(spark, d))


# ------------------------------------------------------ recommendations ----
from revlens.operators import baskets as bk  # noqa: E402
from revlens.operators import metrics, patterns, recommend  # noqa: E402
from revlens.plans import recommend_job  # noqa: E402
from revlens.sources import sinks  # noqa: E402

# Mining parameters for the fixture baskets.  The reference's defaults
# (support 0.05, confidence 0.5, lift 1.0) find no rule in the driver's
# uniform synthetic baskets, so both basket kinds use lower thresholds.
BRAND_RULES = dict(min_support=0.003, min_confidence=0.05, min_lift=1.0)   # order x brand
# min_count: on the smallest tables 0.002 of the customers is less than one, and
# every subset of every basket would be frequent.
PART_RULES = dict(min_support=0.002, min_confidence=0.1, min_lift=1.0, min_count=2)  # customer x part


def _r6(df: DataFrame, cols=("support", "confidence", "lift")) -> DataFrame:
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, F.round(c, 6))
    return df


def brand_mining(spark, d):
    return recommend_job.mine(fx.brand_purchases(spark, d), **BRAND_RULES)


def part_mining(spark, d):
    return recommend_job.mine(fx.purchases(spark, d), **PART_RULES)


@register("customer_baskets")
def q_customer_baskets(spark, d):
    return part_baskets(spark, d)


@register("transactions")
def q_transactions(spark, d):
    return bk.transactions(bk.customer_baskets(fx.brand_purchases(spark, d), 4))


@register("product_name_map")
def q_product_name_map(spark, d):
    return bk.product_name_map(fx.line_products(spark, d))


@register("item_catalog")
def q_item_catalog(spark, d):
    return bk.item_catalog(part_baskets(spark, d))


@register("frequent_itemsets")
def q_frequent_itemsets(spark, d):
    return _r6(brand_mining(spark, d)[2])


@register("frequent_itemsets_unbounded")
def q_frequent_itemsets_unbounded(spark, d):
    # a support below one basket: every itemset of every basket, as plain FP-Growth has it
    return _r6(recommend_job.mine(fx.brand_purchases(spark, d), 1e-9, 1.0, 1.0)[2])


@register("association_rules")
def q_association_rules(spark, d):
    return _r6(brand_mining(spark, d)[3]).drop("rule_id")


@register("part_itemsets")
def q_part_itemsets(spark, d):
    return _r6(part_mining(spark, d)[2])


@register("rules_sorted")
def q_rules_sorted(spark, d):
    return _r6(patterns.rules_sorted(brand_mining(spark, d)[3])).drop("rule_id")


@register("top_rules_by_lift")
def q_top_rules_by_lift(spark, d):
    return _r6(patterns.top_rules(brand_mining(spark, d)[3], 10, "lift")).drop("rule_id")


@register("top_rules_by_confidence")
def q_top_rules_by_confidence(spark, d):
    return _r6(patterns.top_rules(brand_mining(spark, d)[3], 10, "confidence")).drop("rule_id")


@register("top_itemsets")
def q_top_itemsets(spark, d):
    return _r6(patterns.top_itemsets(brand_mining(spark, d)[2], 5))


@register("rule_quality")
def q_rule_quality(spark, d):
    q = patterns.rule_quality(brand_mining(spark, d)[3])
    return q.select("num_rules", *[F.round(c, 6).alias(c) for c in q.columns if c != "num_rules"])


@register("itemset_coverage")
def q_itemset_coverage(spark, d):
    tx, _, itemsets, _ = brand_mining(spark, d)
    return patterns.itemset_coverage(itemsets, tx).select(F.round("coverage", 6).alias("coverage"))


@register("export_rules")
def q_export_rules(spark, d):
    return sinks.export_rules(brand_mining(spark, d)[3])


@register("export_rules_named")
def q_export_rules_named(spark, d):
    rules = part_mining(spark, d)[3]
    return sinks.export_rules_named(rules, fx.products(spark, d), 1000)


@register("predict_from_items")
def q_predict_from_items(spark, d):
    tx, _, _, rules = brand_mining(spark, d)
    p = patterns.predict_from_items(rules, tx)
    return _r6(p).drop("rule_id")


@register("recommend_for_items")
def q_recommend_for_items(spark, d):
    tx, _, _, rules = brand_mining(spark, d)
    return _r6(patterns.recommend_for_items(rules, tx, 5))


@register("rule_explanations")
def q_rule_explanations(spark, d):
    tx, _, _, rules = brand_mining(spark, d)
    return _r6(patterns.rule_explanations(rules, tx, 3))


@register("similar_items")
def q_similar_items(spark, d):
    s = patterns.similar_items(brand_mining(spark, d)[3], 5)
    return s.withColumn("score", F.round("score", 6))


def part_baskets(spark, d):
    return bk.customer_baskets(fx.purchases(spark, d), 4)


def written_baskets(spark, d):
    """The baskets, written once for the several branches of a neighbour search."""
    return cut_lineage(part_baskets(spark, d))


@register("rule_scores")
def q_rule_scores(spark, d):
    tx, _, _, rules = part_mining(spark, d)
    return recommend.rule_scores(rules, tx).withColumn("score", F.round("score", 6))


@register("jaccard_pairs")
def q_jaccard_pairs(spark, d):
    return recommend.jaccard_pairs(part_baskets(spark, d)).withColumn("jaccard", F.round("jaccard", 9))


@register("top_neighbours")
def q_top_neighbours(spark, d):
    nb = recommend.top_neighbours(recommend.neighbour_candidates(written_baskets(spark, d)), salt=0)
    return nb.withColumn("jaccard", F.round("jaccard", 9))


@register("top_neighbours_hot")
def q_top_neighbours_hot(spark, d):
    # three products that nearly all customers hold: the search by classes of hot products
    nb = recommend.top_neighbours(recommend.neighbour_candidates(cut_lineage(fx.hot_baskets(spark, d))), salt=0)
    return nb.withColumn("jaccard", F.round("jaccard", 9))


@register("neighbour_scores")
def q_neighbour_scores(spark, d):
    return recommend.neighbour_scores(written_baskets(spark, d)).withColumn("score", F.round("score", 6))


def hybrid(spark, d, top_n=5):
    tx, _, _, rules = part_mining(spark, d)
    return recommend.hybrid_recommend(rules, tx, top_n)


@register("hybrid_recommend")
def q_hybrid_recommend(spark, d):
    return hybrid(spark, d).withColumn("score", F.round("score", 6))


@register("export_recommendations")
def q_export_recommendations(spark, d):
    return sinks.export_recommendations(hybrid(spark, d), fx.products(spark, d))


def top5_popular(spark, d):
    pop = trends.product_popularity(fx.product_lines(spark, d), fx.products(spark, d))
    return trends.top_products(pop, 5)


@register("recommend_with_fallback")
def q_recommend_with_fallback(spark, d):
    names = fx.products(spark, d)
    recs = cut_lineage(hybrid(spark, d)).join(names, "product_id", "left")
    # customers of the customer table, plus ids absent from it
    wanted = fx.customers(spark, d).unionByName(
        fx.reviews(spark, d).select((F.col("customer_id") + 1000000000).alias("customer_id")).distinct())
    return recommend.recommend_with_fallback(wanted, recs, top5_popular(spark, d))


@register("top_recommended_products")
def q_top_recommended_products(spark, d):
    return recommend.top_recommended_products(cut_lineage(hybrid(spark, d)), fx.products(spark, d), 5)


@register("verify_recommendations")
def q_verify_recommendations(spark, d):
    return recommend.verify_recommendations(hybrid(spark, d), fx.products(spark, d))


@register("verify_recommendations_unnamed")
def q_verify_recommendations_unnamed(spark, d):
    # a catalogue without the rings: some recommended ids have no name
    return recommend.verify_recommendations(hybrid(spark, d), fx.listed_products(spark, d))


@register("unmapped_products")
def q_unmapped_products(spark, d):
    return recommend.unmapped_products(hybrid(spark, d), fx.listed_products(spark, d))


@register("all_recommended")
def q_all_recommended(spark, d):
    return recommend.all_recommended(hybrid(spark, d))


@register("basket_set_ops")
def q_basket_set_ops(spark, d):
    b = written_baskets(spark, d)
    nb = recommend.top_neighbours(recommend.neighbour_candidates(b, 1), 1, salt=0)
    o = b.select(F.col("customer_id").alias("other_id"), F.col("items").alias("other_items"))
    j = nb.join(b, "customer_id").join(o, "other_id")
    return j.select("customer_id", "other_id",
                    F.size(F.array_intersect("items", "other_items")).alias("n_common"),
                    F.size(F.array_union("items", "other_items")).alias("n_union"),
                    F.size(F.array_except("items", "other_items")).alias("n_only_mine"),
                    (F.size(F.array_except("items", "other_items")) == 0).alias("is_subset"))


def liked_pairs(spark, d):
    """Distinct (customer, product) rated 4 or more."""
    return clean.rating_filter(fx.purchases(spark, d), 4).select("customer_id", "product_id").distinct()


@register("train_test_split")
def q_train_test_split(spark, d):
    train, test = metrics.train_test_split(liked_pairs(spark, d))
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


def evaluation(spark, d):
    """(recs, test, pairs): the liked pairs and the recommendations are written once, as
    every metric reads them again."""
    pairs = cut_lineage(liked_pairs(spark, d))
    recs, test = recommend_job.evaluate(pairs, **PART_RULES, top_n=10)
    return cut_lineage(recs), test, pairs


@register("ranking_metrics")
def q_ranking_metrics(spark, d):
    recs, test, _ = evaluation(spark, d)
    return metrics.ranking_metrics(recs, test)


@register("coverage_metrics")
def q_coverage_metrics(spark, d):
    recs, test, _ = evaluation(spark, d)
    return metrics.coverage_metrics(recs.filter(F.col("rank") <= 5), fx.products(spark, d), test)


@register("evaluation_report")
def q_evaluation_report(spark, d):
    recs, test, pairs = evaluation(spark, d)
    return metrics.evaluation_report(recs, test, pairs)


@register("holdout_evaluation")
def q_holdout_evaluation(spark, d):
    recs, test, _ = evaluation(spark, d)
    return metrics.holdout_evaluation(recs.filter(F.col("rank") <= 5), test)


# ------------------------------------------------ single-step operators ----
@register("drop_any_null")
def q_drop_any_null(spark, d):
    return clean.drop_any_null(fx.dirty_comments(spark, d))


@register("convert_types")
def q_convert_types(spark, d):
    return clean.convert_types(dedup.dedup(fx.dirty_comments(spark, d), ["comment_id"]))


@register("column_projection")
def q_column_projection(spark, d):
    return clean.column_projection(fx.raw_comments(spark, d))


@register("review_gaps")
def q_review_gaps(spark, d):
    return flags.review_gaps(fx.burst_events(spark, d)).drop("_b", "_rn")


@register("truncate_recommendations")
def q_truncate_recommendations(spark, d):
    return recommend.truncate_recommendations(hybrid(spark, d, 10), 3).withColumn("score", F.round("score", 6))
