"""Train/test split and ranking metrics.

``recs``: (customer_id, rank, product_id); ``actual``: (customer_id,
product_id).  Per-customer metrics are averaged over customers present in
both, as the reference does.  All k values are computed in one pass: every
recommendation row of rank r is expanded to the k values >= r (at most
four), so there is no join against a table of k values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K_VALUES = (1, 3, 5, 10)
TEST_PERCENT = 20


def split_key(customer: str = "customer_id", product: str = "product_id"):
    """Deterministic 0..99 bucket of a purchase, from the md5 of both ids: ids
    may be text or of any size, and any SQL engine can reproduce it."""
    text = F.concat_ws("|", F.col(customer).cast("string"), F.col(product).cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def train_test_split(purchases: DataFrame, test_percent: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Split the purchases, not the customers: each purchase goes to the
    test part with probability ``test_percent``, so a customer with few
    purchases may have none there."""
    key = split_key()
    return purchases.filter(key >= test_percent), purchases.filter(key < test_percent)


def _per_customer(recs: DataFrame, actual: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    act = actual.select("customer_id", "product_id").distinct()
    sizes = act.groupBy("customer_id").agg(F.count("*").alias("n_actual"))
    r = (recs.select("customer_id", "rank", "product_id")
             .join(sizes, "customer_id")
             .join(act.withColumn("_hit", F.lit(1)), ["customer_id", "product_id"], "left")
             .withColumn("hit", F.coalesce("_hit", F.lit(0))))
    w = Window.partitionBy("customer_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("hits_so_far", F.sum("hit").over(w))
    kk = F.array(*[F.lit(k) for k in ks])
    e = r.select("*", F.explode(F.filter(kk, lambda k: k >= F.col("rank"))).alias("k"))
    per = e.groupBy("customer_id", "k", "n_actual").agg(
        F.count("*").alias("n_recs"),
        F.sum("hit").alias("hits"),
        F.sum(F.when(F.col("hit") == 1, F.col("hits_so_far") / F.col("rank")).otherwise(0.0)).alias("ap_sum"),
        F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first_hit"),
        F.sum(F.col("hit") / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_actual"), F.col("k")).cast("int")),
                        F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1))
    return per.select(
        "customer_id", "k",
        (F.col("hits") / F.col("n_recs")).alias("precision"),
        (F.col("hits") / F.col("n_actual")).alias("recall"),
        (F.col("ap_sum") / F.least(F.col("k"), F.col("n_actual"))).alias("ap"),
        F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)).alias("rr"),
        F.when(ideal > 0, F.col("dcg") / ideal).otherwise(0.0).alias("ndcg"))


def ranking_metrics(recs: DataFrame, actual: DataFrame, ks: tuple[int, ...] = K_VALUES,
                    digits: int = 6) -> DataFrame:
    """Per k, mean precision, recall, MAP, MRR and NDCG."""
    per = _per_customer(recs, actual, ks)
    return per.groupBy("k").agg(*[F.round(F.avg(c), digits).alias(n) for c, n in
                                  [("precision", "precision"), ("recall", "recall"), ("ap", "map"),
                                   ("rr", "mrr"), ("ndcg", "ndcg")]])


def precision_at_k(recs, actual, k=5):
    """E1."""
    return ranking_metrics(recs, actual, (k,)).select("k", "precision")


def recall_at_k(recs, actual, k=5):
    """E2."""
    return ranking_metrics(recs, actual, (k,)).select("k", "recall")


def map_at_k(recs, actual, k=5):
    """E3."""
    return ranking_metrics(recs, actual, (k,)).select("k", "map")


def mrr_at_k(recs, actual, k=5):
    """E4."""
    return ranking_metrics(recs, actual, (k,)).select("k", "mrr")


def ndcg_at_k(recs, actual, k=5):
    """E5."""
    return ranking_metrics(recs, actual, (k,)).select("k", "ndcg")


def coverage_metrics(recs: DataFrame, catalogue: DataFrame, customers: DataFrame, digits: int = 6) -> DataFrame:
    """Catalogue coverage % (distinct recommended / catalogue),
    diversity (mean distinct products per customer) and customer coverage
    % (those of ``customers`` with a recommendation / ``customers``)."""
    reached = (customers.select("customer_id").distinct().join(recs.select("customer_id"), "customer_id", "left_semi")
               .agg(F.count("*")).scalar())
    n_cat = catalogue.select("product_id").distinct().agg(F.count("*")).scalar()
    n_cust = customers.select("customer_id").distinct().agg(F.count("*")).scalar()
    per = recs.groupBy("customer_id").agg(F.countDistinct("product_id").alias("d"))
    div = per.agg(F.coalesce(F.avg("d"), F.lit(0.0))).scalar()
    return recs.agg(
        F.round(F.when(n_cat > 0, F.countDistinct("product_id") * 100.0 / n_cat).otherwise(0.0), digits)
        .alias("catalog_coverage"),
        F.round(div, digits).alias("diversity"),
        F.round(F.when(n_cust > 0, reached * 100.0 / n_cust).otherwise(0.0), digits)
        .alias("customer_coverage"))


def evaluation_report(recs: DataFrame, actual: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The reference's report table: one row per k with 4-decimal
    texts, plus a coverage row (customer %, catalogue %, diversity)."""
    m = ranking_metrics(recs, actual)
    rows = m.select(F.concat(F.lit("@K="), F.col("k").cast("string")).alias("Metric"),
                    *[F.format_string("%.4f", F.col(c)).alias(n) for c, n in
                      [("precision", "Precision"), ("recall", "Recall"), ("map", "MAP"), ("mrr", "MRR"),
                       ("ndcg", "NDCG")]])
    cov = coverage_metrics(recs, catalogue, actual)
    crow = cov.select(F.lit("Coverage").alias("Metric"),
                      F.concat(F.format_string("%.2f", "customer_coverage"), F.lit("%")).alias("Precision"),
                      F.concat(F.format_string("%.2f", "catalog_coverage"), F.lit("%")).alias("Recall"),
                      F.format_string("%.2f", "diversity").alias("MAP"),
                      F.lit("—").alias("MRR"), F.lit("—").alias("NDCG"))
    return rows.unionByName(crow)


def holdout_evaluation(recs: DataFrame, actual: DataFrame, digits: int = 6) -> DataFrame:
    """Mean precision and recall over customers with recommendations
    and test purchases, hit rate (null when no customer overlaps),
    coverage % (test customers with recommendations / test customers) and the
    number of distinct recommended products."""
    act = actual.select("customer_id", "product_id").distinct()
    sizes = act.groupBy("customer_id").agg(F.count("*").alias("n_actual"))
    r = (recs.select("customer_id", "product_id").join(sizes, "customer_id")
             .join(act.withColumn("_hit", F.lit(1)), ["customer_id", "product_id"], "left"))
    per = r.groupBy("customer_id", "n_actual").agg(F.count("*").alias("n"), F.count("_hit").alias("rel"))
    n_test = sizes.agg(F.count("*")).scalar()
    n_rec = sizes.join(recs.select("customer_id"), "customer_id", "left_semi").agg(F.count("*")).scalar()
    n_prod = recs.select("product_id").distinct().agg(F.count("*")).scalar()
    return per.agg(
        F.round(F.coalesce(F.avg(F.col("rel") / F.col("n")), F.lit(0.0)), digits).alias("precision"),
        F.round(F.coalesce(F.avg(F.col("rel") / F.col("n_actual")), F.lit(0.0)), digits).alias("recall"),
        F.round(F.sum(F.when(F.col("rel") > 0, 1).otherwise(0)) / F.when(F.count("*") > 0, F.count("*")), digits)
        .alias("hit_rate"),
    ).select("precision", "recall", "hit_rate",
             F.round(F.when(n_test > 0, n_rec * 100.0 / n_test).otherwise(0.0), digits).alias("coverage"),
             n_prod.alias("diversity"))
