"""The recommendation job (L3): baskets -> FP-Growth rules -> hybrid
recommendations -> names, fallback and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revlens.operators import baskets as bk
from revlens.operators import metrics, patterns, recommend
from revlens.session import cut_lineage


def mine(purchases: DataFrame, min_support: float, min_confidence: float, min_lift: float,
         min_count: int | None = None, rating_threshold: float | None = 4):
    """(transactions, model, itemsets, rules) from rated purchases
    (customer_id, product_id, rating).  The baskets are written once: mining, rule
    matching, the neighbour search and the owned-product filter all read them."""
    tx = cut_lineage(bk.transactions(bk.customer_baskets(purchases, rating_threshold)))
    model, itemsets, rules = patterns.train_fp_growth(tx, min_support, min_confidence, min_lift, min_count)
    return tx, model, itemsets, rules


def recommend_all(purchases: DataFrame, min_support: float, min_confidence: float, min_lift: float,
                  top_n: int = recommend.TOP_N, min_count: int | None = None,
                  rating_threshold: float | None = 4) -> DataFrame:
    tx, _, _, rules = mine(purchases, min_support, min_confidence, min_lift, min_count, rating_threshold)
    return recommend.hybrid_recommend(rules, tx, top_n)


def evaluate(purchases: DataFrame, min_support: float, min_confidence: float, min_lift: float,
             top_n: int = 10, min_count: int | None = None):
    """Split each customer's well-rated purchases 80/20, recommend from the
    training part, score against the held-out part: (recs, test)."""
    train, test = metrics.train_test_split(purchases)
    recs = recommend_all(train, min_support, min_confidence, min_lift, top_n, min_count, rating_threshold=None)
    return recs, test
