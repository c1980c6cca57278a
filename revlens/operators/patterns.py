"""Frequent itemsets, association rules and rule look-ups (M1–M7, M11, M12,
J4, K3, K4, K7).

Mining uses Spark ML's parallel FP-Growth.  Look-ups against baskets are
written as equi-joins: "rule antecedent is a subset of basket" (J4) joins each
antecedent's rarest item with the baskets that hold it and checks the other
items in place – no nested loop over rules x baskets, and an item that most
baskets hold is joined only for a rule that has no other.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Reference thresholds (support, confidence, lift).
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.05, 0.5, 1.0


def fit_fp_growth(transactions: DataFrame, min_support: float = MIN_SUPPORT,
                  min_confidence: float = MIN_CONFIDENCE, partitions: int | None = None,
                  min_count: int | None = None):
    """M3 (model part): fit FP-Growth on the ``items`` column.  This is the
    one operator that runs Spark jobs when called.

    ``min_support`` is passed through as it is: an itemset is frequent in
    ceil(min_support * n) transactions or more.  ``min_count`` (off by default)
    asks for at least that many besides; the half step keeps the ceiling exact."""
    if min_count:
        n = transactions.count()
        min_support = max(min_support, (min_count - 0.5) / n) if n else min_support
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        fp = fp.setNumPartitions(partitions)
    return fp.fit(transactions.select("items"))


def frequent_itemsets(model, transactions: DataFrame) -> DataFrame:
    """M1: (items sorted, freq, support = freq / number of transactions)."""
    n = transactions.agg(F.count("*")).scalar()
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq",
                                     (F.col("freq") / n).alias("support"))


def association_rules(model, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """M2: rules with confidence and lift at least the thresholds, sides
    sorted, highest lift first, with a stable ``rule_id`` hash."""
    r = model.associationRules
    r = r.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    r = r.select(F.array_sort("antecedent").alias("antecedent"), F.array_sort("consequent").alias("consequent"),
                 "support", "confidence", "lift")
    return r.withColumn("rule_id", F.xxhash64("antecedent", "consequent"))


def train_fp_growth(transactions: DataFrame, min_support: float = MIN_SUPPORT,
                    min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT,
                    min_count: int | None = None):
    """M3: (model, itemsets, rules)."""
    model = fit_fp_growth(transactions, min_support, min_confidence, min_count=min_count)
    return model, frequent_itemsets(model, transactions), association_rules(model, min_confidence, min_lift)


def rules_sorted(rules: DataFrame) -> DataFrame:
    """K7: all rules by lift (then confidence, sides) descending."""
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), F.col("antecedent").cast("string"),
                         F.col("consequent").cast("string"))


def top_rules(rules: DataFrame, n: int = 10, by: str = "lift") -> DataFrame:
    """K3: the ``n`` best rules by ``lift`` or ``confidence``."""
    other = "confidence" if by == "lift" else "lift"
    return rules.orderBy(F.desc(by), F.desc(other), F.col("antecedent").cast("string"),
                         F.col("consequent").cast("string")).limit(n)


def top_itemsets(itemsets: DataFrame, n: int = 5) -> DataFrame:
    """K4: the ``n`` most frequent itemsets."""
    return itemsets.orderBy(F.desc("freq"), F.col("items").cast("string")).limit(n)


def rule_quality(rules: DataFrame) -> DataFrame:
    """Count, means, extremes and population std of confidence and
    lift (zeros when there are no rules)."""
    z = F.lit(0.0)
    return rules.agg(
        F.count("*").alias("num_rules"),
        F.coalesce(F.avg("confidence"), z).alias("avg_confidence"),
        F.coalesce(F.avg("lift"), z).alias("avg_lift"),
        F.coalesce(F.avg("support"), z).alias("avg_support"),
        F.coalesce(F.max("confidence"), z).alias("max_confidence"),
        F.coalesce(F.max("lift"), z).alias("max_lift"),
        F.coalesce(F.min("confidence"), z).alias("min_confidence"),
        F.coalesce(F.min("lift"), z).alias("min_lift"),
        F.coalesce(F.stddev_pop("confidence"), z).alias("std_confidence"),
        F.coalesce(F.stddev_pop("lift"), z).alias("std_lift"))


def rarest_item_index(sets: DataFrame, set_id: str, set_col: str, basket_items: DataFrame) -> DataFrame:
    """(set_id, _set, _item): one row per set, indexed under the item that the fewest baskets
    hold.  ``basket_items``: (_item) rows.  A set with an item of no basket is left out."""
    s = sets.select(set_id, F.array_distinct(set_col).alias("_set"))
    held = basket_items.groupBy("_item").agg(F.count("*").alias("_n"))
    items = s.select(set_id, "_set", F.explode("_set").alias("_item")).join(held, "_item", "left")
    return (items.groupBy(set_id, "_set").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_item")).alias("_r"))
            .filter(F.col("_r.n") > 0).select(set_id, "_set", F.col("_r._item").alias("_item")))


def subset_matches(sets: DataFrame, set_id: str, set_col: str, baskets: DataFrame,
                   basket_id: str = "customer_id", basket_col: str = "items") -> DataFrame:
    """(set_id, basket_id) pairs where every element of ``set_col`` is in
    ``basket_col``: an equi-join on each set's rarest item, the remaining items
    checked against the basket's array.  Empty sets match nothing."""
    b = baskets.select(basket_id, F.explode(F.array_distinct(basket_col)).alias("_item"))
    near = rarest_item_index(sets, set_id, set_col, b).join(b, "_item").select(set_id, "_set", basket_id)
    one = F.size("_set") == 1
    rest = near.filter(~one).join(baskets.select(basket_id, F.col(basket_col).alias("_basket")), basket_id)
    whole = rest.filter(F.size(F.array_except("_set", "_basket")) == 0)
    return near.filter(one).select(set_id, basket_id).unionByName(whole.select(set_id, basket_id))


def predict_from_items(rules: DataFrame, queries: DataFrame, query_id: str = "customer_id",
                       items: str = "items") -> DataFrame:
    """M4: for each query item set, the rules whose antecedent is contained
    in it and whose consequent adds new items: (query_id, rule_id,
    antecedent, new_items, confidence, lift, support, pred_rank) with rank 1
    = highest confidence, then lift."""
    m = subset_matches(rules, "rule_id", "antecedent", queries, query_id, items)
    j = (m.join(rules, "rule_id").join(queries.select(query_id, F.col(items).alias("_q")), query_id)
          .withColumn("new_items", F.array_except("consequent", "_q"))
          .filter(F.size("new_items") > 0))
    w = Window.partitionBy(query_id).orderBy(F.desc("confidence"), F.desc("lift"),
                                             F.col("antecedent").cast("string"), F.col("consequent").cast("string"))
    return j.select(query_id, "rule_id", "antecedent", "new_items", "confidence", "lift", "support",
                    F.row_number().over(w).alias("pred_rank"))


def recommend_for_items(rules: DataFrame, queries: DataFrame, top_n: int = 5,
                        query_id: str = "customer_id", items: str = "items") -> DataFrame:
    """M5: items of the first ``top_n`` predictions, each item once (its
    first appearance): (query_id, item, confidence, lift, support, position)."""
    p = predict_from_items(rules, queries, query_id, items).filter(F.col("pred_rank") <= top_n)
    e = p.select(query_id, "pred_rank", "confidence", "lift", "support",
                 F.posexplode("new_items").alias("pos", "item"))
    first = e.groupBy(query_id, "item").agg(F.min(F.struct("pred_rank", "pos", "confidence", "lift", "support")).alias("f"))
    w = Window.partitionBy(query_id).orderBy("f.pred_rank", "f.pos")
    return first.select(query_id, "item", F.col("f.confidence").alias("confidence"), F.col("f.lift").alias("lift"),
                        F.col("f.support").alias("support"), F.row_number().over(w).alias("position"))


def rule_explanations(rules: DataFrame, queries: DataFrame, top_n: int = 3,
                      query_id: str = "customer_id", items: str = "items") -> DataFrame:
    """M6: the first ``top_n`` matched rules with their true antecedent."""
    p = predict_from_items(rules, queries, query_id, items).filter(F.col("pred_rank") <= top_n)
    return p.select(query_id, "pred_rank", "antecedent", F.col("new_items").alias("consequent"),
                    "confidence", "lift", "support")


def similar_items(rules: DataFrame, top_n: int = 5) -> DataFrame:
    """M7 for every item at once: score(item, other) = sum of lift x
    confidence over rules with the item on one side and the other item on
    the opposite side; the ``top_n`` others per item."""
    e = rules.select(F.explode("antecedent").alias("a"), "consequent", (F.col("lift") * F.col("confidence")).alias("s"))
    e = e.select("a", F.explode("consequent").alias("c"), "s")
    both = (e.select(F.col("a").alias("item"), F.col("c").alias("other"), "s")
             .unionByName(e.select(F.col("c").alias("item"), F.col("a").alias("other"), "s")))
    scored = both.filter(F.col("item") != F.col("other")).groupBy("item", "other").agg(F.sum("s").alias("score"))
    w = Window.partitionBy("item").orderBy(F.desc("score"), "other")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)


def itemset_coverage(itemsets: DataFrame, transactions: DataFrame) -> DataFrame:
    """Share of transactions containing at least one frequent itemset.

    Every subset of a frequent itemset is frequent, so this is the share of
    transactions holding a frequent single item.  Frequent single items are
    at most (mean basket size / min support) many, a bound set by the
    support threshold, so they travel as one array (scalar subquery).
    """
    singles = itemsets.filter(F.size("items") == 1).agg(F.collect_set(F.col("items")[0])).scalar()
    hit = F.when(F.arrays_overlap("items", singles), 1.0).otherwise(0.0)
    return transactions.agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("coverage"))
