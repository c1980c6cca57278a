"""Hybrid recommendations, fallback and recommendation reports (J5–J8,
M8–M10, M13, W4, W5, K6, A18, U3, U4).

Scores per (customer, product):
  rules      : sum of lift of rules whose antecedent is in the basket (M8)
  neighbours : sum of Jaccard similarity of the customer's five most similar
               customers that own the product (M9), weighted 0.5
Owned products are removed and the top N by score are kept (M10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.baskets import basket_rows
from revlens.operators.patterns import subset_matches

NEIGHBOURS = 5
DEAL_ITEMS = 1024  # products of a customer from which its partners are dealt over several tasks
NEIGHBOUR_WEIGHT = 0.5
TOP_N = 5


def rule_scores(rules: DataFrame, baskets: DataFrame) -> DataFrame:
    """M8: (customer_id, product_id, score = sum of lift over matched rules)."""
    m = subset_matches(rules, "rule_id", "antecedent", baskets)
    e = m.join(rules.select("rule_id", "consequent", "lift"), "rule_id")
    return (e.select("customer_id", F.explode("consequent").alias("product_id"), "lift")
             .groupBy("customer_id", "product_id").agg(F.sum("lift").alias("score")))


def jaccard_pairs(baskets: DataFrame) -> DataFrame:
    """(customer_id, other_id, jaccard) for every pair of customers
    sharing at least one product, both directions.

    Inverted index: the basket rows are self-joined on product, so only
    pairs that share something are formed; the pair count is the
    intersection and the union comes from the basket sizes.  A product
    bought by many customers still yields all pairs of its buyers: that
    cost is in the definition (exact top neighbours); AQE's skew-join
    splitting spreads such a product over many tasks.
    """
    rows = basket_rows(baskets)
    sizes = baskets.select("customer_id", F.size("items").alias("n"))
    a, b = rows.alias("a"), rows.alias("b")
    # each unordered pair is formed once (a < b), counted, then mirrored
    once = (a.join(b, (F.col("a.product_id") == F.col("b.product_id"))
                   & (F.col("a.customer_id") < F.col("b.customer_id")))
             .groupBy(F.col("a.customer_id").alias("customer_id"), F.col("b.customer_id").alias("other_id"))
             .agg(F.count("*").alias("inter")))
    inter = once.unionByName(once.select(F.col("other_id").alias("customer_id"),
                                         F.col("customer_id").alias("other_id"), "inter"))
    sa = sizes.alias("sa")
    sb = sizes.select(F.col("customer_id").alias("other_id"), F.col("n").alias("m"))
    j = inter.join(sa, "customer_id").join(sb, "other_id")
    return j.select("customer_id", "other_id",
                    (F.col("inter") / (F.col("n") + F.col("m") - F.col("inter"))).alias("jaccard"))


TOPK_SALT = 32


def top_neighbours(pairs: DataFrame, k: int = NEIGHBOURS, salt: int = TOPK_SALT) -> DataFrame:
    """The ``k`` most similar customers per customer (lower id first
    on ties).

    Two-stage top-k: a customer who shares a popular product has partners
    in the order of the customer count, so the first ranking runs per
    (customer, hash of partner mod ``salt``) – spread over ``salt`` tasks –
    and the final one over at most k x salt survivors.  The top k of the
    per-bucket top k is exactly the overall top k.
    """
    order = [F.desc("jaccard"), "other_id"]
    if salt and salt > 1:
        w1 = Window.partitionBy("customer_id", F.pmod(F.xxhash64("other_id"), F.lit(salt))).orderBy(*order)
        pairs = pairs.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r")
    w = Window.partitionBy("customer_id").orderBy(*order)
    return pairs.withColumn("nrank", F.row_number().over(w)).filter(F.col("nrank") <= k)


def _topk(df: DataFrame, key: str, order: list, k: int, salt: int = TOPK_SALT) -> DataFrame:
    """First ``k`` rows per ``key`` by ``order``, in two salted stages so a
    key with millions of rows is ranked across ``salt`` tasks."""
    w1 = Window.partitionBy(key, F.pmod(F.xxhash64(*[c for c in df.columns if c != key]), F.lit(salt))).orderBy(*order)
    df = df.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r")
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def neighbour_candidates(baskets: DataFrame, k: int = NEIGHBOURS, hot: int | None = None) -> DataFrame:
    """(customer_id, other_id, jaccard) containing every customer's exact
    top-k neighbours (their scores exact) without forming all pairs of the buyers
    of a popular product.  Of the others only a few per customer are left, none
    scored higher than it is.

    A product is *hot* when its buyers would make more pairs than there are basket rows
    in all (``hot`` sets a number of buyers instead; it changes the plan, never the
    result).  Two customers share

    * a product that is not hot: the pair is formed through that product's buyer list;
      its intersection is the number of such lists plus the overlap of the two
      customers' hot products;
    * hot products only.  Customers with the same hot products are one *class*.  For a
      customer A and the members B of one class the shared count s is the same, so
      J = s / (|A| + |B| - s) falls with |B|: any member ahead of B in (|B|, id) order
      ranks ahead of B for A (if it shares more with A, all the more).  Only the first
      k + 1 members of a class can be among A's top k, and A's own size and class say which
      classes are best: classes meet classes through an index of their products, and the
      k + 1 best members are found once for all customers of one class and size.

    So a product that a third of all customers hold costs its classes, not
    its buyers; pairs of classes are what remains quadratic.
    """
    held = baskets.select("customer_id", F.size("items").alias("n"), "items")
    rows = held.select("customer_id", "n", F.explode("items").alias("product_id"))
    buyers = rows.groupBy("product_id").agg(F.count("*").alias("buyers"))
    if hot is None:
        total = baskets.agg(F.sum(F.size("items"))).scalar()
        # fewer than the root of all basket rows, so they are broadcast
        hot_products = F.broadcast(buyers.filter(F.col("buyers").cast("double") * (F.col("buyers") - 1) / 2 > total).select("product_id"))
    else:
        hot_products = buyers.filter(F.col("buyers") > hot).select("product_id")
    hot_sets = (rows.join(hot_products, "product_id").groupBy("customer_id", "n")
                .agg(F.array_sort(F.collect_list("product_id")).alias("hs")))
    cold = (held.join(hot_sets.drop("n"), "customer_id", "left").select("customer_id", "n", "hs", F.explode("items").alias("product_id"))
            .join(hot_products, "product_id", "left_anti"))
    sharing = _best_sharing(cold, k)
    # a pair of the second kind that shares another product too is found above with its true, larger score
    found = sharing.unionByName(_hot_only_candidates(hot_sets, k))
    return found.repartition("customer_id").groupBy("customer_id", "other_id").agg(F.max("jaccard").alias("jaccard"))


def _best_sharing(cold: DataFrame, k: int, salt: int = TOPK_SALT) -> DataFrame:
    """(customer_id, other_id, jaccard): of the customers that share a product of ``cold``
    (customer_id, n, hs, product_id), each customer's ``k`` best.

    Each buyer is sent the whole buyer list of a product, ids and basket sizes as plain
    arrays: one shuffle by customer, after which pairs are formed, counted and ranked
    where they are.  A list is shorter than the root of twice all basket rows.  A customer with
    more than DEAL_ITEMS products is dealt over up to ``salt`` tasks by a hash of the
    other customer, which ranks the ``k`` best of each."""
    lists = (cold.groupBy("product_id").agg(F.collect_list(F.struct("customer_id", "n", "hs")).alias("them"))
             .filter(F.size("them") > 1))
    part_of = lambda c: F.transform("them", lambda x: x[c])
    sent = (lists.select("them", part_of("customer_id").alias("ids"), part_of("n").alias("sizes"), part_of("hs").alias("hots"))
            .select(F.explode("them").alias("me"), "ids", "sizes", "hots")
            .select("me.customer_id", "me.n", F.col("me.hs").alias("ha"), "ids", "sizes", "hots"))
    deals = F.least(F.lit(salt), F.ceil(F.col("n") / DEAL_ITEMS)).cast("int")
    sent = sent.withColumn("deals", deals).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    here = F.filter(F.arrays_zip("ids", "sizes", "hots"), lambda o: F.pmod(F.xxhash64(o["ids"]), F.col("deals")) == F.col("deal"))
    own = lambda c: F.when(F.col("deals") == 1, F.col(c)).otherwise(F.transform(here, lambda o: o[c])).alias(c)
    sent = sent.select("customer_id", "deal", "n", "ha", own("ids"), own("sizes"), own("hots")).repartition("customer_id", "deal")
    met = (sent.select("customer_id", "deal", "n", "ha", F.inline(F.arrays_zip(
        F.col("ids").alias("other_id"), F.col("sizes").alias("m"), F.col("hots").alias("hb"))))
        .toDF("customer_id", "deal", "n", "ha", "other_id", "m", "hb").filter(F.col("customer_id") != F.col("other_id")))
    pairs = met.groupBy("customer_id", "deal", "other_id", "n", "m", "ha", "hb").agg(F.count("*").alias("cold"))
    inter = F.col("cold") + F.coalesce(F.size(F.array_intersect("ha", "hb")), F.lit(0))
    scored = pairs.select("customer_id", "deal", "other_id", (inter / (F.col("n") + F.col("m") - inter)).alias("jaccard"))
    w = Window.partitionBy("customer_id", "deal").orderBy(F.desc("jaccard"), "other_id")
    return (scored.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
            .select("customer_id", "other_id", "jaccard"))


def _hot_only_candidates(hot_sets: DataFrame, k: int) -> DataFrame:
    """(customer_id, other_id, jaccard): the pairs sharing hot products only that can be
    among a customer's top ``k``; see ``neighbour_candidates``.  ``hot_sets``: (customer_id, n, hs).
    A pair that shares another product too may be among them, scored by its hot products alone."""
    members = _topk(hot_sets.select("hs", "n", "customer_id"), "hs", ["n", "customer_id"], k + 1)
    classes = hot_sets.select("hs").distinct()
    ca = classes.select(F.col("hs").alias("ha"), F.explode("hs").alias("item"))
    cb = classes.select(F.col("hs").alias("hb"), F.explode("hs").alias("item"))
    common = F.array_intersect("ha", "hb")
    # a pair of classes is formed at its first common product only
    met = ca.join(cb, "item").filter(F.get(common, 0) == F.col("item")).select("ha", "hb", F.size(common).alias("s"))
    shapes = hot_sets.select(F.col("hs").alias("ha"), "n").distinct()
    theirs = members.select(F.col("hs").alias("hb"), F.col("n").alias("m"), F.col("customer_id").alias("other_id"))
    scored = (shapes.join(met, "ha").join(theirs, "hb")
              .select(F.struct("ha", "n").alias("shape"), "other_id", "s", (F.col("s") / (F.col("n") + F.col("m") - F.col("s"))).alias("jaccard")))
    best = _topk(scored, "shape", [F.desc("jaccard"), "other_id"], k + 1)
    return (hot_sets.select("customer_id", F.struct(F.col("hs").alias("ha"), "n").alias("shape")).join(best, "shape")
            .filter(F.col("customer_id") != F.col("other_id")).select("customer_id", "other_id", "jaccard"))


def _neighbour_baskets(baskets: DataFrame, k: int, hot: int | None = None) -> DataFrame:
    """(customer_id, score = Jaccard, items): the baskets of each customer's top-k neighbours."""
    # few candidates are left for a customer: one ranking
    nb = top_neighbours(neighbour_candidates(baskets, k, hot), k, salt=0)
    their = baskets.select(F.col("customer_id").alias("other_id"), "items")
    return nb.join(their, "other_id").select("customer_id", F.col("jaccard").alias("score"), "items")


def exclude_owned(scored: DataFrame, baskets: DataFrame) -> DataFrame:
    """(customer_id, score, items) without the items that the customer already owns."""
    own = baskets.select("customer_id", F.col("items").alias("own"))
    left = F.when(F.col("own").isNull(), F.col("items")).otherwise(F.array_except("items", "own"))
    return scored.join(own, "customer_id", "left").select("customer_id", "score", left.alias("items"))


def _summed(scored: DataFrame) -> DataFrame:
    """(customer_id, score, items), dealt by customer -> (customer_id, product_id, score summed):
    items stay arrays until they are with their customer, and are summed and ranked there."""
    return (scored.select("customer_id", F.explode("items").alias("product_id"), "score")
            .groupBy("customer_id", "product_id").agg(F.sum("score").alias("score")))


def neighbour_scores(baskets: DataFrame, k: int = NEIGHBOURS, hot: int | None = None, owned: bool = False) -> DataFrame:
    """M9: (customer_id, product_id, score = sum of Jaccard of the top-k
    neighbours owning the product), owned products removed unless ``owned``."""
    scored = _neighbour_baskets(baskets, k, hot)
    return _summed(scored.repartition("customer_id") if owned else exclude_owned(scored, baskets))


def rank_recommendations(scores: DataFrame, top_n: int | None = TOP_N) -> DataFrame:
    """W4 + K6: rank by score (product id breaks ties) and keep ``top_n``.
    Scores are sums of floats, so they are compared at 1e-9: equal sums
    added in another order still tie."""
    w = Window.partitionBy("customer_id").orderBy(F.desc(F.round("score", 9)), "product_id")
    r = scores.withColumn("rank", F.row_number().over(w))
    return r if top_n is None else r.filter(F.col("rank") <= top_n)


def hybrid_recommend(rules: DataFrame, baskets: DataFrame, top_n: int = TOP_N,
                     k: int = NEIGHBOURS, weight: float = NEIGHBOUR_WEIGHT) -> DataFrame:
    """(customer_id, rank, product_id, score); customers with no
    candidate are absent.  Owned products leave once, after both scores are added."""
    parts = rule_scores(rules, baskets).select("customer_id", "score", F.array("product_id").alias("items")).unionByName(
        _neighbour_baskets(baskets, k).withColumn("score", F.col("score") * weight))
    return rank_recommendations(_summed(exclude_owned(parts, baskets)), top_n).select("customer_id", "rank", "product_id", "score")


def truncate_recommendations(recs: DataFrame, n: int) -> DataFrame:
    """K6: first ``n`` per customer."""
    return recs.filter(F.col("rank") <= n)


def recommend_with_fallback(customers: DataFrame, recs: DataFrame, popular: DataFrame) -> DataFrame:
    """For every requested customer, their own recommendations
    (``fp_growth``) or else the popular list (``popularity_fallback``).

    ``popular`` is a short ranked list (rank, product_id, product_name),
    e.g. the top five; it travels as one array (scalar subquery), so the
    fallback is a per-row explode, not a join.
    """
    req = customers.select("customer_id").distinct()
    own = (recs.join(req, "customer_id", "left_semi")
               .select("customer_id", "rank", "product_id", "product_name",
                       F.lit("fp_growth").alias("type")))
    arr = popular.agg(F.array_sort(F.collect_list(F.struct("rank", "product_id", "product_name")))).scalar()
    rest = req.join(recs.select("customer_id").distinct(), "customer_id", "left_anti")
    fb = (rest.select("customer_id", F.explode(arr).alias("p"))
              .select("customer_id", F.col("p.rank").cast("int").alias("rank"), F.col("p.product_id").alias("product_id"),
                      F.col("p.product_name").alias("product_name"), F.lit("popularity_fallback").alias("type")))
    return own.unionByName(fb)


def top_recommended_products(recs: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """Customers recommended each product, their share of customers
    with recommendations (``12.34%``), top ``n`` with names."""
    total = recs.agg(F.countDistinct("customer_id")).scalar()
    counts = recs.groupBy("product_id").agg(F.count("*").alias("Recommendation_Count"))
    top = counts.orderBy(F.desc("Recommendation_Count"), "product_id").limit(n)
    named = top.join(products.select("product_id", "product_name"), "product_id", "left")
    return named.select(F.col("product_id").alias("Product_ID"),
                        F.coalesce("product_name", F.lit("Unknown")).alias("Product_Name"),
                        "Recommendation_Count",
                        F.concat(F.format_string("%.2f", F.col("Recommendation_Count") * 100.0 / total),
                                 F.lit("%")).alias("Percentage"))


def verify_recommendations(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Total, mapped and unmapped recommendations, distinct unmapped
    ids, success rate and status (OK at >= 99 %)."""
    names = products.select("product_id", F.lit(True).alias("_known")).distinct()
    j = recs.join(names, "product_id", "left")
    r = j.agg(F.count("*").alias("total_recs"),
              F.count("_known").alias("mapped_count"),
              F.count_if(F.col("_known").isNull()).alias("unmapped_count"),
              F.count_distinct(F.when(F.col("_known").isNull(), F.col("product_id"))).alias("unmapped_ids"))
    rate = F.when(F.col("total_recs") > 0,
                  (1 - F.col("unmapped_count") / F.col("total_recs")) * 100).otherwise(F.lit(0.0))
    return r.withColumn("success_rate", F.round(rate, 6)).withColumn(
        "status", F.when(F.col("success_rate") >= 99.0, "OK").otherwise("WARNING"))


def unmapped_products(recs: DataFrame, products: DataFrame) -> DataFrame:
    """M13 detail: the distinct recommended ids without a product name."""
    return recs.select("product_id").distinct().join(products.select("product_id"), "product_id", "left_anti")


def all_recommended(recs: DataFrame) -> DataFrame:
    """U4: distinct recommended products."""
    return recs.select("product_id").distinct()
