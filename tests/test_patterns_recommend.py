import itertools

from pyspark.sql import functions as F

from revlens.operators import baskets as bk
from revlens.operators import patterns, recommend


def rules_frame(spark, rules):
    df = spark.createDataFrame(rules, "antecedent array<long>, consequent array<long>, support double, confidence double, lift double")
    return df.withColumn("rule_id", F.xxhash64("antecedent", "consequent"))


def test_subset_join_matches_naive(spark):
    baskets = {1: [1, 2, 3], 2: [2, 3], 3: [4], 4: [1, 3, 5]}
    sets = {10: [1, 3], 11: [2], 12: [3, 5], 13: [6], 14: [1, 2, 3]}
    b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<long>")
    s = spark.createDataFrame(list(sets.items()), "rule_id long, antecedent array<long>")
    got = {(r.rule_id, r.customer_id) for r in patterns.subset_matches(s, "rule_id", "antecedent", b).collect()}
    naive = {(i, c) for i, a in sets.items() for c, items in baskets.items() if set(a) <= set(items)}
    assert got == naive


def test_subset_join_joins_each_rule_on_its_rarest_item(spark):
    # item 0 is in every basket: only the rule that has nothing else is joined on it
    baskets = {c: sorted({0, c % 7 + 1, c % 5 + 10}) for c in range(70)}
    sets = {1: [0], 2: [0, 3], 3: [0, 3, 12], 4: [3, 99], 5: [], 6: [12, 12, 0]}
    b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<long>")
    r = spark.createDataFrame(list(sets.items()), "rule_id long, antecedent array<long>")
    items = b.select(F.explode("items").alias("_item"))
    index = {x.rule_id: x["_item"] for x in patterns.rarest_item_index(r, "rule_id", "antecedent", items).collect()}
    assert index == {1: 0, 2: 3, 3: 3, 6: 12}
    got = {(x.rule_id, x.customer_id) for x in patterns.subset_matches(r, "rule_id", "antecedent", b).collect()}
    assert got == {(i, c) for i, s in sets.items() for c, o in baskets.items() if s and set(s) <= set(o)}


def test_rule_scores_half_owned_antecedent_and_owned_consequent(spark):
    rules = rules_frame(spark, [([1, 2], [3], 0.1, 0.6, 2.0), ([1], [2], 0.1, 0.7, 1.5), ([4], [5], 0.1, 0.9, 3.0)])
    b = spark.createDataFrame([(7, [1, 9]), (8, [1, 2])], "customer_id long, items array<long>")
    s = {(r.customer_id, r.product_id): r.score for r in recommend.rule_scores(rules, b).collect()}
    # customer 7 owns half of {1,2}: only rule 1 -> 2 applies
    assert s == {(7, 2): 1.5, (8, 3): 2.0, (8, 2): 1.5}
    recs = recommend.hybrid_recommend(rules, b).collect()
    # the consequent 2 is already owned by customer 8 and is never recommended;
    # 7 and 8 share product 1, so each also gets the other's products
    assert {(r.customer_id, r.product_id) for r in recs} == {(7, 2), (8, 3), (8, 9)}


def test_neighbours_jaccard_and_ties(spark):
    baskets = {1: [1, 2], 2: [1, 2, 3], 3: [1, 4], 4: [9], 5: [1, 2, 5]}
    b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<long>")
    pairs = {(r.customer_id, r.other_id): r.jaccard for r in recommend.jaccard_pairs(b).collect()}
    for (a, o), j in pairs.items():
        sa, so = set(baskets[a]), set(baskets[o])
        assert abs(j - len(sa & so) / len(sa | so)) < 1e-12 and 0 < j <= 1
    assert (4, 1) not in pairs
    top1 = {r.customer_id: r.other_id for r in recommend.top_neighbours(recommend.jaccard_pairs(b), 1).collect()}
    assert top1[1] == 2   # 2 and 5 tie at 2/3: the lower id wins
    ns = recommend.neighbour_scores(b, 5).collect()
    assert all(r.product_id not in baskets[r.customer_id] for r in ns)


def test_fallback_for_customers_without_recommendations(spark):
    recs = spark.createDataFrame([(1, 1, 50, "p50")], "customer_id long, rank int, product_id long, product_name string")
    popular = spark.createDataFrame([(1, 70, "p70"), (2, 71, "p71")], "rank int, product_id long, product_name string")
    cust = spark.createDataFrame([(1,), (2,)], "customer_id long")
    out = sorted(map(tuple, recommend.recommend_with_fallback(cust, recs, popular).collect()))
    assert out == [(1, 1, 50, "p50", "fp_growth"), (2, 1, 70, "p70", "popularity_fallback"),
                   (2, 2, 71, "p71", "popularity_fallback")]


def test_fp_growth_rules_and_lift(spark):
    tx = [[1, 2, 3], [1, 2], [1, 3], [2, 3], [1, 2, 3], [4]]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(tx)], "customer_id long, items array<long>")
    model, itemsets, rules = patterns.train_fp_growth(t, 0.3, 0.5, 1.0)
    freq = {tuple(r["items"]): r.freq for r in itemsets.collect()}
    for k in (1, 2, 3):
        for combo in itertools.combinations([1, 2, 3], k):
            c = sum(1 for x in tx if set(combo) <= set(x))
            assert (freq.get(combo) == c) if c >= 2 else combo not in freq
    for r in rules.collect():
        sup_c = sum(1 for x in tx if r.consequent[0] in x) / len(tx)
        assert abs(r.lift - r.confidence / sup_c) < 1e-12
    cov = patterns.itemset_coverage(itemsets, t).first().coverage
    assert abs(cov - 5 / 6) < 1e-12
    q = patterns.rule_quality(rules.filter(F.lit(False))).first()
    assert q.num_rules == 0 and q.avg_lift == 0.0


def test_predict_and_similar_items(spark):
    rules = rules_frame(spark, [([1], [2], 0.2, 0.9, 1.2), ([1], [3], 0.2, 0.8, 1.5), ([2], [1], 0.2, 0.5, 1.2)])
    q = spark.createDataFrame([(1, [1]), (2, [1, 2])], "customer_id long, items array<long>")
    p = patterns.recommend_for_items(rules, q).orderBy("customer_id", "position").collect()
    assert [(r.customer_id, r.item) for r in p] == [(1, 2), (1, 3), (2, 3)]
    sim = {(r.item, r.other): r.score for r in patterns.similar_items(rules).collect()}
    assert abs(sim[(1, 2)] - (1.2 * 0.9 + 1.2 * 0.5)) < 1e-12 and abs(sim[(3, 1)] - 1.2) < 1e-12


def test_item_catalog_dense_index(spark):
    b = spark.createDataFrame([(1, [5, 3]), (2, [3, 9])], "customer_id long, items array<long>")
    assert [tuple(r) for r in bk.item_catalog(b).orderBy("idx").collect()] == [(3, 0), (5, 1), (9, 2)]


def test_neighbour_candidates_give_exact_top_k(spark):
    import random
    rnd = random.Random(11)
    baskets = {}
    for c in range(120):
        size = 1 if rnd.random() < 0.6 else rnd.randint(2, 5)
        baskets[c] = sorted(set(rnd.choices(range(12), weights=[30] + [1] * 11, k=size)))
    b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<long>")
    fast = {(r.customer_id, r.nrank): (r.other_id, r.jaccard)
            for r in recommend.top_neighbours(recommend.neighbour_candidates(b), 5).collect()}
    full = {(r.customer_id, r.nrank): (r.other_id, r.jaccard)
            for r in recommend.top_neighbours(recommend.jaccard_pairs(b), 5).collect()}
    assert fast == full


def test_neighbour_candidates_with_hot_products_give_exact_top_k(spark):
    # low hot threshold: cold, one-hot-product and hot-pair paths all run
    import random
    for seed in (3, 5, 8):
        rnd = random.Random(seed)
        baskets = {}
        for c in range(150):
            size = 1 if rnd.random() < 0.3 else rnd.randint(2, 6)
            baskets[c] = sorted(set(rnd.choices(range(15), weights=[40, 25, 12] + [1] * 12, k=size)))
        b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<long>")
        for hot in (2, 8):
            fast = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in
                    recommend.top_neighbours(recommend.neighbour_candidates(b, 5, hot), 5).collect()}
            full = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in
                    recommend.top_neighbours(recommend.jaccard_pairs(b), 5).collect()}
            assert fast == full, (seed, hot)


def test_neighbour_candidates_string_products_with_hot_pairs(spark):
    # string ids, one holding a comma: the pair key must not collide with it
    baskets = {1: ["a", "b", "a,b"], 2: ["a", "b"], 3: ["a", "b", "c"], 4: ["a,b", "c"], 5: ["a", "c"], 6: ["b", "c"]}
    b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<string>")
    fast = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in
            recommend.top_neighbours(recommend.neighbour_candidates(b, 3, 2), 3).collect()}
    full = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in
            recommend.top_neighbours(recommend.jaccard_pairs(b), 3).collect()}
    assert fast == full


def test_hot_products_cost_their_classes_not_their_buyers(spark):
    """Twice the customers: candidates grow in proportion though a third of all hold products 0 and 1."""
    import random

    def frame(n):
        rnd = random.Random(n)
        rows = [(c, sorted({1000 + x for x in rnd.sample(range(2 * n), 3)} | ({0, 1} if c % 3 == 0 else {0} if c % 3 == 1 else set())))
                for c in range(n)]
        return spark.createDataFrame(rows, "customer_id long, items array<long>")

    sizes = {}
    for n in (300, 600):
        b = frame(n)
        cand = recommend.neighbour_candidates(b)
        sizes[n] = cand.count()
        fast = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in recommend.top_neighbours(cand, 5).collect()}
        full = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in
                recommend.top_neighbours(recommend.jaccard_pairs(b), 5).collect()}
        assert fast == full
        assert sizes[n] < 20 * n < recommend.jaccard_pairs(b).count()
    assert sizes[600] < 2.6 * sizes[300]


def test_candidates_left_are_few_per_customer_and_dealt_customers_rank_the_same(spark, monkeypatch):
    """No list of all pairs is ranked; a customer with many products is dealt over several tasks."""
    import random
    rnd = random.Random(4)
    baskets = {c: sorted(rnd.sample(range(40), rnd.randint(1, 6))) for c in range(200)} | {500: list(range(40)), 501: list(range(1, 40))}
    b = spark.createDataFrame(list(baskets.items()), "customer_id long, items array<long>")
    full = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in
            recommend.top_neighbours(recommend.jaccard_pairs(b), 5).collect()}
    for items in (recommend.DEAL_ITEMS, 3):
        monkeypatch.setattr(recommend, "DEAL_ITEMS", items)
        cand = recommend.neighbour_candidates(b, hot=30)
        if items > 40:
            assert cand.groupBy("customer_id").count().agg(F.max("count")).first()[0] <= 5 + 6
        fast = {(r.customer_id, r.nrank): (r.other_id, round(r.jaccard, 12)) for r in recommend.top_neighbours(cand, 5, salt=0).collect()}
        assert fast == full, items


def test_reports_read_written_recommendations(spark):
    """Every branch of a report reads the recommendations; none works out the neighbours again."""
    from revlens.plans.catalog import QUERIES
    for name in ("top_recommended_products", "recommend_with_fallback", "coverage_metrics", "evaluation_report", "holdout_evaluation"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "other_id" not in plan, name
