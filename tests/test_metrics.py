import math

from revlens.operators import metrics


def ref_metrics(recs, actual, k):
    """The reference's formulas in plain Python."""
    P, R, AP, RR, ND = [], [], [], [], []
    for c, lst in recs.items():
        if c not in actual:
            continue
        a, top = actual[c], lst[:k]
        rel = len(set(top) & a)
        P.append(rel / len(top))
        R.append(rel / len(a))
        ap, cnt = 0.0, 0
        for i, p in enumerate(top, 1):
            if p in a:
                cnt += 1
                ap += cnt / i
        AP.append(ap / min(k, len(a)))
        RR.append(next((1.0 / i for i, p in enumerate(top, 1) if p in a), 0.0))
        dcg = sum(1 / math.log2(i + 1) for i, p in enumerate(top, 1) if p in a)
        idcg = sum(1 / math.log2(i + 2) for i in range(min(len(a), k)))
        ND.append(dcg / idcg if idcg else 0.0)
    m = lambda x: sum(x) / len(x) if x else 0.0
    return m(P), m(R), m(AP), m(RR), m(ND)


def test_ranking_metrics_match_reference_formulas(spark):
    recs = {1: [10, 11, 12, 13, 14, 15], 2: [20, 21], 3: [30, 31, 32], 4: [40]}   # 2 is shorter than k
    actual = {1: {11, 14, 99}, 2: {21}, 3: {77}, 5: {50}}                          # 4 and 5 do not overlap
    rdf = spark.createDataFrame([(c, i + 1, p) for c, l in recs.items() for i, p in enumerate(l)],
                                "customer_id long, rank int, product_id long")
    adf = spark.createDataFrame([(c, p) for c, s in actual.items() for p in s], "customer_id long, product_id long")
    got = {r.k: (r.precision, r.recall, r.map, r.mrr, r.ndcg) for r in metrics.ranking_metrics(rdf, adf).collect()}
    for k in metrics.K_VALUES:
        ref = ref_metrics(recs, actual, k)
        assert all(abs(x - y) < 1e-6 for x, y in zip(got[k], ref)), (k, got[k], ref)


def test_holdout_no_overlap_gives_null_hit_rate(spark):
    rdf = spark.createDataFrame([(1, 1, 10)], "customer_id long, rank int, product_id long")
    adf = spark.createDataFrame([(2, 10)], "customer_id long, product_id long")
    r = metrics.holdout_evaluation(rdf, adf).first()
    assert r.hit_rate is None and r.precision == 0.0 and r.coverage == 0.0 and r.diversity == 1


def test_split_is_within_customer(spark):
    rows = [(c, p) for c in range(20) for p in range(30)]
    df = spark.createDataFrame(rows, "customer_id long, product_id long")
    train, test = metrics.train_test_split(df)
    assert train.count() + test.count() == len(rows)
    assert test.select("customer_id").distinct().count() == 20
    assert 0.1 < test.count() / len(rows) < 0.3
