import numpy as np
from pyspark.sql import functions as F

from revlens.llm import topk_search as K


def brute(rows, k, every):
    q = [(i, key, [int(np.floor(1024 * float(x))) for x in v]) for i, (key, v) in enumerate(rows)
         if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, key, w in q:
        if key is None or key % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(w, v)), other if other is not None else 2 ** 63, j) for j, other, v in q
                         if j != i and len(v) == len(w)))[:k]
        out += [(key, n + 1, None if other == 2 ** 63 else other, -s) for n, (s, other, _) in enumerate(scored)]
    return sorted(map(str, out))


def found(spark, rows, every=10, clash=lambda df: df, **kw):
    df = spark.createDataFrame([(a, v, 0) for a, v in rows], "vec_id long, embedding array<float>, label int")
    return sorted(str(tuple(r)) for r in K.top_k(clash(df), F.col("vec_id") % every == 0, **kw).collect())


def float32(v):
    return [float(np.float32(x)) for x in v]


def test_equals_brute_force_with_cases(spark, clash):
    rng = np.random.default_rng(3)
    rows = [(i, float32(rng.standard_normal(12))) for i in range(400)]
    rows += [(500 + i, rows[20][1]) for i in range(130)]                   # many ties at the top
    rows += [(20, rows[20][1]), (None, rows[20][1])]                       # repeated key, null key
    rows += [(600, None), (610, []), (620, [float("nan")] * 12), (630, [None] * 12), (640, [0.0] * 12)]
    rows += [(700, [1.0, 2.0]), (701, [3.0, -1.0])]                        # another length
    for stripe, group, bits in ((64, 8, 6), (1000, 100, 3), (8192, 256, 8)):
        assert found(spark, rows, clash=clash, stripe=stripe, group=group, bits=bits) == brute(rows, 10, 10)


def test_few_rows_and_none(spark):
    assert found(spark, []) == [] and found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == []                    # no query
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert found(spark, rows) == brute(rows, 10, 10)


def test_slices_add_up():
    rng = np.random.default_rng(4)
    q = rng.integers(-700, 700, (333, 9))
    index = K.Slices.read(K.Slices(q, 5).packed())
    for w in (rng.integers(-700, 700, 9), np.zeros(9, np.int64), np.array([1] + [0] * 8)):
        slices, slack = index.weighted_sum(w, 4)
        total = sum(np.unpackbits(s.view(np.uint8), count=333, bitorder="little").astype(np.int64) << p for p, s in enumerate(slices))
        total = total if len(slices) else np.zeros(333, np.int64)
        exact = q @ w
        kth = np.sort(total)[-7]
        assert K._kth(slices, index.valid, 7) == kth
        # no row below the slack can be among the best
        cut = total < kth - slack
        assert not cut.any() or exact[cut].max() <= np.sort(exact)[-7]
        near = K._at_least(slices, index.valid, int(kth))
        assert (np.flatnonzero(np.unpackbits(near.view(np.uint8), count=333, bitorder="little")) == np.flatnonzero(total >= kth)).all()


def test_large_components():
    q = np.array([[2 ** 27, -2 ** 27], [2 ** 27, 2 ** 27], [-2 ** 27, 1]])
    rows, scores = K.best_rows(K.Slices(q, 6), q, np.arange(3), q[1], 3, 6)
    assert rows.tolist() == [1, 0, 2] and scores.tolist() == [2 ** 55, 0, 2 ** 27 - 2 ** 54]
