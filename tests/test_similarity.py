import math
import re
from collections import Counter

from revlens.operators import similarity


def ref_tfidf_sims(comments):
    """Plain-Python version of the reference's per-user TF-IDF cosine."""
    docs = [re.findall(r"(?u)\b\w\w+\b", c.lower()) for c in comments]
    docs = [[t for t in d if t] for d in docs]
    n = len(comments)
    df = Counter(t for d in docs for t in set(d))
    if not df:
        return None
    vecs = []
    for d in docs:
        tf = Counter(d)
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in tf.items()}
        nrm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        vecs.append({t: x / nrm for t, x in w.items()})
    sims = [sum(v * vecs[j].get(t, 0.0) for t, v in vecs[i].items()) for i in range(n) for j in range(i + 1, n)]
    return sum(sims) / len(sims), max(sims)


def test_matches_formula_and_edge_users(spark):
    users = {
        1: ["hàng đẹp giá rẻ", "hàng đẹp lắm", "giao nhanh"],
        2: ["chỉ một bình luận"],                  # one comment -> no value
        3: ["   ", "hàng tốt", "\t"],               # blanks dropped -> one comment
        4: ["y hệt nhau", "y hệt nhau", "khác"],    # identical comments -> max 1
        5: ["a b c", "x y z"],                      # one-letter words only -> no tokens
        6: ["mua lại lần nữa", "lại mua", "shop ok"],
    }
    rows = [(u, i, c) for u, cs in users.items() for i, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "customer_id long, comment_id long, content string")
    got = {r.customer_id: (r.mean_similarity, r.max_similarity)
           for r in similarity.user_text_similarity(df, materialize=False).collect()}
    assert set(got) == set(users)
    for u in (2, 3, 5):
        assert got[u] == (None, None)
    for u in (1, 4, 6):
        mean, mx = ref_tfidf_sims([c for c in users[u] if c.strip()])
        assert abs(got[u][0] - mean) < 1e-9 and abs(got[u][1] - mx) < 1e-9
    assert abs(got[4][1] - 1.0) < 1e-12


def test_flags_and_thresholds(spark):
    rows = [(u, i, f"w{u} common text {i % 2}") for u in range(6) for i in range(3)] + \
           [(9, 0, "same same"), (9, 1, "same same")]
    df = spark.createDataFrame(rows, "customer_id long, comment_id long, content string")
    out = similarity.similarity_flags(df).collect()
    flagged = {r.customer_id for r in out if r.F4_Flag}
    assert 9 in flagged


def test_prefix_filtered_max_equals_brute_force(spark):
    import random
    rnd = random.Random(3)
    vocab = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "common", "word"]
    users = {}
    for u in range(40):
        n = rnd.randint(2, 9)
        users[u] = [" ".join(rnd.choices(vocab, weights=[1, 1, 1, 1, 1, 1, 1, 1, 12, 12], k=rnd.randint(1, 6)))
                    for _ in range(n)]
    rows = [(u, i, c) for u, cs in users.items() for i, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "customer_id long, comment_id long, content string")
    got = {r.customer_id: (r.mean_similarity, r.max_similarity)
           for r in similarity.user_text_similarity(df, materialize=False).collect()}
    for u, cs in users.items():
        mean, mx = ref_tfidf_sims(cs)
        assert abs(got[u][0] - mean) < 1e-9 and abs(got[u][1] - mx) < 1e-9, (u, got[u], mean, mx)


def test_copied_comment_and_unique_rarest_terms(spark):
    # user 1: an exact copy, so max is 1.0 without a pair search;
    # user 2: every comment's rarest term is its own, so the lower bound
    # must come from a shared term
    users = {1: ["great phone fast", "great phone fast", "slow battery"],
             2: ["alpha shared common", "beta shared common", "gamma common", "delta other"]}
    rows = [(u, i, c) for u, cs in users.items() for i, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "customer_id long, comment_id long, content string")
    got = {r.customer_id: (r.mean_similarity, r.max_similarity)
           for r in similarity.user_text_similarity(df, materialize=False).collect()}
    assert got[1][1] == 1.0
    for u, cs in users.items():
        mean, mx = ref_tfidf_sims(cs)
        assert abs(got[u][0] - mean) < 1e-9 and abs(got[u][1] - mx) < 1e-9, (u, got[u], mean, mx)


def test_users_in_place_and_across_tasks_agree(spark):
    """Small users are worked out in place, without a row per term; beyond the bound the plan
    changes and the values do not.  Comments of one id are one, blanks and comments without tokens count."""
    import random
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(12)] + ["x", "Đẹp"]
    rows = [(u, i % 7, " ".join(rnd.choices(vocab, k=rnd.randint(0, 6)))) for u in range(30) for i in range(rnd.randint(1, 9))]
    df = spark.createDataFrame(rows + [(99, 0, None)], "customer_id long, comment_id long, content string")
    got = [{r.customer_id: (r.mean_similarity, r.max_similarity)
            for r in similarity.user_text_similarity(df, grouped=limit).collect()} for limit in (0, 100, similarity.GROUPED)]
    assert set(got[0]) == {r[0] for r in rows} | {99}
    for other in got[1:]:
        for u, values in got[0].items():
            assert (values[0] is None) == (other[u][0] is None), u
            assert values[0] is None or all(abs(a - b) < 1e-9 for a, b in zip(values, other[u])), u
    plan = similarity.user_text_similarity(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower()


def test_balanced_sample_writes_no_texts(spark):
    from revlens.plans.catalog import QUERIES
    plan = QUERIES["balanced_sample"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan
