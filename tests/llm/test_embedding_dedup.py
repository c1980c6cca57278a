import numpy as np

from revlens.llm import embedding_dedup as E


def brute(vectors):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = []
    for i, v in enumerate(vectors):
        n = 0
        for j, w in enumerate(vectors):
            if i != j and ok[i] and ok[j] and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                n += a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9
        links.append(n)
    return links


def frame(spark, vectors, **cols):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")


def test_finds_links_and_nothing_below(spark, clash):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 24))
    near = base[:30] + rng.standard_normal((30, 24)) * 0.2
    group = base[0] + rng.standard_normal((80, 24)) * 0.05
    vectors = [[float(np.float32(x)) for x in v] for v in np.vstack([base, near, group])]
    vectors += [vectors[3]] * 3 + [[2 * x for x in vectors[4]]]
    vectors += [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [None] + [1.0] * 23, [float("inf")] + [0.0] * 23, [1.0, 0.0], [1e-30] * 24, [1e30] * 24]
    df = frame(spark, vectors)
    rows = {r.vec_id: r for r in E.embedding_dedup(clash(df)).collect()}
    expected = brute(vectors)
    got = [rows[i].n_links for i in range(len(vectors))]
    assert all(g <= e for g, e in zip(got, expected))
    assert sum(got) >= 0.9 * sum(expected)
    for i, r in rows.items():
        assert r.component_id <= i and r.kept == (r.component_id == i)
        assert r.n_links == 0 and r.kept or r.n_links > 0
    assert rows[170].n_links >= 3 and rows[170].component_id == rows[3].component_id


def test_empty(spark):
    assert E.embedding_dedup(frame(spark, [])).count() == 0
    assert E.embedding_dedup(frame(spark, [None])).first().kept


def test_parameters_reach_recall():
    for n in (10, 10_000, 10 ** 9):
        k, tables = E.parameters(n)
        assert 1 - (1 - E.collision((2 - 1.8) ** 0.5) ** k) ** tables >= E.RECALL


def test_recall_near_the_threshold(spark):
    """500 pairs at a cosine of 0.9 to 0.91 among unlike vectors."""
    rng = np.random.default_rng(6)
    first = rng.standard_normal((500, 48))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = rng.standard_normal((500, 48))
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cos = rng.uniform(0.9001, 0.91, (500, 1))
    vectors = [[float(x) for x in v] for v in np.vstack([first, cos * first + np.sqrt(1 - cos ** 2) * other])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    links = [r.n_links for r in E.embedding_dedup(df).collect()]
    assert set(links) <= {0, 1} and sum(links) >= 0.93 * len(links)


def test_keys_of_the_first_tables():
    x = np.random.default_rng(1).standard_normal((20, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hasher = E.hash_of(8, 3, 10)
    assert (hasher.keys(x, 4) == hasher.keys(x)[:, :4]).all() and E.hash_of(8, 3, 10) is hasher
