import hashlib

import numpy as np

from revlens.llm import centroid_clustering as C
from revlens.llm.int_vectors import BOUND

BAD = [None, [], [0.5] * 5, [float("nan")] + [0.1] * 5, [None] + [0.1] * 5, [float("inf")] + [0.1] * 5]


def brute(rows, k, rounds, dim):
    q = {}
    for i, (key, v) in enumerate(rows):
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v):
            q[i] = [max(-BOUND, min(BOUND, int(np.floor(1024 * float(x))))) for x in v]
    name = {i: hashlib.sha256(f"3:{'null' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest() for i in q}
    places = [q[i] for i in sorted(q, key=lambda i: (name[i], q[i]))[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in places]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        of = {i: near(v)[0] for i, v in q.items()}
        for c in range(len(places)):
            own = [q[i] for i in q if of[i] == c]
            if own:
                places[c] = [sum(x) // len(own) for x in zip(*own)]
    got = {i: near(v) for i, v in q.items()}
    inertia = sum(d for _, d in got.values())
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return sorted((str(rows[i][0]), c, d, sum(e for b, e in got.values() if b == c), inertia, sha[c]) for i, (c, d) in got.items())


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 0) for k, v in rows], "vec_id long, embedding array<float>, label int")


def clusters(spark, rows, clash=lambda df: df, **kw):
    out = C.centroid_clusters(clash(frame(spark, rows)), dim=6, **kw)
    return sorted((str(r[0]), *r[1:]) for r in out.collect())


def float32(v):
    return [float(np.float32(x)) for x in v]


def test_equals_brute_force_with_cases(spark, clash):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((5, 6))
    rows = [(i, float32(centres[i % 5] + 0.3 * rng.standard_normal(6))) for i in range(240)]
    rows += [(1000 + i, v) for i, v in enumerate(BAD)] + [(None, float32(centres[0])), (7, rows[7][1])]
    rows += [(2000 + i, rows[3][1]) for i in range(80)] + [(3000, [1e30, -1e30, 0.0, 0.0, 0.0, 0.0])]
    for k, rounds, bits in ((5, 6, 8), (8, 10, 4), (3, 0, 10)):
        assert clusters(spark, rows, clash, k=k, rounds=rounds, bits=bits) == brute(rows, k, rounds, 6)


def test_few_equal_and_no_vectors(spark):
    assert clusters(spark, []) == [] and clusters(spark, [(1, None)]) == []
    few = [(1, [0.5] * 6), (2, [0.25] * 6)]
    assert clusters(spark, few) == brute(few, 8, 10, 6)
    same = [(i, [0.5] * 6) for i in range(12)]
    got = clusters(spark, same)
    assert got == brute(same, 8, 10, 6) and {r[1] for r in got} == {0}


def test_cells_bound_the_distances():
    rng = np.random.default_rng(1)
    q = rng.integers(-500, 500, (300, 6))
    cells = C.Cells(q[:50], q.min(0), q.max(0), 4)
    centroids = C.Centroids(rng.integers(-300, 300, (4, 6)), cells)
    place, sure = centroids.by_cells(cells.of(q))
    assert 0 < sure.sum() < 300
    assert (place[sure] == centroids.exact(q)[0][sure]).all()


def test_only_overlapping_vectors_are_taken(spark):
    """Two far clusters: after the first round the cells alone decide."""
    rng = np.random.default_rng(2)
    q = np.vstack([rng.integers(0, 50, (100, 6)), rng.integers(5000, 5050, (100, 6))])
    cells = C.Cells(q, q.min(0), q.max(0), 4)
    assert C.Centroids(np.array([q[0], q[150]]), cells).by_cells(cells.of(q))[1].all()
