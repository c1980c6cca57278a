import random

from revlens.llm.components import components


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5), (None, 3), (7, None), (1, 0), (1, 0)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r.node: r.component for r in components(df).collect()} == {x: find(x) for x in parent}
    assert components(df.where("false")).count() == 0
