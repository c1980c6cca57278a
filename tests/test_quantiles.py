import math
import random

from revlens.operators.quantiles import exact_quantiles, quantile_row


def disc(values, q):
    s = sorted(values)
    k = max(1, math.ceil(q * len(s)))
    return s[k - 1]


def test_exact_quantiles_match_definition(spark):
    rnd = random.Random(7)
    vals = [rnd.randint(-10**12, 10**12) for _ in range(3000)] + [5] * 200
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    qs = [0.01, 0.05, 0.25, 0.5, 0.75, 1.0]
    got = [r["value"] for r in exact_quantiles(df, "v", qs, shifts=(40, 20, 0)).orderBy("qi").collect()]
    assert got == [disc(vals, q) for q in qs]


def test_grouped_and_ranks(spark):
    rows = [(g, v) for g in range(3) for v in range(g * 10, g * 10 + 7)]
    df = spark.createDataFrame(rows, "g int, v long")
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "v", [0.5], group="g").collect()}
    assert got == {(0, 0.5): 3, (1, 0.5): 13, (2, 0.5): 23}
    ranks = spark.createDataFrame([(0, 2), (1, 7)], "g int, k long")
    got = {r["g"]: r["value"] for r in exact_quantiles(df, "v", [], group="g", ranks=ranks).collect()}
    assert got == {0: 1, 1: 16}


def test_quantile_row_scale(spark):
    df = spark.createDataFrame([(x,) for x in [150, 250, 350]], "v long")
    assert quantile_row(df, "v", [0.5], scale=100.0).first()["values"] == [2.5]
