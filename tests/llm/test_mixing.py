import re

import pytest
from pyspark.sql import functions as F

from revlens.llm import mixing as M

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes):
    """Iterated resharing, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = sum(sizes.values())
    capped = {}
    while True:
        rest = total - sum(capped.values())
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        share = {s: rest * w / open_weight for s, w in weight.items() if s not in capped} if open_weight else {}
        over = [s for s, x in share.items() if x > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3.0 * sizes[s] for s in over})


def rows_of(n=300):
    rows = [(i, "w " * (i % 17 + 1), ["a", "b", "c", "d", "é", None][min(i % 23, 5)]) for i in range(n)]
    return rows + [(1000, None, "a"), (1001, "", "empty"), (1002, " \u00a0x\t", "b"), (1003, "y " * 30_000, "tail"), (1, "w w ", "b"), (None, "a b c", "b")]


def test_targets_sizes_and_copies(docs, clash):
    rows = rows_of()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    expected = targets(sizes)
    got = M.planned(clash(docs(rows)).drop("size")).collect()
    assert len(got) == len(rows)
    where = {(d, len(WORD.findall(t or ""))): s for d, t, s in rows}
    for r in got:
        s = where[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(expected[s], rel=1e-9)
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 3
    assert sum(expected.values()) == pytest.approx(sum(sizes.values()))
    again = M.planned(docs(rows)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_emits_copies_with_all_columns(docs, clash):
    frame = clash(docs(rows_of()))
    out = M.mix(frame)
    assert out.columns == frame.columns
    counts = {(r.doc_id, r.text): r["count"] for r in out.groupBy("doc_id", "text").count().collect()}
    plan = M.planned(frame).groupBy("doc_id").agg(F.sum("copies").alias("copies")).collect()
    for r in plan:
        assert sum(n for (d, _), n in counts.items() if d == r.doc_id) == r.copies


def test_taken_is_near_target(docs):
    rows = [(i, "w " * (i % 7 + 3), f"s{i % 3}") for i in range(6000)]
    got = M.planned(docs(rows)).withColumn("taken", F.col("size") * F.col("copies"))
    for r in got.groupBy("target").agg(F.sum("taken").alias("taken")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.06)


def test_empty_tables(docs):
    assert M.planned(docs([])).count() == 0 and M.mix(docs([])).count() == 0
    assert [r.copies for r in M.planned(docs([None, ""])).collect()] == [0, 0]


def test_rows_without_a_key_or_with_one_key_fall_each_their_own_way(docs):
    """1000 rows without an id and 1000 of one id: the words taken come near the targets."""
    for key in (None, 7):
        rows = [(key, f"text number {i} of many words", "a") for i in range(1000)] + [(10_000 + i, "a b c d e", "b") for i in range(1000)]
        got = M.planned(docs(rows)).groupBy("source_size").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                                               F.first("target").alias("target")).collect()
        assert len(got) == 2 and all(abs(r.taken - r.target) < 0.1 * r.target for r in got), got
