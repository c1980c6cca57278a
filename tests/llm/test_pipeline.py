"""The stages of corpus_pipeline on a hand-made corpus, each held against what its operator's own tests prove."""

import random

import corpus_pipeline as C
import revlens.llm.mixing as M
from revlens.llm.jaccard_join import words_of


def corpus(n=150):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(4)]
        if i % 4 == 0:
            lines[1] += " vile nasty"
        rows.append((i, "\n".join(lines), f"s{i % 4}"))
    near = rows[1][1].replace("\n", " ")  # one long line: a near copy no line of which repeats
    rows += [(500, near, "s0"), (501, near + " tail", "s1"), (502, rows[2][1] + "\nextra line of its own here", "s2"), (503, None, None), (504, "", "s0")]
    return rows


def test_stages_and_run(spark, docs, tmp_path):
    rows = corpus()
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = frame.columns
    sf = str(tmp_path)
    safe = C.toxicity(spark, frame, sf)
    assert safe.columns == columns
    kept = {r.doc_id for r in safe.collect()}
    assert kept == {d for d, t, _ in rows if not (t and "vile" in t)}
    lines = C.dedup_lines(spark, safe, sf)
    assert lines.columns == columns
    text = {r.doc_id: r.text for r in lines.collect()}
    assert text[502] == "extra line of its own here" and text[503] is None and text[504] == ""
    unique = C.join_near_copies(spark, frame, sf)
    assert unique.columns == columns
    left = {r.doc_id for r in unique.collect()}
    assert {500, 501}.isdisjoint(left) and 1 in left and len(words_of(rows[2][1])) == 120 and 502 not in left
    assert left == {d for d, _, _ in rows} - {500, 501, 502}
    mixed = C.mix_sources(spark, lines, sf)
    assert mixed.columns == columns
    assert mixed.count() == M.planned(lines).agg({"copies": "sum"}).first()[0]
    packed = C.run(spark, sf)
    assert packed.count() > 0 and {"sequence_id", "offset", "length"} <= set(packed.columns)
    assert [len(s) for s in C.STAGES] == [2] * 5


def test_rows_of_null_or_repeated_ids_are_told_apart(spark, docs):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    a, b, c, d, e = ("\n".join(" ".join(rng.choice(words) for _ in range(30)) for _ in range(3)) for _ in range(5))
    rows = [(1, a), (None, a + " tail"), (None, b), (2, c), (3, c), (3, d), (4, e), (4, e)]
    left = sorted((r.doc_id or 0, r.text) for r in C.join_near_copies(spark, docs(rows), "").collect())
    assert left == sorted([(1, a), (0, b), (2, c), (3, d), (4, e)])
    lines = [x.split("\n") for x in (a, b, c, d, e)]
    rows = [(None, a), (None, "\n".join([lines[1][0], lines[1][1]])), (1, "\n".join([lines[2][0], lines[0][1]])),
            (2, d), (2, "\n".join([lines[4][0], lines[4][1]])), (3, "\n".join([lines[3][0], lines[2][2]])), (4, e[:0]), (5, lines[4][2]), (5, lines[4][2])]
    left = sorted((r.doc_id or 0, r.text) for r in C.dedup_lines(spark, docs(rows), "").collect())
    assert left == sorted([(0, a), (0, rows[1][1]), (1, lines[2][0]), (2, d), (2, rows[4][1]), (3, lines[2][2]), (4, ""), (5, lines[4][2])])
