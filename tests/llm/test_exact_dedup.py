import hashlib
import os

import numpy as np

from revlens.llm import exact_dedup as X


def test_perfect_hash_is_minimal_and_perfect():
    for n in (1, 2, 3, 17, 500, 6000):
        digests = np.frombuffer(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(n)), np.uint8).reshape(n, 32)
        displacement, slots = X.build_mph(digests)
        assert sorted(slots) == list(range(n))
        assert (X.lookup_mph(digests, displacement, n) == slots).all()
        other = np.frombuffer(os.urandom(32 * 50), np.uint8).reshape(50, 32)
        spots = X.lookup_mph(other, displacement, n)
        assert (0 <= spots).all() and (spots < n).all()


TEXTS = ["a", "b", "a", None, "", "A", "a ", "é", "a", "x" * 100_000, "x" * 100_000, "c", "c"]


def expected(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for doc, text in rows:
        g = groups[text or ""]
        keep = max((d for d in g if d is not None), default=None)
        out.append((doc, keep, len(g), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(history, arrivals, **options):
    out = X.exact_dedup(history, arrivals, **options)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out.collect()), key=str)


def test_history_and_arrivals(docs, clash):
    rows = list(enumerate(TEXTS)) + [(4, "a"), (None, "c"), (None, "only null"), (2, "a")]
    for split in (0, 5, len(rows)):
        frames = clash(docs(rows[:split])), clash(docs(rows[split:]))
        assert got(*frames, per_bucket=3) == expected(rows)


def test_repeats_are_marked(docs):
    out = X.exact_dedup(docs([(0, "a"), (1, "b")]), docs([(2, "a"), (3, "c"), (4, "c")])).collect()
    assert {r.doc_id: r.repeat for r in out} == {0: True, 1: False, 2: True, 3: False, 4: False}


def test_empty(docs):
    assert X.exact_dedup(docs([]), docs([])).count() == 0


def test_a_small_history_does_not_put_all_arrivals_in_one_bucket(docs, monkeypatch):
    used = []
    bucketed = X._bucketed
    monkeypatch.setattr(X, "_bucketed", lambda groups, buckets: used.append(buckets) or bucketed(groups, buckets))
    for history in ([], [(0, "old")]):
        out = X.exact_dedup(docs(history), docs([(i, f"text {i % 40}") for i in range(1, 101)]), per_bucket=10).collect()
        assert len(out) == 100 + len(history) and {r.group_size for r in out} <= {1, 2, 3}
    assert used and set(used) == {4}
