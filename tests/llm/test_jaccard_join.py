import random
from collections import Counter

import numpy as np

from revlens.llm import jaccard_join as J


def brute(rows):
    """(class, links) per row position, by comparing all pairs of shingle sets."""
    sets, words = [], []
    for _, text in rows:
        w = J.words_of(text or "")
        words.append(tuple(w))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, parent = Counter(), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [(doc, low.get(find(i)), links[i]) for i, (doc, _) in enumerate(rows)]


def near_copies(rng, n):
    base = ["b%d" % rng.randrange(500) for _ in range(150)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = "e%d_%d" % (k, rng.randrange(9))
        out.append(" ".join(w))
    return out


def check(docs, rows, extra=lambda x: x, **options):
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in J.jaccard_join(extra(docs(rows)), **options).collect())
    assert got == Counter(brute(rows))


def test_equals_brute_force(docs, clash):
    rng = random.Random(1)
    texts = near_copies(rng, 60) + near_copies(rng, 3) + [" ".join("w%d" % rng.randrange(4000) for _ in range(80)) for _ in range(60)]
    passage = " ".join("p%d" % i for i in range(60))  # common passage, unlike documents
    texts += [passage + " " + " ".join("q%d" % rng.randrange(9000) for _ in range(90)) for _ in range(40)]
    texts += [None, "", "...", "one two", "One, TWO!", "one two three", "x " * 30_000, "x " * 30_001, texts[0], texts[0]]
    rng.shuffle(texts)
    rows = [(3 * i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (0, texts[0])]
    # small parts and blocks: every split level and block pair is used
    check(docs, rows, clash, small=4, block=16)


def test_empty_and_wordless(docs):
    assert J.jaccard_join(docs([])).count() == 0
    rows = J.jaccard_join(docs(["", None, "?"])).collect()
    assert all(r.kept and r.class_id == r.doc_id and r.n_links == 0 for r in rows)


def test_runs_follow_from_recall():
    assert 1 - (1 - 0.8 ** J.DEPTH) ** J.runs_for(0.8, 0.999) >= 0.999


def test_recall_of_short_texts_at_the_threshold(docs):
    """Pairs of 9 to 25 words at a similarity of 0.8 or little more: nearly all are found."""
    rng = random.Random(4)
    texts = []
    for k in range(600):
        n = rng.choice([8, 12, 16, 20])                  # shingles of the shorter text; n / 4 words are added
        words = ["t%d_%d" % (k, i) for i in range(n + 4)]
        texts += [" ".join(words), " ".join(words + ["u%d_%d" % (k, i) for i in range(n // 4)])]
    rows = list(enumerate(texts))
    assert all(links == 1 for _, _, links in brute(rows[:40]))
    got = [r.n_links for r in J.jaccard_join(docs(rows)).collect()]
    assert set(got) <= {0, 1} and sum(got) >= 0.99 * len(rows)


def test_sampled_tokens_are_independent():
    """Small sets at 0.8: agreement of 64 tokens spreads as that of independent draws does."""
    rng = np.random.default_rng(3)
    sampler = J.Sampler(J.runs_for())
    shares = []
    for _ in range(800):
        union = rng.integers(1, 2 ** 62, 10, dtype=np.int64).astype(np.uint64) * np.uint64(3)
        shares.append((sampler.sample(np.sort(union[:9])) == sampler.sample(np.sort(union[1:]))).mean())
    assert abs(np.mean(shares) - 0.8) < 0.01 and 0.04 < np.std(shares) < 0.06    # sqrt(0.8 * 0.2 / 64) = 0.05
    assert np.mean(np.array(shares) < J.ESTIMATE) < 0.005
