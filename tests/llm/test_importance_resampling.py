import hashlib
import math
import random
import re
import zlib
from collections import Counter

from revlens.llm import importance_resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return len(w), [f.encode() for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(rows, target, buckets=10_000, min_words=20, share=25):
    fs = [(doc, *features(t)) for doc, t in rows]
    s = Counter(zlib.crc32(f) % buckets for *_, fl in fs for f in fl)
    t = Counter(zlib.crc32(f) % buckets for x in target for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for place, (doc, n, fl) in enumerate(fs):
        gains = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in (zlib.crc32(f) % buckets for f in fl)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(fl), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, place])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {r[5]: i + 1 for i, r in enumerate(able[:share * len(able) // 100])}
    return sorted(str((*r[:4], drawn.get(r[5]))) for r in out)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "GAMMA", "été", "Ünder", "東京", "x1", "don't", "a-b", "q"] + [f"w{i}" for i in range(60)]
    return [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))) for _ in range(n)]


def test_crcs_equal_zlib():
    rng = random.Random(1)
    many = [rng.randbytes(n) for n in [0, 1, 1, 7, 511, 512, 513, 1024, 1025, 5000] * 5]
    assert R.crc32_all(many).tolist() == [zlib.crc32(m) for m in many]
    assert R.crc32_all([]).tolist() == []


def test_blocks_lose_no_feature(monkeypatch):
    long_word = "z" * 300
    sample = texts(2, 40) + [None, "", "one", " ".join(texts(3, 30)), long_word, f"{long_word} a {long_word}"]
    expected = [(features(t)[0], sorted(zlib.crc32(f) % 1000 for f in features(t)[1])) for t in sample]
    for block in (16, 100, 1 << 20):
        monkeypatch.setattr(R, "BLOCK", block)
        got = R.hashed_texts([None if t is None else t.encode() for t in sample], 2, 1000)
        assert [(w, sorted(int(x) for a in arrays for x in a)) for w, arrays in got] == expected
    three = R.hashed_texts([b"a b c d"], 3, 1 << 30)[0][1]
    wanted = [b"a", b"b", b"c", b"d", b"a b", b"b c", b"c d", b"a b c", b"b c d"]
    assert sorted(int(x) for a in three for x in a) == sorted(zlib.crc32(f) % (1 << 30) for f in wanted)


def test_equals_brute_force_with_cases(spark, docs, clash):
    rows = list(enumerate(texts(4, 120)))
    rows += [(500, None), (501, ""), (502, "W1 été " * 20_000), (None, texts(5, 1)[0] + " w1" * 30), (7, rows[7][1]), (8, rows[9][1])]
    rows += [(600 + i, rows[20][1] + " tail" * 25) for i in range(60)]
    target = texts(6, 8) + [None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = R.importance_resampling(clash(docs(rows)), clash(frame)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, target)
    few = R.importance_resampling(docs(rows), frame, buckets=70_000, share=100, min_words=0).collect()
    assert sorted(str(tuple(r)) for r in few) == brute(rows, target, 70_000, 0, 100)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert R.importance_resampling(docs([]), none).count() == 0
    got = R.importance_resampling(docs([(1, "a b"), (2, None)]), none).collect()
    assert sorted(str(tuple(r)) for r in got) == brute([(1, "a b"), (2, None)], [])
