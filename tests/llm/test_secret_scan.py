import hashlib
import random
import re

from revlens.llm import secret_scan as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


PIECES = ["password", "passwd=", "secret", "token", "api_key", "apiKEY", "=", ": ", '"', "'", " ", "abcdefg", "12345", "AKIA", "A" * 16,
          "0123456789abcdef" * 2, "é", "😀", "\n", "AKIAAKIA", "Z9" * 8, "deadbeef", ".", "--"]


def texts():
    rng = random.Random(12)
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    return out + [None, "", "secret=token: abcdefgh", "token=abc", "é😀 password: hunter22 é", "token = '" + "ab12" * 9 + "'", "token=abcdef " * 3000,
                  "x" * 50_000]


def scanned(df):
    rows, spans = S.secret_spans(df)
    by = {}
    for r in spans.join(rows, "row").collect():
        by.setdefault(r.key, []).append((r.start, r.kind, r.end))
    return {k: sorted(v) for k, v in by.items()}


def test_base_spans_equal_brute_force(docs, clash):
    got = scanned(clash(docs(texts())))
    for i, t in enumerate(texts()):
        assert [x for x in got.get(i, []) if x[1] < 3] == base(t), t and t[:80]


def test_models_tell_random_from_ordinary(docs):
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    word = lambda: "".join(rng.choice(["tion", "ing", "the", "re", "ment", "er", "on", "is"]) for _ in range(rng.randint(6, 9)))
    rows = [f"token={draw(32)} and {word()}" for _ in range(150)] + [f"{word()} {word()}" for _ in range(300)]
    planted = draw(40)
    rows += [f"see {planted} here", f"see {word()}_{word()} here"]
    got = scanned(docs(rows))
    assert got[450] == [(4, 3, 44)] and 451 not in got
    assert all(k[1] != 3 for i in range(150) for k in got[i])  # inside a base span: not said twice


def test_digest_columns_and_empty(spark, tmp_path, docs):
    docs(texts()).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in S.op8_secrets(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts()):
        joined = ",".join(f"{S.KINDS[k]}:{a}:{z}" for a, k, z in base(t))
        assert out[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [out[i].n_assign, out[i].n_access, out[i].n_hex] == [sum(k == n for _, k, _ in base(t)) for n in range(3)]
    docs([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert S.op8_secrets(spark, f"{tmp_path}/none").count() == 0


def test_no_python_in_the_plan(docs):
    rows, spans = S.secret_spans(docs(texts()[:5]))
    plan = spans._jdf.queryExecution().toString() + S.matched(docs(["x"]), "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
