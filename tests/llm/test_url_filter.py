import random
import re

from revlens.llm import url_filter as U


def glob_regex(glob):
    out = ""
    for part in re.findall(r"\*\*|\*|\?|[^*?]+", glob):
        out += {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part))
    return re.compile(out)


def test_automaton_equals_regular_expressions():
    rng = random.Random(9)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "ab"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    globs += ["a" * 130, "**" + "b" * 70 + "**", ""]
    urls = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["a" * 130, "b" * 200, ""]
    found = U.WildcardAutomaton(globs).matches([u.encode() for u in urls])
    for k, g in enumerate(globs):
        pattern = glob_regex(re.sub(r"\*{3,}", lambda m: m[0], g))
        for i, u in enumerate(urls):
            assert found[i, k] == bool(pattern.fullmatch(u)), (g, u)


def judged(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for h, p, v in U.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    verdict = next((v for g, v in U.GLOB_RULES if glob_regex(g).fullmatch(host + path)), U.DEFAULT_VERDICT)
    return host, path, None, verdict


URLS = ["http://example.org/es/1", "http://EXAMPLE.org/ES/1", "https://a.b.example.org/en/12?x=/es/", "http://org/", "http://org",
        "http://notexample.org/es/", "http://x.com/fr/", "http://com/de/1#y", "http://example.com:80/fr/", None, "", "example.org/es/",
        "http://cheap-pills.net/x", "http://spam-farm.net/", "ftp://a://b/c", "http:///path", "http://a.org\n/x", "://org/x",
        "http://x.net/" + "a" * 5000, "http://x.net?u=http://org/", "http://É.org/é", "http://a.com/x.org/"]


def test_rules(spark, clash):
    df = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(URLS)] + [(None, URLS[0], None), (0, URLS[0], "")],
                               "page_id long, url string, html string")
    rows = U.url_filter(clash(df).drop("host", "path")).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[r.page_id or 0]
        assert (r.host, r.path, r.rule, r.verdict) == judged(url), url
    clashing = U.url_filter(clash(df))
    assert clashing.where("page_id = 0").first().host == "example.org"


def test_empty(spark):
    assert U.url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0
