"""URL rules simulated together by a bit-parallel wildcard automaton.

All glob rules are packed side by side into one row of 64-bit words.  Bit *i*
of a rule's span means "the first *i* symbols of the rule have been read".  A
byte *c* of the URL moves every rule at once (Shift-And with self-loops):

    S' = ((S << 1) & step[c]) | (S & loop[c])

``step[c]`` holds the states entered on *c*; ``loop[c]`` those that a wildcard
lets stay.  Rules run over the canonical URL: lower-cased host followed by the
path, query and fragment removed.  Globs: ``*`` any run without ``/``, ``**``
any run, ``?`` one byte other than ``/``; all else is literal and anchored at
both ends.

URLs of a batch advance together, one byte position at a time, so the Python
work per batch is proportional to its longest URL and everything else is numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SLASH = 0x2F

#: (host, path, verdict) of the contract; a rule fits its host and every subdomain.
HOST_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

#: Rules of the method for URLs that no host rule decides: (glob, verdict).
GLOB_RULES = [
    ("**cheap-pills**", "block"),
    ("spam-farm.**", "block"),
    ("**.spam-farm.**", "block"),
    ("**casino**", "block"),
    ("**/wp-login**", "block"),
]
DEFAULT_VERDICT = "allow"


class WildcardAutomaton:
    """Multiword Shift-And automaton of many globs."""

    def __init__(self, globs: list[str]):
        self.spans: list[int] = []
        steps: list[tuple[int, bytes]] = []
        loops: list[tuple[int, bytes]] = []
        every = bytes(range(256))
        no_slash = bytes(x for x in every if x != SLASH)
        starts, at = [], 0
        for glob in globs:
            starts.append(at)
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i:i + 2] == b"**":
                    loops.append((at, every))
                    i += 2
                elif raw[i:i + 1] == b"*":
                    loops.append((at, no_slash))
                    i += 1
                else:
                    at += 1
                    steps.append((at, no_slash if raw[i:i + 1] == b"?" else raw[i:i + 1]))
                    i += 1
            self.spans.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.step = self._masks(steps)
        self.loop = self._masks(loops)
        self.start = np.zeros(self.words, np.uint64)
        for bit in starts:
            self.start[bit // 64] |= np.uint64(1 << (bit % 64))

    def _masks(self, entries: list[tuple[int, bytes]]) -> np.ndarray:
        masks = np.zeros((256, self.words), np.uint64)
        for bit, chars in entries:
            masks[list(chars), bit // 64] |= np.uint64(1 << (bit % 64))
        return masks

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """Boolean matrix (url, glob)."""
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(urls) or b"\0", np.uint8)
        offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1][order]
        ordered = lengths[order]
        state = np.tile(self.start, (len(urls), 1))
        position = 0
        while True:
            live = int(np.searchsorted(-ordered, -position, side="left"))  # urls longer than position
            if not live:
                break
            now = state[:live]
            if not now.any():
                break
            shifted = now << np.uint64(1)
            if self.words > 1:
                shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            chars = data[offsets[:live] + position]
            state[:live] = (shifted & self.step[chars]) | (now & self.loop[chars])
            position += 1
        final = np.empty((len(urls), len(self.spans)), bool)
        for k, bit in enumerate(self.spans):
            final[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return final


def host_rule_globs(host: str, path: str) -> list[str]:
    """Globs of a host rule: the host itself and all subdomains, path as a prefix."""
    return [f"{host}{path}**", f"*.{host}{path}**"]


def canonical(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and
    ``path`` (then up to ``? #``); both empty for a null URL or one without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.expr(f"substring(coalesce({url}, ''), locate('://', coalesce({url}, '')) + 3)")).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumns({"host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower),
                              "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def url_filter(pages: DataFrame, key: str = "page_id", url: str = "url", host_rules=tuple(HOST_RULES),
               glob_rules=tuple(GLOB_RULES), default: str = DEFAULT_VERDICT) -> DataFrame:
    """Judge every URL: (key, host, path, rule, verdict, glob_rule).

    ``rule`` is the longest fitting host rule (host + path as text; equal
    lengths: first listed), else null; then the first fitting glob rule decides
    and is named in ``glob_rule``; then ``default``.  Only ``key`` and ``url`` are read, so
    other columns may have any name.  Null, empty and scheme-less URLs have an
    empty host and path, fit no host rule and get the globs' verdict on the empty
    string, normally ``default``.  Repeated rows are judged each; an empty table
    gives an empty table.  One narrow pass: no shuffle, nothing collected."""
    ranked = sorted(enumerate(host_rules), key=lambda r: (-len((r[1][0] + r[1][1]).encode()), r[0]))
    globs: list[str] = []
    owner: list[int] = []
    rules = [(h + p, v, None) for _, (h, p, v) in ranked] + [(None, v, g) for g, v in glob_rules]
    for k, (_, (h, p, _v)) in enumerate(ranked):
        for g in host_rule_globs(h, p):
            globs.append(g)
            owner.append(k)
    for k, (g, _v) in enumerate(glob_rules):
        globs.append(g)
        owner.append(len(ranked) + k)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = WildcardAutomaton(globs)
        names = np.array([r[0] for r in rules] + [None], object)
        verdicts = np.array([r[1] for r in rules] + [default], object)
        shown = np.array([r[2] for r in rules] + [None], object)
        for batch in batches:
            urls = [(h + p).encode("utf-8", "surrogatepass") for h, p in zip(batch["host"], batch["path"])]
            found = automaton.matches(urls)
            best = np.full(len(urls), len(rules))
            for column, k in enumerate(owner):
                best = np.where(found[:, column], np.minimum(best, k), best)
            yield pd.DataFrame({"key": batch["key"], "host": batch["host"], "path": batch["path"],
                                "rule": names[best], "verdict": verdicts[best], "glob_rule": shown[best]})

    slim = canonical(pages.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url"))).select("key", "host", "path")
    kind = dict(pages.dtypes)[key]
    judged = slim.mapInPandas(judge, "key string, host string, path string, rule string, verdict string, glob_rule string")
    return judged.select(F.col("key").cast(kind).alias(key), "host", "path", "rule", "verdict", "glob_rule")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def _like(glob: str) -> str:
    return "host || path LIKE '" + glob.replace("**", "%") + "'"


SQL = f"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM split),
rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in HOST_RULES)}),
ruled AS (
  SELECT hp.*, (SELECT arg_max(r.h || r.p, length(r.h || r.p)) FROM rules r
                WHERE (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)) AS rule FROM hp),
globbed AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN NULL {" ".join(f"WHEN {_like(g)} THEN '{g}'" for g, _ in GLOB_RULES)} END AS glob_rule FROM ruled)
SELECT page_id, host, path, rule,
       coalesce((SELECT v FROM rules WHERE h || p = rule), CASE WHEN glob_rule IS NOT NULL THEN 'block' ELSE '{DEFAULT_VERDICT}' END) AS verdict, glob_rule
FROM globbed
"""
