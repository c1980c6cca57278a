"""Licence scan: template mark-up compiled into one token automaton.

A template is text with two kinds of mark-up: ``[[...]]`` is optional wording and
may nest; ``<<name:n>>`` is replaceable, any run of up to n words.  All else is
mandatory and must match word for word.  All templates and base phrases become one
non-deterministic automaton over words, made deterministic lazily while it runs:
a set of states and a word (or "any other word") give the next set.  The automaton
starts at every word that can begin a template and runs until no state is left,
so the work per start is bounded by the longest template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import full_text, table

# Fixed values of the contract: phrase and label.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: The method's templates: (label, mark-up).
TEMPLATES = [
    ("apache-2.0", "licensed under [[the terms of]] the apache license [[version]] 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met"),
    ("bsd", "licensed under [[the terms of]] the [[<<clauses:1>> clause]] bsd license"),
    ("cc-by", "licensed under [[a <<kind:1>>]] creative commons attribution <<variant:4>> [[international]] license"),
    ("cc-by-nc", "cc by nc [[sa]] [[nd]]"),
    ("copyright", "copyright [[c]] <<years:3>> <<holder:8>> all rights reserved"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]] general public "
            "license as published by the free software foundation"),
    ("gpl", "licensed under [[the terms of]] the gnu [[lesser]] [[affero]] general public license [[version <<version:2>>]]"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this <<work:12>> to deal in the <<what:3>> "
            "without restriction"),
    ("mit", "[[released]] [[licensed]] under [[the terms of]] the mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license [[v]] [[version]] 2 0"),
    ("public-domain", "released [[in]] [[into]] [[to]] the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("spdx", "spdx license identifier"),
]

_SEPARATORS = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
_MARK = re.compile(r"\[\[|\]\]|<<\w+:\d+>>|[^\s\[\]<>]+")


def words_of(text: str) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


def parsed(template: str) -> list:
    """Mark-up -> nested list of words, ('optional', [...]) and ('gap', n)."""
    stack: list[list] = [[]]
    for part in _MARK.findall(template):
        if part == "[[":
            stack.append([])
        elif part == "]]":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif part.startswith("<<"):
            stack[-1].append(("gap", int(part[2:-2].rpartition(":")[2])))
        else:
            stack[-1].extend(w.decode() for w in words_of(part))
    if len(stack) != 1:
        raise ValueError(f"unbalanced mark-up: {template}")
    return stack[0]


def mandatory(items: list) -> int:
    return sum(isinstance(x, str) for x in items)


class TokenAutomaton:
    """All templates at once; accepting states carry template numbers."""

    def __init__(self, templates: list[str]):
        self.on_word: list[dict[bytes, int]] = []
        self.on_any: list[int | None] = []
        self.skips: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        starts = []
        for number, template in enumerate(templates):
            first = self._state()
            starts.append(first)
            self.accepts[self._add(parsed(template), first)] = number
        self.vocabulary = {w for edges in self.on_word for w in edges}
        self.start = self._closed(starts)
        self.memo: dict[tuple[frozenset, bytes | None], frozenset] = {}
        self.ends: dict[frozenset, tuple[int, ...]] = {}
        self.can_start = {w for s in self.start for w in self.on_word[s]}
        self.starts_free = any(self.on_any[s] is not None for s in self.start)

    def _state(self) -> int:
        self.on_word.append({})
        self.on_any.append(None)
        self.skips.append([])
        return len(self.skips) - 1

    def _add(self, items: list, at: int) -> int:
        for item in items:
            after = self._state()
            if isinstance(item, str):
                self.on_word[at][item.encode()] = after
            elif item[0] == "optional":
                self.skips[self._add(item[1], at if not self.on_word[at] and self.on_any[at] is None else self._after(at))].append(after)
                self.skips[at].append(after)
            else:
                for _ in range(item[1]):
                    step = self._state()
                    self.on_any[at] = step
                    self.skips[at].append(after)
                    at = step
                self.skips[at].append(after)
            at = after
        return at

    def _after(self, at: int) -> int:
        fresh = self._state()
        self.skips[at].append(fresh)
        return fresh

    def _closed(self, states) -> frozenset:
        seen, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self.skips[s]
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        mark = (states, word if word in self.vocabulary else None)
        if mark not in self.memo:
            moved = [self.on_word[s][word] for s in states if word in self.on_word[s]]
            moved += [self.on_any[s] for s in states if self.on_any[s] is not None]
            self.memo[mark] = self._closed(moved)
            self.ends[self.memo[mark]] = tuple(sorted(self.accepts[s] for s in self.memo[mark] if s in self.accepts))
        return self.memo[mark]

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(template, start, end): per start and template the longest accepted run."""
        begin = self.can_start
        for at in range(len(words)) if self.starts_free else [i for i, w in enumerate(words) if w in begin]:
            states, found = self.start, {}
            for i in range(at, len(words)):
                states = self.step(states, words[i])
                if not states:
                    break
                for t in self.ends[states]:
                    found[t] = i + 1
            for t in sorted(found):
                yield t, at, found[t]


def weight(template: str) -> float:
    """Evidence of one match: mandatory words against four."""
    n = mandatory(parsed(template))
    return n / (n + 4)


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=tuple(TEMPLATES)) -> DataFrame:
    """One row per row of ``docs``: (key, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans).

    ``spans`` lists label:start:end in words, of base phrases and templates.
    ``score`` is the largest weight of a match, 0 without one.  Null text counts as
    empty: no words, null positions, empty labels, score 0.  Repeated rows are
    scanned each; other columns are not read; an empty table gives an empty table.
    One narrow pass, whole texts, no shuffle."""
    marked = [p for p, _ in BASE] + [t for _, t in templates]
    names = [n for _, n in BASE] + [n for n, _ in templates]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = TokenAutomaton(marked)
        weights = [weight(t) for t in marked]
        for batch in batches:
            out = []
            for doc, content in zip(batch["key"], batch["text"]):
                words = words_of(content)
                found = list(automaton.matches(words))
                base = [start for t, start, _ in found if t < len(BASE)]
                out.append((doc, len(words), len(base), base[0] if base else None, base[-1] if base else None,
                            ",".join(sorted({names[t] for t, _, _ in found if t < len(BASE)})),
                            ",".join(sorted({names[t] for t, _, _ in found})),
                            max((weights[t] for t, _, _ in found), default=0.0),
                            ",".join(f"{names[t]}:{a}:{z}" for t, a, z in found)))
            frame = pd.DataFrame(out, columns=["key", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                               "labels", "score", "spans"])
            yield frame.astype({"first_word": "Int64", "last_word": "Int64"})

    slim = docs.select(F.col(key).cast("string").alias("key"), full_text(text).alias("text"))
    scanned = slim.mapInPandas(scan, "key string, n_words long, n_base long, first_word long, last_word long, "
                                     "base_labels string, labels string, score double, spans string")
    return scanned.select(F.col("key").cast(dict(docs.dtypes)[key]).alias(key), *[c for c in scanned.columns if c != "key"])


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def _regex(items: list) -> str:
    return "".join(x + " " if isinstance(x, str) else f"(?:{_regex(x[1])})?" if x[0] == "optional" else f"(?:[^ ]+ ){{0,{x[1]}}}"
                   for x in items)


def _sql() -> str:
    def places(phrase: str) -> str:
        words = phrase.split()
        return "list_filter(range(0, len(w)), lambda i: " + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words)) + ")"

    marked = [(n, _regex(parsed(p)), weight(p)) for p, n in BASE] + [(n, _regex(parsed(t)), weight(t)) for n, t in TEMPLATES]
    hits = ", ".join(f"CASE WHEN regexp_matches(j, ' {r}') THEN '{n}' END" for n, r, _ in marked)
    scores = ", ".join(f"CASE WHEN regexp_matches(j, ' {r}') THEN {s!r}::DOUBLE ELSE 0 END" for _, r, s in marked)
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{n}' END" for k, (_, n) in enumerate(BASE))
    every = "list_concat(" + "p0, list_concat(p1, p2))"
    return f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
j AS (
  SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS j,
         {", ".join(f"{places(p)} AS p{k}" for k, (p, _) in enumerate(BASE))} FROM t)
SELECT doc_id, n_words::BIGINT AS n_words, len({every})::BIGINT AS n_base, list_min({every})::BIGINT AS first_word,
       list_max({every})::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct([{base}])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct([{hits}])), ',') AS labels,
       greatest({scores}) AS score
FROM j
"""


SQL = _sql()
