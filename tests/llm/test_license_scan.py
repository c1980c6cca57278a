import re

from revlens.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(low)
    starts = {}
    for phrase, label in L.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                starts.setdefault(label, []).append(i)
    every = [i for s in starts.values() for i in s]
    return len(words), len(every), min(every, default=None), max(every, default=None), ",".join(sorted(starts))


TEXTS = ["Licensed under CC BY 4.0. ALL rights-reserved; all rights reserved", None, "", "no words ... here É", "...",
         "the GNU General Public License, version 3", "cc by cc by cc BY", "x " * 60_000 + "cc by",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files "
         "to deal in the Software without restriction",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this to deal in software",
         "Licensed under the Apache License, Version 2.0", "Licensed under the terms of the Apache License 2.0",
         "Licensed under an Apache License, Version 2.0", "Copyright (c) 2020 Some Body All rights reserved"]


def test_base_matches_brute_force_and_templates_match_exactly(docs, clash):
    frame = clash(docs(TEXTS + TEXTS[:1]))
    rows = L.license_scan(frame).orderBy("doc_id").collect()
    assert len(rows) == len(TEXTS) + 1
    for r, text in zip(rows, TEXTS + TEXTS[:1]):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text[:50]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score < 1
    labels = [r.labels.split(",") for r in rows]
    assert "mit" in labels[8] and "mit" not in labels[9]
    assert "apache-2.0" in labels[10] and "apache-2.0" in labels[11] and "apache-2.0" not in labels[12]
    assert labels[13] == ["copyright", "reserved"]


def test_mark_up():
    a = L.TokenAutomaton(["one [[two [[three]]]] four", "five <<gap:2>> six", "[[seven]] eight"])
    def run(text):
        return [(t, s, e) for t, s, e in a.matches(L.words_of(text))]
    assert run("one four") == [(0, 0, 2)] and run("one two four") == [(0, 0, 3)]
    assert run("one two three four") == [(0, 0, 4)] and run("one three four") == []
    assert run("five six") == [(1, 0, 2)] and run("five a b six") == [(1, 0, 4)] and run("five a b c six") == []
    assert run("seven eight") == [(2, 0, 2), (2, 1, 2)]


def test_empty_table(docs):
    assert L.license_scan(docs([])).count() == 0
