"""License scans against a plain scan with the same rules."""

import re

from keyfold.llm import licenses

TEXTS = [
    None,
    "",
    "!!! ,,",
    "no words é ÀÉ Ä",
    "Released under the MIT License. Under the MIT license; cc-by-nc CC BY NC. cc by nc-sa 4.0",
    "SPDX-License-Identifier: GPL-3.0-or-later. See the GNU Lesser General Public License version 2.1",
    "under the terms of the Apache License, Version 2.0; a copy of the Mozilla Public License v2 or v 2",
    "cc by nc cc by nc under the mit license " * 800,
    "in the public domain; gplv3 the GNU GPL and BSD-3-Clause license, creative commons attribution-sharealike 4.0",
    "apache license version 2",
    "xapache license version 2 under the mit licenses",
    "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.",
]


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    spaced = "".join(f" {w} " for w in words)
    spans = []
    for no, rule in enumerate(licenses.default_rules()):
        for m in re.finditer(rule.pattern, spaced):
            start = spaced[: m.start()].count(" ")
            spans.append((start // 2, (start + m[0].count(" ") + 1) // 2, rule.priority, no, rule.label, rule.confidence))

    def hidden(a):
        for b in spans:
            if b is not a and b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2]:
                if (b[0], b[1]) != (a[0], a[1]) or b[2] > a[2] or b[3] < a[3]:
                    return True
        return False

    left = sorted((a for a in spans if not hidden(a)), key=lambda a: (a[0], -a[1], -a[2], a[3])) if len(spans) < 2000 else None
    return words, base, left


def test_scan_equals_plain_scan(spark):
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate([*TEXTS, *TEXTS[:3]])], "doc_id BIGINT, text STRING, labels STRING")
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words, base, left = brute(r.text)
        places = [i for i, _ in base]
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        if left is not None:
            assert [(d.start, d.end, d.label) for d in r.detections] == [(a[0], a[1], a[4]) for a in left]
            assert r.labels == ",".join(sorted({label for _, label in base} | {a[4] for a in left}))
            assert r.score == (1.0 if base else max((a[5] for a in left), default=0.0))
        assert 0 <= r.score <= 1


def examples(pattern):
    """Texts of the pattern that together take every alternative, with and without optional parts."""
    pattern = re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)
    for nth in range(12):
        for optional in (True, False):
            text = pattern
            while "(?:" in text:
                group = re.search(r"\(\?:([^()]*)\)(\??)", text)
                choices = group[1].split("|")
                own = "" if group[2] and not optional else choices[min(nth, len(choices) - 1)]
                text = text[: group.start()] + own + text[group.end() :]
            yield re.sub(r".\?", "", text)


def test_hundreds_of_rules_pass_their_gates():
    rules = licenses.default_rules()
    assert len(rules) > 200
    for rule in rules:
        for text in examples(rule.pattern):
            assert re.fullmatch(rule.pattern, text), (rule, text)
            assert any(gate in text for gate in licenses.GATES), (rule, text)
            assert rule.keyword in text, (rule, text)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id BIGINT, text STRING")
    assert "Python" not in licenses.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id BIGINT, text STRING")).count() == 0


def test_a_hundred_thousand_hits_take_time_in_proportion(spark):
    import time

    seconds, found = [], []
    for n in (6_000, 36_000):
        docs = spark.createDataFrame([("cc by mit license " * n,)], "text STRING")
        start = time.perf_counter()
        row = licenses.scan_licenses(docs).first()
        seconds.append(time.perf_counter() - start)
        found.append(row)
        assert row.n_words == 4 * n
        assert {"cc-by", "mit"} <= set(row.labels.split(","))
    assert len(found[1].detections) >= 36_000
    assert seconds[1] < 12 * seconds[0] + 5
