import random
import re

import pytest
from rows import ODD, frame, sentence

from fairsketch.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    hits = [(i, label) for p, label in PHRASES for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({l for _, l in hits})))


def texts():
    rng = random.Random(5)
    out = list(ODD) + ["MIT License, mit-license; MIT\nLICENSE mit licenses", "the Apache License", "GNU General Public License"]
    for _ in range(60):
        parts = [sentence(rng, rng.randint(0, 30)) for _ in range(3)]
        out.append(rng.choice(["MIT License ", "general public\tlicense ", "Apache  License", "license mit "]).join(parts))
    return out


def test_base_columns_equal_brute_force(spark):
    ts = texts()
    rows = {r.doc_id: r for r in licenses.license_scan(frame(spark, ts)).collect()}
    for i, t in enumerate(ts):
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


@pytest.mark.parametrize("text,label", [
    ("Licensed under the Apache License, Version 2.0 (the License)", "apache-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("under the terms of the GNU Lesser General Public License version 2.1", "lgpl-2.1"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("released under the GNU GPL v3", "gpl-3.0"),
    ("Mozilla Public License 2.0", "mpl-2.0"),
    ("nothing to see here", ""),
])
def test_labels(spark, text, label):
    r = licenses.license_scan(frame(spark, [text])).collect()[0]
    assert label in r.labels.split(",")


def test_contained_detections_are_suppressed():
    text = "this is distributed under the gnu lesser general public license version 2.1 only"
    kept = licenses.detections(text, set(text.replace(".", " ").split()))
    spans = [(a, b) for _, a, b in kept]
    assert not any(x != y and x[0] <= y[0] and y[1] <= x[1] for x in spans for y in spans)
    assert [licenses._RULES[k].label for k, _, _ in kept] == ["lgpl-2.1"]


def test_hundreds_of_rules_by_priority():
    priorities = [r.priority for r in licenses.rules()]
    assert len(priorities) > 300 and priorities == sorted(priorities, reverse=True)


def test_keyword_gate_loses_nothing():
    """Every name in every form is found although only gated rules run."""
    for name in ("mit license", "isc license", "boost software license", "eclipse public license", "gnu gplv3", "lgpl 2.1"):
        for form in ("licensed under the {}", "a copy of the {}", "{}"):
            text = form.format(name)
            assert licenses.detections(text, set(re.findall(r"\w+", text)))


def test_null_ids_repeated_rows_extra_columns_and_empty_table(spark):
    df = frame(spark, ["mit license", "mit license", None], ids=[None, 7, 7]).selectExpr("*", "1 as labels", "2 as n_words")
    rows = licenses.license_scan(df).collect()
    assert sorted((r.doc_id is None, r.n_base) for r in rows) == [(False, 0), (False, 1), (True, 1)]
    assert licenses.license_scan(df.limit(0)).count() == 0
