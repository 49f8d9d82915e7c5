"""Operator 8, license scans: ordered signature rules over each whole text.

A rule is a regular expression with a label, a priority, a confidence and keywords.  Rules come
from hand-written license names and grant forms (every name in every form) plus hand-written body
sentences.  A text's words are looked up in the keyword list first (one vectorised pass over the
batch); only rules whose keywords all occur are run, so most texts meet no expression at all.

Detections are ordered by priority, then length, then place.  One that lies inside the span of an
earlier one is suppressed.  The labels of the rest are joined with the base labels, which always
stay; the score is the highest confidence among them (base phrases count ``BASE_SCORE``).

Rows are independent: no shuffle, no hot key.  A text is scanned whole.

Defined results.  Null or empty text: no words, no labels, score 0.  Null ids pass through.
Repeated rows are scanned alone.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm.words import LETTERS_DIGITS, Text, sums, texts

# The base phrases and their labels.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
BASE_SCORE = 0.6

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, detections array<struct<rule:int,label:string,start:int,end:int>>")

# Hand-written names: label, SPDX-style identifier, name (a space stands for any separators),
# words that a text must contain (a|b: one of them).
NAMES = [
    ("mit", "mit", r"mit(?: x11| expat)? licen[cs]e", "mit"),
    ("mit-0", "mit 0", r"mit no attribution(?: licen[cs]e)?", "mit attribution"),
    ("x11", "x11", r"x11 licen[cs]e", "x11"),
    ("apache-1.1", "apache 1 1", r"apache(?: software)? licen[cs]e,?(?: version)? 1 1", "apache"),
    ("apache-2.0", "apache 2 0", r"apache(?: software)? licen[cs]e,?(?: ?(?:version|v))? ?2(?: 0)?\b", "apache"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e", "apache"),
    ("gpl-1.0", "gpl 1 0", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: ?(?:version|v))? ?1(?: 0)?\b", "general|gpl|gpl1|gplv1"),
    ("gpl-2.0", "gpl 2 0", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: ?(?:version|v))? ?2(?: 0)?\b", "general|gpl|gpl2|gplv2"),
    ("gpl-3.0", "gpl 3 0", r"(?:gnu )?(?:general public licen[cs]e|gpl)(?: ?(?:version|v))? ?3(?: 0)?\b", "general|gpl|gpl3|gplv3"),
    ("gpl", "gpl", r"(?:gnu )?general public licen[cs]e", "general public"),
    ("lgpl-2.0", "lgpl 2 0", r"(?:gnu )?library general public licen[cs]e", "library general"),
    ("lgpl-2.1", "lgpl 2 1", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: ?(?:version|v))? ?2 1", "lesser|lgpl|lgpl2|lgplv2"),
    ("lgpl-3.0", "lgpl 3 0", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: ?(?:version|v))? ?3(?: 0)?\b", "lesser|lgpl|lgpl3|lgplv3"),
    ("lgpl", "lgpl", r"(?:gnu )?lesser general public licen[cs]e", "lesser general"),
    ("agpl-3.0", "agpl 3 0", r"(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: ?(?:version|v))? ?3(?: 0)?\b", "affero|agpl|agpl3|agplv3"),
    ("agpl", "agpl", r"(?:gnu )?affero general public licen[cs]e", "affero"),
    ("gfdl", "gfdl", r"(?:gnu )?free documentation licen[cs]e", "documentation"),
    ("bsd-2-clause", "bsd 2 clause", r"(?:simplified|freebsd|2 clause|two clause) bsd licen[cs]e|bsd 2 clause(?: licen[cs]e)?", "bsd"),
    ("bsd-3-clause", "bsd 3 clause", r"(?:new|modified|revised|3 clause|three clause) bsd licen[cs]e|bsd 3 clause(?: licen[cs]e)?", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", r"(?:original|4 clause|four clause) bsd licen[cs]e|bsd 4 clause(?: licen[cs]e)?", "bsd"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e", "bsd"),
    ("0bsd", "0bsd", r"zero clause bsd(?: licen[cs]e)?", "zero bsd"),
    ("isc", "isc", r"isc licen[cs]e", "isc"),
    ("mpl-1.1", "mpl 1 1", r"mozilla public licen[cs]e,?(?: ?(?:version|v))? ?1 1", "mozilla"),
    ("mpl-2.0", "mpl 2 0", r"mozilla public licen[cs]e,?(?: ?(?:version|v))? ?2(?: 0)?\b", "mozilla"),
    ("mpl", "mpl", r"mozilla public licen[cs]e", "mozilla"),
    ("epl-1.0", "epl 1 0", r"eclipse public licen[cs]e,?(?: ?(?:version|v))? ?1(?: 0)?\b", "eclipse"),
    ("epl-2.0", "epl 2 0", r"eclipse public licen[cs]e,?(?: ?(?:version|v))? ?2(?: 0)?\b", "eclipse"),
    ("epl", "epl", r"eclipse public licen[cs]e", "eclipse"),
    ("eupl", "eupl 1 2", r"european union public licen[cs]e", "european"),
    ("cddl", "cddl 1 0", r"common development and distribution licen[cs]e", "common distribution"),
    ("cpl", "cpl 1 0", r"common public licen[cs]e", "common public"),
    ("artistic-2.0", "artistic 2 0", r"artistic licen[cs]e 2(?: 0)?\b", "artistic"),
    ("artistic", "artistic 1 0", r"artistic licen[cs]e", "artistic"),
    ("bsl-1.0", "bsl 1 0", r"boost software licen[cs]e", "boost"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("unlicense", "unlicense", r"the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"do what the fuck you want to public licen[cs]e", "want"),
    ("cc0-1.0", "cc0 1 0", r"cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?", "cc0"),
    ("cc-by-nc", "cc by nc 4 0", r"(?:creative commons|cc) (?:attribution|by) (?:non ?commercial|nc)", "nc|non|noncommercial"),
    ("cc-by-nc", "cc by nc 3 0", r"creative commons attribution non ?commercial", "creative"),
    ("cc-by-sa", "cc by sa 4 0", r"creative commons attribution share ?alike", "creative"),
    ("cc-by-nd", "cc by nd 4 0", r"creative commons attribution no ?deriv(?:ative)?s", "creative"),
    ("cc-by", "cc by 4 0", r"creative commons attribution(?: \d 0)?(?: international)?(?: licen[cs]e)?", "creative"),
    ("odbl", "odbl 1 0", r"open database licen[cs]e", "database"),
    ("ofl-1.1", "ofl 1 1", r"(?:sil )?open font licen[cs]e", "font"),
    ("python-2.0", "python 2 0", r"python software foundation licen[cs]e", "python"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", "postgresql"),
    ("ms-pl", "ms pl", r"microsoft public licen[cs]e", "microsoft"),
]

# Hand-written forms: text around a name, priority, confidence, words that a text must contain.
FORMS = [
    (r"spdx license identifier {spdx}\b", 100, 1.0, "spdx"),
    (r"(?:dual|tri|multi) licen[cs]ed under(?: the)? {name}", 90, 0.95, "under"),
    (r"(?:is |are )?(?:licen[cs]ed|released|distributed|published|provided|made available) under(?: the)?(?: terms of(?: the)?)? {name}",
     85, 0.95, "under"),
    (r"under the terms(?: and conditions)? of(?: the)? {name}", 80, 0.9, "terms"),
    (r"(?:subject to|governed by|covered by)(?: the)?(?: terms of(?: the)?)? {name}", 75, 0.85, ""),
    (r"(?:copy|text) of(?: the)? {name}", 65, 0.8, ""),
    (r"{name}", 40, 0.7, ""),
]

# Hand-written sentences of license bodies: label, text, needed words.
BODIES = [
    ("mit", r"permission is hereby granted,? free of charge,? to any person", "hereby granted"),
    ("mit", r"the above copyright notice and this permission notice shall be included", "notice included"),
    ("bsd", r"redistribution and use in source and binary forms", "redistribution binary"),
    ("bsd-3-clause", r"neither the name of .{1,80} nor the names of its contributors", "neither contributors"),
    ("isc", r"permission to use,? copy,? modify,? and or distribute this software for any purpose", "permission distribute"),
    ("gpl", r"this program is free software:? you can redistribute it and or modify it", "program redistribute"),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "compliance"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", r"(?:dedicated|released|placed) (?:to|in|into) the public domain", "domain"),
    ("proprietary", r"all rights reserved", "reserved"),
    ("zlib", r"this software is provided as is,? without any express or implied warranty", "implied warranty"),
    ("wtfpl", r"you just do what the fuck you want to", "want"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    priority: int
    score: float
    needs: tuple  # sets of words; a text must hold one word of each


def _expression(text: str) -> re.Pattern:
    return re.compile(r"(?<![0-9a-z])" + text.replace(",?", "").replace(" ?", r"[\W_]*").replace(" ", r"[\W_]+"), re.S)


def _words(text: str) -> tuple:
    return tuple(frozenset(w.split("|")) for w in text.split())


def rules() -> list[Rule]:
    """All rules, highest priority first; equal priorities keep the order of the tables."""
    made = [Rule(label, _expression(form.format(name=f"(?:{name})", spdx=spdx)), priority, score,
                 _words(f"{need} {words if '{name}' in form else ''}"))
            for form, priority, score, need in FORMS for label, spdx, name, words in NAMES]
    made += [Rule(label, _expression(text), 70, 0.9, _words(need)) for label, text, need in BODIES]
    return sorted(made, key=lambda r: -r.priority)


_RULES = rules()
_NEEDED = sorted({w for r in _RULES for some in r.needs for w in some})


def _fingerprints(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return Text(data, np.array([0, len(data)]), LETTERS_DIGITS).hashes()


def detections(text: str, present: set[str]) -> list[tuple[int, int, int]]:
    """(rule, start, end) of the detections that no earlier one contains; places in characters."""
    found = []
    for k, rule in enumerate(_RULES):
        if all(some & present for some in rule.needs):
            found += [(k, m.start(), m.end()) for m in rule.pattern.finditer(text)]
    found.sort(key=lambda d: (-_RULES[d[0]].priority, d[1] - d[2], d[1], d[0]))
    kept: list[tuple[int, int, int]] = []
    spans: list[tuple[int, int]] = []  # kept spans by start, none inside another
    for k, a, b in found:
        if not any(x <= a and b <= y for x, y in spans):
            kept.append((k, a, b))
            spans = [s for s in spans if not (a <= s[0] and s[1] <= b)] + [(a, b)]
    return sorted(kept, key=lambda d: (d[1], d[2], d[0]))


def _scan(ids, col) -> Iterator[pa.RecordBatch]:
    phrases = [(_fingerprints(p.split()), label) for p, label in BASE_PHRASES]
    needed = _fingerprints(_NEEDED)
    by = np.argsort(needed)
    for lo, hi, t in texts(col, LETTERS_DIGITS, lower=True):
        h = t.hashes()
        start, label_of = [], []
        for phrase, label in phrases:
            k = len(phrase)
            if len(h) < k:
                continue
            hit = np.ones(len(h) - k + 1, bool)
            for j in range(k):
                hit &= h[j:len(h) - k + 1 + j] == phrase[j]
            at = np.flatnonzero(hit)
            at = at[at + k <= t.first[t.doc[at] + 1]]
            start.append(at)
            label_of += [label] * len(at)
        start = np.concatenate(start) if start else np.zeros(0, np.int64)
        doc = t.doc[start]
        n_base = np.bincount(doc, minlength=t.n)
        big = np.iinfo(np.int64).max
        first, last = np.full(t.n, big), np.full(t.n, -1)
        np.minimum.at(first, doc, start - t.first[doc])
        np.maximum.at(last, doc, start - t.first[doc])
        base: list[set] = [set() for _ in range(t.n)]
        for d, label in zip(doc.tolist(), label_of):
            base[d].add(label)

        place = np.minimum(np.searchsorted(needed[by], h), len(needed) - 1)
        is_key = needed[by][place] == h
        keyed = np.unique(t.doc[is_key] * len(needed) + by[place[is_key]])
        present: dict[int, set] = {}
        for x in keyed.tolist():
            present.setdefault(x // len(needed), set()).add(_NEEDED[x % len(needed)])
        found: list[list] = [[] for _ in range(t.n)]
        for d, words in present.items():
            found[d] = detections(t.data[t.offsets[d]:t.offsets[d + 1]].tobytes().decode("utf-8", "replace"), words)

        labels = [",".join(sorted(b | {_RULES[k].label for k, _, _ in f})) for b, f in zip(base, found)]
        scores = [max([BASE_SCORE if b else 0.0, *(_RULES[k].score for k, _, _ in f)]) for b, f in zip(base, found)]
        none = n_base == 0
        yield pa.RecordBatch.from_arrays(
            [ids[lo:hi], pa.array(t.counts, pa.int64()), pa.array(n_base, pa.int64()),
             pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none),
             pa.array([",".join(sorted(b)) for b in base], pa.string()), pa.array(labels, pa.string()),
             pa.array(scores, pa.float64()),
             pa.array([[{"rule": k, "label": _RULES[k].label, "start": a, "end": b} for k, a, b in f] for f in found],
                      pa.list_(pa.struct([("rule", pa.int32()), ("label", pa.string()),
                                          ("start", pa.int32()), ("end", pa.int32())])))],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: base counts and labels, all labels, score and the detections."""

    def run(batches):
        for b in batches:
            yield from _scan(b.column(0), b.column(1))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
