import random
import re
from collections import Counter

import numpy as np
from rows import ODD, frame, sentence

from fairsketch.llm import repetition
from fairsketch.llm.words import texts as slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [l for l in text.split("\n") if WORD.search(l)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed)


def brute_repeats(w, k):
    best = []
    for i in range(len(w)):
        m = 0
        for j in range(len(w)):
            if i != j:
                l = 0
                while max(i, j) + l < len(w) and w[i + l] == w[j + l]:
                    l += 1
                m = max(m, l)
        best.append(m if m >= k else 0)
    return best


def sample():
    rng = random.Random(3)
    out = list(ODD)
    for _ in range(40):
        parts = [sentence(rng, rng.randint(1, 50)) for _ in range(3)]
        out.append("".join(rng.choice(parts) + rng.choice(["", "#$ | ", "\n"]) for _ in range(rng.randint(1, 6))))
    return out


def test_base_columns_equal_brute_force(spark):
    ts = sample()
    rows = {r.doc_id: r for r in repetition.quality_rules(frame(spark, ts)).collect()}
    for i, t in enumerate(ts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t
        assert not (r.kept and r.base_failed)


def test_longest_repeats_equal_brute_force():
    import pyarrow as pa

    ts = [t or "" for t in sample()]
    for k in (1, 4, 10):
        for lo, hi, text in slices(pa.array(ts), slice_bytes=3000):
            got = repetition.longest_repeats(text, text.hashes(), k)
            for d in range(hi - lo):
                w = WORD.findall(ts[lo + d])
                if len(w) <= 300:
                    assert got[text.first[d]:text.first[d + 1]].tolist() == brute_repeats(w, k)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 3, 200).astype(np.uint64)
    sa = repetition.suffix_array(keys, np.full(200, 200))
    suffixes = [keys[i:].tolist() for i in sa]
    assert suffixes == sorted(suffixes)


def test_verdicts(spark):
    rng = random.Random(9)
    unique = " ".join(f"w{i}{rng.random():.6f}" for i in range(400))
    block = " ".join(f"b{i}" for i in range(130))
    half = " ".join(f"c{i}" for i in range(20))
    docs = [unique, unique + " " + block + " x " + block, unique[:900] + (" " + half) * 3]
    rows = {r.doc_id: r for r in repetition.quality_rules(frame(spark, docs)).collect()}
    assert rows[0].kept and rows[0].longest_repeat == 0
    assert rows[1].longest_repeat == 130 and not rows[1].kept and not rows[1].base_failed
    assert rows[2].covered_words == 60 and rows[2].kept == (60 <= 0.3 * rows[2].n_words)


def test_edges(spark):
    df = frame(spark, [None, "a b", "a b"], ids=[None, 1, 1]).selectExpr("*", "true as kept")
    rows = repetition.quality_rules(df).collect()
    assert [r.base_failed for r in rows] == [True] * 3 and not any(r.kept for r in rows)
    assert repetition.quality_rules(df.limit(0)).count() == 0
