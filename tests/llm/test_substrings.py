import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from rows import ODD, frame, sentence

from fairsketch.llm import substrings as S
from fairsketch.llm.words import texts as slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, ids, window):
    words = [WORD.findall(t or "") for t in texts]
    least = {}
    for i, w in zip(ids, words):
        if i is not None:
            for p in range(len(w) - window + 1):
                key = tuple(w[p:p + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in zip(ids, words):
        gone = {q for p in range(len(w) - window + 1) if i is not None and least[tuple(w[p:p + window])] < i
                for q in range(p, p + window)}
        kept = [x for q, x in enumerate(w) if q not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def corpus(seed, n=70):
    rng = random.Random(seed)
    passages = [sentence(rng, rng.randint(8, 60)) for _ in range(8)] + ["a a a a a a a a ", "a b a b a b a b a b ", "x " * 30]
    return list(ODD) + ["".join(rng.choice(passages) if rng.random() < .5 else sentence(rng, rng.randint(1, 20))
                                for _ in range(rng.randint(1, 5))) for _ in range(n)]


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,window,rounds", [(1, 13, 3), (2, 13, 2), (3, 5, 1), (4, 2, 2), (5, 13, 5)])
def test_equals_brute_force(spark, seed, window, rounds):
    ts = corpus(seed)
    ids = list(range(len(ts)))
    random.Random(seed).shuffle(ids)
    assert got(S.substring_dedup(frame(spark, ts, ids), window, rounds)) == sorted(brute(ts, ids, window), key=str)


def test_repeated_and_null_ids_extra_columns(spark):
    ts = corpus(6, 30) * 2
    rng = random.Random(0)
    ids = [rng.choice([None, *range(12)]) for _ in ts]
    df = frame(spark, ts, ids).selectExpr("*", "1 as block", "2 as n_words")
    assert got(S.substring_dedup(df)) == sorted(brute(ts, ids, 13), key=str)


def test_empty_table_and_one_row(spark):
    assert S.substring_dedup(frame(spark, [])).count() == 0
    assert got(S.substring_dedup(frame(spark, ["one two"]))) == brute(["one two"], [0], 13)


def test_many_copies_and_a_long_text(spark):
    rng = random.Random(11)
    long = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(30000))
    ts = [long, long[:90000] + " tail " + long[40000:]] + [" ".join(f"c{i}" for i in range(40))] * 300
    assert got(S.substring_dedup(frame(spark, ts))) == sorted(brute(ts, range(len(ts)), 13), key=str)


def test_kept_text_cuts_spans_and_carries_columns(spark):
    a = " ".join(f"p{i}" for i in range(20))
    rows = {r.doc_id: r for r in S.substring_dedup(frame(spark, [a, f"head\nline {a}  tail\tend", "x  y"]), others=("lang",)).collect()}
    assert rows[1].kept_text == "head\nline tail\tend" and rows[2].kept_text == "x  y" and rows[1].lang == "en"


def test_equal_windows_have_equal_anchors():
    """The property that makes round one lossless, for windows in any surroundings."""
    rng = random.Random(4)
    ts = [t or "" for t in corpus(9, 200)]
    seen = {}
    for lo, hi, t in slices(pa.array(ts), slice_bytes=5000):
        h = t.hashes()
        for rounds in (1, 3, 6):
            at, anchor, prints = S.anchors(t, h, 13, rounds)
            for p, a, f in zip(at.tolist(), anchor.tolist(), prints.tolist()):
                assert seen.setdefault((rounds, tuple(h[p:p + 13].tolist())), (a, f)) == (a, f)
    assert len(seen) > 1000


def test_symbols_shrink_by_rounds():
    rng = np.random.default_rng(0)
    ts = pa.array([" ".join(map(str, rng.integers(0, 5000, 20000)))])
    for _, _, t in slices(ts):
        s = S.runs(t, t.hashes())
        sizes = [len(s.name)]
        for k in range(4):
            s = S.pairs(s, S._SALTS[1 + k], t.first)
            sizes.append(len(s.name))
    assert all(b < 0.8 * a for a, b in zip(sizes, sizes[1:]))
