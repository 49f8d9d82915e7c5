import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from rows import ODD, frame, sentence

from fairsketch.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").lower())


def bm25(items, threshold):
    """Normalised impacts by item, written from the formula."""
    ws = [words(t) for t in items]
    n, avg = len(ws), sum(map(len, ws)) / len(ws)
    df = Counter(w for x in ws for w in set(x))
    out = []
    for x in ws:
        tf = Counter(x)
        imp = {w: math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c * 2.2 / (c + 1.2 * (.25 + .75 * len(x) / avg)) for w, c in tf.items()}
        out.append({w: v / sum(imp.values()) for w, v in imp.items()})
    return out


def setup(seed, n_items=40, n_docs=60):
    rng = random.Random(seed)
    items = [sentence(rng, rng.randint(6, 30)) for _ in range(n_items)]
    docs = []
    for _ in range(n_docs):
        parts = [sentence(rng, rng.randint(0, 90)) for _ in range(3)]
        if rng.random() < .5:
            w = rng.choice(items).split()
            parts[1] = " ".join(x for x in w if rng.random() > rng.choice([0, .1, .5])).upper()
        docs.append(" ".join(parts))
    return items, docs


def test_retrieval_equals_exhaustive_scoring():
    """No passage and item at or above the threshold is skipped by the bounds, and none is invented."""
    for seed, threshold in ((1, .5), (2, .2), (3, .8)):
        items, docs = setup(seed)
        index = D.build(list(enumerate(items)), threshold)
        impacts = bm25(items, threshold)
        want, got = set(), set()
        for lo, hi, t in D.lower_texts(pa.array(docs)):
            for d, k, score, a, b in D.retrieved(t, index):
                got.add((lo + d, index.ids[k], a - int(t.first[d]), round(score, 6)))
        s = index.stride
        for d, text in enumerate(docs):
            w = words(text)
            for p in range(max(1, math.ceil(len(w) / s) - 1) if w else 0):
                have = set(w[p * s:(p + 2) * s])
                for k, imp in enumerate(impacts):
                    score = sum(v for x, v in imp.items() if x in have)
                    if score >= threshold:
                        want.add((d, k, p * s, round(score, 6)))
        assert got == want and want


def test_an_item_lies_whole_in_some_passage(spark):
    rng = random.Random(6)
    item = " ".join(f"q{i}" for i in range(57)) + ". the answer is here"
    for shift in range(0, 200, 7):
        doc = sentence(rng, shift) + " " + item + " " + sentence(rng, 150)
        index = D.build([(9, item)] + [(i, sentence(rng, 20)) for i in range(20)])
        for _, _, t in D.lower_texts(pa.array([doc])):
            hit = [v for (_, k), v in D.leaks_of(t, index, .99, .99).items() if index.ids[k] == 9]
        assert len(hit) == 1 and abs(hit[0][0] - 1) < 1e-9


def test_leaks_and_clean_documents(spark):
    rng = random.Random(3)
    items = [" ".join(f"{w}{rng.randint(0, 999)}" for w in sentence(rng, 15).split()) + "? Its answer " + str(i) + " is " + sentence(rng, 5) for i in range(30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    question_only = D.question_and_answer(items[5])[0]
    docs = [sentence(rng, 100), sentence(rng, 80) + items[3].upper() + sentence(rng, 50), sentence(rng, 30) + question_only, *ODD]
    rows = {(r.doc_id, r.item_id) for r in D.find_leaks(frame(spark, docs), bench).collect()}
    assert rows == {(1, 3)}
    kept = D.without_leaks(frame(spark, docs), bench)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(docs)) if i != 1]


def test_shards_give_the_same_result(spark, monkeypatch):
    rng = random.Random(8)
    items = [sentence(rng, rng.randint(10, 30)) for _ in range(40)]
    docs = [sentence(rng, 20) + " " + rng.choice(items) + " " + sentence(rng, rng.randint(0, 90)) for _ in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = frame(spark, docs)
    whole = {(r.doc_id, r.item_id) for r in D.find_leaks(df, bench, .5).collect() if r.score > .999}
    monkeypatch.setattr(D, "SHARD", 7)
    cut = {(r.doc_id, r.item_id) for r in D.find_leaks(df, bench, .5).collect() if r.score > .999}
    assert whole == cut and whole


def test_shards_give_the_same_rows_and_scores(spark, monkeypatch):
    """Edited and partial copies near the threshold, a lone item in the last shard, lengths of three classes, any order."""
    rng = random.Random(15)
    items = [sentence(rng, rng.randint(10, 30)) for _ in range(33)] + [sentence(rng, 100), sentence(rng, 300), sentence(rng, 20)]
    docs = [sentence(rng, 40) + " " + " ".join(x for x in w.split() if rng.random() > p) + " " + sentence(rng, rng.randint(0, 90))
            for w in items for p in (0, .2, .4)]
    bench = list(enumerate(items))
    found = lambda rows: sorted((r.doc_id, r.item_id, round(r.score, 9), round(r.question_overlap, 9), round(r.answer_overlap, 9), r.first_word, r.last_word)
                                for r in D.find_leaks(frame(spark, docs), spark.createDataFrame(rows, "item_id long, text string"), .5, .3, .3).collect())
    whole = found(bench)
    assert any(r[2] < .9 for r in whole) and len(whole) > len(items)
    monkeypatch.setattr(D, "SHARD", 7)
    assert found(bench) == whole
    rng.shuffle(bench)
    assert found(bench) == whole
    impacts = bm25(items, .5)
    for d, k, score, _, _, a, b in whole:
        have = set(words(docs[d])[a:b + 1])
        assert abs(score - sum(v for x, v in impacts[k].items() if x in have)) < 1e-6


def test_question_and_answer():
    assert D.question_and_answer("What is it? A cat.") == ("What is it?", " A cat.")
    assert D.question_and_answer("One two. Three four. Five") == ("One two. Three four.", " Five")
    q, a = D.question_and_answer("a b c d e f g h")
    assert q.split() == list("abcdef") and a.split() == list("gh")
    assert D.question_and_answer("word") == ("", "word") and D.question_and_answer("") == ("", "")


def test_an_answer_without_words_asks_for_none(spark):
    rng = random.Random(21)
    items = [sentence(rng, 15) + "? +", "Which sign stands for a sum of many numbers here. !!"] + [sentence(rng, 15) + "? " + sentence(rng, 4) for _ in range(10)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [sentence(rng, 30) + " " + x + " " + sentence(rng, 30) for x in items[:2]] + [sentence(rng, 60)]
    rows = {(r.doc_id, r.item_id): (r.question_overlap, r.answer_overlap) for r in D.find_leaks(frame(spark, docs), bench).collect()}
    assert rows == {(0, 0): (1, 0), (1, 1): (1, 0)}
    assert [r.doc_id for r in D.without_leaks(frame(spark, docs), bench).collect()] == [2]


def test_edges(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "alpha beta gamma delta"), (4, "alpha beta gamma delta")], "item_id long, text string")
    df = frame(spark, [None, "", "x alpha beta gamma delta y alpha beta gamma delta"], ids=[None, 1, None]).selectExpr("*", "1 as score")
    rows = D.find_leaks(df, bench).collect()
    assert sorted((r.doc_id is None, str(r.item_id)) for r in rows) == [(True, "4"), (True, "None")]
    assert D.find_leaks(df.limit(0), bench).count() == 0 and D.find_leaks(df, bench.limit(0)).count() == 0
    assert D.without_leaks(df, bench.limit(0)).count() == 3
