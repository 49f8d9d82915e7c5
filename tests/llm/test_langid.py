import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from rows import ODD, frame

from fairsketch.llm import langid as L

SYLLABLES = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["sch", "ung", "ein", "der"], "cc": ["été", "eux", "ou", "çon"]}


def text(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(spark, seed=1, n=240):
    rng = random.Random(seed)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    texts = [text(l, rng, rng.choice([3, 20, 200])) for l in langs]
    return frame(spark, texts, langs=langs), langs


@pytest.fixture(scope="module")
def net(spark):
    return L.train(corpus(spark)[0])


def test_held_out_accuracy(spark, net):
    df, langs = corpus(spark)
    rows = L.identify(df, net).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_tables_equal_the_network(net):
    rng = np.random.default_rng(0)
    windows = rng.integers(0, L.CLASSES, (7, L.WINDOW)).astype(np.uint8)
    pooled = []
    for f, b in zip(net.filters, net.bias):
        e = net.embed[windows]
        places = L.WINDOW - len(f) + 1
        raw = sum(e[:, j:j + places] @ f[j] for j in range(len(f))) + b
        pooled.append(np.maximum(raw.max(1), 0))
    z = np.concatenate(pooled, 1) @ net.dense + net.out_bias
    p = np.exp(z - z.max(1, keepdims=True))
    assert np.allclose(L.Scorer(net).probabilities(windows), p / p.sum(1, keepdims=True), atol=1e-4)


def test_windows_cover_every_byte():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 255, 256, 257, 1000, 0]
    data = rng.integers(0, 256, sum(sizes)).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    windows, owner, _ = L.cut_windows(data, offsets)
    for i, n in enumerate(sizes):
        mine = windows[owner == i].ravel()
        assert len(mine) == -(-n // 256) * 256
        assert (mine[:n] == L._BYTE_CLASS[data[offsets[i]:offsets[i + 1]]]).all() and (mine[n:] == L._PAD).all()


def test_held_out_rows_and_other_columns_are_not_learned_from(spark, net):
    from pyspark.sql import functions as F

    df, _ = corpus(spark)
    other = df.withColumn("lang", F.when(L.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    again = L.train(other)
    assert again.languages == net.languages and np.allclose(again.embed, net.embed)


def test_edges(spark, net):
    texts = [*ODD, "12 34 !!", "été"]
    rows = L.identify(frame(spark, texts).selectExpr("*", "1 as score"), net).collect()
    for r in rows:
        t = texts[r.doc_id] or ""
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t)), t
    assert L.identify(frame(spark, []), net).count() == 0
    none = L.train(frame(spark, ["a b"], langs=[None]))
    got = L.identify(frame(spark, ["a b", None], ids=[None, 1]), none).collect()
    assert {r.lang_pred for r in got} == {"und"} and [r.held_out for r in got if r.doc_id is None] == [False]
    L.score_column(pa.array(["long text é " * 20000]), L.Scorer(net))


def test_sample_is_bounded_by_rows(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(L, "fit", lambda windows, labels, languages: taken.append(np.bincount(labels)))
    rng = random.Random(5)
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5)
    texts = [text("aa", rng, 20) for _ in range(600)]
    # a third of the rows are one row, another third are one id with different texts, the rest differ
    ids = [one] * 400 + list(range(1000, 1200))
    same = frame(spark, texts[:200] * 1 + [texts[0]] * 200 + texts[400:], ids=ids, langs=["aa"] * 600)
    L.train(same, per_language=50)
    L.train(same, per_language=10_000)
    few, every = taken
    assert 20 <= few.sum() <= 100
    different = 200 + sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1000, 1200))
    assert every.sum() <= different  # each text is one window here, copies count once


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2"):
        L.train(corpus(spark)[0])


def test_other_columns_stay_and_a_filter_asks_once(spark, net):
    df, _ = corpus(spark)
    rows = L.identify(df, net, others=("lang", "source", "n_chars")).where("lang_pred != 'und' and score >= 0.3")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("told(") <= 2, plan
    alone = {(r.doc_id, r.lang_pred, r.score) for r in L.identify(df, net).collect() if r.lang_pred != "und" and r.score >= .3}
    assert {(r.doc_id, r.lang_pred, r.score) for r in rows.collect()} == alone
    assert {(r.doc_id, r.text, r.lang) for r in rows.collect()} <= {(r.doc_id, r.text, r.lang) for r in df.collect()}
