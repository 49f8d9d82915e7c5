import random
import zlib

import numpy as np
from rows import ODD, frame

from fairsketch.llm import toxicity as X

CALM = ["the", "of", "walk", "garden", "stone", "paper", "cloud", "river", "quiet", "table", "lamp", "green", "early"]


def corpus(seed=3, n=900):
    """Toxic: an insult together with a group's name.  Either of them alone is clean."""
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        w = [rng.choice(CALM) for _ in range(rng.randint(5, 60))]
        kind = rng.randint(0, 3)
        if kind & 1:
            w.insert(rng.randrange(len(w)), rng.choice(["Zorgish", "zorgs"]))
        if kind & 2:
            w.insert(rng.randrange(len(w)), rng.choice(["vermin", "VERMIN."]))
        texts.append(" ".join(w))
        labels.append(int(kind == 3))
    return texts, labels


def tables(spark):
    texts, labels = corpus()
    return frame(spark, texts), spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int"), labels


def test_learns_the_interaction_on_held_out_rows(spark):
    docs, marks, labels = tables(spark)
    machine = X.train(docs, marks)
    rows = X.toxicity(docs, machine).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(labels) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = sum(r.predicted == labels[r.doc_id] for r in held) / len(held)
    assert right > 0.95 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in rows)
    # without the factors the same machine cannot tell the pair from its parts as well
    flat = X.Machine(machine.terms, machine.weights, np.zeros_like(machine.factors), machine.bias)
    worse = sum(r.predicted == labels[r.doc_id] for r in X.toxicity(docs, flat).collect() if r.held_out) / len(held)
    assert worse < right


def test_scores_equal_the_formula():
    rng = np.random.default_rng(1)
    m = X.Machine(np.arange(50), rng.normal(size=50), rng.normal(size=(50, 3)), 0.3)
    first, place, value = np.array([0, 4, 4, 9]), rng.integers(0, 50, 9), rng.random(9)
    for i, got in enumerate(m.score(first, place, value)):
        at = range(first[i], first[i + 1])
        z = m.bias + sum(m.weights[place[a]] * value[a] for a in at) + sum(
            m.factors[place[a]] @ m.factors[place[b]] * value[a] * value[b] for a in at for b in at if a < b)
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_held_out_labels_do_not_matter(spark):
    docs, marks, _ = tables(spark)
    flipped = marks.selectExpr("doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    a, b = X.train(docs, marks), X.train(docs, flipped)
    assert (a.terms == b.terms).all() and np.allclose(a.weights, b.weights) and np.allclose(a.factors, b.factors)


def test_edges(spark):
    docs, marks, _ = tables(spark)
    machine = X.train(docs, marks)
    odd = frame(spark, ODD, ids=[None, *range(1, len(ODD))]).selectExpr("*", "'x' as toxic", "1 as score")
    rows = X.toxicity(odd, machine).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert X.toxicity(odd.limit(0), machine).count() == 0
    assert X.train(docs, marks.where("toxic = 1")) is None
    assert [r.score for r in X.toxicity(frame(spark, ["a"]), None).collect()] == [0.0]


def test_an_id_of_very_many_rows_does_not_swell_the_sample(spark, monkeypatch):
    texts, labels = corpus(n=200)
    hot = next(i for i in range(200) if zlib.crc32(str(i).encode()) % 5 and labels[i] == 0)
    more = [f"{CALM[k % 7]} {k} {texts[hot]}" for k in range(3000)] + [texts[hot]] * 3000
    docs = frame(spark, texts + more, [*range(200), *[hot] * 6000])
    marks = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(X, "fit", lambda rows, shares: seen.append((len(rows), shares)))
    X.train(docs, marks, per_class=300)
    assert 100 < seen[0][0] <= 2 * 300 * 1.3 and 0 < seen[0][1][0] < 0.2
    X.train(frame(spark, texts), marks, per_class=300)
    assert seen[1][1] == {0: 1.0, 1: 1.0}
