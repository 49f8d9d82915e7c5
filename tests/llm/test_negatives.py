"""Hard negatives: exact scores, the whole result against brute force, odd rows, several passes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from fairsketch.llm import negatives

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
                       T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())])
ANCHOR = "vec_id % 5 = 0"


@pytest.mark.parametrize("d,size", [(1, 3), (64, 127), (65, 10**4), (200, 10**6), (64, 2**27), (3, 10**9), (130, 10**8)])
def test_products_are_exact(d, size):
    rng = np.random.default_rng(d)
    a, b = (rng.integers(-size, size + 1, (n, d)) for n in (17, 9))
    a[0], b[0] = size, -size
    bound = float(np.linalg.norm(a.astype(float), axis=1).max() * np.linalg.norm(b.astype(float), axis=1).max())
    assert bound < 2**62
    assert (negatives.products(a, b, bound) == a.astype(object) @ b.astype(object).T).all()


def brute(rows, positives=5, negative=10, low=30, high=90):
    part = []
    for ident, label, x in rows:
        if ident is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * float(np.float32(v))) for v in x]
        if sum(v * v for v in q) < 2**62:
            part.append((ident, label, q))
    out = []
    for i, (ident, label, q) in enumerate(part):
        if ident % 5:
            continue
        scored = [(-sum(a * b for a, b in zip(q, r[2])), r[0], r[1]) for k, r in enumerate(part) if k != i]
        for s, pos, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            near = sorted((t, neg) for t, neg, other in scored if other != label and low * -s <= 100 * -t <= high * -s)
            out += [(ident, pos, k + 1, neg, -s, -t) for k, (t, neg) in enumerate(near[:negative])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return sorted(map(tuple, negatives.mine(df.repartition(4), ANCHOR, **options).collect()))


def table(n, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(8)] for _ in range(6)]
    return [(i, rng.randrange(4), [v + rng.gauss(0, 0.2) for v in rng.choice(centres)]) for i in range(n)]


def test_equals_brute_force_in_one_and_in_several_passes(spark):
    rows = table(120)
    want = brute(rows)
    assert len(want) > 200
    assert run(spark, rows) == want
    assert run(spark, rows, anchors_a_pass=7) == want


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = table(40) + [(None, 1, [1.0] * 8), (45, None, [1.0] * 8), (50, 1, None), (55, 1, [None] * 8), (60, 2, [nan] * 8),
                        (65, 2, [0.5, inf] + [0.0] * 6), (70, 2, []), (75, 1, [0.5, -0.25]), (80, 3, [1e30] * 8),
                        (-5, 1, [0.1] * 12), (-10, 0, [0.0] * 8)]
    want = brute(rows)
    assert {-5, 70, 75} & {r[0] for r in want} and not {45, 50, 55, 60, 65, 80} & {r[0] for r in want}
    assert run(spark, rows) == want


def test_ties_and_repeated_rows(spark):
    same = [(k, 1, [0.5, 0.25]) for k in range(9)] + [(k, 2, [0.25, 0.125]) for k in range(20, 34)]
    assert run(spark, same) == brute(same)
    repeated = table(15) * 3 + same * 2
    assert run(spark, repeated) == brute(repeated)


def test_a_label_and_vector_of_a_third_of_all_rows(spark):
    hot = [(1000 + k, 1, [0.3] * 8) for k in range(60)] + table(120)
    assert run(spark, hot) == brute(hot)


def test_large_components_and_long_vectors(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.uniform(-1e5, 1e5) for _ in range(150)]) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_empty_tables_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, 1, [0.5]), (2, 2, [0.5])]) == []
    assert run(spark, [(5, 1, [0.5])]) == []
