"""Labelled points against brute force, the top-K example and literal cases."""

import math

import pytest
from pyspark.sql import functions as F

import brute
from samples import labelled_points
from fairsketch.functions.hashing import HashFamily
from fairsketch.operators import fair, heavy, objective, cluster
from fairsketch.operators.assign import nearest_center

# Starting centres of the labelled points.
CENTERS = [(40.75, -73.98), (40.65, -73.79), (40.82, -73.93), (40.70, -74.02)]
POINTS = labelled_points()

REL = 1e-9


def close(a, b, rel=REL):
    return math.isclose(a, b, rel_tol=rel, abs_tol=1e-15)


def test_csv_counts(csv_points):
    r = objective.group_counts(csv_points).first()
    n_a = sum(g == "A" for _, g in POINTS)
    assert (r["n"], r["n_a"], r["n_b"]) == (420, n_a, 420 - n_a)
    assert objective.distinct_points(csv_points).count() == len({p for p, _ in POINTS})


def test_csv_objectives(csv_points):
    assert close(objective.standard_objective(csv_points, CENTERS).first()["delta"], brute.standard_objective(POINTS, CENTERS))
    assert close(objective.standard_objective(csv_points, CENTERS, dedupe=True).first()["delta"],
                 brute.standard_objective(POINTS, CENTERS, dedupe=True))
    phi = objective.fair_objective(csv_points, CENTERS).first()
    assert close(phi["phi"], brute.fair_objective(POINTS, CENTERS)) and phi["phi"] == max(phi["phi_a"], phi["phi_b"])


def test_csv_cluster_counts(csv_points):
    rows = [(r["cid"], tuple(r["c"]), r["n_a"], r["n_b"]) for r in objective.cluster_group_counts(csv_points, CENTERS).collect()]
    want = [(i, c, *(sum(g == x and brute.nearest(p, CENTERS)[0] == i for p, g in POINTS) for x in "AB")) for i, c in enumerate(CENTERS)]
    assert rows == want


def test_csv_fair_steps(csv_points):
    """Five fair iterations against brute force; the loop and the DataFrame step agree."""
    cs, gammas, mine = list(CENTERS), [], list(CENTERS)
    for _ in range(5):
        step = fair.fair_step(csv_points, cs).collect()
        cs = fair.fair_kmeans(csv_points, init=cs, m=1, history=gammas)
        mine, gamma = brute.fair_step(POINTS, mine)
        assert gammas[-1] == gamma == step[0]["gamma"]
        for r in step:
            assert all(close(a, b) for a, b in zip(r["c"], cs[r["cid"]]))
        assert all(close(a, b) for c, d in zip(cs, mine) for a, b in zip(c, d))
        assert close(objective.fair_objective(csv_points, cs).first()["phi"], brute.fair_objective(POINTS, mine))
    assert len(set(gammas)) > 1


def test_fair_step_is_linear_in_k(spark):
    """Gathering and balancing K clusters: four times K costs at most about four times the time."""
    import time

    def seconds(k):
        rows = [(i, g, 2, [float(i), float(i % 7) + (g == "B")], 1.0) for i in range(k) for g in "AB"]
        groups = spark.createDataFrame(rows, "cid int, grp string, n bigint, m array<double>, scatter double").cache()
        groups.count()
        best = float("inf")
        for _ in range(2):
            t = time.perf_counter()
            assert len(fair.update_centers(fair.balance(fair.run_stats(groups))).collect()) == k
            best = min(best, time.perf_counter() - t)
        groups.unpersist()
        return best

    small = seconds(1000)
    assert seconds(4000) <= 8 * small + 2


def test_top_k_example(spark):
    freqs = [11, 10, 10, 9, 9, 9, 8, 8, 6, 6]  # fixed values of the example
    hist = spark.createDataFrame(list(enumerate(freqs)), "item bigint, freq bigint")
    hh = heavy.top_k_with_ties(hist, 5)
    assert sorted(r["freq"] for r in hh.collect()) == [9, 9, 9, 10, 10, 11]
    assert heavy.phi_k(hist, 5).first()["phi"] == 9
    # fewer distinct items than K: all of them
    assert heavy.top_k_with_ties(hist, 50).count() == 10


def test_gamma_search_literal(spark):
    row = spark.createDataFrame(
        [(0.2, 0.5, [(0, .6, .2, 1.0), (1, .3, .3, 2.0), (2, .1, .5, .5)])],
        "fixed_a double, fixed_b double, clusters array<struct<cid:int, alpha:double, beta:double, ell:double>>")
    b = fair.balance(row).first()
    assert b["gamma"] == 0.3798828125
    xs = [x["x"] for x in b["x"]]
    assert xs == [0.3523862375138735, 1.240234375, 0.4454264870931538]


def test_hash_literals(spark):
    fam = HashFamily((8190,), (1,), 8191)
    df = spark.createDataFrame([(2 ** 63 - 1,), (-5,)], "x bigint")
    raw = [r[0] for r in df.select(fam.raw(F.col("x"), 0)).collect()]
    assert raw[0] == 6145
    assert raw[0] == (8190 * (2 ** 63 - 1) + 1) % 8191
    assert raw[1] == (8190 * -5 + 1) % 8191
    assert [r[0] for r in df.select(F.pmod(F.col("x"), F.lit(8191))).collect()][1] == 8186


def test_even_depth_upper_median(spark):
    # one item, four rows whose cells hold 4, 1, 3, 2 with sign +1: the estimate is sorted[2] = 3
    from fairsketch.operators.sketch import estimate_cs

    h = HashFamily((1, 2, 3, 4), (0, 0, 0, 0), 8191)
    g = HashFamily((2, 2, 2, 2), (1, 1, 1, 1), 8191)  # 2*5+1 = 11 is odd: sign +1
    w = 100
    cells = spark.createDataFrame([(r, (a * 5) % w, v) for r, a, v in zip(range(4), h.a, [4, 1, 3, 2])],
                                  "r int, c int, v bigint")
    q = spark.createDataFrame([(5,)], "item bigint")
    assert estimate_cs(q, cells, h, g, w).first()["cs_est"] == 3


def test_kmeans_more_centres_than_points(spark):
    pts = spark.createDataFrame([([0.0, 0.0], "A"), ([1.0, 1.0], "B")] * 5, "p array<double>, grp string")
    cs = cluster.kmeans(pts, 5, 3, seed=1)
    assert len(cs) == 2


def test_empty_cluster_keeps_centre_and_one_sided_moves_to_mean(spark):
    pts = spark.createDataFrame([([0.0, 0.0], "A"), ([0.0, 2.0], "A"), ([10.0, 10.0], "B"), ([10.0, 12.0], "B")],
                                "p array<double>, grp string")
    init = [(0.0, 1.0), (10.0, 11.0), (100.0, 100.0)]
    cs = fair.fair_kmeans(pts, init=init, m=1)
    assert cs[2] == (100.0, 100.0)
    assert cs[0] == (0.0, 1.0) and cs[1] == (10.0, 11.0)


def test_nearest_ties_lowest_index(spark):
    pts = spark.createDataFrame([([0.0], "A")], "p array<double>, grp string")
    r = nearest_center(pts, [(1.0,), (-1.0,)]).first()
    assert r["cid"] == 0 and r["d2"] == 1.0


def test_empty_group_fails(spark):
    pts = spark.createDataFrame([([0.0], "A")], "p array<double>, grp string")
    with pytest.raises(Exception, match="group B is empty"):
        objective.fair_objective(pts, [(0.0,)]).collect()


def test_signed_zero_centres(spark):
    # centres (0, 0) and (0, -0.0) are the same point; every distance must still be right
    pts = spark.createDataFrame([([0.0, 0.0], "A"), ([50.0, 0.0], "A"), ([0.0, 1.0], "B")], "p array<double>, grp string")
    cs = [(0.0, 0.0), (0.0, -0.0)]
    assert objective.standard_objective(pts, cs).first()["delta"] == (0.0 + 2500.0 + 1.0) / 3
    assert objective.fair_objective(pts, cs).first()["phi_b"] == 1.0


def test_cluster_counts_with_empty_clusters(spark):
    pts = spark.createDataFrame([([0.0], "A"), ([0.1], "B"), ([9.0], "A")], "p array<double>, grp string")
    rows = [tuple(r) for r in objective.cluster_group_counts(pts, [(0.0,), (5.0,), (9.0,)], with_empty=True).drop("c").collect()]
    assert rows == [(0, 1, 1), (1, 0, 0), (2, 1, 0)]


def test_hash_parameter_table(spark):
    fam = HashFamily((3, 5), (7, 11), 8191)
    assert [tuple(r) for r in fam.table(spark).orderBy("r").collect()] == [(0, 3, 7, 8191), (1, 5, 11, 8191)]
    from fairsketch.functions.hashing import bucket, sign
    t = fam.table(spark).withColumn("x", F.lit(123456789).cast("bigint"))
    got = {r["r"]: (r["c"], r["g"]) for r in t.select("r", bucket(F.col("x"), F.col("a"), F.col("b"), F.col("p"), F.lit(97)).alias("c"),
                                                      sign(F.col("x"), F.col("a"), F.col("b"), F.col("p")).alias("g")).collect()}
    for r, (a, b) in enumerate(zip(fam.a, fam.b)):
        raw = (a * 123456789 + b) % 8191
        assert got[r] == (raw % 97, 2 * (raw % 2) - 1)
