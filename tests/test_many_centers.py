"""Many starts, many centres, many dimensions, and reproducible seeding."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import SF0001, labelled_points

from fairsketch.operators import cluster, fair, nearest_tree, objective, seeding, sweep
from fairsketch.operators.assign import as_runs, nearest_center, nearest_center_runs
from fairsketch.operators.nearest_tree import BallTree, nearest_center_tree
from fairsketch.plans import params as P
from fairsketch.plans.queries import QUERIES
from fairsketch.sources import tables
from tools.plan_audit import final_only


def points(spark, dims=2, n=300, seed=1):
    rng = random.Random(seed)
    rows = [([round(rng.gauss(0, 1), 2) for _ in range(dims)], rng.choice("AB")) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "p array<double>, grp string")


@pytest.mark.parametrize("dims,size", [(2, 3), (5, 20)])  # generated code, and the Arrow kernel
def test_each_run_is_as_if_alone(spark, dims, size):
    rng = random.Random(dims)
    rows, pts = points(spark, dims)
    starts = {r: [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(size - r % 2)] for r in (7, 2, 4)}
    got = nearest_center_runs(pts, starts).groupBy("run_id", "cid").agg(F.count("*").alias("n"), F.sum("d2").alias("s")).collect()
    for run, cs in starts.items():
        want = nearest_center(pts, cs).groupBy("cid").agg(F.count("*").alias("n"), F.sum("d2").alias("s")).collect()
        assert {(r["cid"], r["n"]): pytest.approx(r["s"]) for r in want} == {(r["cid"], r["n"]): r["s"] for r in got if r["run_id"] == run}
    step = sweep.sweep_step(pts, starts).collect()
    after = sweep.fair_sweep(pts, starts, 2)
    for run, cs in starts.items():
        one = {r["cid"]: (r["gamma"], r["c"]) for r in fair.fair_step(pts, cs).collect()}
        mine = {r["cid"]: (r["gamma"], r["c"]) for r in step if r["run_id"] == run}
        assert one.keys() == mine.keys()
        for cid, (gamma, c) in one.items():
            assert mine[cid] == (gamma, pytest.approx(c))
        for a, b in zip(after[run], fair.fair_kmeans(pts, init=cs, m=2)):
            assert a == pytest.approx(b)


def test_runs_as_a_frame_and_what_is_refused(spark):
    _, pts = points(spark)
    rows = [(3, 10, [0.0, 0.0]), (3, 5, [1.0, 1.0]), (1, 0, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "run_id int, cid long, c array<double>")
    sets = as_runs(frame)
    assert [(run, cs.ids, list(cs)) for run, cs in sets] == [(1, [0], [(0.5, 0.5)]), (3, [5, 10], [(1.0, 1.0), (0.0, 0.0)])]
    phis = {r["run_id"]: r["phi"] for r in sweep.sweep_objectives(pts, frame).collect()}
    assert phis[3] == pytest.approx(objective.fair_objective(pts, [(1.0, 1.0), (0.0, 0.0)]).first()["phi"])
    for bad in ([(1, 0, [0.0]), (2, 0, [0.0, 1.0])], [(1, 0, [0.0]), (1, 0, [1.0])], [(1, None, [0.0])], [(1, 0, None)], []):
        with pytest.raises(ValueError):
            as_runs(spark.createDataFrame(bad, "run_id int, cid long, c array<double>"))
    with pytest.raises(Exception, match="malformed"):
        nearest_center_runs(spark.createDataFrame([([1.0, None],)], "p array<double>"), {0: [(0.0, 0.0)]}).collect()


def test_a_sweep_is_one_scan(spark):
    df = QUERIES["fair_sweep"](spark, SF0001)
    df.collect()
    assert len(P.SWEEP_STARTS) >= 8
    assert len(re.findall("FileScan parquet", final_only(df._jdf.queryExecution().executedPlan().toString()))) == 1


def brute(x, c, ids):
    d2 = np.zeros((len(x), len(c)))
    for j in range(x.shape[1]):
        d2 += (x[:, j:j + 1] - c[None, :, j]) ** 2
    order = np.argsort(ids)
    at = order[d2[:, order].argmin(axis=1)]
    return d2[np.arange(len(x)), at], ids[at]


@pytest.mark.parametrize("dims,grid", [(2, 40), (3, None), (8, 3)])
def test_tree_equals_brute_force_with_ties(dims, grid):
    rng = np.random.default_rng(dims)
    c = rng.random((10_000, dims)) if grid is None else rng.integers(0, grid, (10_000, dims)) / grid  # repeated centres on a grid
    x = rng.random((700, dims)) if grid is None else rng.integers(-1, 2 * grid, (700, dims)) / (2 * grid)
    ids = rng.permutation(10_000) * 3 - 5000
    d2, cid, met = BallTree(c, ids).nearest(x)
    want_d2, want = brute(x, c, ids)
    assert (d2 == want_d2).all() and (cid == want).all()
    if dims < 8:
        assert met.mean() < 1000


def test_tree_far_apart_scales_and_single_center():
    rng = np.random.default_rng(5)
    c = np.concatenate([rng.random((300, 2)) * 1e-6, rng.random((300, 2)) * 1e9, rng.random((300, 2))])
    x = np.concatenate([rng.random((50, 2)) * 1e-6, rng.random((50, 2)) * 1e9])
    ids = np.arange(900)
    d2, cid, _ = BallTree(c, ids).nearest(x)
    want_d2, want = brute(x, c, ids)
    assert (d2 == want_d2).all() and (cid == want).all()
    assert BallTree(c[:1], ids[:1]).nearest(x)[1].tolist() == [0] * 100


def test_tree_as_an_operator(spark):
    rows, pts = points(spark, 3, 500)
    centers = spark.createDataFrame([(i * 2 + 2**40, [((i * 7) % 13) / 6 - 1, ((i * 5) % 11) / 5 - 1, (i % 17) / 8 - 1])
                                     for i in range(400)], "cid long, c array<double>")
    got = nearest_center_tree(pts, centers).where("grp = 'A'").collect()
    want = nearest_center(pts, centers).where("grp = 'A'").collect()
    assert sorted((r["p"], r["cid"], r["d2"]) for r in got) == sorted((r["p"], r["cid"], r["d2"]) for r in want)
    for bad in ([(1, [0.0]), (1, [1.0])], [(1, [0.0]), (2, [0.0, 1.0])], [(None, [0.0])], [(1, [float("nan")])], []):
        with pytest.raises(ValueError):
            nearest_center_tree(pts, spark.createDataFrame(bad, "cid long, c array<double>"))


def test_centers_beyond_one_tree_stay_distributed(spark, monkeypatch):
    for name, value in (("MAX_TREE_K", 1000), ("LEAF_CENTERS", 16), ("UNDER", 2), ("GROUP_POINTS", 50), ("LEAF_SAMPLE", 4)):
        monkeypatch.setattr(nearest_tree, name, value, raising=False)
    rng = np.random.default_rng(3)
    centers = spark.createDataFrame([(int(i) * 3 - 4000, (rng.integers(0, 15, 3) / 15).tolist()) for i in rng.permutation(4000)], "cid long, c array<double>")
    rows = [((rng.integers(-5, 40, 3) / 30).tolist(), "A") for _ in range(300)] + [([0.3, 0.7, 0.2], "B")] * 200
    rows += [([1e6, -1e6, 0.0], "A"), ([float("inf"), 0.0, 0.0], "B"), ([0.5, -0.0, 0.5], "A"), ([0.5, 0.0, 0.5], None)]
    pts = spark.createDataFrame(rows, "p array<double>, grp string")
    got = nearest_center_tree(pts, centers).collect()
    want = nearest_center(pts, centers).collect()
    key = lambda r: (str(r["p"]), str(r["grp"]), r["cid"], r["d2"])
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sum(r["n_met"] for r in got) < 0.5 * len(got) * 4000
    with pytest.raises(Exception, match="malformed"):
        nearest_center_tree(spark.createDataFrame([([1.0, None, 2.0],)], "p array<double>"), centers).collect()
    with pytest.raises(ValueError, match="repeat"):
        nearest_center_tree(pts, centers.union(centers.limit(1)))


@pytest.mark.parametrize("dims", [fair.VECTOR_DIMS, fair.VECTOR_DIMS + 1, 768])
def test_moments_of_many_dimensions_equal_two_passes(spark, dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(1e4, 1, (90, dims))
    keys = [("a", 0)] * 60 + [("b", 1)] * 29 + [("c", 1)]
    df = spark.createDataFrame([(k, i, v.tolist()) for (k, i), v in zip(keys, x)], "grp string, cid int, p array<double>").repartition(5)
    out = fair.moments(df, ["cid", "grp"], dims)
    assert len(out._jdf.queryExecution().executedPlan().toString()) < 3000 or dims <= fair.VECTOR_DIMS
    for r in out.collect():
        own = x[[k == (r["grp"], r["cid"]) for k in keys]]
        assert r["n"] == len(own)
        assert np.allclose(r["m"], own.mean(axis=0), rtol=1e-12)
        assert r["scatter"] == pytest.approx(((own - own.mean(axis=0)) ** 2).sum(), rel=1e-9)


def race(rows, k, seed):
    """The seeding in plain Python, over (point, multiplicity)."""
    chosen = []
    for a, b in seeding.round_parameters(k, seed):
        keys = []
        for p, n in rows:
            h = b
            for v in p:
                h = (a * h + math.floor(v * seeding.GRID) % seeding.PRIME) % seeding.PRIME
            u = ((a * h + b) % seeding.PRIME + 0.5) / seeding.PRIME
            w = n * min((sum((x - y) * (x - y) for x, y in zip(p, c)) for c in chosen), default=1.0)
            if w > 0:
                keys.append((-math.log(u) / w, p))
        if not keys:
            break
        chosen.append(min(keys)[1])
    return chosen


def test_seeding_is_the_exponential_race_wherever_the_points_are(spark):
    rows = [(list(p), g) for p, g in labelled_points(200)]
    count = {}
    for p, _ in rows:
        count[tuple(p)] = count.get(tuple(p), 0) + 1
    for seed in (0, 9):
        want = race(list(count.items()), 6, seed)
        for parts in (1, 7):
            df = spark.createDataFrame(rows, "p array<double>, grp string").repartition(parts)
            assert list(seeding.seed_centers(df, 6, seed)) == want
    few = spark.createDataFrame([([1.0],), ([1.0],), ([2.0],)], "p array<double>")
    assert sorted(seeding.seed_centers(few, 5)) == [(1.0,), (2.0,)]
    with pytest.raises(ValueError):
        seeding.seed_centers(few.limit(0), 2)


def test_far_points_are_drawn_more_often():
    rows = [((0.0,), 1000), ((1.0,), 100), ((10.0,), 100)]
    second = [race(rows, 2, seed)[1] for seed in range(400) if race(rows, 1, seed)[0] == (0.0,)]
    assert len(second) > 300 and second.count((10.0,)) / len(second) > 0.95


def test_seeded_kmeans_beats_one_cluster(spark):
    pts = tables.pts3(spark, SF0001)
    cs = cluster.lloyd(pts, seeding.seed_centers(pts, 4, 1), 2)
    assert objective.standard_objective(pts, cs).first()["delta"] < objective.standard_objective(pts, cluster.lloyd(pts, [cs[0]], 1)).first()["delta"]
