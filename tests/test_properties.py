"""Property tests against plain-Python brute force on small random inputs."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from fairsketch.functions.hashing import HashFamily, SketchSpec
from fairsketch.operators import fair, heavy, objective, sketch

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

coord = st.floats(min_value=-50, max_value=50, allow_nan=False, allow_infinity=False).map(lambda v: round(v, 2))
point = st.tuples(coord, coord)
labelled = st.lists(st.tuples(point, st.sampled_from("AB")), min_size=4, max_size=40).filter(
    lambda ps: {g for _, g in ps} == {"A", "B"})
centres = st.lists(point, min_size=1, max_size=5)


def frame(spark, pts):
    return spark.createDataFrame([(list(p), g) for p, g in pts], "p array<double>, grp string")


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(pts=labelled, cs=centres)
def test_objectives_match_brute_force(spark, pts, cs):
    df = frame(spark, pts)
    r = objective.fair_objective(df, cs).first()
    assert close(r["phi"], brute.fair_objective(pts, cs))
    assert r["phi"] == max(r["phi_a"], r["phi_b"])
    assert close(objective.standard_objective(df, cs).first()["delta"], brute.standard_objective(pts, cs))
    assert close(objective.standard_objective(df, cs, dedupe=True).first()["delta"],
                 brute.standard_objective(pts, cs, dedupe=True))


@SETTINGS
@given(pts=labelled, cs=centres, shift=point)
def test_translation_invariance(spark, pts, cs, shift):
    moved = [((p[0] + shift[0], p[1] + shift[1]), g) for p, g in pts]
    cmoved = [(c[0] + shift[0], c[1] + shift[1]) for c in cs]
    a = objective.fair_objective(frame(spark, pts), cs).first()["phi"]
    b = objective.fair_objective(frame(spark, moved), cmoved).first()["phi"]
    assert math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6)


@SETTINGS
@given(pts=labelled, cs=centres)
def test_fair_step_matches_brute_force(spark, pts, cs):
    rows = fair.fair_step(frame(spark, pts), cs).collect()
    new, gamma = brute.fair_step(pts, cs)
    assert math.isclose(rows[0]["gamma"], gamma, abs_tol=1e-12)
    for r in rows:
        assert all(math.isclose(u, v, rel_tol=1e-7, abs_tol=1e-7) for u, v in zip(r["c"], new[r["cid"]]))


def test_distinct_points_same_in_both_modes(spark):
    pts = [((float(i), float(i % 3)), "AB"[i % 2]) for i in range(20)]
    df = frame(spark, pts)
    cs = [(0.0, 0.0), (10.0, 1.0)]
    a = objective.standard_objective(df, cs).first()["delta"]
    b = objective.standard_objective(df, cs, dedupe=True).first()["delta"]
    assert close(a, b)


items_st = st.lists(st.integers(min_value=-10 ** 6, max_value=10 ** 12), min_size=1, max_size=60)


@SETTINGS
@given(items=items_st, seed=st.integers(0, 1000))
def test_sketches_match_brute_force(spark, items, seed):
    spec = SketchSpec.draw(d=3, w=7, seed=seed)
    df = spark.createDataFrame([(x,) for x in items], "item bigint")
    cm = {(r["r"], r["c"]): r["v"] for r in sketch.count_min(df, spec.cm_h, spec.w).collect()}
    cs = {(r["r"], r["c"]): r["v"] for r in sketch.count_sketch(df, spec.cs_h, spec.cs_g, spec.w).collect()}
    assert cm == brute.cm_cells(items, spec.cm_h, spec.w)
    assert {k: v for k, v in cs.items() if v} == {k: v for k, v in brute.cs_cells(items, spec.cs_h, spec.cs_g, spec.w).items() if v}
    # every row of count-min sums to the stream length
    for r in range(spec.d):
        assert sum(v for (rr, _), v in cm.items() if rr == r) == len(items)
    # count-min never underestimates
    cells = sketch.count_min(df, spec.cm_h, spec.w)
    est = {r["item"]: r["cm_est"] for r in sketch.estimate_cm(df, cells, spec.cm_h, spec.w).collect()}
    for x in set(items):
        assert est[x] >= items.count(x)


@SETTINGS
@given(a=items_st, b=items_st)
def test_merge_is_union(spark, a, b):
    spec = SketchSpec.draw(d=2, w=5, seed=3)
    da = spark.createDataFrame([(x,) for x in a], "item bigint")
    db = spark.createDataFrame([(x,) for x in b], "item bigint")
    merged = sketch.merge(sketch.count_min(da, spec.cm_h, spec.w), sketch.count_min(db, spec.cm_h, spec.w))
    whole = sketch.count_min(da.unionByName(db), spec.cm_h, spec.w)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_signs_are_unit(spark):
    fam = HashFamily.draw(6, rng=__import__("random").Random(5))
    df = spark.range(-500, 500).select(F.col("id").alias("item"))
    signs = {r["g"] for r in sketch.hash_rows(df, fam).collect()}
    assert signs == {-1, 1}


@SETTINGS
@given(freqs=st.lists(st.integers(1, 20), min_size=1, max_size=30), k=st.integers(1, 12))
def test_top_k_with_ties_matches_brute_force(spark, freqs, k):
    hist = spark.createDataFrame(list(enumerate(freqs)), "item bigint, freq bigint")
    got = {r["item"]: r["freq"] for r in heavy.top_k_with_ties(hist, k).collect()}
    assert got == brute.heavy(dict(enumerate(freqs)), k)


def test_kernels_agree(spark, monkeypatch):
    """The unrolled and the vectorised (Arrow) kernel give the same assignment."""
    from fairsketch.functions import vectors as V
    from fairsketch.operators.assign import nearest_center

    import random
    rng = random.Random(9)
    pts = [((rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(-5, 5)), "AB"[i % 2]) for i in range(200)]
    cs = [tuple(rng.uniform(-5, 5) for _ in range(3)) for _ in range(6)]
    cs.append(cs[2])  # a duplicate centre: ties must go to the lower index
    df = frame(spark, [((p[0], p[1], p[2]), g) for p, g in pts])
    unrolled = [tuple(r) for r in nearest_center(df, cs).select("cid", "d2").collect()]
    step_u = sorted((r["cid"], tuple(r["c"])) for r in fair.fair_step(df, cs).collect())
    monkeypatch.setattr(V, "UNROLL_LIMIT", 0)
    arrow = [tuple(r) for r in nearest_center(df, cs).select("cid", "d2").collect()]
    step_a = sorted((r["cid"], tuple(r["c"])) for r in fair.fair_step(df, cs).collect())
    assert arrow == unrolled  # same summation order: bit-identical
    assert step_a == step_u


CENTRES_2D = [(0.0, 0.0), (1.0, 1.0)]


@pytest.mark.parametrize("limit", [64, 0])
@pytest.mark.parametrize("bad", [[float("nan"), 1.0], [None, 1.0], None, [1.0], [1.0, 2.0, 3.0], []])
def test_malformed_points_are_refused_by_both_kernels(spark, monkeypatch, limit, bad):
    from fairsketch.functions import vectors as V
    from fairsketch.operators.assign import min_sq_distance, nearest_center

    monkeypatch.setattr(V, "UNROLL_LIMIT", limit)
    df = spark.createDataFrame([([0.5, 0.5], "A"), (bad, "B")], "p array<double>, grp string")
    for op in (nearest_center, min_sq_distance):
        with pytest.raises(Exception):
            op(df, CENTRES_2D).collect()
    with pytest.raises(Exception):
        objective.fair_objective(df, CENTRES_2D).collect()


@pytest.mark.parametrize("limit", [64, 0])
def test_given_ids_and_clashing_columns(spark, monkeypatch, limit):
    from fairsketch.functions import vectors as V
    from fairsketch.operators.assign import as_center_list, nearest_center

    monkeypatch.setattr(V, "UNROLL_LIMIT", limit)
    cs = spark.createDataFrame([(5, [10.0]), (0, [0.0]), (9, [10.0])], "cid int, c array<double>")
    df = spark.createDataFrame([([1.0], 7, -1.0, 3), ([9.0], 8, -1.0, 4)], "p array<double>, cid int, D2 double, _near0 int")
    rows = nearest_center(df, cs).orderBy("d2", "_near0").collect()
    assert [(r["cid"], r["d2"], r["_near0"]) for r in rows] == [(0, 1.0, 3), (5, 1.0, 4)]
    # a step's output (non-empty clusters only) can be chained: ids stay
    step = fair.fair_step(spark.createDataFrame([([1.0], "A"), ([9.0], "B")], "p array<double>, grp string"), cs)
    assert sorted(as_center_list(step).ids) == [0, 5]
    for broken in ([(1, [0.0]), (1, [2.0])], [(None, [0.0])], [(1, None)], [(1, [None])]):
        with pytest.raises(ValueError):
            as_center_list(spark.createDataFrame(broken, "cid int, c array<double>"))


def test_center_budget_is_checked_before_collecting(spark):
    from fairsketch.operators.assign import as_center_list

    wide = spark.range(1001).select(F.col("id").cast("int").alias("cid"), F.array_repeat(F.lit(0.5), 1000).alias("c"))
    with pytest.raises(ValueError, match="budget"):
        as_center_list(wide)


@pytest.mark.parametrize("text", ["1.0,,A\n", "1.0,nan,A\n", "1.0,2.0,C\n", "1.0,2.0,A\n\n3.0,4.0,B\n"])
def test_unusable_lines_fail(spark, tmp_path, text):
    from fairsketch.sources.points import read_points

    (tmp_path / "p.csv").write_text(text)
    with pytest.raises(Exception):
        read_points(spark, f"file:{tmp_path}/p.csv").collect()
    if "\n\n" not in text:  # the CSV reader has no blank lines
        with pytest.raises(Exception):
            read_points(spark, f"file:{tmp_path}/p.csv", dims=2).collect()


def test_ragged_points_fail_when_cached_and_when_not(spark):
    from fairsketch.sources.points import prepare

    df = spark.createDataFrame([([1.0], "A"), ([1.0, 99.0], "B")], "p array<double>, grp string")
    for persist in (True, False):
        with prepare(df, 1, persist=persist) as prep:
            with pytest.raises(Exception):
                fair.group_moments(prep.points, [(0.0,)]).collect()


@pytest.mark.parametrize("name", ["heavy_hitter_detail", "sketch_accuracy", "cm_estimate", "cs_estimate"])
def test_reports_scan_their_table_once(spark, name):
    import re

    from samples import SF0001
    from fairsketch.plans.queries import QUERIES
    from tools.plan_audit import final_only

    df = QUERIES[name](spark, SF0001)
    df.collect()
    assert len(re.findall("FileScan parquet", final_only(df._jdf.queryExecution().executedPlan().toString()))) == 1


@pytest.mark.parametrize("dims", [2, 40])
def test_filters_on_the_assignment_test_finished_values(spark, dims):
    import re

    from fairsketch.operators.assign import nearest_center

    rows = [([i % 5 + j % 2 / 10 for j in range(dims)], "A" if i % 3 else "B") for i in range(60)]
    pts = spark.createDataFrame(rows, "p array<double>, grp string")
    centers = spark.createDataFrame([(2**40 + 3, [0.0] * dims), (5, [2.0] * dims), (9, [4.0] * dims)], "cid bigint, c array<double>")
    near = nearest_center(pts, centers)
    assert dict(near.dtypes)["cid"] == "bigint"
    every = near.collect()
    assert 2**40 + 3 in {r["cid"] for r in every}
    some = near.where("cid = 5 AND d2 < 1 AND grp = 'A'").join(centers, "cid")
    assert sorted(map(tuple, some.select("p", "grp", "cid", "d2").collect())) == sorted(
        (r["p"], r["grp"], r["cid"], r["d2"]) for r in every if r["cid"] == 5 and r["d2"] < 1 and r["grp"] == "A")
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert all(len(line) < 200 for line in re.findall(r"Filter [^\n]*", plan))
