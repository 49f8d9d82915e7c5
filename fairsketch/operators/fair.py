"""Socially fair k-means (two demographic groups A and B).

One fair Lloyd step, given centres C:

1. assign every point to its nearest centre (row-local, see ``assign``);
2. per cluster i: group sizes, group means μA_i, μB_i and within-group scatter ΔA_i, ΔB_i,
   as one hash aggregate by (cluster, group) with partial aggregation (``avg`` and
   ``var_pop`` are mergeable, so a huge or skewed cluster never has to sit in one task);
3. over the at most 2K (cluster, group) rows, in one global aggregate: α_i = nA_i/NA,
   β_i = nB_i/NB, ℓ_i = ‖μA_i − μB_i‖ and the fixed terms ΣΔA/NA, ΣΔB/NB;
4. the balance search: 10 rounds of bisection on γ, each evaluating
   x_i = (1−γ)β_iℓ_i / (γα_i + (1−γ)β_i),
   fA = ΣΔA/NA + Σ α_i x_i², fB = ΣΔB/NB + Σ β_i (ℓ_i − x_i)²,
   stopping early when fA = fB; x is kept from the last evaluated γ;
5. the new centre c_i = ((ℓ_i − x_i)μA_i + x_i μB_i)/ℓ_i, or μA_i when ℓ_i = 0.

A cluster with only one group takes the other group's mean for the missing one (so ℓ = 0 and
the missing group's scatter is 0).  As a DataFrame operator, steps 3-5 run on K rows as column
expressions, linear in K; the loop collects the at most 2K moment rows once per iteration and
finishes them on the driver, where the new centres are needed anyway.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.points import prepare
from .assign import Centers, as_center_list, nearest_center
from .objective import fair_objective
from . import cluster as _cluster

# Fixed value: bisection rounds of the balance search (the first evaluates γ = 1/2).
GAMMA_ROUNDS = 10


# Dimensions from which group moments are one vector aggregate instead of two expressions a dimension.
VECTOR_DIMS = 100


def moments(assigned: DataFrame, keys: list[str], d: int) -> DataFrame:
    """Per distinct ``keys``: ``[*keys, n, m, scatter]`` of the points ``p`` of dimension ``d``.

    ``m`` is the mean vector and ``scatter`` = n · Σ_j var_pop(x_j), the sum of squared distances of the
    points to it.  One aggregate with partial aggregation before the shuffle.  Up to ``VECTOR_DIMS``
    dimensions it is plain ``avg``/``var_pop`` in generated code; beyond, one mergeable vector summary a
    group, so the plan does not grow with the dimension.
    """
    if d > VECTOR_DIMS:
        summary = Summarizer.metrics("mean", "variance").summary(array_to_vector("p"))
        per = assigned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), summary.alias("s"))
        # the summary's variance is the sample one
        return per.select(*keys, "n", vector_to_array("s.mean").alias("m"),
                          (F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda acc, v: acc + v) * (F.col("n") - 1)).alias("scatter"))
    # per-dimension aggregates as SQL text: one JVM parse each instead of many client calls
    aggs = [F.count(F.lit(1)).alias("n")]
    for j in range(d):
        aggs += [F.expr(f"avg(p[{j}])").alias(f"m{j}"), F.expr(f"var_pop(p[{j}])").alias(f"v{j}")]
    return assigned.groupBy(*keys).agg(*aggs).selectExpr(
        *keys, "n", "array(" + ", ".join(f"m{j}" for j in range(d)) + ") AS m",
        "n * (" + " + ".join(f"v{j}" for j in range(d)) + ") AS scatter")


def group_moments(points: DataFrame, centers, shared_code: bool = False) -> DataFrame:
    """Per (non-empty cluster, group): ``[cid, grp, n, m, scatter]`` (see ``moments``); at most 2K rows."""
    cs = as_center_list(centers)
    return moments(nearest_center(points.select("p", "grp"), cs, shared_code=shared_code), ["cid", "grp"], len(cs[0]))


def cluster_moments(points: DataFrame, centers, shared_code: bool = False) -> DataFrame:
    """Per non-empty cluster: ``[cid, n_a, n_b, ell, d_a, d_b, mu_a, mu_b]`` (the group rows folded)."""
    return fold_groups(group_moments(points, centers, shared_code))


def fold_groups(groups: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row a cluster (of each ``by``) from its one or two group rows (see ``cluster_moments``)."""
    folded = groups.groupBy(*by, "cid").agg(
        F.expr("coalesce(sum(CASE WHEN grp = 'A' THEN n END), 0)").alias("n_a"),
        F.expr("coalesce(sum(CASE WHEN grp = 'B' THEN n END), 0)").alias("n_b"),
        F.expr("coalesce(sum(CASE WHEN grp = 'A' THEN scatter END), 0D)").alias("d_a"),
        F.expr("coalesce(sum(CASE WHEN grp = 'B' THEN scatter END), 0D)").alias("d_b"),
        F.expr("max(CASE WHEN grp = 'A' THEN m END)").alias("ma"),
        F.expr("max(CASE WHEN grp = 'B' THEN m END)").alias("mb"))
    return folded.selectExpr(
        *by, "cid", "n_a", "n_b", f"{_ELL_SQL.format(a='ma', b='mb')} AS ell", "d_a", "d_b",
        "coalesce(ma, mb) AS mu_a", "coalesce(mb, ma) AS mu_b")


# ℓ = ‖μA − μB‖ when both groups are present (coordinates summed in order), else 0
_ELL_SQL = ("CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN "
            "sqrt(aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, (acc, t) -> acc + t)) "
            "ELSE 0D END")


def _guard(n: Column, g: str, v: Column) -> Column:
    return F.when(n == 0, F.raise_error(F.lit(f"group {g} is empty"))).otherwise(v)


def cluster_stats(points: DataFrame, centers) -> DataFrame:
    """Per non-empty cluster: ``[cid, n_a, n_b, na_total, nb_total, alpha, beta, ell, d_a, d_b, mu_a, mu_b]``.

    The group totals come from a window over the K cluster rows (one small partition).
    """
    everything = Window.partitionBy()
    m = cluster_moments(points, centers).select(
        "*", F.sum("n_a").over(everything).alias("na_total"), F.sum("n_b").over(everything).alias("nb_total"))
    return m.select(
        "cid", "n_a", "n_b", "na_total", "nb_total",
        _guard(F.col("na_total"), "A", F.col("n_a") / F.col("na_total")).alias("alpha"),
        _guard(F.col("nb_total"), "B", F.col("n_b") / F.col("nb_total")).alias("beta"),
        "ell", "d_a", "d_b", "mu_a", "mu_b")


def run_stats(groups: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row (of each ``by``): ``[*by, na, nb, fixed_a, fixed_b, clusters]`` from the per-(cluster, group) moments.

    ``clusters`` holds the K cluster statistics ordered by cid (``alpha``, ``beta``, ``ell``,
    ``mu_a``, ``mu_b``).  The at most 2K group rows are folded by cluster in one aggregate and
    gathered in a second, so the work is linear in K.  A one-sided cluster takes the other
    group's mean for the missing group (so ℓ = 0).
    """
    agg = fold_groups(groups, by).groupBy(*by).agg(
        F.expr("coalesce(sum(n_a), 0)").alias("na"), F.expr("coalesce(sum(n_b), 0)").alias("nb"),
        F.expr("coalesce(sum(d_a), 0D)").alias("sum_d_a"), F.expr("coalesce(sum(d_b), 0D)").alias("sum_d_b"),
        F.expr("array_sort(collect_list(named_struct('cid', cid, 'n_a', n_a, 'n_b', n_b, 'ell', ell, "
               "'mu_a', mu_a, 'mu_b', mu_b)))").alias("_cl"))
    na, nb = F.col("na"), F.col("nb")
    return agg.select(
        *by, "na", "nb",
        _guard(na, "A", F.col("sum_d_a") / na).alias("fixed_a"),
        _guard(nb, "B", F.col("sum_d_b") / nb).alias("fixed_b"),
        F.expr("transform(_cl, c -> named_struct('cid', c.cid, 'alpha', c.n_a / na, 'beta', c.n_b / nb, "
               "'ell', c.ell, 'mu_a', c.mu_a, 'mu_b', c.mu_b))").alias("clusters"))


def _x_sql(c: str, g: str) -> str:
    """x_i = (1-γ)β_iℓ_i / (γα_i + (1-γ)β_i) as SQL text over a cluster struct ``c``."""
    return f"(((1D - {g}) * {c}.beta * {c}.ell) / ({g} * {c}.alpha + (1D - {g}) * {c}.beta))"


def gamma_search_sql(clusters: str = "clusters", fixed_a: str = "fixed_a", fixed_b: str = "fixed_b",
                     rounds: int = GAMMA_ROUNDS) -> str:
    """SQL text of the γ of the last evaluated round of the bisection.

    γ lies on the grid of 1/2^rounds.  The state is the bracket's lower end ``lo`` and its ``width``
    in grid steps, and the γ last used.  Each round takes the bracket's middle, evaluates fA and fB
    there in one pass over the clusters in cid order, and keeps the upper half when fA > fB, the lower
    when fA < fB; equal costs end the search (width 0).  One-element arrays bind a round's values once.
    """
    grid = 1 << rounds
    x = _x_sql("c", "g")
    costs = (f"aggregate({clusters}, named_struct('a', {fixed_a}, 'b', {fixed_b}), (acc, c) -> named_struct("
             f"'a', acc.a + c.alpha * {x} * {x}, 'b', acc.b + c.beta * (c.ell - {x}) * (c.ell - {x})))")
    moved = ("named_struct('lo', CASE WHEN f.a > f.b THEN v.lo + v.width / 2D ELSE v.lo END, "
             "'width', CASE WHEN f.a = f.b THEN 0D ELSE v.width / 2D END, 'used', g)")
    return (f"aggregate(sequence(1, {int(rounds)}), named_struct('lo', 0D, 'width', {grid}D, 'used', 0D), (s, t) -> "
            f"CASE WHEN s.width = 0D THEN s ELSE aggregate(array((s.lo + s.width / 2D) / {grid}D), s, (u, g) -> "
            f"aggregate(array({costs}), u, (v, f) -> {moved})) END).used")


def gamma_search(clusters: str = "clusters", fixed_a: str = "fixed_a", fixed_b: str = "fixed_b",
                 rounds: int = GAMMA_ROUNDS) -> Column:
    """The γ of the last evaluated round of the bisection (a column expression)."""
    return F.expr(gamma_search_sql(clusters, fixed_a, fixed_b, rounds))


def balance(run: DataFrame) -> DataFrame:
    """Add ``gamma`` (last evaluated) and ``x`` (array of ``struct(cid, x)``) to a run row."""
    withg = run.select("*", gamma_search().alias("gamma"))
    return withg.selectExpr(
        "*", f"transform(clusters, c -> named_struct('cid', c.cid, 'x', {_x_sql('c', 'gamma')})) AS x")


def update_centers(balanced: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``[*by, cid, c, gamma]``: the moved centre of every non-empty cluster."""
    x = _x_sql("c", "gamma")
    moved = (f"transform(clusters, c -> named_struct('cid', c.cid, 'c', CASE WHEN c.ell = 0D THEN c.mu_a "
             f"ELSE zip_with(c.mu_a, c.mu_b, (a, b) -> ((c.ell - {x}) * a + {x} * b) / c.ell) END))")
    return balanced.select(*by, F.inline(F.expr(moved)), "gamma")


def fair_step(points: DataFrame, centers, shared_code: bool = False) -> DataFrame:
    """``[cid, c, gamma]``: one fair Lloyd iteration from ``centers`` (non-empty clusters only).

    ``shared_code`` passes the centres as a scalar subquery (for loops; see ``assign``).
    """
    return update_centers(balance(run_stats(group_moments(points, centers, shared_code))))


def finish_step(rows: list, rounds: int = GAMMA_ROUNDS) -> tuple[dict[int, tuple[float, ...]], float]:
    """(moved centre of every non-empty cluster, γ) from the collected ``group_moments`` rows.

    The same arithmetic as ``balance`` and ``update_centers`` on at most 2K rows, for loops: no second
    job and no expression to plan.
    """
    by: dict[int, dict] = {}
    for r in rows:
        by.setdefault(r["cid"], {})[r["grp"]] = r
    total = {g: sum(r["n"] for r in rows if r["grp"] == g) for g in "AB"}
    for g, n in total.items():
        if not n:
            raise ValueError(f"group {g} is empty")
    ids = sorted(by)
    mean = {g: np.array([(by[i].get(g) or next(iter(by[i].values())))["m"] for i in ids]) for g in "AB"}
    share = {g: np.array([by[i][g]["n"] if g in by[i] else 0 for i in ids]) / total[g] for g in "AB"}
    fixed = {g: sum(by[i][g]["scatter"] for i in ids if g in by[i]) / total[g] for g in "AB"}
    ell = np.sqrt(((mean["A"] - mean["B"]) ** 2).cumsum(axis=1)[:, -1])

    def x_at(g: float) -> np.ndarray:
        return ((1 - g) * share["B"] * ell) / (g * share["A"] + (1 - g) * share["B"])

    lo, width, gamma = 0, 1 << rounds, 0.5
    while width > 1:
        gamma = (lo + width // 2) / (1 << rounds)
        x = x_at(gamma)
        a = np.cumsum(np.append(fixed["A"], share["A"] * x * x))[-1]
        b = np.cumsum(np.append(fixed["B"], share["B"] * (ell - x) * (ell - x)))[-1]
        if a == b:
            break
        width //= 2
        lo += width if a > b else 0
    x, safe = x_at(gamma)[:, None], np.where(ell == 0, 1, ell)[:, None]
    moved = np.where(ell[:, None] == 0, mean["A"], ((safe - x) * mean["A"] + x * mean["B"]) / safe)
    return {i: tuple(c.tolist()) for i, c in zip(ids, moved)}, gamma


def fair_kmeans(points: DataFrame, k: int | None = None, m: int = 10, seed: int | None = None,
                init=None, persist: bool | None = None, history: list | None = None) -> list[tuple[float, ...]]:
    """Fair Lloyd: seed with k-means|| (or ``init``), then ``m`` fair steps.

    An empty cluster keeps its previous centre.  ``history``, when given, receives the γ of
    every step.  Returns the K centres.  The points are parsed once into a cached, spread-out
    form (``sources.points.prepare``) when the job scans them at least three times (``persist``
    None: k-means|| seeding, or ``m >= 3``); ``persist=False`` when the caller prepared them.
    A step is one job; its at most 2K moment rows are finished on the driver.
    """
    if init is None and k is None:
        raise ValueError("give k or init")
    if persist is None:
        persist = init is None or m >= 3
    dims = len(as_center_list(init)[0]) if init is not None else None
    with prepare(points, dims, persist=persist) as prep:
        pts = prep.points
        if init is None:
            init = _cluster.init_centers(pts, k, seed)
        cs = as_center_list(init)
        for _ in range(m):
            moved, gamma = finish_step(group_moments(pts, cs, shared_code=True).collect())
            cs = Centers((moved.get(i, c) for i, c in zip(cs.ids, cs)), cs.ids)
            if history is not None:
                history.append(gamma)
        return cs


def compare(points: DataFrame, k: int | None = None, m: int = 10, seed: int | None = None, init=None) -> DataFrame:
    """``[method, phi_a, phi_b, phi]`` of standard and fair centres after ``m`` iterations.

    With ``init`` both methods start there (Lloyd and fair Lloyd); without, both are seeded by k-means||.
    """
    with prepare(points, None if init is None else len(as_center_list(init)[0])) as prep:
        pts = prep.points
        if init is not None:
            stand = _cluster.lloyd(pts, init, m, persist=False)
        else:
            stand = _cluster.kmeans(pts, k, m, seed)
        fair = fair_kmeans(pts, k, m, seed, init=init, persist=False)
        rows = []
        for name, cs in (("standard", stand), ("fair", fair)):
            r = fair_objective(pts, cs).first()
            rows.append((name, r["phi_a"], r["phi_b"], r["phi"]))
    return points.sparkSession.createDataFrame(rows, "method string, phi_a double, phi_b double, phi double")
