"""Many starts at once: fair k-means from several centre sets in one scan of the points an iteration.

Every operator takes the starts as ``{run_id: centres}`` or a frame ``[run_id, cid, c]`` (see ``assign.as_runs``).
An iteration assigns each point to all sets in its task and aggregates by (run, cluster, group), so the shuffle
carries at most partitions x 2·R·K partial rows and one job serves all runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.points import prepare
from .assign import Centers, as_runs, nearest_center_runs
from .fair import balance, finish_step, moments, run_stats, update_centers
from .objective import _guard_nonempty

RUN = ("run_id",)


def sweep_moments(points: DataFrame, runs) -> DataFrame:
    """Per (run, non-empty cluster, group): ``[run_id, cid, grp, n, m, scatter]``; at most 2·R·K rows."""
    sets = as_runs(runs)
    return moments(nearest_center_runs(points.select("p", "grp"), dict(sets)), ["run_id", "cid", "grp"], len(sets[0][1][0]))


def sweep_step(points: DataFrame, runs) -> DataFrame:
    """``[run_id, cid, c, gamma]``: one fair iteration of every run (non-empty clusters only)."""
    return update_centers(balance(run_stats(sweep_moments(points, runs), RUN)), RUN)


def sweep_objectives(points: DataFrame, runs) -> DataFrame:
    """``[run_id, phi_a, phi_b, phi]`` of every run's centres, in one scan."""
    a, b = F.col("grp") == "A", F.col("grp") == "B"
    agg = nearest_center_runs(points, runs).groupBy("run_id").agg(
        F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"),
        F.coalesce(F.sum(F.when(a, F.col("d2"))), F.lit(0.0)).alias("s_a"),
        F.coalesce(F.sum(F.when(b, F.col("d2"))), F.lit(0.0)).alias("s_b"))
    return agg.select("run_id", _guard_nonempty(F.col("n_a"), "A", F.col("s_a") / F.col("n_a")).alias("phi_a"),
                      _guard_nonempty(F.col("n_b"), "B", F.col("s_b") / F.col("n_b")).alias("phi_b")) \
        .withColumn("phi", F.greatest("phi_a", "phi_b"))


def fair_sweep(points: DataFrame, starts, m: int = 10, persist: bool | None = None) -> dict[int, Centers]:
    """The centres of every run after ``m`` fair iterations; an empty cluster keeps its centre.

    One job an iteration; its at most 2·R·K moment rows are finished on the driver.
    """
    sets = dict(as_runs(starts))
    if persist is None:
        persist = m >= 3
    with prepare(points, len(next(iter(sets.values()))[0]), persist=persist) as prep:
        for _ in range(m):
            rows: dict[int, list] = {run: [] for run in sets}
            for r in sweep_moments(prep.points, sets).collect():
                rows[r["run_id"]].append(r)
            for run, cs in sets.items():
                moved, _ = finish_step(rows[run])
                sets[run] = Centers((moved.get(i, c) for i, c in zip(cs.ids, cs)), cs.ids)
    return sets


def best_run(points: DataFrame, starts, m: int = 10) -> DataFrame:
    """``[run_id, phi_a, phi_b, phi, best]`` after ``m`` iterations; ``best`` marks the smallest phi (lowest id on ties)."""
    phis = sweep_objectives(points, fair_sweep(points, starts, m))
    least = phis.agg(F.min_by("run_id", F.struct("phi", "run_id")).alias("run")).scalar()  # R rows
    return phis.withColumn("best", F.col("run_id") == least)
