"""Reproducible D²-weighted seeding (k-means++) from a hash of the points.

Each round draws one centre with probability proportional to a point's squared distance to the centres chosen so
far (times its multiplicity; in the first round the multiplicity alone).  The draw is an exponential race: every
distinct point gets u in (0, 1) from a polynomial hash of its coordinates and the round, and the smallest
-ln(u) / weight wins.  The result depends on the points alone, not on partitions, order or a generator's state, so
it has an exact oracle, and a recomputed task draws the same.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, functions as F

from ..functions import vectors as V
from .assign import Centers
from .objective import distinct_points

# Prime of the hash, and the grid on which coordinates are hashed.
PRIME = 2147483647
GRID = 1_000_000


def round_parameters(k: int, seed: int) -> list[tuple[int, int]]:
    """The hash parameters (a, b) of each round."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(k)]


def uniform_sql(coords: list[str], a: int, b: int) -> str:
    """SQL text of u in (0, 1): a polynomial in ``a`` over the coordinates on the grid, plus ``b``, modulo the prime."""
    acc = f"{b}L"
    for c in coords:
        acc = f"pmod({a}L * ({acc}) + pmod(CAST(floor({c} * {GRID}D) AS BIGINT), {PRIME}L), {PRIME}L)"
    return f"((pmod({a}L * ({acc}) + {b}L, {PRIME}L) + 0.5D) / {PRIME}D)"


def seed_centers(points: DataFrame, k: int, seed: int = 0, dims: int | None = None) -> Centers:
    """``k`` centres drawn from the points (fewer if there are fewer distinct ones).

    The distinct points are kept with their multiplicity; each of the ``k`` rounds is one aggregate over them that
    returns one row.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if dims is None:
        first = points.select(F.size("p").alias("d")).first()
        if first is None:
            raise ValueError("no points")
        dims = first["d"]
    V.check_budget(k, dims)
    distinct = distinct_points(points).persist()
    chosen: list[tuple[float, ...]] = []
    try:
        for a, b in round_parameters(k, seed):
            weight = "CAST(n AS DOUBLE)"
            if chosen:
                d2 = [V.sq_dist_sql("p", c) for c in chosen]
                weight = f"n * {d2[0]}" if len(d2) == 1 else f"n * least({', '.join(f'({x})' for x in d2)})"
                if len(d2) == 1:
                    weight = f"n * ({d2[0]})"
            u = uniform_sql([f"p[{j}]" for j in range(dims)], a, b)
            race = distinct.selectExpr("p", f"{weight} AS w", f"-ln({u}) AS e").where("w > 0")
            row = race.agg(F.min(F.expr("struct(e / w AS key, p)")).alias("least")).first()["least"]
            if row is None:
                break  # every point is a centre
            chosen.append(tuple(row["p"]))
    finally:
        distinct.unpersist()
    if not chosen:
        raise ValueError("no points")
    return Centers(chosen)
