"""Labelled cluster-mixture generator: N points in K discs that separate fair from standard k-means.

Each cluster is a disc of B points (radius R = 12/K) round a centre in one of the four
quadrants, plus a disc of A points of the same radius whose centre lies at 0.4R..0.7R from the
cluster centre in a random direction.  Clusters are spread over the quadrants in the order
(+,+), (-,+), (-,-), (+,-), K div 4 each and one more for the first K mod 4.  A centre is
sign * randint(4, 20) * 1.3 per axis.  Cluster sizes are N div K, the first N mod K clusters one
more.  A cluster has 1 + floor(u * floor(0.4 * (N div K))) A points (u uniform in [0, 1)) and
the rest are B.  Points are uniform in their disc (radius R * sqrt(U)).

Only the K-row cluster specification is drawn on the driver (seeded); the N points are
generated by ``spark.range(N)`` in parallel with seeded ``rand`` columns.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the generator.
QUADRANTS = [(1, 1), (-1, 1), (-1, -1), (1, -1)]
RADIUS_SCALE = 12.0
OFFSET_MIN, OFFSET_MAX = 4, 20
OFFSET_FACTOR = 1.3
A_RATIO_MIN, A_RATIO_MAX = 0.4, 0.7
A_FRACTION = 0.4

MAX_K = 1_000_000
# Cluster specifications up to this many rows are broadcast to the point generator; larger
# ones are joined by shuffle.
BROADCAST_K = 100_000


def spec(k: int, seed: int | None = None) -> list[dict]:
    """The K cluster rows: ``cid, cx, cy, ax, ay, u`` (independent of N)."""
    if k < 1 or k > MAX_K:
        raise ValueError(f"need 1 <= k <= {MAX_K}")
    rng = random.Random(seed)
    radius = RADIUS_SCALE / k
    per, extra = divmod(k, 4)
    rows = []
    for qi, (sx, sy) in enumerate(QUADRANTS):
        for _ in range(per + (1 if qi < extra else 0)):
            cx = sx * rng.randint(OFFSET_MIN, OFFSET_MAX) * OFFSET_FACTOR
            cy = sy * rng.randint(OFFSET_MIN, OFFSET_MAX) * OFFSET_FACTOR
            angle = rng.uniform(0, 2 * math.pi)
            ratio = rng.uniform(A_RATIO_MIN, A_RATIO_MAX)
            rows.append({"cid": len(rows), "cx": cx, "cy": cy,
                         "ax": cx + ratio * radius * math.cos(angle),
                         "ay": cy + ratio * radius * math.sin(angle),
                         "u": rng.random()})
    return rows


def _check(n: int, k: int) -> None:
    if k < 1 or n // k <= 4:
        raise ValueError("need N div K > 4")


def fair_gap_points(spark: SparkSession, n: int, k: int, seed: int | None = None,
                    partitions: int | None = None) -> DataFrame:
    """``[p: array<double>, grp, cid]``: N generated points (2-D)."""
    _check(n, k)
    rows = spec(k, seed)
    seed = seed if seed is not None else random.randrange(2 ** 31)
    radius = RADIUS_SCALE / k
    q, r = divmod(n, k)
    max_a = math.floor(q * A_FRACTION)
    clusters = spark.createDataFrame(  # K rows
        [(x["cid"], x["cx"], x["cy"], x["ax"], x["ay"], 1 + math.floor(x["u"] * max_a)) for x in rows],
        "cid int, cx double, cy double, ax double, ay double, n_a bigint")
    if k <= BROADCAST_K:
        clusters = F.broadcast(clusters)
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    big = r * (q + 1)
    # clusters 0..r-1 hold q+1 points, the others q: exact integer arithmetic on the id
    cid = F.expr(f"CASE WHEN id < {big} THEN id div {q + 1} ELSE {r} + (id - {big}) div {q} END")
    local = F.expr(f"CASE WHEN id < {big} THEN id % {q + 1} ELSE (id - {big}) % {q} END")
    pts = ids.select(cid.cast("int").alias("cid"), local.alias("j"),
                     (F.rand(seed) * F.lit(2 * math.pi)).alias("angle"),
                     (F.lit(radius) * F.sqrt(F.rand(seed + 1))).alias("rad"))
    pts = pts.join(clusters, "cid")
    is_a = F.col("j") < F.col("n_a")
    ox = F.when(is_a, F.col("ax")).otherwise(F.col("cx"))
    oy = F.when(is_a, F.col("ay")).otherwise(F.col("cy"))
    return pts.select(
        F.array(ox + F.col("rad") * F.cos("angle"), oy + F.col("rad") * F.sin("angle")).alias("p"),
        F.when(is_a, F.lit("A")).otherwise(F.lit("B")).alias("grp"),
        "cid")


def check_counts(points: DataFrame, k: int, seed: int | None) -> DataFrame:
    """``[cid, grp, n, in_disc, in_cluster]`` for the invariants of generated points."""
    rows = spec(k, seed)
    radius = RADIUS_SCALE / k
    centres = points.sparkSession.createDataFrame(
        [(x["cid"], x["cx"], x["cy"], x["ax"], x["ay"]) for x in rows],
        "cid int, cx double, cy double, ax double, ay double")
    if k <= BROADCAST_K:
        centres = F.broadcast(centres)
    x, y = F.col("p")[0], F.col("p")[1]
    is_a = F.col("grp") == "A"
    own = F.sqrt((x - F.when(is_a, F.col("ax")).otherwise(F.col("cx"))) ** 2
                 + (y - F.when(is_a, F.col("ay")).otherwise(F.col("cy"))) ** 2)
    whole = F.sqrt((x - F.col("cx")) ** 2 + (y - F.col("cy")) ** 2)
    tol = 1 + 1e-9
    return (points.join(centres, "cid").groupBy("cid", "grp")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.bool_and(own <= F.lit(radius * tol)).alias("in_disc"),
                 F.bool_and(whole <= F.lit((1 + A_RATIO_MAX) * radius * tol)).alias("in_cluster")))
