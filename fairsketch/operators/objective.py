"""Clustering objectives and per-cluster group counts.

All of these are one scan of the points plus a hash aggregate with map-side partial
aggregation: the shuffle carries at most (partitions x groups) partial rows, whatever the
number of points and however skewed the clusters are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .assign import as_center_list, center_frame, min_sq_distance, nearest_center


def _guard_nonempty(n: F.Column, name: str, value: F.Column) -> F.Column:
    return F.when(n == 0, F.raise_error(F.lit(f"group {name} is empty"))).otherwise(value)


def group_counts(points: DataFrame) -> DataFrame:
    """``[n, n_a, n_b]`` in a single pass."""
    return points.agg(F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("grp") == "A").alias("n_a"),
                      F.count_if(F.col("grp") == "B").alias("n_b"))


def group_filter(points: DataFrame, group: str) -> DataFrame:
    return points.where(F.col("grp") == group)


def distinct_points(points: DataFrame) -> DataFrame:
    """``[p, n]``: each distinct coordinate vector with its multiplicity (labels ignored)."""
    return points.groupBy("p").agg(F.count(F.lit(1)).alias("n"))


def standard_objective(points: DataFrame, centers, dedupe: bool = False) -> DataFrame:
    """``[delta]``: the k-means objective Δ(U, C).

    ``dedupe=False`` is the mean squared distance over all points.  ``dedupe=True`` sums the
    squared distance over *distinct* coordinate vectors and divides by the number of all points
    (duplicates contribute once to the numerator only).
    """
    cs = as_center_list(centers)
    if not dedupe:
        return nearest_center(points, cs).agg(F.avg("d2").alias("delta"))
    distinct = min_sq_distance(distinct_points(points), cs)
    return distinct.agg((F.sum("d2") / F.sum("n")).alias("delta"))


def group_objectives(points: DataFrame, centers) -> DataFrame:
    """``[grp, n, sum_d2, mean_d2]``: per-group average squared distance."""
    return (nearest_center(points, centers).groupBy("grp")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("sum_d2"), F.avg("d2").alias("mean_d2")))


def fair_objective(points: DataFrame, centers) -> DataFrame:
    """``[phi_a, phi_b, phi]``: Φ(A, B, C) = max(mean d² over A, mean d² over B), one pass."""
    a = F.col("grp") == "A"
    b = F.col("grp") == "B"
    agg = nearest_center(points, centers).agg(
        F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"),
        F.coalesce(F.sum(F.when(a, F.col("d2"))), F.lit(0.0)).alias("s_a"),
        F.coalesce(F.sum(F.when(b, F.col("d2"))), F.lit(0.0)).alias("s_b"))
    phi_a = _guard_nonempty(F.col("n_a"), "A", F.col("s_a") / F.col("n_a"))
    phi_b = _guard_nonempty(F.col("n_b"), "B", F.col("s_b") / F.col("n_b"))
    return (agg.select(phi_a.alias("phi_a"), phi_b.alias("phi_b"))
            .withColumn("phi", F.greatest("phi_a", "phi_b")))


def cluster_group_counts(points: DataFrame, centers, with_empty: bool = False) -> DataFrame:
    """``[cid, c, n_a, n_b]`` for each non-empty cluster, ordered by ``cid``; ``c`` is the centre.

    ``with_empty`` also lists empty clusters with zero counts (K rows).
    """
    cs = as_center_list(centers)
    out = (nearest_center(points, cs).groupBy("cid")
           .agg(F.count_if(F.col("grp") == "A").alias("n_a"),
                F.count_if(F.col("grp") == "B").alias("n_b")))
    out = center_frame(points.sparkSession, cs).join(out, "cid", "left" if with_empty else "inner")
    return out.select("cid", "c", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b")).orderBy("cid")


def cluster_summary(points: DataFrame, centers) -> DataFrame:
    """``[cid, n, n_a, n_b, sum_d2]`` per non-empty cluster."""
    return (nearest_center(points, centers).groupBy("cid")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("grp") == "A").alias("n_a"),
                 F.count_if(F.col("grp") == "B").alias("n_b"),
                 F.sum("d2").alias("sum_d2")))
