"""Top-K heavy hitters (with ties) and the accuracy of sketch estimates on them.

φ(K) is the K-th largest frequency.  It is found with a per-partition top-K followed by a merge
of at most K x partitions values (``limit`` over a sort), and used as a scalar subquery: the
heavy hitters are then a plain filter on the distributed histogram, so the answer - which may
hold many more than K items when frequencies tie - is never funnelled through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import SketchSpec
from .sketch import estimate_both


def phi_k(hist: DataFrame, k: int) -> DataFrame:
    """One row ``[phi]``: the K-th largest frequency (the smallest one if fewer than K items)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    return hist.select("freq").orderBy(F.desc("freq")).limit(k).agg(F.min("freq").alias("phi"))


def top_k_with_ties(hist: DataFrame, k: int) -> DataFrame:
    """``[item, freq]`` of every item with ``freq >= φ(K)`` (may be more than K items)."""
    return hist.where(F.col("freq") >= phi_k(hist, k).scalar())


def top_k_by(hist: DataFrame, k: int, by: str) -> DataFrame:
    """``[by, item, freq]``: the heavy hitters with ties of every group of a histogram ``[by, item, freq]``.

    Spark limits each task's rows of a group to the first ranks before it shuffles them, so a group sends at most k
    items (and those that tie with the last) a task, however many it has.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    order = Window.partitionBy(by).orderBy(F.desc("freq"))
    return hist.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= k).select(by, "item", "freq")


def report(hist: DataFrame, k: int, cm_cells: DataFrame, cs_cells: DataFrame, spec: SketchSpec) -> DataFrame:
    """``[item, freq, cm_est, cs_est, cm_err, cs_err]`` for the top-K heavy hitters.

    ``*_err`` is the relative error ``|f - f_est| / f``.
    """
    hh = top_k_with_ties(hist, k)
    # one pass: probes of both sketches joined to their (bounded) cells, one aggregate by item
    out = estimate_both(hh, cm_cells, cs_cells, spec, keep=("freq",))
    f = F.col("freq").cast("double")
    return out.select(
        "item", "freq", "cm_est", "cs_est",
        (F.abs(F.col("freq") - F.col("cm_est")) / f).alias("cm_err"),
        (F.abs(F.col("freq") - F.col("cs_est")) / f).alias("cs_err"))


def accuracy(rep: DataFrame) -> DataFrame:
    """``[n_hh, cm_avg_err, cs_avg_err]``: number of heavy hitters and average relative errors."""
    return rep.agg(F.count(F.lit(1)).alias("n_hh"),
                   F.avg("cm_err").alias("cm_avg_err"),
                   F.avg("cs_err").alias("cs_avg_err"))


def summary(hist: DataFrame, k: int, cm_cells: DataFrame, cs_cells: DataFrame, spec: SketchSpec) -> DataFrame:
    """One row: ``[n_items, n_distinct, n_hh, cm_avg_err, cs_avg_err]`` (the stream report)."""
    acc = accuracy(report(hist, k, cm_cells, cs_cells, spec))
    n_items = hist.agg(F.sum("freq").cast("bigint")).scalar()
    n_distinct = hist.agg(F.count(F.lit(1))).scalar()
    return acc.select(n_items.alias("n_items"), n_distinct.alias("n_distinct"), "*")
