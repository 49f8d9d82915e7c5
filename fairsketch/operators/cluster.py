"""Standard k-means: Spark ML's k-means (k-means|| seeding) and a Lloyd loop from given centres."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..sources.points import prepare
from .assign import Centers, as_center_list, nearest_center


def kmeans(points: DataFrame, k: int, max_iter: int, seed: int | None = None,
           init_mode: str = "k-means||", init_steps: int = 2) -> list[tuple[float, ...]]:
    """Centres from Spark ML k-means over the coordinates (groups ignored).

    ``max_iter=0`` returns the seeding alone.  Spark may return fewer than ``k`` centres when
    there are fewer distinct points.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    if max_iter < 0:
        raise ValueError("max_iter must be >= 0")
    vec = points.select(array_to_vector("p").alias("features"))
    km = KMeans(k=k, maxIter=max_iter, initMode=init_mode, initSteps=init_steps, featuresCol="features")
    if seed is not None:
        km = km.setSeed(seed)
    model = km.fit(vec)
    return [tuple(float(v) for v in c) for c in model.clusterCenters()]


def init_centers(points: DataFrame, k: int, seed: int | None = None) -> list[tuple[float, ...]]:
    """k-means|| seeding only."""
    return kmeans(points, k, 0, seed)


def lloyd_step(points: DataFrame, centers, shared_code: bool = False) -> DataFrame:
    """``[cid, c]``: the mean of every non-empty cluster."""
    cs = as_center_list(centers)
    d = len(cs[0])
    per = (nearest_center(points.select("p"), cs, shared_code=shared_code).groupBy("cid")
           .agg(*[F.expr(f"avg(p[{j}])").alias(f"m{j}") for j in range(d)]))
    return per.select("cid", F.expr("array(" + ", ".join(f"m{j}" for j in range(d)) + ")").alias("c"))


def lloyd(points: DataFrame, init, m: int, persist: bool | None = None) -> list[tuple[float, ...]]:
    """``m`` Lloyd iterations from ``init``; an empty cluster keeps its centre.

    ``persist`` None caches the prepared points only when ``m >= 3`` (caching costs one extra
    pass, so it pays off from about three scans).
    """
    cs = as_center_list(init)
    if persist is None:
        persist = m >= 3
    with prepare(points, len(cs[0]), persist=persist) as prep:
        for _ in range(m):
            moved = {r["cid"]: r["c"] for r in lloyd_step(prep.points, cs, shared_code=True).collect()}  # at most K rows
            cs = Centers((moved.get(i, c) for i, c in zip(cs.ids, cs)), cs.ids)
    return cs
