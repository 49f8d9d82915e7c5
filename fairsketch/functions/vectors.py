"""Column expressions over coordinate arrays ``p: array<double>``.

Two kernels compute squared distances to a small, known set of centres:

* unrolled: plain column arithmetic ``(p[0]-c0)*(p[0]-c0) + ...``; stays inside whole-stage
  codegen, no Python round trip (used while ``K * D`` is small, ``UNROLL_LIMIT``);
* vectorised (``nearest_arrow``): for large ``K * D`` an Arrow UDF around a small NumPy loop
  (measured 4-10x faster than an unrolled tree that large).  It sums the coordinates in the same
  order, so distances are bit-identical, and keeps the lowest id on ties.

Both refuse malformed points (null, wrong length, null or NaN coordinates) with the same message.
All are row-local: assigning points to centres never shuffles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# K*D terms up to which the nearest-centre kernel is unrolled into column arithmetic; larger
# sets use the vectorised kernel.  Measured on 600k points (local[8]): level at K*D = 24,
# vectorised 4-5x faster at 150 and ~10x at 640, even with the unrolled code compiled once.
UNROLL_LIMIT = 64
# Centre literals larger than this (K*D doubles, 8 MB) are refused: they travel with every task.
MAX_CENTER_TERMS = 1_000_000
# Terms of the one-column-a-centre form (point_distances), which has no other kernel.
MAX_COLUMN_TERMS = 4096

MALFORMED = "malformed point: null, wrong length, or a null or NaN coordinate"

Centers = Sequence[Sequence[float]]


def coord(p: Column | str, j: int) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return p.getItem(j)


def num(v: float) -> str:
    """A double literal in SQL text (exact: the shortest repr round-trips).

    ``-0.0`` is written as ``0.0``: squared differences do not change, and a projection that
    holds both signed zeros as literals was seen to mix up common subexpressions in generated
    code (wrong distances), so they are never emitted together.
    """
    v = float(v) + 0.0
    if not math.isfinite(v):
        raise ValueError("centre coordinates must be finite")
    return f"{v!r}D"


def sq_dist_sql(p: str, c: Sequence[float]) -> str:
    """SQL text of the squared distance between array column ``p`` and literal point ``c``,
    summed in coordinate order like a plain loop."""
    terms = [f"(`{p}`[{j}] - {num(v)}) * (`{p}`[{j}] - {num(v)})" for j, v in enumerate(c)]
    return " + ".join(terms) if terms else "0D"


def sq_dist(p: Column | str, c: Sequence[float]) -> Column:
    """Squared Euclidean distance between the array column ``p`` and a literal point ``c``."""
    if isinstance(p, str):
        return F.expr(sq_dist_sql(p, c))
    total = None
    for j, cj in enumerate(c):
        diff = coord(p, j) - F.lit(float(cj) + 0.0)  # no signed zero literal (see num)
        term = diff * diff
        total = term if total is None else total + term
    return total if total is not None else F.lit(0.0)


def checked_sql(p: str, d: int, some: str, value: str) -> str:
    """``value``, or an error if the point ``p`` is malformed; ``some`` is any of its squared distances
    (null or NaN exactly when a coordinate is)."""
    return f"if(size(`{p}`) = {d} AND {some} IS NOT NULL AND NOT isnan({some}), {value}, CAST(raise_error('{MALFORMED}') AS DOUBLE))"


def check_budget(k: int, d: int) -> None:
    if k * d > MAX_CENTER_TERMS:
        raise ValueError(f"{k} centres of dimension {d} exceed the literal budget {MAX_CENTER_TERMS}")


def check_centers(centers: Centers) -> tuple[int, int]:
    k = len(centers)
    if k == 0:
        raise ValueError("at least one centre is required")
    d = len(centers[0])
    if d == 0 or any(len(c) != d for c in centers):
        raise ValueError("all centres must have the same, non-zero dimension")
    check_budget(k, d)
    return k, d


# Rows x centres evaluated at once inside the vectorised kernel (bounds its memory per batch).
ARROW_BLOCK_CELLS = 2_000_000


def point_matrix(points: pa.Array, d: int) -> np.ndarray:
    """The points of an Arrow batch as an n x d matrix; a malformed one fails."""
    flat = points.flatten()
    if points.null_count or flat.null_count or any(np.diff(points.offsets.to_numpy()) != d):
        raise ValueError(MALFORMED)
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(points), d)
    if np.isnan(x).any():
        raise ValueError(MALFORMED)
    return x


def nearest_rows(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared distance, place) of each point's nearest centre, the first one on ties.

    Squared differences are summed in coordinate order, as the unrolled form does.
    """
    n, d = x.shape
    best = np.full(n, np.inf)
    arg = np.zeros(n, dtype=np.int64)
    block = max(1, ARROW_BLOCK_CELLS // max(1, n))
    for k0 in range(0, len(centers), block):
        cb = centers[k0:k0 + block]
        acc = np.zeros((n, len(cb)))
        for j in range(d):
            diff = x[:, j:j + 1] - cb[None, :, j]
            acc += diff * diff
        m = acc.min(axis=1)
        better = m < best  # strict: an earlier block keeps its ties
        arg = np.where(better, acc.argmin(axis=1) + k0, arg)
        best = np.where(better, m, best)
    return best, arg


def center_matrix(centers: Centers) -> np.ndarray:
    return np.asarray([[float(v) + 0.0 for v in c] for c in centers], dtype=np.float64)


def nearest_arrow(p: str, centers: Centers, ids: Sequence[int]) -> Column:
    """``struct(d2, cid)`` of the nearest centre, computed batch-wise with NumPy in an Arrow UDF.

    The K x D centre array (at most ``MAX_CENTER_TERMS`` values) travels with the function; the
    points' flat child buffer is reshaped without per-row objects and compared with blocks of
    centres, squared differences summed in coordinate order, and the first minimum kept.
    """
    k, d = check_centers(centers)
    cmat = center_matrix(centers)
    names = np.asarray(ids, np.int64)

    @F.arrow_udf("struct<d2: double, cid: bigint>")
    def _nearest(points: pa.Array) -> pa.Array:
        best, arg = nearest_rows(point_matrix(points, d), cmat)
        return pa.StructArray.from_arrays([pa.array(best), pa.array(names[arg])], ["d2", "cid"])

    return _nearest(F.col(p))


def nearest_runs_arrow(p: str, runs: Sequence[tuple[int, Centers, Sequence[int]]]) -> Column:
    """``array(struct(run_id, cid, d2))``: the nearest centre of each of several centre sets, in one Arrow UDF."""
    d = check_centers(runs[0][1])[1]
    sets = [(center_matrix(cs), np.asarray(ids, np.int64)) for _, cs, ids in runs]
    names = np.asarray([r for r, _, _ in runs], np.int64)

    @F.arrow_udf("array<struct<run_id: bigint, cid: bigint, d2: double>>")
    def _nearest_runs(points: pa.Array) -> pa.Array:
        x = point_matrix(points, d)
        n, r = len(x), len(sets)
        d2, cid = np.empty((n, r)), np.empty((n, r), np.int64)
        for k, (cmat, ids) in enumerate(sets):
            d2[:, k], arg = nearest_rows(x, cmat)
            cid[:, k] = ids[arg]
        rows = pa.StructArray.from_arrays([pa.array(np.tile(names, n)), pa.array(cid.ravel()), pa.array(d2.ravel())],
                                          ["run_id", "cid", "d2"])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, n * r + 1, r), pa.int32()), rows)

    return _nearest_runs(F.col(p))


def distances(p: str, centers: Centers, squared: bool = True) -> list[Column]:
    """One distance column per centre (``dist_i``)."""
    out = []
    for i, c in enumerate(centers):
        d2 = sq_dist_sql(p, c)
        out.append(F.expr(d2 if squared else f"sqrt({d2})").alias(f"dist_{i}"))
    return out
