"""Nearest-centre assignment (an argmin theta join of points against K centres).

The K centres are a bounded, small input: they are taken to the driver (at most ``max_k`` rows and
``vectors.MAX_CENTER_TERMS`` coordinates, checked before anything is collected) and inlined as
literals, so every point is assigned inside its own task with no shuffle and no join.

Centre ids are the caller's: a frame's ``cid`` values are kept (gaps and all), a plain sequence is
numbered from 0.  Ties go to the lowest id.  A malformed point (null, wrong length, or a null or NaN
coordinate) fails the query, whichever kernel runs.

Loops that assign the same points to a new set of centres every iteration pass
``shared_code=True``: the centres then reach the tasks as one ``array<double>`` scalar
subquery instead of literals, so the generated code is the same in every iteration and is
compiled once (new literals would cost a fresh compilation per iteration).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import vectors as V

# Largest number of centres accepted (they are inlined into every task).
MAX_K = 100_000


class Centers(list):
    """Centres as tuples in id order, with their ids in ``ids``."""

    def __init__(self, points, ids=None):
        super().__init__(tuple(float(v) for v in c) for c in points)
        self.ids = list(range(len(self))) if ids is None else list(ids)


def as_center_list(centers, max_k: int = MAX_K) -> Centers:
    """Centres in id order.

    Accepts a sequence of points (ids 0, 1, ...) or a DataFrame ``[cid, c: array<double>]`` (or with
    ``x0..x{d-1}`` columns).  A DataFrame is collected only after one aggregate has checked its row
    count, width and ids.
    """
    if isinstance(centers, Centers):
        out = centers
    elif isinstance(centers, DataFrame):
        cols = centers.columns
        if "c" in cols:
            sel = centers.select("cid", F.col("c").cast("array<double>").alias("c"))
        else:
            xs = sorted((c for c in cols if c.startswith("x") and c[1:].isdigit()), key=lambda c: int(c[1:]))
            sel = centers.select("cid", F.array(*[F.col(x).cast("double") for x in xs]).alias("c"))
        sel = sel.persist()  # computed once for the check and the rows
        try:
            n, known, width = sel.agg(F.count(F.lit(1)), F.count("cid"), F.max(F.size("c"))).first()
            if n > max_k:
                raise ValueError(f"more than {max_k} centres")
            if known < n:
                raise ValueError("a centre has no id")
            V.check_budget(n, width or 0)
            rows = sel.orderBy("cid").collect()  # at most max_k rows and MAX_CENTER_TERMS coordinates
        finally:
            sel.unpersist()
        if any(r["c"] is None or any(v is None for v in r["c"]) for r in rows):
            raise ValueError("a centre has no coordinates")
        out = Centers((r["c"] for r in rows), (r["cid"] for r in rows))
        if len(set(out.ids)) < len(out):
            raise ValueError("centre ids repeat")
    else:
        out = Centers(centers)
    if len(out) > max_k:
        raise ValueError(f"more than {max_k} centres")
    V.check_centers(out)
    return out


def _centers_param(spark, cs) -> F.Column:
    """The centres, flattened row-major, as a scalar subquery over a one-row JVM-side frame."""
    flat = ", ".join(V.num(v) for c in cs for v in c)
    return spark.range(1).select(F.expr(f"array({flat})").alias("c")).scalar()


def center_frame(spark, cs: Centers) -> DataFrame:
    """``[cid, c]`` of the centres, made in the JVM (K rows)."""
    rows = ", ".join(f"named_struct('cid', {i}, 'c', array({', '.join(V.num(v) for v in c)}))" for i, c in zip(cs.ids, cs))
    return spark.range(1).select(F.expr(f"inline(array({rows}))"))


def _kept(points: DataFrame, *new: str) -> list[str]:
    """The input's columns that stay; output columns replace those of the same name."""
    return [f"`{c}`" for c in points.columns if c.lower() not in new]


def _free(points: DataFrame, stem: str) -> str:
    """A column name prefix that no input column starts with."""
    while any(c.lower().startswith(stem) for c in points.columns):
        stem = "_" + stem
    return stem


def nearest_center(points: DataFrame, centers, p: str = "p", shared_code: bool = False) -> DataFrame:
    """Add ``cid`` (nearest centre, lowest id on ties) and ``d2`` (its squared distance).

    Columns of these names in ``points`` are replaced.  While the kernel is unrolled, the K distances
    are plain double columns, ``d2`` is their ``least`` and ``cid`` the first id reaching it: no
    tree of structs is compared.  Beyond ``UNROLL_LIMIT`` terms the vectorised kernel
    (``functions.vectors.nearest_arrow``) gives the same result.  ``shared_code`` reads the centres
    from a scalar subquery (see the module note).

    Both columns (bigint, double) leave through ``inline`` of one struct.  The optimizer does not copy
    expressions through a generator, so a filter or join on ``cid`` or ``d2`` tests the finished value
    instead of a copy of all K distances; filters on the input's own columns still reach the scan.
    """
    cs = as_center_list(centers)
    k, d = V.check_centers(cs)
    cols, tmp_stem = _kept(points, "cid", "d2"), _free(points, "_near")
    if k * d > V.UNROLL_LIMIT:
        # too large to unroll: the vectorised kernel (one Arrow round trip per batch)
        found = points.select("*", V.nearest_arrow(p, cs, cs.ids).alias(tmp_stem))
        return found.selectExpr(*cols, f"inline(array(named_struct('cid', {tmp_stem}.cid, 'd2', {tmp_stem}.d2)))")
    tmp = [f"{tmp_stem}{i}" for i in range(k)]
    if shared_code:
        base = points.select("*", _centers_param(points.sparkSession, cs).alias(f"{tmp_stem}c"))
        dist = [" + ".join(f"(`{p}`[{j}] - {tmp_stem}c[{i * d + j}]) * (`{p}`[{j}] - {tmp_stem}c[{i * d + j}])" for j in range(d))
                for i in range(k)]
    else:
        base = points
        dist = [V.sq_dist_sql(p, c) for c in cs]
    least = f"least({', '.join(tmp)})" if k > 1 else tmp[0]
    with_d = base.selectExpr(*cols, *([] if f"`{p}`" in cols else [f"`{p}`"]), *[f"{e} AS {t}" for t, e in zip(tmp, dist)]) \
        .selectExpr("*", f"{V.checked_sql(p, d, tmp[0], least)} AS {tmp_stem}d2")
    first = "CASE " + " ".join(f"WHEN {t} = {tmp_stem}d2 THEN {i}L" for i, t in zip(cs.ids, tmp)) + " END"
    return with_d.selectExpr(*cols, f"inline(array(named_struct('cid', {first}, 'd2', {tmp_stem}d2)))")


def min_sq_distance(points: DataFrame, centers, p: str = "p") -> DataFrame:
    """Add ``d2``: the squared distance to the nearest centre (replacing a column of that name)."""
    cs = as_center_list(centers)
    k, d = V.check_centers(cs)
    if k * d > V.UNROLL_LIMIT:
        return points.withColumn("d2", V.nearest_arrow(p, cs, cs.ids).getField("d2"))
    terms = [V.sq_dist_sql(p, c) for c in cs]
    return points.withColumn("d2", F.expr(V.checked_sql(p, d, terms[0], f"least({', '.join(terms)})" if k > 1 else terms[0])))


def point_distances(points: DataFrame, centers, p: str = "p", squared: bool = False) -> DataFrame:
    """Add ``dist_0 .. dist_{K-1}``: Euclidean (or squared) distance to each centre, in id order.

    One output column a centre, so K * D is limited to ``V.MAX_COLUMN_TERMS``.
    """
    cs = as_center_list(centers)
    k, d = V.check_centers(cs)
    if k * d > V.MAX_COLUMN_TERMS:
        raise ValueError(f"{k} distance columns of dimension {d}: use nearest_center, or fewer centres")
    return points.select("*", *V.distances(p, cs, squared=squared))


def as_runs(runs, max_rows: int = MAX_K) -> list[tuple[int, Centers]]:
    """Centre sets by run id, in id order: from a mapping ``{run_id: centres}`` or a frame ``[run_id, cid, c]``.

    All sets together are held to the limits of one (``max_rows`` rows and ``vectors.MAX_CENTER_TERMS`` values),
    checked before anything is collected.
    """
    if isinstance(runs, DataFrame):
        sel = runs.select("run_id", "cid", F.col("c").cast("array<double>").alias("c")).persist()
        try:
            n, known, width = sel.agg(F.count(F.lit(1)), F.count_if(F.expr("run_id IS NOT NULL AND cid IS NOT NULL")), F.max(F.size("c"))).first()
            if n > max_rows:
                raise ValueError(f"more than {max_rows} centres")
            if known < n:
                raise ValueError("a centre has no run or no id")
            V.check_budget(n, width or 0)
            sets: dict[int, list] = {}
            for r in sel.orderBy("run_id", "cid").collect():  # at most max_rows rows
                sets.setdefault(r["run_id"], []).append((r["cid"], r["c"]))
        finally:
            sel.unpersist()
        if any(c is None or any(v is None for v in c) for cs in sets.values() for _, c in cs):
            raise ValueError("a centre has no coordinates")
        out = [(run, Centers((c for _, c in cs), (i for i, _ in cs))) for run, cs in sets.items()]
        if any(len(set(cs.ids)) < len(cs) for _, cs in out):
            raise ValueError("centre ids repeat")
    else:
        out = [(run, as_center_list(cs)) for run, cs in sorted(runs.items())]
    if not out:
        raise ValueError("at least one run is required")
    shapes = [V.check_centers(cs) for _, cs in out]
    if len({d for _, d in shapes}) > 1:
        raise ValueError("all runs must have the same dimension")
    V.check_budget(sum(k for k, _ in shapes), shapes[0][1])
    return out


def nearest_center_runs(points: DataFrame, runs, p: str = "p") -> DataFrame:
    """Each point once for every run, with ``run_id``, ``cid`` and ``d2`` (its nearest centre in that run's set).

    The points are scanned once whatever the number of runs; the rows are multiplied inside their task, where a
    following aggregate by run folds them again.  Ties and malformed points are treated as in ``nearest_center``.
    """
    sets = as_runs(runs)
    d, k = len(sets[0][1][0]), max(len(cs) for _, cs in sets)
    cols, stem = _kept(points, "run_id", "cid", "d2"), _free(points, "_run")
    if k * d > V.UNROLL_LIMIT:
        found = points.select("*", V.nearest_runs_arrow(p, [(run, cs, cs.ids) for run, cs in sets]).alias(stem))
        return found.selectExpr(*cols, f"inline({stem})")
    # a point meets the sets one after the other, as rows: the code holds K * D terms whatever the number of runs
    # (smaller sets end with centres at infinity)
    rows = []
    for run, cs in sets:
        flat = [V.num(v) for c in cs for v in c] + ["CAST('Infinity' AS DOUBLE)"] * ((k - len(cs)) * d)
        ids = [f"{i}L" for i in cs.ids] + [f"{cs.ids[0]}L"] * (k - len(cs))
        rows.append(f"named_struct('r', {run}L, 'c', array({', '.join(flat)}), 'i', array({', '.join(ids)}))")
    own = cols if f"`{p}`" in cols else [*cols, f"`{p}`"]
    every = points.selectExpr(*own, f"inline(array({', '.join(rows)})) AS (run_id, {stem}c, {stem}i)")
    names = [f"{stem}{i}" for i in range(k)]
    terms = [" + ".join(f"(`{p}`[{j}] - {stem}c[{i * d + j}]) * (`{p}`[{j}] - {stem}c[{i * d + j}])" for j in range(d)) for i in range(k)]
    best = f"least({', '.join(names)})" if k > 1 else names[0]
    first = "CASE " + " ".join(f"WHEN {t} = {stem}d2 THEN {stem}i[{i}]" for i, t in enumerate(names)) + " END"
    return every.selectExpr("*", *[f"{t} AS {n}" for t, n in zip(terms, names)]) \
        .selectExpr("*", f"{V.checked_sql(p, d, names[0], best)} AS {stem}d2") \
        .selectExpr(*cols, "run_id", f"inline(array(named_struct('cid', {first}, 'd2', {stem}d2)))")
