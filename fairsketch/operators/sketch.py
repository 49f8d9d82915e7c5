"""Exact histograms, count-min and count sketches as DataFrames.

A sketch is the long table ``[r, c, v]`` of its non-zero cells (row ``r`` < d, column
``c`` < w).  Building it is row-local hashing (``inline`` of d rows per item, all in
generated code) followed by one hash aggregate on ``(r, c)``.  The partial aggregate
collapses every partition to at most d*w rows before the shuffle, so the shuffle size does not
grow with the stream, and a hot item (even a third of all rows) costs nothing extra.

Sketches over the same hash functions are linear: the sketch of a union is the cell-wise sum
(``merge``), which is how batches of a stream are accumulated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import HashFamily, SketchSpec, sketch_name

# Sketches with at most this many cells are broadcast to the probing side of an estimate;
# larger ones are joined by shuffle.
BROADCAST_CELLS = 2_000_000


def histogram(items: DataFrame, item_col: str = "item") -> DataFrame:
    """``[item, freq]``: the exact frequency of every distinct item."""
    return (items.where(F.col(item_col).isNotNull())
            .groupBy(F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("freq")))


def histogram_by(items: DataFrame, by: str, item_col: str = "item") -> DataFrame:
    """``[by, item, freq]``: the exact frequency of every item in every group."""
    return (items.where(F.col(item_col).isNotNull())
            .groupBy(by, F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("freq")))


def stream_totals(hist: DataFrame) -> DataFrame:
    """``[n_items, n_distinct]`` of a histogram."""
    return hist.agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.count(F.lit(1)).alias("n_distinct"))


def _weight_sql(weight: str | None) -> str:
    return f"CAST(`{weight}` AS BIGINT)" if weight else "1L"


def _inline(fields_per_row: list[str]) -> F.Column:
    """``inline(array(named_struct(...), ...))`` as one SQL-text expression (one JVM parse)."""
    return F.expr("inline(array(" + ", ".join(f"named_struct({f})" for f in fields_per_row) + "))")


def hash_rows(items: DataFrame, family: HashFamily, w: int | None = None, item_col: str = "item") -> DataFrame:
    """``[item, r, c]`` (bucket, when ``w`` is given) or ``[item, r, g]`` (sign in {-1, +1})."""
    if w is not None:
        rows = [f"'r', {r}, 'c', {family.bucket_sql(item_col, r, w)}" for r in range(family.d)]
    else:
        rows = [f"'r', {r}, 'g', {family.sign_sql(item_col, r)}" for r in range(family.d)]
    return items.select(F.col(item_col).alias("item"), _inline(rows))


def _cell_rows(items: DataFrame, w: int, h: HashFamily, g: HashFamily | None, item_col: str, weight: str | None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """``[*keep, r, c, f]``: what each item adds to its cell of every row."""
    f = _weight_sql(weight)
    rows = [f"'r', {r}, 'c', {h.bucket_sql(item_col, r, w)}, 'f', {f}{f' * {g.sign_sql(item_col, r)}' if g else ''}" for r in range(h.d)]
    return items.where(F.col(item_col).isNotNull()).select(*keep, _inline(rows))


def cell_rows(items: DataFrame, spec: SketchSpec, kind: str, item_col: str = "item", weight: str | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """``[*keep, r, c, f]`` for a sketch of the kind ``cm`` or ``cs``."""
    spec.fingerprint(kind)  # refuses other kinds
    h, g = (spec.cm_h, None) if kind == "cm" else (spec.cs_h, spec.cs_g)
    return _cell_rows(items, spec.w, h, g, item_col, weight, keep)


def _cells(rows: DataFrame, name: str) -> DataFrame:
    # the sketch's name travels with the column, so that merge and the estimates can refuse other ones
    return rows.groupBy("r", "c").agg(F.sum("f").alias("v", metadata={"sketch": name}))


def count_min(items: DataFrame, family: HashFamily, w: int, item_col: str = "item",
              weight: str | None = None) -> DataFrame:
    """``[r, c, v]``: count-min sketch cells, ``CM[r][h_r(x)] += f``.

    ``weight`` names a frequency column (e.g. build from a histogram); default 1 per row.
    """
    return _cells(_cell_rows(items, w, family, None, item_col, weight), sketch_name("cm", w, family))


def count_sketch(items: DataFrame, h: HashFamily, g: HashFamily, w: int, item_col: str = "item",
                 weight: str | None = None) -> DataFrame:
    """``[r, c, v]``: count-sketch cells, ``CS[r][h_r(x)] += f * g_r(x)``."""
    if h.d != g.d:
        raise ValueError("h and g need the same number of rows")
    return _cells(_cell_rows(items, w, h, g, item_col, weight), sketch_name("cs", w, h, g))


def sketches(items: DataFrame, spec: SketchSpec, item_col: str = "item",
             weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sketches of a stream: ``(cm_cells, cs_cells)``."""
    return (count_min(items, spec.cm_h, spec.w, item_col, weight),
            count_sketch(items, spec.cs_h, spec.cs_g, spec.w, item_col, weight))


def name_of(cells: DataFrame) -> str | None:
    """The sketch that the cells say they belong to (None for cells made elsewhere)."""
    return cells.schema["v"].metadata.get("sketch")


def _check(cells: DataFrame, name: str) -> None:
    if name_of(cells) not in (None, name):
        raise ValueError(f"cells of {name_of(cells)} do not belong to {name}")


def merge(*cells: DataFrame) -> DataFrame:
    """Cell-wise sum of sketches built with the same hash functions and width; others are refused."""
    if not cells:
        raise ValueError("nothing to merge")
    names = {n for n in map(name_of, cells) if n}
    if len(names) > 1:
        raise ValueError(f"sketches with different parameters cannot be merged: {', '.join(sorted(names))}")
    u = cells[0].select("r", "c", "v")
    for c in cells[1:]:
        u = u.unionByName(c.select("r", "c", "v"))
    return u.groupBy("r", "c").agg(F.sum("v").cast("bigint").alias("v", metadata={"sketch": n for n in names}))


def _probe(cells: DataFrame, d: int, w: int, broadcast_cells: int | None = None) -> DataFrame:
    """Broadcast while the sketch's cells are few; beyond that both sides are shuffled by (r, c) and merged."""
    return F.broadcast(cells) if d * w <= (BROADCAST_CELLS if broadcast_cells is None else broadcast_cells) else cells.hint("merge")


def estimate_cm(queries: DataFrame, cells: DataFrame, family: HashFamily, w: int,
                item_col: str = "item") -> DataFrame:
    """``[item, cm_est]``: min over rows of ``CM[r][h_r(x)]`` for every distinct query item (null items have none)."""
    _check(cells, sketch_name("cm", w, family))
    probes = hash_rows(queries.where(F.col(item_col).isNotNull()).select(item_col).distinct(), family, w, item_col)
    joined = probes.join(_probe(cells, family.d, w), ["r", "c"], "left")
    return joined.groupBy("item").agg(F.min(F.coalesce("v", F.lit(0))).cast("bigint").alias("cm_est"))


def estimate_cs(queries: DataFrame, cells: DataFrame, h: HashFamily, g: HashFamily, w: int,
                item_col: str = "item") -> DataFrame:
    """``[item, cs_est]``: ``sorted(CS[r][h_r(x)] * g_r(x))[d // 2]`` (upper median for even d)."""
    _check(cells, sketch_name("cs", w, h, g))
    rows = [f"'r', {r}, 'c', {h.bucket_sql(item_col, r, w)}, 'g', {g.sign_sql(item_col, r)}" for r in range(h.d)]
    known = queries.where(F.col(item_col).isNotNull()).select(item_col).distinct()
    probes = known.select(F.col(item_col).alias("item"), _inline(rows))
    joined = probes.join(_probe(cells, h.d, w), ["r", "c"], "left")
    est = F.coalesce("v", F.lit(0)) * F.col("g")
    return joined.groupBy("item").agg(
        F.sort_array(F.collect_list(est)).getItem(h.d // 2).cast("bigint").alias("cs_est"))


def estimate_both(queries: DataFrame, cm_cells: DataFrame, cs_cells: DataFrame, spec: SketchSpec,
                  item_col: str = "item", keep: tuple[str, ...] = ()) -> DataFrame:
    """``[item, *keep, cm_est, cs_est]`` in one pass for distinct query items.

    Each item yields d probe rows carrying both its count-min cell and its count-sketch cell
    and sign; both cell tables (at most d*w rows each) are joined to the probes, and a single
    aggregate by item takes the count-min minimum and the count-sketch upper median.
    ``keep`` columns must be functions of the item (e.g. its true frequency).
    """
    w, d = spec.w, spec.d
    _check(cm_cells, spec.fingerprint("cm"))
    _check(cs_cells, spec.fingerprint("cs"))
    rows = [f"'r', {r}, 'cm_c', {spec.cm_h.bucket_sql(item_col, r, w)}, "
            f"'cs_c', {spec.cs_h.bucket_sql(item_col, r, w)}, 'g', {spec.cs_g.sign_sql(item_col, r)}"
            for r in range(d)]
    probes = queries.select(F.col(item_col).alias("item"), *keep, _inline(rows))
    cm = _probe(cm_cells.select("r", F.col("c").alias("cm_c"), F.col("v").alias("cm_v")), d, w)
    cs = _probe(cs_cells.select("r", F.col("c").alias("cs_c"), F.col("v").alias("cs_v")), d, w)
    joined = probes.join(cm, ["r", "cm_c"], "left").join(cs, ["r", "cs_c"], "left")
    return joined.groupBy("item", *keep).agg(
        F.min(F.coalesce("cm_v", F.lit(0))).cast("bigint").alias("cm_est"),
        F.sort_array(F.collect_list(F.coalesce("cs_v", F.lit(0)) * F.col("g"))).getItem(d // 2)
        .cast("bigint").alias("cs_est"))
