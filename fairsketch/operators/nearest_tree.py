"""Nearest centre among very many centres, by ball trees.

``nearest_center`` compares every point with every centre, which is best for a few hundred.  Here the centres are
split at the median of their widest coordinate until a leaf holds ``LEAF`` of them; each node has a ball that
encloses its centres.  A batch of points first goes down to one leaf each, which gives a bound; then every node is
visited once with the points whose bound its ball does not rule out (triangle inequality).  The result equals
the full comparison bit for bit, ties included: distances are summed in coordinate order, balls are ruled out with a
margin above rounding, and equal distances go to the lowest id.

Up to ``MAX_TREE_K`` centres and ``MAX_TREE_TERMS`` values are one tree, which is broadcast; the points stay where they
are.  More centres stay distributed:

* A bounded sample of the centres is halved into the leaves of a k-d tree (``Top``); it and the boxes of the leaves
  are broadcast.  Every centre goes to its leaf, and a leaf's centres are one row.
* Points are dealt by cell (``UNDER`` levels of the tree above the leaves) in groups of bounded size.  A few sampled
  centres of a point's leaf bound its distance, and a group asks for the leaves whose boxes these bounds reach.
* Each group gets these leaves, makes a ball tree of their centres and searches it.

The sample decides how even the leaves are, not the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import vectors as V
from ..session import checkpoint_root
from .assign import _free, _kept

LEAF = 48
# Centres of a tree that is broadcast, and values of any tree.
MAX_TREE_K = 1 << 15
MAX_TREE_TERMS = 32_000_000  # 256 MB
# Centres and sampled centres of a leaf of the top, levels below a cell, most leaves, values sampled, and bounding centres.
LEAF_CENTERS, LEAF_SAMPLE, UNDER, MAX_LEAVES, SAMPLE_TERMS, BOUNDING = 512, 16, 6, 1 << 14, 1 << 20, 8
# Points of a group, about.
GROUP_POINTS = 1 << 19
# Distances and radii are trusted up to this relative error when a ball is ruled out.
MARGIN = 1e-9


class BallTree:
    """Centres (rows of ``c``, coordinates finite) with distinct ``ids``."""

    def __init__(self, c: np.ndarray, ids: np.ndarray):
        by = np.argsort(ids)
        self.c, self.ids = np.ascontiguousarray(c[by] + 0.0), ids[by]
        self.middle, self.radius, self.sides, self.leaf = [], [], [], []
        self._split(np.arange(len(ids)))

    def _split(self, rows: np.ndarray) -> int:
        node, part = len(self.middle), self.c[rows]
        middle = part.mean(axis=0)
        self.middle.append(middle)
        self.radius.append(float(np.sqrt(((part - middle) ** 2).sum(axis=1)).max()))
        self.sides.append(None)
        self.leaf.append(None)
        if len(rows) <= LEAF or self.radius[node] == 0:
            self.leaf[node] = np.sort(rows)  # ids rise with rows
        else:
            by = np.argsort(part[:, int(np.ptp(part, axis=0).argmax())], kind="stable")
            half = len(rows) // 2
            self.sides[node] = (self._split(rows[by[:half]]), self._split(rows[by[half:]]))
        return node

    def _away(self, node: int, x: np.ndarray) -> np.ndarray:
        gap = x - self.middle[node]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(squared distance, id of the nearest centre, centres compared) of each row of ``x``."""
        best, row, met = np.full(len(x), np.inf), np.full(len(x), len(self.ids)), np.zeros(len(x), np.int64)

        def compare(node: int, some: np.ndarray) -> None:
            for lo in range(0, len(self.leaf[node]), 4096):  # a leaf of equal centres may be large
                rows = self.leaf[node][lo:lo + 4096]
                d2, at = V.nearest_rows(x[some], self.c[rows])
                better = (d2 < best[some]) | ((d2 == best[some]) & (rows[at] < row[some]))
                best[some[better]], row[some[better]] = d2[better], rows[at[better]]
                met[some] += len(rows)

        first = np.full(len(x), -1)

        def descend(node: int, some: np.ndarray) -> None:
            if not len(some):
                return
            if self.leaf[node] is not None:
                first[some] = node
                compare(node, some)
                return
            a, b = self.sides[node]
            left = self._away(a, x[some]) <= self._away(b, x[some])
            descend(a, some[left])
            descend(b, some[~left])

        def visit(node: int, some: np.ndarray) -> None:
            away = self._away(node, x[some])
            least = away - self.radius[node] - MARGIN * (away + self.radius[node])
            some = some[(least <= 0) | (least * least <= best[some])]
            if not len(some):
                return
            if self.leaf[node] is not None:
                compare(node, some[first[some] != node])
                return
            for side in self.sides[node]:
                visit(side, some)

        descend(0, np.arange(len(x)))
        visit(0, np.arange(len(x)))
        return best, self.ids[row], met


class Top:
    """A k-d tree of 2**levels leaves over all centres, from a sample of them; its nodes are numbered as in a heap.

    Points beyond ``value[node]`` on ``axis[node]`` go right.  After ``box`` each node has the box of its centres.
    """

    def __init__(self, some: np.ndarray, levels: int, under: int):
        self.levels, self.under = levels, min(under, levels)
        self.axis, self.value = np.zeros(1 << levels, np.int64), np.full(1 << levels, np.inf)
        parts = [np.arange(len(some))]
        for level in range(levels):
            halves = []
            for node, rows in enumerate(parts, 1 << level):
                right = rows[:0]
                if len(rows) > 1:  # distinct, so some coordinate differs
                    axis = int(np.ptp(some[rows], axis=0).argmax())
                    rows = rows[np.argsort(some[rows, axis], kind="stable")]
                    steps = np.flatnonzero(np.diff(some[rows, axis])) + 1
                    half = int(steps[np.abs(steps - len(rows) // 2).argmin()])
                    self.axis[node], self.value[node] = axis, some[rows[half - 1], axis]
                    rows, right = rows[:half], rows[half:]
                halves += [rows, right]
            parts = halves
        # sampled centres of each leaf that a point can reach
        self.bounding = np.zeros((1 << levels, BOUNDING, some.shape[1]))
        for leaf, rows in enumerate(parts):
            if len(rows):
                self.bounding[leaf] = some[np.resize(rows, BOUNDING)]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(self.levels):
            node = 2 * node + (x[rows, self.axis[node]] > self.value[node])
        return node - (1 << self.levels)

    def box(self, leaf: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        n, d = 1 << self.levels, low.shape[1]
        self.low, self.high = np.full((2 * n, d), np.inf), np.full((2 * n, d), -np.inf)
        self.low[n + leaf], self.high[n + leaf] = low, high
        for node in range(n - 1, 0, -1):
            self.low[node] = np.minimum(self.low[2 * node], self.low[2 * node + 1])
            self.high[node] = np.maximum(self.high[2 * node], self.high[2 * node + 1])

    def reached(self, x: np.ndarray) -> list[int]:
        """The leaves that may hold a nearest centre of a row of ``x``.

        A box's distance is rounded as its centres' distances are, and so never above them.
        """
        bound, own = np.full(len(x), np.inf), self.leaf(x)
        for k in range(BOUNDING):
            d2 = np.zeros(len(x))
            for j in range(x.shape[1]):
                gap = x[:, j] - self.bounding[own, k, j]
                d2 += gap * gap
            bound = np.minimum(bound, d2)
        found = []

        def visit(node: int, some: np.ndarray) -> None:
            far = np.zeros(len(some))
            for j in range(x.shape[1]):
                at = x[some, j]
                gap = np.maximum(np.maximum(self.low[node, j] - at, at - self.high[node, j]), 0)
                far += gap * gap
            some = some[far <= bound[some]]
            if not len(some):
                return
            if node >> self.levels:
                found.append(node - (1 << self.levels))
                return
            visit(2 * node, some)
            visit(2 * node + 1, some)

        visit(1, np.arange(len(x)))
        return found


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, place of each row of ``x`` among them)."""
    x = np.ascontiguousarray(x)
    code = pa.Array.from_buffers(pa.binary(8 * x.shape[1]), len(x), [None, pa.py_buffer(x)]).dictionary_encode()
    place = code.indices.to_numpy()
    first = np.unique(place, return_index=True)[1]
    return x[first], place


def _search(tree: BallTree, x: np.ndarray) -> list[pa.Array]:
    """cid, d2 and n_met of each row of ``x``; equal rows are searched once."""
    rows, place = _distinct(x)
    d2, cid, met = tree.nearest(rows)
    return [pa.array(cid[place]), pa.array(d2[place]), pa.array(met[place])]


def _checked(centers: DataFrame) -> tuple[DataFrame, int, int]:
    """(persisted centres, their number, dimension) of a frame ``[cid, c: array<double>]`` with usable centres and distinct ids."""
    sel = centers.select(F.col("cid").cast("bigint").alias("cid"), F.col("c").cast("array<double>").alias("c")).persist()
    try:
        whole = F.expr("cid IS NOT NULL AND c IS NOT NULL AND NOT exists(c, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
        n, ok, d, least = sel.agg(F.count(F.lit(1)), F.count_if(whole), F.max(F.size("c")), F.min(F.size("c"))).first()
        if not n:
            raise ValueError("at least one centre is required")
        if ok < n or d != least or not d:
            raise ValueError("a centre has no id, or its coordinates are missing, not finite or too few")
        if d > MAX_TREE_TERMS:
            raise ValueError(f"centres of dimension {d} exceed the tree's limit ({MAX_TREE_TERMS} values)")
        if sel.groupBy("cid").count().where("count > 1").limit(1).count():
            raise ValueError("centre ids repeat")
    except BaseException:
        sel.unpersist()
        raise
    return sel, n, d


def _values(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def center_tops(sel: DataFrame, n: int, d: int) -> tuple[Top, DataFrame]:
    """The top over the centres, and their leaves as rows (leaf, ids, flat coordinates); of equal centres the lowest id stays."""
    spark = sel.sparkSession
    checkpoint_root(spark)
    once = sel.groupBy("c").agg(F.min("cid").alias("cid"))
    share = min(1.0, SAMPLE_TERMS / (n * d))
    some = _values(once.where(F.pmod(F.xxhash64("c"), F.lit(1 << 30)) < share * (1 << 30)).select("c").toArrow().column("c"), d)
    some = some[np.lexsort(some.T)]
    leaves = min(len(some) // LEAF_SAMPLE, int(len(some) / share) // LEAF_CENTERS, MAX_LEAVES, SAMPLE_TERMS // d)
    top = Top(some, max(leaves, 1).bit_length() - 1, UNDER)
    sent = spark.sparkContext.broadcast(top)

    @F.arrow_udf("int")
    def _leaf(batch: pa.Array) -> pa.Array:
        return pa.array(sent.value.leaf(V.point_matrix(batch, d)), pa.int32())

    def pack(rows: pa.Table) -> pa.Table:
        c = _values(rows.column("c"), d) + 0.0
        lists = [[rows.column("leaf")[0].as_py()], [c.min(axis=0)], [c.max(axis=0)], [rows.column("cid").to_numpy()], [c.ravel()]]
        return pa.table([pa.array(x, t) for x, t in zip(lists, _LEAF.types)], schema=_LEAF)

    packed = once.select("cid", "c", _leaf("c").alias("leaf")).groupBy("leaf").applyInArrow(
        pack, "leaf int, low array<double>, high array<double>, ids array<bigint>, c array<double>").checkpoint()
    boxes = packed.select("leaf", "low", "high").toArrow()
    top.box(boxes.column("leaf").to_numpy(), _values(boxes.column("low"), d), _values(boxes.column("high"), d))
    return top, packed.select("leaf", "ids", "c")


_LEAF = pa.schema([("leaf", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
                   ("ids", pa.list_(pa.int64())), ("c", pa.list_(pa.float64()))])


def _nearest_of_leaves(points: DataFrame, sel: DataFrame, n: int, d: int, p: str) -> DataFrame:
    spark = points.sparkSession
    top, leaves = center_tops(sel, n, d)
    sent = spark.sparkContext.broadcast(top)
    stem = _free(points, "_tree")
    cell, group = f"{stem}_cell", f"{stem}_group"

    @F.arrow_udf("int")
    def _cell(batch: pa.Array) -> pa.Array:
        return pa.array(sent.value.leaf(V.point_matrix(batch, d)) >> sent.value.under, pa.int32())

    # a group number need not be the same twice: what a group asks for, all groups of its cell get
    celled = points.select("*", _cell(F.col(p)).alias(cell))
    sizes = {r[0]: -(-r[1] // GROUP_POINTS) for r in celled.groupBy(cell).count().collect()}  # at most MAX_LEAVES >> UNDER
    groups = F.array(*(F.lit(sizes.get(k, 1)) for k in range(1 << (top.levels - top.under))))
    dealt = celled.withColumn(group, F.pmod(F.monotonically_increasing_id(), groups[F.col(cell)]).cast("int")) \
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), cell, group)  # one exchange for both passes

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        x = _distinct(V.point_matrix(rows.column("p").combine_chunks(), d))[0]
        found = sent.value.reached(x[np.isfinite(x).all(axis=1)])
        return pa.table([pa.array([key[0].as_py()] * len(found), pa.int32()), pa.array(found, pa.int32())], names=[cell, "leaf"])

    asked = dealt.select(cell, group, F.col(p).alias("p")).groupBy(cell, group).applyInArrow(ask, f"{cell} int, leaf int").distinct()
    carried = asked.join(leaves, "leaf").withColumn(group, F.explode(F.sequence(F.lit(0), groups[F.col(cell)].cast("int") - 1)))
    lowest = sel.agg(F.min("cid")).first()[0]
    kept = [c for c in points.columns if c.lower() not in ("cid", "d2", "n_met")]

    def find(rows: pa.Table, side: pa.Table) -> pa.Table:
        x = V.point_matrix(rows.column(p).combine_chunks(), d)
        ids = _values(side.column("ids"), 1)[:, 0] if len(side) else np.zeros(0, np.int64)
        if len(ids) * d > MAX_TREE_TERMS:
            raise ValueError(f"a group of points is near {len(ids)} centres of dimension {d}, more than a tree's {MAX_TREE_TERMS} values")
        # an infinite point is equally far from all centres
        finite = np.isfinite(x).all(axis=1)
        cid, d2, met = np.full(len(x), lowest), np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        if finite.any():
            found = _search(BallTree(_values(side.column("c"), d), ids), x[finite])
            cid[finite], d2[finite], met[finite] = (v.to_numpy() for v in found)
        return pa.table([*(rows.column(k) for k in kept), pa.array(cid), pa.array(d2), pa.array(met)], names=[*kept, "cid", "d2", "n_met"])

    schema = T.StructType([points.schema[k] for k in kept] + [T.StructField("cid", T.LongType()), T.StructField("d2", T.DoubleType()),
                                                             T.StructField("n_met", T.LongType())])
    return dealt.groupBy(cell, group).cogroup(carried.select(cell, group, "ids", "c").groupBy(cell, group)).applyInArrow(find, schema)


def nearest_center_tree(points: DataFrame, centers: DataFrame, p: str = "p") -> DataFrame:
    """Add ``cid`` and ``d2`` as ``nearest_center`` does, and ``n_met``, the number of centres a point was compared with."""
    sel, n, d = _checked(centers)
    try:
        if n > MAX_TREE_K or n * d > MAX_TREE_TERMS:
            return _nearest_of_leaves(points, sel, n, d, p)
        rows = sel.toArrow()
    finally:
        sel.unpersist()
    tree = BallTree(_values(rows.column("c"), d), rows.column("cid").to_numpy())
    sent = points.sparkSession.sparkContext.broadcast(tree)

    @F.arrow_udf("struct<cid: bigint, d2: double, n_met: bigint>")
    def _nearest(batch: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_search(sent.value, V.point_matrix(batch, d)), ["cid", "d2", "n_met"])

    stem = _free(points, "_tree")
    found = points.select("*", _nearest(F.col(p)).alias(stem))
    return found.selectExpr(*_kept(points, "cid", "d2", "n_met"), f"inline(array({stem}))")
