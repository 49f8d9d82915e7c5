"""Labelled point sets as DataFrames ``[p: array<double>, grp: string]``.

A point file has one point per line, ``c1,...,cD,label`` with no header.  It is parsed once at
ingestion; every operator after that works on the typed columns.  Labels are trimmed.  Ingestion
fails on what it cannot use: a blank line, a coordinate that is missing, not a number or NaN, and a
label other than ``A`` or ``B``.  Dropping such labels, or keeping them, is an explicit argument.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.vectors import MALFORMED

GROUPS = ("A", "B")


def _fail(what: str, kind: str) -> Column:
    return F.expr(f"CAST(raise_error('{what}') AS {kind})")


def _number(c: Column) -> Column:
    """A coordinate that fails if it is null or NaN; stays plain column arithmetic."""
    return F.when(c.isNotNull() & ~F.isnan(c), c).otherwise(_fail(MALFORMED, "DOUBLE"))


def checked(points: DataFrame, dims: int | None = None) -> DataFrame:
    """``points`` whose ``p`` fails on a null, a null or NaN coordinate or (with ``dims``) another length."""
    ok = F.col("p").isNotNull() & ~F.exists("p", lambda v: v.isNull() | F.isnan(v)) & (F.size("p") > 0)
    if dims is not None:
        ok &= F.size("p") == dims
    return points.withColumn("p", F.when(F.coalesce(ok, F.lit(False)), F.col("p")).otherwise(
        _fail(MALFORMED, "ARRAY<DOUBLE>")))


def _finish(df: DataFrame, partitions: int | None, other_labels: str) -> DataFrame:
    if other_labels not in ("fail", "drop", "keep"):
        raise ValueError("other_labels is 'fail', 'drop' or 'keep'")
    known = F.coalesce(F.col("grp").isin(*GROUPS), F.lit(False))
    if other_labels == "drop":
        df = df.where(known)
    df = checked(df)
    if other_labels == "fail":
        df = df.withColumn("grp", F.when(known, F.col("grp")).otherwise(_fail("a label is neither A nor B", "STRING")))
    if partitions:
        df = df.repartition(partitions)
    return df


def read_points(spark: SparkSession, path: str, dims: int | None = None,
                partitions: int | None = None, other_labels: str = "fail") -> DataFrame:
    """Read a text/CSV point file.

    With ``dims`` known, the CSV reader parses a fixed schema (``FAILFAST``).  Without it, the
    lines are split and every field but the last becomes a coordinate, so each line may carry
    any dimension.  ``partitions`` repartitions the parsed points (round robin).  ``other_labels``:
    ``fail`` on labels other than A and B, ``drop`` their rows, or ``keep`` them.
    """
    if dims is not None:
        schema = T.StructType([T.StructField(f"c{j}", T.DoubleType()) for j in range(dims)]
                              + [T.StructField("grp", T.StringType())])
        raw = spark.read.schema(schema).option("mode", "FAILFAST").csv(path)
        df = raw.select(F.array(*[F.col(f"c{j}") for j in range(dims)]).alias("p"),
                        F.trim("grp").alias("grp"))
    else:
        fields = F.split(F.col("value"), ",")
        n = F.size(fields)
        df = spark.read.text(path).select(
            F.transform(F.slice(fields, 1, n - 1), lambda s: F.trim(s).cast("double")).alias("p"),
            F.trim(F.element_at(fields, -1)).alias("grp"))
    return _finish(df, partitions, other_labels)


# Why a line is set aside, in the order of the tests.
REASONS = ("blank line", "wrong number of fields", "a coordinate is not a number", "a label is neither A nor B")


def read_points_checked(spark: SparkSession, path: str, dims: int | None = None) -> DataFrame:
    """``[p, grp, line, reason]`` of every line of a point file, in one scan and without failing.

    A good line has its point and group, null ``line`` and null ``reason``.  A line that ``read_points`` would fail on has
    null ``p`` and ``grp``, its text, and the first of ``REASONS`` that holds.  NaN is not a number here; without
    ``dims`` each line may carry any dimension of at least one.
    """
    fields = F.split("value", ",")
    n = F.size("_fields")
    rows = spark.read.text(path).withColumn("_fields", fields).withColumn(
        "_p", F.transform(F.slice("_fields", 1, F.greatest(n - 1, F.lit(0))), lambda v: F.trim(v).try_cast("double"))) \
        .withColumn("_grp", F.trim(F.element_at("_fields", -1)))
    sizes = n != dims + 1 if dims is not None else n < 2
    tests = (F.trim("value") == "", sizes, F.exists("_p", lambda v: v.isNull() | F.isnan(v)), ~F.col("_grp").isin(*GROUPS))
    reason = F.lit(None).cast("string")
    for test, name in reversed(list(zip(tests, REASONS))):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    rows = rows.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return rows.select(F.when(good, F.col("_p")).alias("p"), F.when(good, F.col("_grp")).alias("grp"),
                       F.when(~good, F.col("value")).alias("line"), "reason")


def write_sorted_out(checked_lines: DataFrame, path: str, mode: str = "error") -> tuple[str, str]:
    """Writes good and bad lines apart in one job; returns the folders of the points and of the lines set aside."""
    checked_lines.withColumn("bad", F.col("reason").isNotNull()).write.mode(mode).partitionBy("bad").parquet(path)
    return f"{path}/bad=false", f"{path}/bad=true"


def as_points(df: DataFrame, coords: Sequence[Column | str], group: Column,
              extra: Sequence[str] = ()) -> DataFrame:
    """Points from any table: coordinate expressions plus a two-valued group expression.

    ``group`` must evaluate to ``'A'`` or ``'B'`` (e.g. ``when(cond, 'A').otherwise('B')``).
    """
    cols = [_number((F.col(c) if isinstance(c, str) else c).cast("double")) for c in coords]
    return df.select(*extra, F.array(*cols).alias("p"), group.alias("grp"))


def flat(points: DataFrame, dims: int, prefix: str = "x") -> DataFrame:
    """Coordinates as scalar columns ``x0 .. x{dims-1}`` followed by ``grp``."""
    return points.select(*[F.col("p")[j].alias(f"{prefix}{j}") for j in range(dims)], "grp")


class Prepared:
    """Points parsed once for an iterative job (see ``prepare``); ``release()`` frees the cache."""

    def __init__(self, points: DataFrame, cached: DataFrame | None, dims: int):
        self.points, self._cached, self.dims = points, cached, dims

    def release(self) -> None:
        if self._cached is not None:
            self._cached.unpersist()
            self._cached = None

    def __enter__(self) -> "Prepared":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def prepare(points: DataFrame, dims: int | None = None, partitions: int | None = None,
            persist: bool = True) -> Prepared:
    """Parse-once form of ``points`` for loops that scan them many times.

    Coordinates are stored as flat double columns (the in-memory cache keeps them columnar;
    an ``array`` column would be cached row by row) and the data is spread over at least
    ``partitions`` tasks (default: the cluster's parallelism) - a source with fewer, larger
    splits is repartitioned once, a source that is already wide is left as it is.  The cache
    level spills to disk; lost blocks are recomputed from the source.  ``points`` of the
    returned object exposes ``p`` again as ``array(x0, ...)``, which the optimizer reduces to
    plain column reads.
    """
    if dims is None:
        first = points.select(F.size("p").alias("d")).first()
        if first is None:
            raise ValueError("no points")
        dims = int(first["d"])
    if not persist:
        return Prepared(points.select("p", "grp"), None, dims)
    # dims may come from one row: every other row must agree (uncached points are checked by the kernels)
    alike = points.withColumn("p", F.when(F.size("p") == dims, F.col("p")).otherwise(_fail(MALFORMED, "ARRAY<DOUBLE>")))
    flat_df = alike.select(*[_number(F.col("p")[j].cast("double")).alias(f"x{j}") for j in range(dims)], "grp")
    want = partitions or points.sparkSession.sparkContext.defaultParallelism
    if flat_df.rdd.getNumPartitions() < want:
        flat_df = flat_df.repartition(want)
    cached = flat_df.persist(StorageLevel.MEMORY_AND_DISK)
    view = cached.select(F.array(*[F.col(f"x{j}") for j in range(dims)]).alias("p"), "grp")
    return Prepared(view, cached, dims)


def write_points(points: DataFrame, path: str, dims: int, mode: str = "error") -> None:
    """Write points in the text form ``c1,...,cD,label`` (the reader's input format)."""
    flat(points, dims, "c").write.mode(mode).option("header", "false").csv(path)
