"""Sketches kept as a table: cells by batch, with the fingerprint of the hash parameters that made them.

A store is a Parquet folder partitioned by batch.  Writing a batch again replaces it, so a corrected or replayed day
counts once; a sketch of any set of batches is the cell-wise sum of theirs.  Cells are only ever added to cells of
the same kind, shape and hash functions: reading with other parameters fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import SketchSpec
from .sketch import cell_rows, merge


def write_batches(items: DataFrame, path: str, batch_col: str, spec: SketchSpec, kind: str = "cm", item_col: str = "item") -> None:
    """Sketches every batch of ``items`` in one pass and replaces these batches in the store (others stay)."""
    cells = cell_rows(items, spec, kind, item_col, keep=(batch_col,)).groupBy(F.col(batch_col).alias("batch"), "r", "c") \
        .agg(F.sum("f").alias("v"))
    # partial sums are by (batch, r, c), so a batch writes at most d * w rows
    cells.withColumn("sketch", F.lit(spec.fingerprint(kind))).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def read_sketch(spark: SparkSession, path: str, spec: SketchSpec, kind: str = "cm", batches: str | None = None) -> DataFrame:
    """``[r, c, v]`` over the batches that meet the condition ``batches`` (SQL on ``batch``; all if None).

    Only their partitions are read.  A cell made with other parameters fails the query.
    """
    rows = spark.read.parquet(path)
    if batches:
        rows = rows.where(batches)
    mine = spec.fingerprint(kind)
    same = F.when(F.col("sketch") == mine, F.col("v")).otherwise(
        F.raise_error(F.concat(F.lit(f"the store holds cells of another sketch than {mine}: "), F.coalesce("sketch", F.lit("none")))).cast("bigint"))
    return merge(rows.select("r", "c", same.alias("v", metadata={"sketch": mine})))
