"""Point sets and item streams derived from the driver's parquet tables.

Each view reads the whole table; Catalyst prunes the scan to the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .items import items
from .points import as_points

# Number of items per batch in the batch-keyed item streams.
BATCH_SIZE = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pts3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as 3-D points: (quantity/50, discount*10, tax*10); A = open lines."""
    li = table(spark, sf_dir, "lineitem")
    return as_points(
        li,
        [F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0, F.col("l_tax") * 10.0],
        F.when(F.col("l_linestatus") == "O", F.lit("A")).otherwise(F.lit("B")),
    )


def emb(spark: SparkSession, sf_dir: str, keep_label: bool = False) -> DataFrame:
    """embeddings as 64-D points (float widened to double); A = even label."""
    e = table(spark, sf_dir, "embeddings")
    extra = ["label"] if keep_label else []
    return e.select(*extra,
                    F.transform("embedding", lambda x: x.cast("double")).alias("p"),
                    F.when(F.col("label") % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("grp"))


def items_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.user_id as the item, batch = event_id div 250."""
    ev = table(spark, sf_dir, "events")
    return items(ev.withColumn("batch", F.expr(f"event_id div {BATCH_SIZE}")), "user_id", keep=["batch"])


def skew_item_expr(col: str = "event_id"):
    """A Zipf-like item derived from an id: ``10000 div (1 + (id * 7919) mod 10000)``."""
    return F.expr(f"10000 div (1 + pmod({col} * 7919, 10000))")


def items_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zipf-like items over events (item 1 holds about half of all rows), batch = event_id div 250."""
    ev = table(spark, sf_dir, "events")
    return items(ev.withColumn("batch", F.expr(f"event_id div {BATCH_SIZE}")), skew_item_expr(), keep=["batch"])


def items_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(table(spark, sf_dir, "lineitem"), "l_partkey")


def items_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(table(spark, sf_dir, "lineitem"), "l_orderkey")
