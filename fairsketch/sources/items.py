"""Item columns for the frequency operators: ``[item: bigint]`` (plus any kept columns)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def items(df: DataFrame, col: Column | str, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Project an item column as ``bigint``.

    ``strict`` casts with the session's (ANSI) rules, so a malformed text item fails the job
    like an integer parse would; otherwise malformed items are dropped (``try_cast``).
    """
    c = F.col(col) if isinstance(col, str) else col
    if strict:
        return df.select(*keep, c.cast("bigint").alias("item"))
    out = df.select(*keep, c.try_cast("bigint").alias("item"))
    return out.where(F.col("item").isNotNull())


def read_item_lines(spark, path: str, strict: bool = True) -> DataFrame:
    """A text file (or folder) with one integer per line."""
    raw = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return items(raw, F.trim("value"), strict=strict)


ITEM_REASONS = ("blank line", "not an integer", "beyond 64 bits")


def read_items_checked(spark, path: str) -> DataFrame:
    """The lines of a text file (or folder), sorted out in one scan: ``[item, line, reason]``.

    A good line has its item and nulls; a bad one keeps its text and one of ``ITEM_REASONS``.
    ``points.write_sorted_out`` writes both sides apart in one job.
    """
    value = F.trim("value")
    item = value.try_cast("bigint")
    reason = F.when(F.length(value) == 0, ITEM_REASONS[0]).when(item.isNotNull(), F.lit(None)) \
        .when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), ITEM_REASONS[2]).otherwise(ITEM_REASONS[1])
    return spark.read.text(path).select(item.alias("item"), F.when(reason.isNotNull(), F.col("value")).alias("line"), reason.alias("reason"))
