"""Rows dealt into blocks by hash, and sorted key arrays exchanged between blocks and buckets.

Operators that compare rows across the table work in three moves.  Rows are dealt once into blocks
of a few megabytes (``block`` is a hash of id and text, so neither a hot id nor a hot source meets
in one block).  A block sends each bucket one row with its distinct keys of that bucket, so a key
that a third of all rows hold arrives once a block and not once a row.  A bucket answers each block
with one bit a key.  Blocks and buckets follow ``spark.sql.shuffle.partitions``, which is set by the
size of the input, so a group is a partition's share or less.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS_A_PARTITION = 2


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_blocks(docs: DataFrame, id_col: str, text_col: str, others: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, others..., block), dealt by ``block``."""
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *others)
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n * BLOCKS_A_PARTITION)).cast("int")) \
        .repartition(n, "block")


def collapsed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies``: rows alike in all columns that are more than a tenth of a partition's share become one.

    A first scan counts rows by hash.  At most ten hashes a partition can hold so many rows, so they are sent to
    all tasks; the rows of these few groups are summed before they are shuffled, all others stay where they are.
    """
    n = partitions(rows.sparkSession)
    hashed = rows.withColumn("_row", F.xxhash64(*rows.columns))
    counts = hashed.groupBy("_row").agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    least = max(1.0, (total or 0) / (10 * n))
    if (most or 0) <= least:
        return rows.withColumn("copies", F.lit(1).cast("long"))
    hot = [r["_row"] for r in counts.where(F.col("n") > least).select("_row").collect()]  # fewer than 10 n
    some = F.col("_row").isin(hot)
    return hashed.where(~some).drop("_row").withColumn("copies", F.lit(1).cast("long")).unionByName(
        hashed.where(some).groupBy(*rows.columns).agg(F.count("*").alias("copies")))


def on_blocks(rows: DataFrame, side: DataFrame | None, run: Callable, schema: str) -> DataFrame:
    """``run(block's rows, block's rows of side)`` on Arrow tables; without ``side``, ``run(block's rows)``."""
    if side is None:
        return rows.groupBy("block").applyInArrow(run, schema)
    return rows.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(run, schema)


def limits(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted 64-bit keys; buckets are equal ranges."""
    firsts = np.array([-(-(b << 64) // buckets) for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, firsts), len(keys))


def parts(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that have keys."""
    cut = limits(keys, buckets).tolist()
    return [(b, x, y) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]


def shares(keys: np.ndarray, bucket: int, buckets: int, n: int) -> list[int]:
    """Limits of ``n`` equal ranges of a bucket in its sorted keys."""
    firsts = np.array([-(-(b << 64) // (buckets * n)) for b in range(bucket * n, bucket * n + n)], np.uint64)
    return [*np.searchsorted(keys, firsts).tolist(), len(keys)]


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def answered(keys: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """One flag a key, from the buckets' answers; no answer means no."""
    out = np.zeros(len(keys), bool)
    for b, x, y in parts(keys, buckets):
        if b in answers:
            out[x:y] = flags(answers[b], y - x)
    return out


def coded(ids: np.ndarray) -> bytes:
    """64-bit ids as the distinct ones and each one's short place among them."""
    every, place = np.unique(ids, return_inverse=True)
    width = np.uint16 if len(every) <= 1 << 16 else np.uint32
    return np.int64(len(every)).tobytes() + every.astype(np.int64).tobytes() + place.astype(width).tobytes()


def decoded(raw: bytes, lo: int = 0, hi: int | None = None) -> np.ndarray:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    every = np.frombuffer(raw, np.int64, n, 8)
    return every[np.frombuffer(raw, np.uint16 if n <= 1 << 16 else np.uint32, offset=8 + 8 * n)[lo:hi]]


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Frames built and run inside drop their shuffle files when their action ends.

    For steps whose results are checkpointed: nothing reads those files again, and without this they
    stay until the driver happens to collect its garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Sends at most so many rows of whole texts to Python at once, from now on in this session.

    A batch stands in the executor's buffers and in its Python worker at the same time; the default of 10,000 rows is
    tens of megabytes for each.  A smaller setting stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def table(columns: dict, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray))
                     else columns[f.name].cast(f.type) for f in schema], schema=schema)
