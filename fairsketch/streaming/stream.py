"""Counting and sketching an unbounded item stream with Structured Streaming.

* ``histogram_state`` / ``sketch_state`` are streaming aggregates; Spark's state store holds one row per
  distinct item, resp. at most d*w cells.  ``run_state`` drives one of them in update mode: every
  micro-batch writes the rows that changed under ``<sink>/batch_id=<id>``, and ``latest`` reads
  each key's value of its last batch.  Every ``COMPACT_EVERY`` batches they are folded into one snapshot, so a
  sink holds one row a key and the rows of a few batches.  A replayed batch overwrites its own folder, so the
  result is as if every batch ran once; a query started again with the same sink and checkpoint goes on.
* ``until_state`` applies the stop rule inside the stream: a batch is taken only if the earlier batches hold
  fewer than ``t`` items (whole batches, so the total may exceed ``t``).  The running length is kept in the state
  store.  ``run_until`` drives it and stops the query once ``t`` is reached; ``taken`` sums what was taken.
  The sketches of what was taken follow from the histogram, because sketches are linear.

``prefix`` is the same stop rule on a static table that carries a batch key.
"""

from __future__ import annotations

import threading

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.hashing import SketchSpec
from ..operators.sketch import count_min, count_sketch, histogram
from ..session import children, path_exists, remove_path, scratch_path

# Ranges of batch ids, of about equal numbers of batches, for the two-level running total in ``prefix``.
PREFIX_BUCKETS = 256


def items_before(sizes: DataFrame, batch_col: str, buckets: int = PREFIX_BUCKETS) -> DataFrame:
    """``sizes`` ``[batch, n]`` plus ``before``: the total ``n`` of all smaller batch ids.

    A two-level prefix sum, so no task ever holds all batches: approximate quantiles of the batch ids cut them
    into ranges of about equal counts however the ids are spread, running totals are taken inside each range, and
    each range is offset by the totals of the ranges before it.  The at most ``buckets`` range totals are one
    array in a scalar subquery, looked up by each batch: the ranges are not joined.
    """
    # constant arrays as one cast of a split text: an array of hundreds of literals slows every pass of the optimizer
    shares = ",".join(str(i / buckets) for i in range(1, buckets)) or "0.5"
    cuts = sizes.agg(F.expr(f"percentile_approx(`{batch_col}`, CAST(split('{shares}', ',') AS ARRAY<DOUBLE>), {10 * buckets})").alias("c")) \
        .first()["c"] or []  # fewer than `buckets` ids
    known = ",".join(map(str, sorted(set(cuts))))
    place = f"aggregate(CAST(split('{known}', ',') AS ARRAY<BIGINT>), 0, (k, c) -> k + IF(c < `{batch_col}`, 1, 0))" if cuts else "0"
    keyed = sizes.withColumn("_bucket", F.expr(place))
    # what lies before each range, as one array made once; its element is looked up by place
    before = F.expr(f"transform(sequence(0, {len(set(cuts))}), b -> aggregate(ranges, 0L, (acc, x) -> acc + IF(x._bucket < b, x.t, 0L)))")
    ranges = keyed.groupBy("_bucket").agg(F.sum("n").cast("bigint").alias("t")) \
        .agg(F.collect_list(F.struct("_bucket", "t")).alias("ranges")).select(before.alias("before")).scalar()
    local = F.coalesce(F.sum("n").over(
        Window.partitionBy("_bucket").orderBy(batch_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return keyed.withColumn("_local", local).withColumn("_ranges", ranges) \
        .select(*sizes.columns, (F.element_at("_ranges", F.col("_bucket") + 1) + F.col("_local")).cast("bigint").alias("before"))


def prefix(df: DataFrame, batch_col: str, t: int) -> DataFrame:
    """Rows of the batches taken by the stop-at-``t`` rule (batch b is taken iff the earlier
    batches hold fewer than ``t`` rows).

    The running total runs over one row per batch (see ``items_before``), never over the
    items; the items themselves are only filtered by the last batch taken.
    """
    # the filter makes every use of the sizes need the counts, so all read one exchange
    sizes = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    # a condition inside the aggregate: as a filter over the window and its subquery it ran 4 s longer
    last = items_before(sizes, batch_col).agg(F.max(F.when(F.col("before") < F.lit(t), F.col(batch_col)))).scalar()
    return df.where(F.col(batch_col) <= last)


def histogram_state(stream: DataFrame, item_col: str = "item") -> DataFrame:
    """Streaming exact histogram ``[item, freq]`` (write in ``complete`` or ``update`` mode)."""
    return histogram(stream, item_col)


def sketch_state(stream: DataFrame, spec: SketchSpec, kind: str = "cm", item_col: str = "item") -> DataFrame:
    """Streaming sketch cells ``[r, c, v]``; the state holds at most d*w rows."""
    if kind == "cm":
        return count_min(stream, spec.cm_h, spec.w, item_col)
    if kind == "cs":
        return count_sketch(stream, spec.cs_h, spec.cs_g, spec.w, item_col)
    raise ValueError("kind is 'cm' or 'cs'")


def write_batch(rows: DataFrame, batch_id: int, sink: str) -> None:
    """One batch's rows under its own id; a replay replaces them."""
    rows.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


# Batches after which a state sink is folded into a snapshot.
COMPACT_EVERY = 16


def run_state(state: DataFrame, sink: str | None = None, checkpoint: str | None = None, keys: list[str] | None = None,
              value: str | None = None, compact_every: int = COMPACT_EVERY) -> str:
    """Runs a streaming aggregate over everything available; returns the sink for ``latest``.

    With ``keys`` and ``value`` the sink is compacted as it grows.
    """
    spark = state.sparkSession
    sink = sink or scratch_path(spark, "stream-state")

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, batch_id, sink)
        if keys and (batch_id + 1) % compact_every == 0:
            compact(spark, sink, keys, value, batch_id)

    query = (state.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint or f"{sink}-checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return sink


def _parts(spark: SparkSession, sink: str) -> tuple[int, list[int]]:
    """(batch up to which the newest complete snapshot reaches, or -1; the later batches in the sink)."""
    snapshots = [int(n.partition("=")[2]) for n in children(spark, f"{sink}/snapshots")
                 if path_exists(spark, f"{sink}/snapshots/{n}/_SUCCESS")]
    upto = max(snapshots, default=-1)
    return upto, sorted(b for n in children(spark, sink) if n.startswith("batch_id=") for b in [int(n[9:])] if b > upto)


def compact(spark: SparkSession, sink: str, keys: list[str], value: str, upto: int) -> None:
    """Folds all batches up to ``upto`` into one snapshot, then drops what it replaces.

    A crash in between leaves both: readers take the newest complete snapshot and the batches after it.  A replayed
    batch that a snapshot holds already writes a folder that readers pass over.
    """
    before, later = _parts(spark, sink)
    if upto <= before:
        return
    now = _latest(spark, sink, keys, value, before, [b for b in later if b <= upto])
    now.write.mode("overwrite").parquet(f"{sink}/snapshots/upto={upto}")
    for name in children(spark, f"{sink}/snapshots"):
        if int(name.partition("=")[2]) < upto:
            remove_path(spark, f"{sink}/snapshots/{name}")
    for name in children(spark, sink):
        if name.startswith("batch_id=") and int(name[9:]) <= upto:
            remove_path(spark, f"{sink}/{name}")


def _latest(spark: SparkSession, sink: str, keys: list[str], value: str, upto: int, batches: list[int]) -> DataFrame:
    frames = [spark.read.parquet(f"{sink}/batch_id={b}").select(*keys, value, F.lit(b).alias("batch_id")) for b in batches[:1]]
    if len(batches) > 1:  # one scan of the batch folders
        frames = [spark.read.option("basePath", sink).parquet(*[f"{sink}/batch_id={b}" for b in batches]).select(*keys, value, "batch_id")]
    if upto >= 0:
        frames.append(spark.read.parquet(f"{sink}/snapshots/upto={upto}").select(*keys, value, F.lit(upto).alias("batch_id")))
    if not frames:
        return spark.createDataFrame([], ", ".join(f"`{c}` bigint" for c in (*keys, value)))
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    return every.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))


def latest(spark: SparkSession, sink: str, keys: list[str], value: str) -> DataFrame:
    """``[*keys, value]`` as of the last batch; an empty (bigint) frame if no batch was written."""
    upto, batches = _parts(spark, sink)
    return _latest(spark, sink, keys, value, upto, batches)


def until_state(stream: DataFrame, t: int, item_col: str = "item") -> DataFrame:
    """Streaming ``[item, freq, length]``: the item counts of the batches taken by the stop-at-``t`` rule.

    Each task folds its part of a batch into counts by item and says its size to every bucket of items; a bucket
    keeps the length of what was taken before in its state, so all buckets decide alike and none holds more than
    its share of the items.  Bucket 0 adds one row a taken batch with null item and the length so far.
    """
    buckets = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def counts(batches):
        items, freq = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            if len(new):
                some, n = np.unique(new, return_counts=True)
                items, place = np.unique(np.append(items, some), return_inverse=True)
                freq = np.bincount(place, np.append(freq, n), len(items)).astype(np.int64)
        if len(items):
            every = np.arange(buckets)
            yield pa.record_batch([pa.array(np.append(items % buckets, every)),
                                   pa.array(np.append(items, every), mask=np.append(np.zeros(len(items), bool), np.ones(buckets, bool))),
                                   pa.array(np.append(freq, np.full(buckets, freq.sum())))], names=["bucket", "item", "n"])

    def take(key, frames, state):
        before = state.get[0] if state.exists else 0
        if before >= t:
            return
        size = 0
        for rows in frames:
            sizes = rows["item"].isna()
            size += int(rows.loc[sizes, "n"].sum())
            own = rows.loc[~sizes]
            yield pd.DataFrame({"item": own["item"].astype("Int64"), "freq": own["n"], "length": pd.array([None] * len(own), "Int64")})
        state.update((before + size,))
        if key[0] == 0:
            yield pd.DataFrame({"item": pd.array([None], "Int64"), "freq": [0], "length": pd.array([before + size], "Int64")})

    parts = stream.select(F.col(item_col).cast("bigint").alias("item")).mapInArrow(counts, "bucket bigint, item bigint, n bigint")
    return parts.groupBy("bucket").applyInPandasWithState(
        take, "item bigint, freq bigint, length bigint", "length bigint", "append", GroupStateTimeout.NoTimeout)


def run_until(stream: DataFrame, t: int, sink: str | None = None, item_col: str = "item", checkpoint: str | None = None,
              processing_time: str | None = None, timeout: float | None = None) -> str:
    """Runs the stream until ``t`` items were taken or it is exhausted; returns the sink for ``taken``.

    ``processing_time`` (e.g. ``"1 second"``) runs a continuous micro-batch query instead of
    ``availableNow``.  Started again with the same sink and checkpoint it goes on with the length in the state.
    """
    spark = stream.sparkSession
    sink = sink or scratch_path(spark, "stream-until")
    reached = threading.Event()

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, batch_id, sink)
        length = spark.read.parquet(f"{sink}/batch_id={batch_id}").agg(F.max("length")).first()[0]
        if length is not None and length >= t:
            reached.set()

    writer = until_state(stream, t, item_col).writeStream.outputMode("append").foreachBatch(write) \
        .option("checkpointLocation", checkpoint or f"{sink}-checkpoint")
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    query = writer.trigger(**trigger).start()
    waited = 0.0
    try:
        while query.isActive and not reached.is_set():
            query.awaitTermination(0.1)
            waited += 0.1
            if timeout is not None and waited > timeout:
                raise TimeoutError("stream did not finish in time")
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None and not reached.is_set():
        raise query.exception()
    return sink


def taken(spark: SparkSession, sink: str) -> DataFrame:
    """``[item, freq]`` over all taken batches; an empty frame if none was."""
    if not path_exists(spark, sink):
        return spark.createDataFrame([], "item bigint, freq bigint")
    return spark.read.parquet(sink).where("item is not null").groupBy("item").agg(F.sum("freq").cast("bigint").alias("freq"))


def forget_commit(spark: SparkSession, checkpoint: str) -> int:
    """Takes back the last batch's commit, as if the driver was lost between its write and its commit.

    The next start runs that batch again under its id.  Returns the id.
    """
    last = max(int(n) for n in children(spark, f"{checkpoint}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if path_exists(spark, f"{checkpoint}/commits/{name}"):
            remove_path(spark, f"{checkpoint}/commits/{name}")
    return last


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A parquet file or folder as a stream (one or more files per micro-batch, oldest first)."""
    path = path.rstrip("/")
    # as a pattern that matches this path only: a plain path is taken as the base folder, which a single file is not
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("basePath", path.rpartition("/")[0]).parquet(f"{path[:-1]}[{path[-1]}]"))
