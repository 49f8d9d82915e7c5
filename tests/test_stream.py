"""Streaming: stream = batch, stop-at-T rule, replayed batches count once."""

import random

import pytest
from pyspark.sql import functions as F

from samples import SF0001
from fairsketch.functions.hashing import SketchSpec
from fairsketch.operators import sketch
from fairsketch.session import children, scratch_path
from fairsketch.sources import tables
from fairsketch.streaming import stream

SPEC = SketchSpec.draw(d=4, w=16, seed=11)


@pytest.fixture(scope="module")
def staged(spark):
    """events of sf0.001 as 5 parquet files (one micro-batch each)."""
    path = scratch_path(spark, "test-events")
    ev = tables.table(spark, SF0001, "events").select("event_id")
    ev.repartitionByRange(5, "event_id").write.parquet(path)
    return path, ev.schema


def _items(src):
    return src.select(tables.skew_item_expr().cast("bigint").alias("item"))


def _batch_items(spark):
    return tables.items_skew(spark, SF0001)


def _histogram(df):
    return {r["item"]: r["freq"] for r in df.collect()}


def test_state_over_many_batches_equals_batch(spark, staged):
    src = _items(stream.file_stream(spark, *staged))
    sink = stream.run_state(stream.histogram_state(src))
    assert spark.read.parquet(sink).select("batch_id").distinct().count() == 5
    assert _histogram(stream.latest(spark, sink, ["item"], "freq")) == _histogram(sketch.histogram(_batch_items(spark)))
    for kind, cells in zip(("cm", "cs"), sketch.sketches(_batch_items(spark), SPEC)):
        sink = stream.run_state(stream.sketch_state(src, SPEC, kind))
        got = sorted(map(tuple, stream.latest(spark, sink, ["r", "c"], "v").collect()))
        assert got == sorted(map(tuple, cells.collect()))


def test_a_restarted_state_query_goes_on_where_it_was(spark, staged):
    path, schema = staged
    folder, sink = scratch_path(spark, "test-growing"), scratch_path(spark, "test-growing-sink")
    ev = spark.read.parquet(path)
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(folder)
    run = lambda: stream.run_state(stream.histogram_state(_items(stream.file_stream(spark, folder, schema))), sink)
    run()
    ev.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(folder)
    run()
    run()  # nothing new
    assert _histogram(stream.latest(spark, sink, ["item"], "freq")) == _histogram(sketch.histogram(_batch_items(spark)))


@pytest.mark.parametrize("processing_time", [None, "200 milliseconds"])
def test_stop_at_t(spark, staged, processing_time):
    t = 450  # batches hold about 200 items each
    sink = stream.run_until(_items(stream.file_stream(spark, *staged)), t, processing_time=processing_time, timeout=120)
    per_batch = [r["n"] for r in spark.read.parquet(sink).groupBy("batch_id").agg(F.sum("freq").alias("n")).orderBy("batch_id").collect()]
    assert sum(per_batch) >= t > sum(per_batch[:-1]) and len(per_batch) < 5
    assert sum(_histogram(stream.taken(spark, sink)).values()) == sum(per_batch)


def test_an_exhausted_stream_is_taken_whole(spark, staged):
    sink = stream.run_until(_items(stream.file_stream(spark, *staged)), 10**9)
    assert _histogram(stream.taken(spark, sink)) == _histogram(sketch.histogram(_batch_items(spark)))


def _rows(spark, folder, *values):
    spark.createDataFrame([(v,) for v in values], "item bigint").coalesce(1).write.mode("append").parquet(folder)


def test_the_rule_goes_on_after_a_restart_and_a_replay(spark):
    folder, sink = scratch_path(spark, "test-arrivals"), scratch_path(spark, "test-until")
    schema = spark.createDataFrame([], "item bigint").schema
    run = lambda: stream.run_until(stream.file_stream(spark, folder, schema, 100), 7, sink)
    _rows(spark, folder, 1, 1, 2, None)
    run()
    _rows(spark, folder, 2, 2, 3, 4, 5)
    assert stream.forget_commit(spark, f"{sink}-checkpoint") == 0
    run()  # batch 0 again, then batch 1
    assert _histogram(stream.taken(spark, sink)) == {1: 2, 2: 3, 3: 1, 4: 1, 5: 1}
    _rows(spark, folder, 6, 6)
    run()  # eight items were taken before it
    run()
    assert _histogram(stream.taken(spark, sink)) == {1: 2, 2: 3, 3: 1, 4: 1, 5: 1}


def test_state_sinks_are_compacted_and_replays_change_nothing(spark):
    folder, sink = scratch_path(spark, "test-arrivals"), scratch_path(spark, "test-compact")
    schema = spark.createDataFrame([], "item bigint").schema
    run = lambda: stream.run_state(stream.histogram_state(stream.file_stream(spark, folder, schema, 100)), sink,
                                   keys=["item"], value="freq", compact_every=2)
    want = {}
    for n in range(5):
        _rows(spark, folder, n, n, 7)
        for v in (n, n, 7):
            want[v] = want.get(v, 0) + 1
        run()
        if n in (1, 2):
            assert stream.forget_commit(spark, f"{sink}-checkpoint") == n
            run()
        assert _histogram(stream.latest(spark, sink, ["item"], "freq")) == want
    assert children(spark, f"{sink}/snapshots") == ["upto=3"] and children(spark, sink)[0] == "batch_id=4"


def test_nothing_written_is_an_empty_frame_and_other_errors_are_raised(spark):
    sink = scratch_path(spark, "test-nothing")
    assert stream.taken(spark, sink).count() == 0 and stream.latest(spark, sink, ["item"], "freq").columns == ["item", "freq"]
    spark.range(3).write.json(f"{sink}/batch_id=0")
    with pytest.raises(Exception):
        stream.taken(spark, sink).collect()


def test_prefix_rule(spark):
    df = spark.createDataFrame([(b, i) for b, n in enumerate([3, 4, 2, 5]) for i in range(n)], "batch int, item int")
    # items before each batch: 0, 3, 7, 9
    assert stream.prefix(df, "batch", 7).count() == 7   # batches 0, 1
    assert stream.prefix(df, "batch", 8).count() == 9   # batches 0, 1, 2
    assert stream.prefix(df, "batch", 100).count() == 14
    assert stream.prefix(df, "batch", 1).count() == 3
    assert stream.prefix(df, "batch", 0).count() == 0
    assert stream.prefix(df.limit(0), "batch", 5).count() == 0


def test_prefix_scans_its_table_twice_at_most(spark):
    import re

    from tools.plan_audit import final_only

    df = stream.prefix(_batch_items(spark), "batch", 700)
    df.collect()
    assert len(re.findall("FileScan parquet", final_only(df._jdf.queryExecution().executedPlan().toString()))) <= 2


@pytest.mark.parametrize("ids", ["dense", "sparse", "outlier"])
def test_items_before_across_ranges(spark, ids):
    rng = random.Random(3)
    batches = {"dense": range(60), "sparse": sorted(rng.sample(range(-10**12, 10**12), 60)), "outlier": [*range(59), 10**15]}[ids]
    sizes = [(b, rng.randint(1, 9)) for b in batches]
    df = spark.createDataFrame(sizes, "batch bigint, n bigint")
    for buckets in (1, 3, 7, 256):
        got = {r["batch"]: r["before"] for r in stream.items_before(df, "batch", buckets).collect()}
        run = 0
        for b, n in sizes:
            assert got[b] == run
            run += n


def test_ranges_hold_about_equal_numbers_of_batches(spark):
    """One far id does not pull the others into one window partition."""
    sizes = spark.range(5000).select(F.col("id").alias("batch"), F.lit(1).cast("bigint").alias("n")) \
        .union(spark.createDataFrame([(10**17, 1)], "batch bigint, n bigint"))
    cuts = sizes.agg(F.percentile_approx("batch", [i / 256 for i in range(1, 256)], 2560)).first()[0]
    counts = {}
    for b in range(5000):
        k = sum(c < b for c in cuts)
        counts[k] = counts.get(k, 0) + 1
    assert max(counts.values()) < 100
