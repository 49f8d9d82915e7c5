"""Sketches that know their parameters, kept sketch tables, and the shuffled and per-group forms."""

import pytest
from pyspark.sql import functions as F
from samples import SF0001

from fairsketch.functions.hashing import SketchSpec
from fairsketch.operators import heavy, sketch, sketch_store
from fairsketch.plans.queries import QUERIES
from fairsketch.session import scratch_path
from tools.plan_audit import final_only

ONE, OTHER = SketchSpec.draw(d=3, w=16, seed=1), SketchSpec.draw(d=3, w=16, seed=2)


def items(spark, n=500):
    return spark.range(n).select((F.col("id") * 7 % 31).alias("item"), (F.col("id") % 5).alias("batch"))


def cells(df):
    return sorted(map(tuple, df.select("r", "c", "v").collect()))


def test_other_parameters_are_refused(spark):
    df = items(spark)
    cm, cm2 = (sketch.count_min(df, s.cm_h, s.w) for s in (ONE, OTHER))
    cs = sketch.count_sketch(df, ONE.cs_h, ONE.cs_g, ONE.w)
    for a, b in ((cm, cm2), (cm, cs), (sketch.merge(cm), cm2)):
        with pytest.raises(ValueError, match="cannot be merged"):
            sketch.merge(a, b)
    with pytest.raises(ValueError, match="do not belong"):
        sketch.estimate_cm(df, cm, OTHER.cm_h, OTHER.w)
    with pytest.raises(ValueError, match="do not belong"):
        sketch.estimate_cs(df, cm, ONE.cs_h, ONE.cs_g, ONE.w)
    with pytest.raises(ValueError, match="do not belong"):
        sketch.estimate_both(df, cm, cm, ONE)
    unnamed = spark.createDataFrame(cm.collect(), "r int, c int, v bigint")
    assert cells(sketch.merge(cm, unnamed)) == [(r, c, 2 * v) for r, c, v in cells(cm)]
    names = {ONE.fingerprint("cm"), ONE.fingerprint("cs"), OTHER.fingerprint("cm"), SketchSpec(17, ONE.cm_h, ONE.cs_h, ONE.cs_g).fingerprint("cm")}
    assert len(names) == 4


@pytest.mark.parametrize("kind", ["cm", "cs"])
def test_batches_add_up_and_replace_themselves(spark, kind):
    path, df = scratch_path(spark, "test-store"), items(spark)
    whole = lambda x: cells(dict(zip(("cm", "cs"), sketch.sketches(x, ONE)))[kind])
    sketch_store.write_batches(df.where("batch < 3"), path, "batch", ONE, kind)
    assert cells(sketch_store.read_sketch(spark, path, ONE, kind)) == whole(df.where("batch < 3"))
    sketch_store.write_batches(df.where("batch >= 2"), path, "batch", ONE, kind)  # batch 2 again
    assert cells(sketch_store.read_sketch(spark, path, ONE, kind)) == whole(df)
    some = sketch_store.read_sketch(spark, path, ONE, kind, "batch in (1, 4)")
    assert cells(some) == whole(df.where("batch in (1, 4)"))
    assert "PartitionFilters: [batch" in some._jdf.queryExecution().executedPlan().toString()
    assert sketch.name_of(some) == ONE.fingerprint(kind)
    sketch_store.write_batches(df.where("batch = 0").withColumn("item", F.col("item") + 1), path, "batch", ONE, kind)  # corrected
    assert cells(sketch_store.read_sketch(spark, path, ONE, kind, "batch = 0")) == whole(df.where("batch = 0").withColumn("item", F.col("item") + 1))


def test_a_store_of_other_parameters_fails(spark):
    path, df = scratch_path(spark, "test-store"), items(spark)
    sketch_store.write_batches(df.where("batch = 0"), path, "batch", ONE)
    sketch_store.write_batches(df.where("batch = 1"), path, "batch", OTHER)
    with pytest.raises(Exception, match="another sketch"):
        sketch_store.read_sketch(spark, path, ONE).collect()
    assert cells(sketch_store.read_sketch(spark, path, ONE, batches="batch = 0")) == cells(sketch.count_min(df.where("batch = 0"), ONE.cm_h, ONE.w))


def test_large_sketches_are_not_broadcast(spark):
    df = QUERIES["cm_estimate_shuffled"](spark, SF0001)
    df.collect()
    plan = final_only(df._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_groups_are_limited_before_the_shuffle(spark):
    df = QUERIES["heavy_hitters_by_batch"](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(batch") < plan.index("Partial")
    hist = spark.createDataFrame([(b, i, f) for b in (1, None) for i, f in ((1, 9), (2, 7), (3, 7), (4, 5))], "g int, item bigint, freq bigint")
    got = {(r["g"], r["item"]) for r in heavy.top_k_by(hist, 2, "g").collect()}
    assert got == {(g, i) for g in (1, None) for i in (1, 2, 3)}
    with pytest.raises(ValueError):
        heavy.top_k_by(hist, 0, "g")
