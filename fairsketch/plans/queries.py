"""The named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.

Every double in a result is rounded to ``DIGITS`` places and every integer widened to bigint,
so results compare with the SQL oracles (``oracle.py``) independently of summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import cluster, fair, heavy, objective, seeding, sketch, sketch_store, sweep
from ..operators.assign import as_center_list, min_sq_distance, nearest_center, point_distances
from ..operators.nearest_tree import nearest_center_tree
from ..sources import tables
from ..sources.items import read_items_checked
from ..sources.points import flat, read_points, read_points_checked, write_points, write_sorted_out
from ..streaming import stream
from ..session import checkpoint_root, remove_path, scratch_path
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


def out(df: DataFrame) -> DataFrame:
    """Round doubles, widen integers (the result form shared with the oracles)."""
    cols = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = f"round(CAST({c} AS DOUBLE), {P.DIGITS})"
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = f"CAST({c} AS BIGINT)"
        cols.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*cols)


def _centers_df(spark: SparkSession, cs) -> DataFrame:
    d = len(cs[0])
    rows = [(i, *[float(v) for v in c]) for i, c in zip(cs.ids, cs)]
    schema = "cid bigint, " + ", ".join(f"x{j} double" for j in range(d))
    return spark.createDataFrame(rows, schema)


def _flat_centers(df: DataFrame, d: int, extra=()) -> DataFrame:
    return df.selectExpr("CAST(cid AS BIGINT) AS cid", *[f"c[{j}] AS x{j}" for j in range(d)], *extra)


# ---------------------------------------------------------------- points, assignment, objectives

def q_points_scan(spark, sf):
    return out(flat(tables.pts3(spark, sf), 3))


def q_points_roundtrip(spark, sf):
    """Points written in the text form c1,...,cD,label and parsed back (any-D text reader)."""
    path = scratch_path(spark, "points-text")
    write_points(tables.pts3(spark, sf), path, 3)
    return _kept(spark, out(flat(read_points(spark, path), 3)), path)


def q_points_csv_fixed(spark, sf):
    """The same, read back with the known dimension (CSV reader, fixed schema)."""
    path = scratch_path(spark, "points-csv")
    write_points(tables.pts3(spark, sf), path, 3)
    return _kept(spark, out(flat(read_points(spark, path, dims=3), 3)), path)


def q_points_quarantine(spark, sf):
    """A point file with spoilt lines, read and sorted out in one scan: points by group, lines set aside by reason."""
    path, sorted_out = scratch_path(spark, "points-spoilt"), scratch_path(spark, "points-sorted-out")
    lines = tables.table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN '  ' WHEN l_linenumber = 2 AND l_returnflag = 'R' "
        "THEN concat(l_quantity, ',', l_linestatus) ELSE concat(l_quantity, ', ', CASE WHEN l_linenumber = 3 AND l_returnflag = 'A' "
        "THEN 'n/a' WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 'NaN' ELSE CAST(l_linenumber AS STRING) END, ',', "
        "CASE WHEN l_linestatus = 'O' THEN ' A' WHEN l_linenumber = 1 THEN 'C' ELSE 'B ' END) END AS value")
    lines.write.text(path)
    good, bad = write_sorted_out(read_points_checked(spark, path, dims=2), sorted_out)
    points = spark.read.parquet(good).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.expr("sum(p[0] * p[1])").alias("total"))
    aside = spark.read.parquet(bad).groupBy(F.col("reason").alias("grp")).agg(F.count("line").alias("n"), F.lit(0.0).alias("total"))
    return _kept(spark, out(points.unionByName(aside)), path, sorted_out)


def q_items_quarantine(spark, sf):
    """A file of item lines, some spoilt, read and sorted out in one scan: item totals, lines set aside by reason."""
    path, sorted_out = scratch_path(spark, "items-spoilt"), scratch_path(spark, "items-sorted-out")
    lines = tables.table(spark, sf, "events").selectExpr(
        "CASE WHEN event_id % 97 = 0 THEN '  ' WHEN event_id % 89 = 0 THEN concat(user_id, 'x') "
        "WHEN event_id % 83 = 0 THEN concat('9999999999999999999', user_id) ELSE concat(' ', user_id) END AS value")
    lines.write.text(path)
    good, bad = write_sorted_out(read_items_checked(spark, path), sorted_out)
    kept = spark.read.parquet(good).agg(F.lit("item").alias("kind"), F.count("item").alias("n"), F.sum("item").alias("total"),
                                        F.countDistinct("item").alias("different"))
    zero = F.lit(0).cast("long")
    aside = spark.read.parquet(bad).groupBy(F.col("reason").alias("kind")).agg(
        F.count("line").alias("n"), zero.alias("total"), zero.alias("different"))
    return _kept(spark, out(kept.unionByName(aside)), path, sorted_out)


def q_group_filter(spark, sf):
    return out(flat(objective.group_filter(tables.pts3(spark, sf), "A"), 3))


def q_group_counts(spark, sf):
    return out(objective.group_counts(tables.pts3(spark, sf)))


def q_point_distance(spark, sf):
    pts = point_distances(tables.pts3(spark, sf), P.CENTERS_PTS3)
    return out(pts.select(*[F.col("p")[j].alias(f"x{j}") for j in range(3)], "grp",
                          *[f"dist_{i}" for i in range(len(P.CENTERS_PTS3))]))


def q_min_sq_distance(spark, sf):
    pts = min_sq_distance(tables.pts3(spark, sf), P.CENTERS_PTS3)
    return out(pts.select(*[F.col("p")[j].alias(f"x{j}") for j in range(3)], "grp", "d2"))


def q_nearest_center(spark, sf):
    pts = nearest_center(tables.pts3(spark, sf), P.CENTERS_PTS3)
    return out(pts.select(*[F.col("p")[j].alias(f"x{j}") for j in range(3)], "grp", "cid", "d2"))


def q_nearest_center_gapped_ids(spark, sf):
    """Centres given as a frame whose ids have gaps: the ids come back as given."""
    cs = spark.createDataFrame([(i, list(c)) for i, c in P.GAPPED_CENTERS], "cid int, c array<double>")
    pts = nearest_center(tables.pts3(spark, sf), cs)
    return out(pts.select(*[F.col("p")[j].alias(f"x{j}") for j in range(3)], "grp", "cid", "d2"))


def q_standard_objective(spark, sf):
    return out(objective.standard_objective(tables.pts3(spark, sf), P.CENTERS_PTS3))


def q_standard_objective_distinct(spark, sf):
    return out(objective.standard_objective(tables.pts3(spark, sf), P.CENTERS_PTS3, dedupe=True))


def q_distinct_points(spark, sf):
    d = objective.distinct_points(tables.pts3(spark, sf))
    return out(d.select(*[F.col("p")[j].alias(f"x{j}") for j in range(3)], "n"))


def q_group_objectives(spark, sf):
    return out(objective.group_objectives(tables.pts3(spark, sf), P.CENTERS_PTS3))


def q_fair_objective(spark, sf):
    return out(objective.fair_objective(tables.pts3(spark, sf), P.CENTERS_PTS3))


def q_cluster_group_counts(spark, sf):
    counts = objective.cluster_group_counts(tables.pts3(spark, sf), P.CENTERS_PTS3)
    return out(counts.select("cid", *[F.col("c")[j].alias(f"x{j}") for j in range(3)], "n_a", "n_b"))


def q_cluster_members(spark, sf):
    """The points of one cluster: a filter on the assigned id."""
    pts = nearest_center(tables.pts3(spark, sf), P.CENTERS_PTS3).where(F.col("cid") == P.MEMBERS_OF)
    return out(pts.select(*[F.col("p")[j].alias(f"x{j}") for j in range(3)], "grp", "cid", "d2"))


def _nearest_part(spark, sf):
    """Every lineitem point with the nearest of as many centres as there are parts."""
    parts = tables.table(spark, sf, "part").selectExpr(
        "p_partkey AS cid", "array(p_size / 50D, p_partkey * 37 % 101 / 100D, p_partkey * 53 % 81 / 100D) AS c")
    return nearest_center_tree(tables.pts3(spark, sf).select("p"), parts)


def q_nearest_part(spark, sf):
    return out(_nearest_part(spark, sf).groupBy("cid").agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("sum_d2")))


def q_nearest_part_skipped(spark, sf):
    """How much of the full comparison the tree spares: here more than nine tenths."""
    met = _nearest_part(spark, sf).agg(F.count(F.lit(1)).alias("n_points"), F.sum("n_met").alias("met"))
    every = tables.table(spark, sf, "part").agg(F.count(F.lit(1)).alias("n_centers"))
    return out(met.crossJoin(every).selectExpr("n_points", "n_centers", "met < 0.1 * n_points * n_centers AS nine_tenths_skipped"))


def emb_centers(spark, sf) -> list[tuple[float, ...]]:
    """Centres for the 64-D embeddings: the mean vector of each label (at most 10 rows)."""
    e = tables.emb(spark, sf, keep_label=True)
    means = e.groupBy(F.col("label").alias("cid")).agg(
        F.expr("array(" + ", ".join(f"avg(p[{j}])" for j in range(64)) + ")").alias("c"))
    return as_center_list(means)  # at most MAX_K rows reach the driver


def q_nearest_center_emb(spark, sf):
    cs = emb_centers(spark, sf)
    return out(objective.cluster_summary(tables.emb(spark, sf), cs))


def q_fair_objective_emb(spark, sf):
    return out(objective.fair_objective(tables.emb(spark, sf), emb_centers(spark, sf)))


# ---------------------------------------------------------------- fair k-means

def q_fair_cluster_stats(spark, sf):
    st = fair.cluster_stats(tables.pts3(spark, sf), P.CENTERS_PTS3)
    return out(st.select("cid", "n_a", "n_b", "alpha", "beta", "ell", "d_a", "d_b",
                         *[F.col("mu_a")[j].alias(f"mu_a{j}") for j in range(3)],
                         *[F.col("mu_b")[j].alias(f"mu_b{j}") for j in range(3)]))


def q_fair_fixed_terms(spark, sf):
    run = fair.run_stats(fair.group_moments(tables.pts3(spark, sf), P.CENTERS_PTS3))
    return out(run.select("fixed_a", "fixed_b", F.size("clusters").alias("n_clusters")))


def q_fair_balance(spark, sf):
    b = fair.balance(fair.run_stats(fair.group_moments(tables.pts3(spark, sf), P.CENTERS_PTS3)))
    return out(b.select("gamma", F.inline("x")))


def q_fair_step(spark, sf):
    st = fair.fair_step(tables.pts3(spark, sf), P.CENTERS_PTS3)
    return out(_flat_centers(st, 3, ["gamma"]))


def q_fair_step_emb(spark, sf):
    st = fair.fair_step(tables.emb(spark, sf), emb_centers(spark, sf))
    return out(_flat_centers(st, 64, ["gamma"]))


def q_fair_sweep(spark, sf):
    """One fair iteration from each of several starts, in one scan."""
    st = sweep.sweep_step(tables.pts3(spark, sf), P.SWEEP_STARTS)
    return out(_flat_centers(st, 3, ["run_id", "gamma"]))


def q_fair_sweep_best(spark, sf):
    """Φ of every run after some fair iterations, and the best run."""
    return out(sweep.best_run(tables.pts3(spark, sf), P.SWEEP_STARTS, P.LOOP_STEPS))


def q_fair_cluster_stats_wide(spark, sf):
    """Cluster statistics of 768-dimensional points: the embedding's coordinates times 1, 2, ..., one after the other."""
    e = tables.emb(spark, sf, keep_label=True)
    wide = e.withColumn("p", F.expr(f"flatten(transform(sequence(1, {P.WIDE_REPEATS}), k -> transform(p, x -> x * k)))"))
    cs = as_center_list([tuple(v * k for k in range(1, P.WIDE_REPEATS + 1) for v in c) for c in emb_centers(spark, sf)])
    st = fair.cluster_stats(wide, cs)
    return out(st.select("cid", "n_a", "n_b", "alpha", "beta", "ell", "d_a", "d_b"))


def q_seeding(spark, sf):
    """D²-weighted seeding from a hash of the points."""
    return out(_centers_df(spark, seeding.seed_centers(tables.pts3(spark, sf), P.KMEANS_K, P.SEEDING_SEED)))


def q_kmeans_seeded(spark, sf):
    """Lloyd's iterations from the hashed seeding: a k-means result that is the same everywhere."""
    pts = tables.pts3(spark, sf)
    return out(_centers_df(spark, cluster.lloyd(pts, seeding.seed_centers(pts, P.KMEANS_K, P.SEEDING_SEED), P.LOOP_STEPS)))


def q_fair_kmeans_fixed_start(spark, sf):
    cs = fair.fair_kmeans(tables.pts3(spark, sf), init=P.CENTERS_PTS3, m=P.LOOP_STEPS)
    return out(_centers_df(spark, cs))


def q_lloyd_fixed_start(spark, sf):
    cs = cluster.lloyd(tables.pts3(spark, sf), P.CENTERS_PTS3, P.LOOP_STEPS)
    return out(_centers_df(spark, cs))


def q_fair_kmeans_cached_loop(spark, sf):
    """Enough steps for the points to be cached and spread out."""
    return out(_centers_df(spark, fair.fair_kmeans(tables.pts3(spark, sf), init=P.CENTERS_PTS3, m=P.CACHED_LOOP_STEPS)))


def q_lloyd_cached_loop(spark, sf):
    return out(_centers_df(spark, cluster.lloyd(tables.pts3(spark, sf), P.CENTERS_PTS3, P.CACHED_LOOP_STEPS)))


def q_kmeans_standard(spark, sf):
    """k-means|| k-means: checkable facts of its random result (Δ against the mean's and the seeding's)."""
    pts = tables.pts3(spark, sf)
    seeding = cluster.init_centers(pts, P.KMEANS_K, P.KMEANS_SEED)
    cs = cluster.kmeans(pts, P.KMEANS_K, P.KMEANS_ITER, P.KMEANS_SEED)
    mean = cluster.lloyd(pts, [P.CENTERS_PTS3[0]], 1)
    n = objective.group_counts(pts).select("n").first()["n"]
    d_seed, d, d_mean = (objective.standard_objective(pts, c).first()["delta"] for c in (seeding, cs, mean))
    row = [(n, len(cs), d_mean, d < d_mean, d <= d_seed * (1 + 1e-9))]
    return out(spark.createDataFrame(row, "n_points bigint, n_centers bigint, delta_of_mean double, below_mean boolean, "
                                          "not_above_seeding boolean"))


def q_fair_vs_standard(spark, sf):
    """Φ of Lloyd's and the fair centres after the same number of steps from the same start."""
    return out(fair.compare(tables.pts3(spark, sf), m=P.LOOP_STEPS, init=P.CENTERS_PTS3))


# ---------------------------------------------------------------- sketches and heavy hitters

def q_item_frequencies(spark, sf):
    return out(sketch.histogram(tables.items_skew(spark, sf)))


def q_stream_totals(spark, sf):
    return out(sketch.stream_totals(sketch.histogram(tables.items_skew(spark, sf))))


def q_hash_buckets(spark, sf):
    it = tables.items_order(spark, sf).distinct()
    return out(sketch.hash_rows(it, P.SPEC_WIDE.cm_h, P.SPEC_WIDE.w))


def q_hash_signs(spark, sf):
    it = tables.items_order(spark, sf).distinct()
    return out(sketch.hash_rows(it, P.SPEC_WIDE.cs_g))


def q_cm_cells(spark, sf):
    s = P.SPEC_WIDE
    return out(sketch.count_min(tables.items_order(spark, sf), s.cm_h, s.w))


def q_cs_cells(spark, sf):
    s = P.SPEC_WIDE
    return out(sketch.count_sketch(tables.items_order(spark, sf), s.cs_h, s.cs_g, s.w))


def q_cm_estimate(spark, sf):
    s = P.SPEC_WIDE
    # one scan: both branches need the counts, so both read the same exchange
    hist = sketch.histogram(tables.items_part(spark, sf)).where("freq > 0")
    return out(sketch.estimate_cm(hist, sketch.count_min(hist, s.cm_h, s.w, weight="freq"), s.cm_h, s.w))


def q_cs_estimate(spark, sf):
    s = P.SPEC_WIDE
    hist = sketch.histogram(tables.items_part(spark, sf)).where("freq > 0")
    cells = sketch.count_sketch(hist, s.cs_h, s.cs_g, s.w, weight="freq")
    return out(sketch.estimate_cs(hist, cells, s.cs_h, s.cs_g, s.w))


def q_heavy_hitters(spark, sf):
    return out(heavy.top_k_with_ties(sketch.histogram(tables.items_skew(spark, sf)), P.TOP_K))


def q_heavy_hitters_users(spark, sf):
    return out(heavy.top_k_with_ties(sketch.histogram(tables.items_user(spark, sf)), P.TOP_K_USERS))


def q_heavy_hitter_detail(spark, sf):
    hist = sketch.histogram(tables.items_skew(spark, sf))
    cm, cs = sketch.sketches(hist, P.SPEC_NARROW, weight="freq")
    return out(heavy.report(hist, P.TOP_K, cm, cs, P.SPEC_NARROW))


def q_sketch_accuracy(spark, sf):
    hist = sketch.histogram(tables.items_order(spark, sf))
    cm, cs = sketch.sketches(hist, P.SPEC_WIDE, weight="freq")
    return out(heavy.accuracy(heavy.report(hist, P.TOP_K_ORDERS, cm, cs, P.SPEC_WIDE)))


def q_order_frequencies(spark, sf):
    """A histogram whose domain grows with the table (order keys)."""
    return out(sketch.histogram(tables.items_order(spark, sf)))


def q_heavy_hitters_orders(spark, sf):
    return out(heavy.top_k_with_ties(sketch.histogram(tables.items_order(spark, sf)), P.TOP_K_ORDERS))


def q_cm_merge(spark, sf):
    s = P.SPEC_WIDE
    li = tables.table(spark, sf, "lineitem")
    is_open = F.col("l_linestatus").eqNullSafe("O")  # a null status is in the second half
    open_lines = li.where(is_open).select(F.col("l_orderkey").alias("item"))
    closed_lines = li.where(~is_open).select(F.col("l_orderkey").alias("item"))
    return out(sketch.merge(sketch.count_min(open_lines, s.cm_h, s.w), sketch.count_min(closed_lines, s.cm_h, s.w)))


def q_cm_estimate_shuffled(spark, sf):
    """Estimates from a sketch too large to broadcast: cells and probes meet by shuffle."""
    s = P.SPEC_LARGE
    hist = sketch.histogram(tables.items_order(spark, sf)).where("freq > 0")
    return out(sketch.estimate_cm(hist, sketch.count_min(hist, s.cm_h, s.w, weight="freq"), s.cm_h, s.w))


def q_heavy_hitters_by_batch(spark, sf):
    return out(heavy.top_k_by(sketch.histogram_by(tables.items_skew(spark, sf), "batch"), P.TOP_K_BATCH, "batch"))


def _stored(spark, sf, batches=None):
    """Count-min cells of the order keys by shipping year, kept as a table; one year is written again."""
    path, spec = scratch_path(spark, "sketch-store"), P.SPEC_WIDE
    lines = tables.table(spark, sf, "lineitem").selectExpr("l_orderkey AS item", "year(l_shipdate) AS batch")
    sketch_store.write_batches(lines, path, "batch", spec)
    sketch_store.write_batches(lines.where(P.STORE_YEARS), path, "batch", spec)  # corrected years replace theirs
    return _kept(spark, out(sketch_store.read_sketch(spark, path, spec, batches=batches)), path)


def q_sketch_store(spark, sf):
    return _stored(spark, sf)


def q_sketch_store_years(spark, sf):
    return _stored(spark, sf, P.STORE_YEARS)


# ---------------------------------------------------------------- streams

def q_stream_prefix(spark, sf):
    taken = stream.prefix(tables.items_skew(spark, sf), "batch", P.STREAM_T)
    return out(taken.agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("item").alias("n_distinct"),
                         F.max("batch").alias("last_batch")))


def _event_items(spark: SparkSession, sf: str) -> DataFrame:
    """The events table itself as a stream of items."""
    src = stream.file_stream(spark, f"{sf.rstrip('/')}/events.parquet", tables.table(spark, sf, "events").schema)
    return src.select(tables.skew_item_expr().cast("bigint").alias("item"))


def _kept(spark: SparkSession, rows: DataFrame, *paths: str) -> DataFrame:
    """``rows`` made durable, so that the scratch paths it was read from can go."""
    checkpoint_root(spark)
    rows = rows.checkpoint()
    for path in paths:
        remove_path(spark, path)
    return rows


def _state(spark: SparkSession, state: DataFrame, keys: list[str], value: str) -> DataFrame:
    sink = stream.run_state(state, keys=keys, value=value)
    return _kept(spark, stream.latest(spark, sink, keys, value), sink, f"{sink}-checkpoint")


# The tables of the several-batch streams in the order they arrive, each with its item.
_ARRIVALS = (("events", "user_id"), ("orders", "o_custkey"), ("lineitem", "l_partkey"))
_ITEM_SCHEMA = T.StructType([T.StructField("item", T.LongType())])


def _arrivals(spark: SparkSession, sf: str, run, again=None) -> list[str]:
    """Whole tables arrive one after the other in a folder; after each the stream is started again and goes on.

    ``run(stream)`` takes up its own sink and checkpoint.  ``again()`` is called between the last run and one more.
    Returns the folders to remove.
    """
    inbox = scratch_path(spark, "stream-inbox")
    for name, item in _ARRIVALS:
        tables.table(spark, sf, name).select(F.col(item).cast("bigint").alias("item")).write.mode("append").parquet(inbox)
        run(stream.file_stream(spark, inbox, _ITEM_SCHEMA, files_per_trigger=100_000))
    if again:
        again()
        run(stream.file_stream(spark, inbox, _ITEM_SCHEMA, files_per_trigger=100_000))
    return [inbox]


def _state_of_tables(spark: SparkSession, sf: str, state, keys: list[str], value: str) -> DataFrame:
    """A state over three batches, two restarts and a replay of the last batch."""
    sink = scratch_path(spark, "stream-state")
    paths = _arrivals(spark, sf, lambda src: stream.run_state(state(src), sink, keys=keys, value=value, compact_every=2),
                      lambda: stream.forget_commit(spark, f"{sink}-checkpoint"))
    return _kept(spark, stream.latest(spark, sink, keys, value), sink, f"{sink}-checkpoint", *paths)


def q_stream_tables_histogram(spark, sf):
    return out(_state_of_tables(spark, sf, stream.histogram_state, ["item"], "freq"))


def q_stream_tables_cm_cells(spark, sf):
    return out(_state_of_tables(spark, sf, lambda src: stream.sketch_state(src, P.SPEC_NARROW, "cm"), ["r", "c"], "v"))


def q_stream_tables_cs_cells(spark, sf):
    return out(_state_of_tables(spark, sf, lambda src: stream.sketch_state(src, P.SPEC_NARROW, "cs"), ["r", "c"], "v"))


def q_stream_tables_until(spark, sf):
    """The stop rule in the stream's state: batches are taken while fewer than T items were, across restarts and a replay."""
    sink = scratch_path(spark, "stream-until")
    paths = _arrivals(spark, sf, lambda src: stream.run_until(src, P.STREAM_T_TABLES, sink),
                      lambda: stream.forget_commit(spark, f"{sink}-checkpoint"))
    return out(_kept(spark, stream.taken(spark, sink), sink, f"{sink}-checkpoint", *paths))


def _stream_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, stream.histogram_state(_event_items(spark, sf)), ["item"], "freq")


def q_stream_histogram(spark, sf):
    return out(_stream_histogram(spark, sf))


def q_stream_cm_cells(spark, sf):
    return out(_state(spark, stream.sketch_state(_event_items(spark, sf), P.SPEC_NARROW, "cm"), ["r", "c"], "v"))


def q_stream_cs_cells(spark, sf):
    return out(_state(spark, stream.sketch_state(_event_items(spark, sf), P.SPEC_NARROW, "cs"), ["r", "c"], "v"))


def _report(hist: DataFrame) -> DataFrame:
    cm, cs = sketch.sketches(hist, P.SPEC_NARROW, weight="freq")
    return out(heavy.summary(hist, P.TOP_K, cm, cs, P.SPEC_NARROW))


def q_stream_report(spark, sf):
    return _report(_stream_histogram(spark, sf))


def q_stream_report_t(spark, sf):
    """Stop at T, then report: whole files are taken while fewer than T items were taken before."""
    sink = stream.run_until(_event_items(spark, sf), P.STREAM_T)
    return _report(_kept(spark, stream.taken(spark, sink), sink, f"{sink}-checkpoint"))


QUERIES: dict[str, Query] = {
    "points_scan": q_points_scan,
    "points_roundtrip": q_points_roundtrip,
    "points_csv_fixed": q_points_csv_fixed,
    "points_quarantine": q_points_quarantine,
    "items_quarantine": q_items_quarantine,
    "group_filter": q_group_filter,
    "group_counts": q_group_counts,
    "point_distance": q_point_distance,
    "min_sq_distance": q_min_sq_distance,
    "nearest_center": q_nearest_center,
    "nearest_center_gapped_ids": q_nearest_center_gapped_ids,
    "standard_objective": q_standard_objective,
    "standard_objective_distinct": q_standard_objective_distinct,
    "distinct_points": q_distinct_points,
    "group_objectives": q_group_objectives,
    "fair_objective": q_fair_objective,
    "cluster_group_counts": q_cluster_group_counts,
    "cluster_members": q_cluster_members,
    "nearest_part": q_nearest_part,
    "nearest_part_skipped": q_nearest_part_skipped,
    "nearest_center_emb": q_nearest_center_emb,
    "fair_objective_emb": q_fair_objective_emb,
    "fair_cluster_stats": q_fair_cluster_stats,
    "fair_fixed_terms": q_fair_fixed_terms,
    "fair_balance": q_fair_balance,
    "fair_step": q_fair_step,
    "fair_step_emb": q_fair_step_emb,
    "fair_sweep": q_fair_sweep,
    "fair_sweep_best": q_fair_sweep_best,
    "fair_cluster_stats_wide": q_fair_cluster_stats_wide,
    "seeding": q_seeding,
    "kmeans_seeded": q_kmeans_seeded,
    "fair_kmeans_fixed_start": q_fair_kmeans_fixed_start,
    "lloyd_fixed_start": q_lloyd_fixed_start,
    "fair_kmeans_cached_loop": q_fair_kmeans_cached_loop,
    "lloyd_cached_loop": q_lloyd_cached_loop,
    "kmeans_standard": q_kmeans_standard,
    "fair_vs_standard": q_fair_vs_standard,
    "item_frequencies": q_item_frequencies,
    "stream_totals": q_stream_totals,
    "hash_buckets": q_hash_buckets,
    "hash_signs": q_hash_signs,
    "cm_cells": q_cm_cells,
    "cs_cells": q_cs_cells,
    "cm_estimate": q_cm_estimate,
    "cs_estimate": q_cs_estimate,
    "heavy_hitters": q_heavy_hitters,
    "heavy_hitters_users": q_heavy_hitters_users,
    "heavy_hitter_detail": q_heavy_hitter_detail,
    "sketch_accuracy": q_sketch_accuracy,
    "order_frequencies": q_order_frequencies,
    "heavy_hitters_orders": q_heavy_hitters_orders,
    "cm_merge": q_cm_merge,
    "cm_estimate_shuffled": q_cm_estimate_shuffled,
    "heavy_hitters_by_batch": q_heavy_hitters_by_batch,
    "sketch_store": q_sketch_store,
    "sketch_store_years": q_sketch_store_years,
    "stream_prefix": q_stream_prefix,
    "stream_histogram": q_stream_histogram,
    "stream_cm_cells": q_stream_cm_cells,
    "stream_cs_cells": q_stream_cs_cells,
    "stream_report": q_stream_report,
    "stream_report_t": q_stream_report_t,
    "stream_tables_histogram": q_stream_tables_histogram,
    "stream_tables_cm_cells": q_stream_tables_cm_cells,
    "stream_tables_cs_cells": q_stream_tables_cs_cells,
    "stream_tables_until": q_stream_tables_until,
}
