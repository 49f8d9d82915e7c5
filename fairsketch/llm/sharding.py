"""Operator 1, sharding: rows along a Hilbert curve over several metadata dimensions, cut into equal runs.

Each dimension is quantised at its own approximate quantiles into at most ``2**bits`` steps (text by
the order of its first seven bytes, null lowest).  The cell's Hilbert index orders the rows, so rows
near each other in all dimensions meet in one shard and the minima and maxima of a shard's files
are narrow in every dimension.  The law is ``rows``: shard sizes differ by at most one row.

All of it is DataFrame code.  Nothing is sorted globally: rows are counted per cell, a cell with
many rows is split by hash into short runs, one prefix sum over the run counts (at most
``RUNS + 2**(dims * bits)`` rows at any input size) gives every run's first rank, and a window
numbers the rows inside a run.  Both broadcast tables are bounded by the same figures, and a hot
cell is as many small windows.

Defined results.  Null text: size 16, checksum 0.  Null or repeated ids are ordinary rows (order
inside a run: id, checksum, size).  An empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUNS = 65536
RUN_ROWS = 256
ACCURACY = 2000


def order_code(df: DataFrame, column: str) -> Column:
    """A long in the column's order: numbers as they are, text by its first seven bytes, null lowest."""
    c = F.col(column)
    if df.schema[column].dataType.typeName() == "string":
        c = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10)
    return F.coalesce(c.cast("long"), F.lit(-1))


def hilbert_index(cells: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """Adds the Hilbert index of the cell whose coordinates (0..2**bits - 1) are in ``axes``.

    Coordinates become the curve's transposed form: from the highest bit down, each axis either
    inverts or exchanges the lower bits of the first axis; a Gray code follows.  The index reads
    the bits of all axes, highest first.  Folds over short arrays keep the expression small.
    """
    n = len(axes)
    steps = ", ".join(f"struct({1 << b}L as bit, {i} as axis)" for b in range(bits - 1, 0, -1) for i in range(n))
    levels = ", ".join(f"{1 << b}L" for b in range(bits - 1, 0, -1))
    shifts = ", ".join(str(b) for b in range(bits - 1, -1, -1))
    x = f"array({', '.join(f'cast({a} as bigint)' for a in axes)})"
    if bits > 1:
        x = f"""aggregate(array({steps}), {x}, (x, s) -> transform(x, (v, j) ->
            if(j <> 0 and j <> s.axis, v,
               if((x[s.axis] & s.bit) <> 0L, if(j = 0, v ^ (s.bit - 1L), v), v ^ ((x[0] ^ x[s.axis]) & (s.bit - 1L))))))"""
    gray = "transform(_x, (v, j) -> aggregate(slice(_x, 1, j + 1), 0L, (a, w) -> a ^ w))"
    turn = f"aggregate(array({levels}), 0L, (t, b) -> if((_g[{n - 1}] & b) <> 0L, t ^ (b - 1L), t))" if bits > 1 else "0L"
    index = f"aggregate(array({shifts}), 0L, (a, b) -> aggregate(_g, a, (c, v) -> c * 2L + (shiftright(v ^ _turn, b) & 1L)))"
    return cells.withColumn("_x", F.expr(x)).withColumn("_g", F.expr(gray)).withColumn("_turn", F.expr(turn)) \
        .withColumn(name, F.expr(index)).drop("_x", "_g", "_turn")


def _steps(code: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts lie below the code."""
    return reduce(lambda a, c: a + (code > F.lit(c)).cast("int"), cuts, F.lit(0))


def hilbert_shards(docs: DataFrame, dims: tuple[str, ...] = ("lang", "source", "size"), shards: int = 40, bits: int = 5,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert for every row of ``docs``.

    ``dims`` names columns of ``docs``, or ``size`` (UTF-8 bytes of the text plus 16).
    """
    others = [d for d in dims if d != "size"]
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    axes = [f"_q{i}" for i in range(len(dims))]
    coded = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        *(order_code(docs, d).alias(f"_c{i}") for i, d in enumerate(dims) if d in others))
    coded = coded.withColumns({f"_c{i}": F.col("size") for i, d in enumerate(dims) if d == "size"})
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    # at most 2**bits - 1 numbers for each dimension
    cuts = coded.agg(*(F.percentile_approx(f"_c{i}", shares, ACCURACY).alias(f"_c{i}") for i in range(len(dims)))).first()
    rows = coded.withColumns({axes[i]: _steps(F.col(f"_c{i}"), sorted(set(cuts[f"_c{i}"] or []))) for i in range(len(dims))}) \
        .drop(*(f"_c{i}" for i in range(len(dims))))

    every = Window.partitionBy()
    cells = hilbert_index(rows.groupBy(axes).agg(F.count("*").alias("_n")), axes, bits, "hilbert")
    # one task over at most 2**(dims * bits) cells
    cells = cells.withColumn("_total", F.sum("_n").over(every))
    run_rows = F.greatest(F.lit(RUN_ROWS), F.ceil(F.col("_total") / RUNS))
    cells = cells.withColumn("_runs", F.ceil(F.col("_n") / run_rows)).select(*axes, "hilbert", "_runs")
    rows = rows.join(F.broadcast(cells), axes).drop(*axes) \
        .withColumn("_run", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.col("_runs"))).drop("_runs")

    # one task over at most RUNS + 2**(dims * bits) run counts
    upto = Window.orderBy("hilbert", "_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("hilbert", "_run").agg(F.count("*").alias("_n")) \
        .withColumns({"_before": F.coalesce(F.sum("_n").over(upto), F.lit(0)), "_total": F.sum("_n").over(every)}).drop("_n")
    inside = Window.partitionBy("hilbert", "_run").orderBy("doc_id", "text_crc32", "size")
    ranked = rows.join(F.broadcast(runs), ["hilbert", "_run"]) \
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1) \
        .withColumn("shard", F.expr(f"_rank * {shards} div _total").cast("int"))
    slot = F.col("_rank") - F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, rows_per_file: int = 1_000_000, id_col: str = "doc_id") -> None:
    """Writes ``docs`` (unique ids) as ``path/shard=N/``, each shard in slot order, cut into files of ``rows_per_file``."""
    place = sharded.select(F.col("doc_id").alias(id_col), "shard", "slot", F.floor(F.col("slot") / rows_per_file).alias("_file"))
    docs.join(place, id_col).repartition("shard", "_file").sortWithinPartitions("shard", "_file", "slot").drop("_file") \
        .write.partitionBy("shard").parquet(path)
