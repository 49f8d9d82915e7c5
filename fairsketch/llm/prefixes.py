"""Operator 12, conversation prefix trie by fixed-length block hashing.

A node is a distinct sequence of first turns.  Conversations are cut into blocks of ``BLOCK`` turns, and a block is
known by the digests of all blocks up to it, so conversations that begin alike meet block by block: their equal
blocks are counted as one row each, before the shuffle too.  Turn boundaries are refined only where a block has
siblings, i.e. where different blocks follow the same beginning: their prefixes are grouped turn by turn.  A block
without siblings is a chain of nodes that need no grouping.

Sums over subtrees need no walk along the trie.  Each node belongs to its smallest member; a conversation's own
nodes are the last part of its path.  A node's childless descendants, and what its subtree saves, are sums over its
members, taken by the same grouping of blocks, less what its own conversation owns above it.

No conversation and no group of equal ones has to fit a task: turns are numbered over range partitions, running
sums go in two levels, and counts are combined before they are sent.  Only the digest of a node's member ids is
sequential by its nature: ids are sorted and formatted in parallel, and one task streams a node's text through SHA-256.

Defined results.  Turns are ordered by number (null first); equal numbers by the digest of role and text, rows alike
in all three are all kept.  A null role or text is empty.  Rows without conversation id are left out.  A conversation
may have no turns (see ``trie``).  Very long texts enter by their digest and size.  An empty table gives no rows.
Extra columns are ignored, whatever their names.  Turns are compared by MD5, blocks by 128-bit sums of MD5 parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairsketch.llm.blocks import partitions
from fairsketch.session import checkpoint_root, scratch_path

BLOCK = 8
#: Places summed in one window; longer sequences are summed range by range.
SPAN = 8192
_LANES = ["l0", "l1", "l2", "l3"]


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written to the shared scratch folder."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, counting from 1 in each (long, non-null) key by ``order``; a key may span many tasks."""

    def count(batches):
        last, seen = None, 0
        for batch in batches:
            k = batch.column(key).to_numpy(zero_copy_only=False)
            if not len(k):
                continue
            at = np.arange(len(k))
            new = np.append(True, k[1:] != k[:-1])
            local = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
            if last is not None and k[0] == last:
                local[:int(np.argmax(new[1:])) + 1 if new[1:].any() else len(k)] += seen
            last, seen = k[-1], int(local[-1])
            at = batch.schema.get_field_index("_local")
            yield batch.set_column(at, "_local", pa.array(local))

    dealt = rows.repartitionByRange(partitions(rows.sparkSession), key, *order).sortWithinPartitions(key, *order) \
        .withColumn("_local", F.lit(0).cast("long")).withColumn("_part", F.spark_partition_id())
    local = _kept(dealt.mapInArrow(count, dealt.schema), "numbered")
    ends = local.groupBy("_part").agg(F.min(key).alias("first"), F.max(F.struct(key, "_local")).alias("last")).collect()
    offsets, before = [], (None, 0)
    for r in sorted(ends, key=lambda r: r["_part"]):  # a row a partition
        more = before[1] if r["first"] == before[0] else 0
        offsets.append((r["_part"], r["first"], more))
        key_last, n = r["last"]
        before = (key_last, n + (more if key_last == r["first"] else 0))
    side = rows.sparkSession.createDataFrame(offsets, "_part int, _first long, _more long")
    return local.join(F.broadcast(side), "_part").select(
        *rows.columns, (F.col("_local") + F.when(F.col(key) == F.col("_first"), F.col("_more")).otherwise(0)).alias("place"))


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """conv_id, place (from 1), digest, n_bytes of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
                                F.octet_length(text).cast("long").alias("n_bytes")).where("conv_id is not null")
    return numbered(rows, "conv_id", ["turn", "digest"]).drop("turn")


def sums_before(rows: DataFrame, key: str, place: str, values: list[str]) -> DataFrame:
    """``rows`` with ``before_<value>``: sums over the key's smaller places, in two levels of SPAN places."""
    cut = rows.withColumn("_range", F.floor(F.col(place) / SPAN))
    inside = Window.partitionBy(key, "_range").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    ranges = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(key, "_range").agg(*[F.sum(v).alias(v) for v in values]) \
        .select(key, "_range", *[F.sum(v).over(ranges).alias(f"_{v}") for v in values]).where("_range > 0")
    zero = F.lit(0).cast("long")
    return cut.select("*", *[F.coalesce(F.sum(v).over(inside), zero).alias(f"before_{v}") for v in values]) \
        .join(totals, [key, "_range"], "left") \
        .select(*rows.columns, *[(F.col(f"before_{v}") + F.coalesce(f"_{v}", zero)).alias(f"before_{v}") for v in values])


def _beginning(lanes: list, block) -> F.Column:
    return F.md5(F.concat_ws(",", *[x.cast("string") for x in lanes], block.cast("string")))


#: The beginning of no turns: the trie's root.
ROOT = hashlib.md5(b"0,0,0,0,0").hexdigest()


def blocks_of(turns: DataFrame) -> DataFrame:
    """conv_id, block, ``start`` and ``end`` (the beginnings before and after it), and the block's nodes in order
    (node, parent, depth, n_bytes)."""
    some = turns.withColumn("block", F.floor((F.col("place") - 1) / BLOCK)).groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "n_bytes"))).alias("turns"))
    some = some.withColumn("_hash", F.md5(F.concat(F.col("block").cast("string"), F.lit(":"), F.concat_ws("", "turns.digest"))))
    for k, lane in enumerate(_LANES):  # sums of 32-bit parts cannot overflow
        some = some.withColumn(lane, F.conv(F.substring("_hash", 1 + 8 * k, 8), 16, 10).cast("long"))
    some = sums_before(some, "conv_id", "block", _LANES)
    some = some.select("conv_id", "block", "turns",
                       _beginning([F.col(f"before_{x}") for x in _LANES], F.col("block")).alias("start"),
                       _beginning([F.col(f"before_{x}") + F.col(x) for x in _LANES], F.col("block") + 1).alias("end"))
    keys = F.expr(f"transform(sequence(1, size(turns)), j -> if(j = {BLOCK}, end, "
                  "md5(concat(start, '/', concat_ws('', slice(turns.digest, 1, j))))))")
    nodes = F.expr("transform(sequence(1, size(turns)), j -> named_struct('node', keys[j - 1], 'parent', "
                   "if(j = 1, start, keys[j - 2]), 'depth', turns[j - 1].place, 'n_bytes', turns[j - 1].n_bytes))")
    return some.withColumn("keys", keys).select("conv_id", "block", "start", "end", nodes.alias("nodes"))


def _ends_digest(ends: DataFrame) -> DataFrame:
    """node, ends_sha256: the digest of its conv_ids in rising order, joined by commas."""
    n = partitions(ends.sparkSession)

    def text(batches):
        for batch in batches:
            node, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            cut = [0, *(i for i in range(1, len(node)) if node[i] != node[i - 1]), len(node)]
            runs = [(x, y) for x, y in zip(cut, cut[1:]) if y > x]
            yield pa.record_batch([pa.array([node[x] for x, _ in runs], pa.string()), pa.array([ids[x] for x, _ in runs], pa.int64()),
                                   pa.array([",".join(map(str, ids[x:y])) for x, y in runs], pa.string())], names=["node", "least", "ids"])

    def digest(batches):
        now, state = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = node, hashlib.sha256(ids.encode())
            yield pa.record_batch([pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.string())],
                                  names=["node", "ends_sha256"])
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.string()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    return ends.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id") \
        .mapInArrow(text, "node string, least long, ids string") \
        .repartition(n, "node").sortWithinPartitions("node", "least").mapInArrow(digest, "node string, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every node: node and parent (keys), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_bytes (over its subtree, each node's members but one times the bytes of its last text) and ends_sha256 (of the
    conversations that end there).  A node's last turn is that of its conv_id at place depth.

    ``turns``: conv_id, place (1, 2, ... in each conversation), digest, n_bytes.  ``conversations``: all distinct conv_id,
    also those without turns, which are members of the root only.
    """
    checkpoint_root(turns.sparkSession)
    blocks = _kept(blocks_of(turns), "trie-blocks")
    distinct = blocks.groupBy("start", "block", "end").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                                           F.first("nodes").alias("nodes"))
    siblings = distinct.groupBy("start").agg(F.count("*").alias("n_siblings"))
    distinct = _kept(distinct.join(siblings, "start"), "trie-distinct")
    flat = distinct.select("n_siblings", "n_convs", "conv_id", F.explode("nodes").alias("x")) \
        .select("n_siblings", "n_convs", "conv_id", "x.*")
    refined = flat.where("n_siblings > 1").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("n_bytes").alias("n_bytes"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_bytes"), "n_convs", "conv_id")
    nodes = flat.where("n_siblings = 1").select(*root.columns).unionByName(refined).unionByName(root)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = _kept(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                  .withColumn("saves", (F.col("n_convs") - 1) * F.col("n_bytes"))
                  .withColumn("leaf", (F.col("n_children") == 0).cast("long")), "trie-nodes")
    # what each conversation owns, summed over the members of every block and then of every node
    owned = nodes.groupBy("conv_id").agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("leaf")).where("saves > 0 or leaf > 0")
    by_block = blocks.select("conv_id", "end").join(owned, "conv_id").groupBy("end").agg(
        F.sum("saves").alias("saves"), F.sum("leaf").alias("leaf"))
    members = distinct.select("end", F.explode("nodes.node").alias("node")).join(by_block, "end") \
        .groupBy("node").agg(F.sum("saves").alias("all_saves"), F.sum("leaf").alias("n_leaves"))
    members = members.unionByName(owned.agg(F.sum("saves").alias("all_saves"), F.sum("leaf").alias("n_leaves"))
                                  .select(F.lit(ROOT).alias("node"), "all_saves", "n_leaves"))
    ends = blocks.groupBy("conv_id").agg(F.max_by(F.element_at("nodes.node", -1), "block").alias("node"))
    ends = conversations.select("conv_id").join(ends, "conv_id", "left").select("conv_id", F.coalesce("node", F.lit(ROOT)).alias("node"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    zero, nothing = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    return sums_before(nodes, "conv_id", "depth", ["saves"]).join(members, "node", "left").join(_ends_digest(ends), "node", "left") \
        .join(above, "parent", "left").select(
            "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
            (F.coalesce("all_saves", zero) - F.col("before_saves")).alias("saved_bytes"),
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
