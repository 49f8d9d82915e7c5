"""Connected components of a link table, as Spark joins.

Each round lets every node point its larger neighbours (and itself) at its smallest neighbour, then
lets every node point at the smallest of its smaller neighbours (alternating large and small stars).
A round is two minimum aggregations and joins, so a node with very many links is one aggregate row
joined to splittable rows, never a list.  Lineage is cut by checkpoint() each round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.session import checkpoint_root


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, node): the links (a, b) of one task as one star a component, around its smallest node.

    They connect what the links connect, in fewer rows than there are nodes.  Tasks that see parts of one
    dense group mostly name the same roots, so what is left of it after a ``distinct`` is a few rows a node.
    """
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, x, root[y])
        np.minimum.at(least, y, root[x])
        least = least[least]
        if np.array_equal(least, root):
            break
        root = least
    leaf = root != np.arange(len(nodes))
    return nodes[root[leaf]], nodes[leaf]


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: distinct (u, v) with u > v.  One star round; the result has the same form."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.where("m < u").select("u", F.col("m").alias("v")))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        out = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every linked node except each component's smallest; component is that smallest node."""
    checkpoint_root(links.sparkSession)
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct().checkpoint()
    while True:
        after = _star(_star(now, True), False).checkpoint()
        # a settled table: stars only, i.e. no node is both a centre and a leaf and no leaf has two centres
        state = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        before = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        now = after
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
