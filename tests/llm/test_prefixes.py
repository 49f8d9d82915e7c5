"""The prefix trie against brute force: shared beginnings, long and equal conversations, odd rows, ranges, the query."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairsketch.llm import prefixes
from fairsketch.llm.queries import op12_prefix_trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("depth", T.StringType())])


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    out = {}
    for c, n, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((n is not None, n or 0, digest(role, text), (role or "", text or "")))
    return {c: [x[3] for x in sorted(v)] for c, v in out.items()}


def nodes(paths):
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends of every node, from whole paths."""
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in sorted(members, key=len, reverse=True):
        children.setdefault(path, 0)
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    out = []
    for path, who in members.items():
        ends = sorted(c for c in who if len(paths[c]) == len(path))
        out.append((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children[path], leaves[path],
                    saved[path], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"]


def collected(df, saved="saved_bytes"):
    return sorted((tuple(r[c] for c in (*COLUMNS, saved, "ends_sha256")) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def run(spark, rows):
    turns = prefixes.turns_of(frame(spark, rows).repartition(3))
    return collected(prefixes.trie(turns, turns.select("conv_id").distinct()))


def chats(seed, n=40, longest=30):
    rng = random.Random(seed)
    words = ["", "a", "bé", "cc"]
    rows, paths = [], []
    for c in range(n):
        path = list(rng.choice(paths))[:rng.randrange(longest)] if paths and rng.random() < .7 else []
        path += [(rng.choice(["user", "assistant"]), rng.choice(words)) for _ in range(rng.randrange(1, 1 + max(1, longest - len(path)) // 2 + 1))]
        paths.append(path)
        rows += [(c * 3, k * 2, *t) for k, t in enumerate(path)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("longest", [3, 30])
def test_equals_brute_force(spark, longest):
    rows = chats(longest, longest=longest)
    assert run(spark, rows) == nodes(ordered(rows))


def test_blocks_and_ranges_of_long_and_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SPAN", 4)
    long = [(7, k, "user", str(k % 3)) for k in range(150)]
    rows = long + [(100 + i, k, "user", str(k % 3)) for i in range(12) for k in range(16)] + \
        [(200 + i, k, "user", str(k % 3)) for i in range(12) for k in range(8 + i)] + chats(5, 12)
    rows = [(c + 1000 if i >= 150 + 12 * 16 + sum(range(8, 20)) else c, *r) for i, (c, *r) in enumerate(rows)]
    assert run(spark, rows) == nodes(ordered(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, None, "user", "x"), (1, 3, "", ""), (1, 3, "", ""), (2, None, "", ""),
            (2, -5, "user", "y" * 9000), (-4, 0, "us", "erx"), (-3, 0, "user", "x"), (2**40, 0, "user", "x"), (2**40 + 1, 0, "user", "x")]
    assert run(spark, rows) == nodes(ordered(rows))


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "lost")]) == []


def test_a_third_of_all_rows_in_one_conversation_without_numbers(spark):
    rows = chats(8, 30) + [(9999, None, "user", str(k)) for k in range(150)]
    assert run(spark, rows) == nodes(ordered(rows))
    numbered = prefixes.turns_of(frame(spark, rows))
    assert numbered.where("conv_id = 9999").agg(F.min("place"), F.max("place"), F.count_distinct("place")).first() == (1, 150, 150)
    sizes = prefixes.numbered(frame(spark, rows).select("conv_id", "text"), "conv_id", ["text"]).groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 150  # the conversation spans tasks


def rebuilt(own):
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + mine[h:]
    return out


def test_query(spark, tmp_path):
    rows = [(c // 3 + c % 4, n, role, text) for c, n, role, text in chats(21, 60, 12)]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    want = nodes(rebuilt(ordered(rows)))
    assert any(r[1] == 0 for r in want)
    assert collected(op12_prefix_trie(spark, str(tmp_path)), "saved_tokens") == want
