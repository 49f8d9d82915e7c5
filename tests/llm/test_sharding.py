import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from rows import ODD, frame, sentence

from fairsketch.llm import sharding


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_index_visits_every_cell_by_unit_steps(spark, n, bits):
    axes = [f"a{i}" for i in range(n)]
    cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), axes)
    path = sorted((r["h"], tuple(r[a] for a in axes)) for r in sharding.hilbert_index(cells, axes, bits, "h").collect())
    assert [h for h, _ in path] == list(range(1 << (n * bits)))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for (_, a), (_, b) in zip(path, path[1:]))


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(t) + 16, zlib.crc32(t), "rows", None)
        by[r.shard].append(r.slot)
    counts = [len(by[s]) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_law_slots_and_digests(spark):
    import random

    rng = random.Random(4)
    texts = list(ODD) + [sentence(rng, rng.randint(0, 80)) for _ in range(150)]
    langs = [rng.choice(["en", "fr", None]) for _ in texts]
    rows = sharding.hilbert_shards(frame(spark, texts, langs=langs)).collect()
    check(rows, texts, 40)
    order = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_one_hot_cell_is_split(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 7)
    texts = ["same"] * 500
    check(sharding.hilbert_shards(frame(spark, texts), shards=13).collect(), texts, 13)


def test_fewer_rows_than_shards_nulls_and_empty(spark):
    df = frame(spark, ["a", "a", None], ids=[None, 3, 3], langs=[None, "x", "x"]).selectExpr("*", "1 as shard", "1 as size")
    rows = sharding.hilbert_shards(df, dims=("lang", "source")).collect()
    assert Counter(r.doc_id for r in rows) == {None: 1, 3: 2} and all(r.slot == 0 for r in rows)
    assert len({r.shard for r in rows}) == 3
    assert sharding.hilbert_shards(df.limit(0)).count() == 0


def test_shards_are_narrow_in_every_dimension(spark):
    import random

    rng = random.Random(8)
    texts = ["x" * rng.randint(1, 4000) for _ in range(2000)]
    df = frame(spark, texts, langs=[rng.choice(["de", "en", "es", "fr"]) for _ in texts])
    rows = sharding.hilbert_shards(df, dims=("lang", "size"), shards=40).collect()
    lang = {r.doc_id: r.lang for r in df.collect()}
    span, kinds = defaultdict(list), defaultdict(set)
    for r in rows:
        span[r.shard].append(r["size"])
        kinds[r.shard].add(lang[r.doc_id])
    assert sum(len(k) for k in kinds.values()) / 40 < 2.5
    assert sum(max(v) - min(v) for v in span.values()) / 40 < 1600


def test_written_shards_hold_every_row_in_slot_order(spark, tmp_path):
    texts = [f"t{i}" for i in range(60)]
    df = frame(spark, texts)
    sharding.write_shards(df, sharding.hilbert_shards(df, shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter(r.shard for r in back) == {s: 15 for s in range(4)} and {r.text for r in back} == set(texts)
