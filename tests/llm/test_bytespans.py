"""Byte dedup against brute force: whole tables, odd rows, hot keys, repeated rows, very long texts."""

import hashlib
import random

import pyarrow as pa
import pytest
from rows import ODD, SCHEMA, frame, sentence

from fairsketch.llm import blocks, bytespans
from fairsketch.llm.queries import op13_suffix_dedup


def brute(rows, window):
    """(id, n_bytes, n_removed, spans, kept) of each (id, text)."""
    data = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in data:
        if i is not None:
            for k in range(len(b) - window + 1):
                w = b[k:k + window]
                least[w] = min(least.get(w, i), i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if i is not None and least[b[k:k + window]] < i:
                gone[k:k + window] = b"\1" * window
        begins = [k for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])]
        ends = [k + 1 for k in range(len(b)) if gone[k] and (k + 1 == len(b) or not gone[k + 1])]
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), list(zip(begins, ends)), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def run(spark, rows, window=50, gram=16, **options):
    df = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    out = bytespans.byte_dedup(df, window, gram, **options).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], r["kept_sha256"], bytes(r["kept"]))
                   for r in out), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    common = [sentence(rng, k) for k in (4, 9, 15, 40)]
    rows = []
    for i in range(n):
        parts = [sentence(rng, rng.randrange(12)), *rng.sample(common, rng.randrange(4)), sentence(rng, rng.randrange(12))]
        rng.shuffle(parts)
        rows.append((i, "".join(parts)))
    return rows + [(n + 1, rows[3][1]), (n + 2, rows[3][1][7:] + "!"), (n + 3, rows[5][1] * 3)]


@pytest.mark.parametrize("window,gram", [(50, 16), (50, 50), (20, 6), (63, 1)])
def test_equals_brute_force(spark, window, gram):
    rows = corpus(window + gram)
    want = brute(rows, window)
    assert sum(r[2] for r in want) > 1000
    assert run(spark, rows, window, gram) == want


def test_hot_keys_split_by_window(spark):
    rows = corpus(4)
    assert run(spark, rows, hot_segments=0) == brute(rows, 50)


def test_only_keys_with_different_segments_are_sorted(monkeypatch):
    a, b = ("a" * 30 + "b" * 30).encode(), ("b" * 30 + "c" * 30).encode()
    rows = [(1, a, 0, 10, 4), (1, a, 1, 11, 2), (1, a, 2, 12, 9), (2, a[:55], 0, 13, 5), (2, b, 0, 14, 5), (3, b, 0, 15, 1)]
    rows += [(4, b, 0, 16, 3), (4, b"x" + b, 1, 17, 8)]
    seen, least_ids = [], bytespans.least_ids
    monkeypatch.setattr(bytespans, "least_ids", lambda texts, *rest: (seen.extend(texts.to_pylist()), least_ids(texts, *rest))[1])
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), bytespans.SENT_ARROW.types)], schema=bytespans.SENT_ARROW)
    got = bytespans.earlier_windows(table, 50).to_pylist()
    assert sorted((r["block"], r["key"], r["bits"]) for r in got) == [(0, 10, 2**11 - 1), (1, 17, 2**12 - 2), (2, 12, 2**11 - 1)]
    assert sorted(seen) == [b, b"x" + b]
    assert bytespans.earlier_windows(table.slice(0, 0), 50).num_rows == 0


def test_odd_rows(spark):
    rows = list(enumerate(ODD * 2)) + [(None, "w " * 60), (None, None), (3, "w " * 60), (3, "x\n" * 70), (-7, "w " * 80), (10**15, "é" * 90)]
    assert run(spark, rows) == brute(rows, 50)


def test_a_third_of_all_rows_alike(spark):
    rng = random.Random(2)
    passage = sentence(rng, 30)
    rows = corpus(9) + [(1000, passage)] * 40 + [(None, passage)] * 30 + [(2000 + k, passage) for k in range(20)]
    df = frame(spark, [t for _, t in rows], [i for i, _ in rows]).select("doc_id", "text")
    few = blocks.collapsed(df)
    assert few.where("text = '%s'" % passage).count() <= 22 and few.selectExpr("sum(copies)").first()[0] == len(rows)
    assert run(spark, rows) == brute(rows, 50)


def test_a_text_longer_than_a_slice(spark):
    rng = random.Random(3)
    long = sentence(rng, 2000)
    rows = [(0, long[5000:5100]), (1, long), (2, "x" + long[:300])] + [(3, "".join(rng.choice("ab") for _ in range(9000)))]
    bytes_before = bytespans.SLICE_BYTES
    assert max(len(t) for _, t in rows) < bytes_before
    assert run(spark, rows) == brute(rows, 50)
    big = long * (bytes_before // len(long.encode()) + 2)
    got = run(spark, [(0, "b" + big), (1, "a" + big)])
    assert [(r[0], r[2], r[3]) for r in got] == [(0, 0, []), (1, len(big.encode()), [(1, len(big.encode()) + 1)])]


def test_empty_table_extra_columns_and_missing_texts(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a" * 60, "en", "s", 60), (2, "a" * 60, None, None, None)], SCHEMA)
    df = df.withColumn("kept", df.lang).withColumn("block", df.n_chars).withColumn("copies", df.n_chars).withColumn("spans", df.n_chars)
    out = bytespans.byte_dedup(df, others=("lang",), texts=False)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "lang"]
    assert {(r["doc_id"], r["n_removed"], r["lang"]) for r in out.collect()} == {(1, 0, "en"), (2, 60, None)}


def test_query(spark, tmp_path):
    rows = corpus(12)
    frame(spark, [t for _, t in rows], [i for i, _ in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    out = op13_suffix_dedup(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out), key=str) == sorted(
        ((i, n, k, len(s), h) for i, n, k, s, h, _ in brute(rows, 50)), key=str)
