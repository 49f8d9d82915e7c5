import random
from collections import defaultdict

import pytest
from rows import VOCABULARY, frame, sentence
from test_jaccard import brute as near
from test_packing import PATH, brute as cut_pieces
from test_substrings import WORD

import corpus_pipeline as P


def passages(rng, n):
    return " ".join(f"{rng.choice(VOCABULARY) or 'x'}{rng.randint(0, 999)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    items = [passages(rng, 20) + "? " + passages(rng, 6) for _ in range(6)]
    shared = passages(rng, 60)
    texts = []
    for i in range(70):
        base = passages(rng, rng.randint(20, 120))
        texts.append(base)
        if i % 7 == 0:
            texts.append(base)
        if i % 9 == 0:
            texts.append(base + " added words")
        if i % 5 == 0:
            texts.append(passages(rng, 40) + " " + shared + " " + passages(rng, 40))
        if i % 11 == 0:
            texts.append(passages(rng, 30) + " " + items[i % 6] + " " + passages(rng, 30))
    texts += [None, "", "12 34", shared]
    root = str(tmp_path_factory.mktemp("sf"))
    langs = ["en"] * (len(texts) - 1) + [None]
    frame(spark, texts, langs=langs).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, texts, items


def expected(texts, items):
    """Every stage by brute force on the rows the stage before it kept; language keeps texts with letters."""
    left = {i: t for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)}
    ids = sorted(left)
    left = {i: left[i] for i, _, c in near([left[i] for i in ids], ids, 5, 80) if c == i}
    least, out = {}, {}
    for i in sorted(left):
        w = WORD.findall(left[i])
        gone = set()
        for p in range(len(w) - 12):
            if least.setdefault(tuple(w[p:p + 13]), i) < i:
                gone |= set(range(p, p + 13))
        if len(gone) < len(w):
            out[i] = [x for q, x in enumerate(w) if q not in gone]
    return {i: w for i, w in out.items() if not any(x in " ".join(w) for x in items)}


def test_stages_equal_brute_force(spark, corpus):
    root, texts, items = corpus
    want = expected(texts, items)
    docs = spark.read.parquet(f"{root}/documents.parquet").selectExpr("*", "1 as score", "2 as block")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, root)
        assert docs.columns == P.COLUMNS
    rows = docs.collect()
    assert {r.doc_id: WORD.findall(r.text) for r in rows} == want and len(rows) == len(want)
    assert all(r.lang == "en" and r.n_chars == len(r.text) for r in rows)


def test_near_copies_keep_one_row_of_each_component(spark):
    """Ids repeat with other texts and with the same, and are null; clean texts of a repeated id stay."""
    rng = random.Random(31)
    a, b, c, d, e, f = (passages(rng, 60) for _ in range(6))
    rows = [(1, a), (2, a + " more"), (2, b), (2, c + " more"), (5, c), (6, d), (6, d), (6, d + " more"), (None, e), (None, e),
            (None, f), (9, f + " more"), (None, b + " more"), (3, ""), (3, ""), (None, None)]
    df = frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    kept = sorted(((r.doc_id, r.text) for r in P.near_copies(spark, df, "").collect()), key=str)
    (d_kept,) = {t for i, t in kept if i == 6}
    assert d_kept in (d, d + " more")  # by text hash
    want = [(1, a), (2, b), (2, c + " more"), (6, d_kept), (None, e), (9, f + " more"), (3, ""), (3, ""), (None, None)]
    assert kept == sorted(want, key=str)


def test_run_packs_what_is_left_and_removes_its_files(spark, corpus):
    import os

    from fairsketch.session import checkpoint_root

    root, texts, items = corpus
    want = expected(texts, items)
    rows = P.run(spark, root).collect()
    ids = sorted(want)
    pieces = cut_pieces([" ".join(want[i]) for i in ids], 4096)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == {(ids[i], k): v for (i, k), v in pieces.items()}
    by = defaultdict(int)
    for r in rows:
        by[r.sequence_id] += r.length
    assert max(by.values()) <= 4096
    scratch = checkpoint_root(spark).removeprefix("file:") + "/fairsketch"
    assert not [d for d in os.listdir(scratch) if d.startswith(("language", "near", "repeated", "benchmark"))]


def test_sequences_can_be_built_from_the_result(spark, corpus):
    """The pieces' ids fill each sequence from its start, and a document's pieces give its text again."""
    from tokenizers import Tokenizer

    root, texts, items = corpus
    want = expected(texts, items)
    rows = P.run(spark, root).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = [int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4)]
        assert len(ids) == r.length and len(sequences[r.sequence_id]) == r.offset
        sequences[r.sequence_id] += ids
        documents[r.doc_id].append((r.start, ids))
    encode = Tokenizer.from_file(PATH).encode
    assert {d: [i for _, ids in sorted(x) for i in ids] for d, x in documents.items()} == \
        {d: encode(" ".join(w), add_special_tokens=False).ids + [1] for d, w in want.items()}


def test_whole_texts_go_to_python_in_small_batches(spark, corpus):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, root = spark.conf.get(key), corpus[0]
    try:
        for rows, stage, want in ((10_000, P.language, 2000), (0, P.near_copies, 2000), (500, P.language, 500)):
            spark.conf.set(key, str(rows))
            stage(spark, spark.read.parquet(f"{root}/documents.parquet"), root)
            assert int(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, before)


def test_empty_table(spark, corpus, tmp_path):
    root, _, _ = corpus
    empty = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        empty = stage(spark, empty, root)
        assert empty.count() == 0
    assert PATH
