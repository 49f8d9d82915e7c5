import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from rows import ODD, frame, sentence
from tokenizers import Tokenizer

from fairsketch.llm import packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TRICKY = ["don't I'LL we've 'tis x's''s", "a<|endoftext|>b <|startoftext|>", "A<|STARTOFTEXT|>", "x≠y é É ́a",
          "v1.2.3-beta+4 (foo)bar[baz]", "İstanbul ΑΣ ΑΣ. ß", "tab\x0bvt\x0cff\x1cfs nbsp em　x", "a|b|c <| |>", "١٢ 12ab34 ½",
          "#tag $5.00 100%&more", "日本語テキスト。English混在"]


def brute(texts, capacity):
    tok = Tokenizer.from_file(PATH)
    out = {}
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            out[i, k // capacity] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


def sample():
    rng = random.Random(2)
    texts = list(ODD) + TRICKY + [sentence(rng, rng.randint(0, 300)) for _ in range(60)]
    return texts + [" ".join(rng.choice(TRICKY) for _ in range(40)) for _ in range(10)]


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(l for _, l in parts[:i]) for i in range(len(parts))]
        assert sum(l for _, l in parts) <= capacity
    return len(by)


def first_fit_decreasing(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        for i, r in enumerate(room):
            if n <= r:
                room[i] -= n
                break
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("capacity", [4096, 50])
def test_pieces_equal_brute_force(spark, capacity):
    texts = sample()
    rows = packing.pieces(frame(spark, texts), PATH, capacity).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == brute(texts, capacity)
    assert len(rows) == len(brute(texts, capacity))


def test_payload_round_trip(spark):
    texts = sample()
    tok = Tokenizer.from_file(PATH)
    by = defaultdict(dict)
    for r in packing.pieces(frame(spark, texts), PATH, 64, payload=True).collect():
        by[r.doc_id][r.piece] = np.frombuffer(r.ids, "<u4").tolist()
    for i, t in enumerate(texts):
        ids = [x for _, p in sorted(by[i].items()) for x in p]
        assert ids == tok.encode(t or "", add_special_tokens=False).ids + [1]


def test_packing_is_valid_and_close_to_the_bound(spark):
    texts = sample()
    rows = packing.pack(packing.pieces(frame(spark, texts), PATH, 512), 512).collect()
    assert {(r.doc_id, r.piece) for r in rows} == set(brute(texts, 512))
    used = check(rows, 512)
    assert used <= first_fit_decreasing([r.length for r in rows], 512)


def test_fullest_equals_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 40)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * j for s in sums for j in range(n + 1) if s + k * j <= room}
        got = packing.fullest(room, counts)
        assert sum(k * m for k, m in got.items()) == max(sums)
        assert all(0 < m <= counts[k] for k, m in got.items())


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    counts = {rng.randint(1, 100): rng.randint(1, 60) for _ in range(60)}
    rows = packing.plan(counts, 100)
    uses = defaultdict(list)
    n = max(r[3] for r in rows)  # the last use's first sequence
    for k, base, m, seq, off in rows:
        uses[k].append(base)
    assert set(uses) == set(counts) and all(0 in v for v in uses.values())
    assert n + 1 <= first_fit_decreasing([k for k, c in counts.items() for _ in range(c)], 100) + 2


def test_hot_length_is_split(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN_ROWS", 5)
    rows = packing.pack(packing.pieces(frame(spark, ["same words"] * 300 + ["a b c"] * 40), PATH, 16), 16).collect()
    assert len(rows) == 340
    check(rows, 16)


def test_edges(spark):
    df = frame(spark, [None, "", "x"], ids=[None, 1, 1]).selectExpr("*", "1 as piece", "2 as length")
    rows = packing.pack(packing.pieces(df, PATH)).collect()
    assert sorted(r.length for r in rows) == [1, 1, 2] and check(rows, 4096) == 1
    assert packing.pack(packing.pieces(df.limit(0), PATH)).count() == 0


def test_a_small_cache_forgets_and_encodes_alike(monkeypatch):
    import random

    import pyarrow as pa

    from fairsketch.llm import packing
    from fairsketch.llm.queries import vocabulary

    rng = random.Random(1)
    common = ["alpha", "beta's", "42", "gamma"]
    texts = [" ".join(rng.choice(common) if rng.random() < .6 else f"w{rng.randrange(10**6)}x{rng.randrange(99)}" for _ in range(300)) for _ in range(20)]
    model = packing.tokenizer_model(vocabulary())
    encode = lambda: [ids[a:b].tolist() for _, _, ids, limits in packing.token_ids(pa.array(texts), model)
                      for a, b in zip(limits, limits[1:])]
    want = encode()
    for size in (1 << 9, 1 << 12):
        monkeypatch.setattr(packing, "CACHE_WORDS", 400)
        monkeypatch.setattr(packing, "SLICE", size)
        monkeypatch.setattr(packing, "ENCODED", 50)
        packing._vocabularies.clear()
        assert encode() == want
        kept = next(iter(packing._vocabularies.values()))
        assert kept.n == len(kept.place) < 2000
    packing._vocabularies.clear()


def test_a_vocabulary_that_cuts_otherwise_is_refused():
    import public_tokenizers
    import pytest

    from fairsketch.llm import packing

    with pytest.raises(ValueError, match="another way"):
        packing.Vocabulary(packing.tokenizer_model(str(public_tokenizers.path("byte_bpe_50k.json"))))
