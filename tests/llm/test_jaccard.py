import random
import re

import numpy as np
import pyarrow as pa
import pytest
from rows import ODD, VOCABULARY, frame, sentence

from fairsketch.llm import jaccard as J
from fairsketch.llm.components import stars
from fairsketch.llm.words import SPACED, texts as slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(texts, ids, k, percent):
    sets = [shingles(t, k) for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i in range(len(texts)):
        known = [ids[j] for j in range(len(texts)) if root(j) == root(i) and ids[j] is not None]
        out.append((ids[i], len(sets[i]), min(known) if known and sets[i] else ids[i]))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed, n=40):
    """Families of texts around the threshold: words replaced, cut or added one by one (chains arise)."""
    rng = random.Random(seed)
    out = list(ODD) + ["A b C", "a B c", "a b c d", "A  b\nc d"]
    for _ in range(n):
        w = [rng.choice(VOCABULARY) + str(rng.randint(0, 99)) for _ in range(rng.choice([3, 5, 8, 20, 60, 200]))]
        for _ in range(rng.randint(1, 6)):
            out.append(" ".join(w))
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + ["new" + str(rng.randint(0, 9))] + w[p + 1:], w[:p] + w[p + 1:] or w, w + [str(rng.randint(0, 99))], w[::1]])
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 1, 60)])
def test_components_equal_brute_force(spark, seed, k, percent):
    ts = corpus(seed)
    ids = list(range(len(ts)))
    random.Random(seed).shuffle(ids)
    assert got(J.jaccard_components(frame(spark, ts, ids), k, percent)) == brute(ts, ids, k, percent)


def test_without_first_links_the_index_finds_everything(spark, monkeypatch):
    """No cheap links at all and chunks of a few rows: every component comes from the R-trees."""
    ts = corpus(5, 25)
    monkeypatch.setattr(J, "CHUNK", 3)
    original = J._first_pairs
    monkeypatch.setattr(J, "_first_pairs", lambda nodes, percent: original(nodes, percent).limit(0))
    assert got(J.jaccard_components(frame(spark, ts))) == brute(ts, range(len(ts)), 4, 85)


def test_linking_pairs_share_a_cell():
    rng = random.Random(3)
    for percent, k in ((85, 4), (80, 5), (50, 1)):
        ts = [t or "" for t in corpus(7, 60)]
        sets, keys = [], []
        for lo, hi, t in slices(pa.array(ts), SPACED, True, slice_bytes=10**9):
            s = J.Sets(t, k)
            doc, key = J.cell_keys(s, np.arange(t.n), percent)
            for i in range(t.n):
                sets.append(set(s.of(i).tolist()))
                keys.append(set(key[doc == i].tolist()))
        for i in range(len(ts)):
            for j in range(i):
                a, b = sets[i], sets[j]
                if a and b and J.linked(len(a), len(b), len(a & b), percent):
                    assert keys[i] & keys[j]


def test_r_tree_loses_no_link():
    rng = np.random.default_rng(1)
    base = [rng.integers(0, 1 << 60, rng.integers(1, 300)).astype(np.uint64) for _ in range(40)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > p], rng.integers(0, 1 << 60, 3).astype(np.uint64)]))
            for b in base for p in (0, .05, .1, .3)]
    points = np.array([J.point(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = J.RTree(points, sizes)
    pruned = 0
    for q in range(len(sets)):
        found = set(tree.search(points[q], int(sizes[q]), 85).tolist())
        pruned += len(sets) - len(found)
        for i in range(len(sets)):
            if J.linked(int(sizes[q]), int(sizes[i]), len(np.intersect1d(sets[q], sets[i])), 85):
                assert i in found
    assert pruned > 0.9 * len(sets) ** 2 * 0.9


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    w = [f"w{i}" for i in range(150)]
    ts = []
    for i in range(400):
        v = list(w)
        v[rng.randrange(150)] = f"x{i}"
        ts.append(" ".join(v))
    ts += [" ".join(w)] * 200 + [sentence(rng, 100) for _ in range(50)]
    rows = got(J.jaccard_components(frame(spark, ts)))
    assert {c for i, _, c in rows if i < 600} == {0}
    assert all(c == i for i, _, c in rows if i >= 600)


def links(texts, k, percent):
    """How many other, different texts each text links with."""
    every = {t: shingles(t, k) for t in texts if shingles(t, k)}
    link = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
    n = {t: sum(u != t and link(every[t], every[u]) for u in every) for t in every}
    return [n.get(t, 0) for t in texts]


def n_links(df):
    return [r.n_links for r in sorted(df.collect(), key=lambda r: r.doc_id)]


def near_copies(n):
    """All link with each other; the first few stand there in capitals too, and as repeated rows."""
    out = [" ".join("x" + str(i) if p == i % 150 else f"w{p}" for p in range(150)) for i in range(n)]
    return out + [t.upper() for t in out[:5]] + out[:3]


@pytest.mark.parametrize("part", [2048, 7])
def test_links_equal_brute_force(spark, monkeypatch, part):
    """Every pair of different texts once, within a first component and across parts too."""
    monkeypatch.setattr(J, "PART", part)
    for ts, k, percent in ((corpus(11) + near_copies(60), 4, 85), (corpus(12, 25), 1, 60)):
        want = links(ts, k, percent)
        assert n_links(J.jaccard_components(frame(spark, ts), k, percent)) == want and max(want) > 2


def test_overlaps():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 200)).astype(np.uint64)) for _ in range(90)]
    sets += [np.unique(np.append(np.arange(120, dtype=np.uint64), U)) for U in rng.integers(0, 3000, 60).astype(np.uint64)]
    for left, right in ((sets, sets), (sets[:20], sets[20:]), (sets[:1], sets[1:3])):
        assert J.overlaps(left, right).tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_edges(spark):
    df = frame(spark, ["a b c d e", "a b c d e", None, "", "q r"], ids=[None, 4, 4, None, None]).selectExpr("*", "1 as block", "1 as n")
    assert got(J.jaccard_components(df)) == sorted([(None, 2, 4), (4, 2, 4), (4, 0, 4), (None, 0, None), (None, 1, None)], key=str)
    assert J.jaccard_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_stars_connect_what_the_links_connect(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-40, 40, (2, int(rng.integers(0, 60))))
    below = {int(x): int(x) for x in np.concatenate([a, b])}
    for _ in below:  # the smallest node within reach, by plain repetition
        for x, y in zip(a.tolist(), b.tolist()):
            below[x] = below[y] = min(below[x], below[y])
    root, node = stars(a, b)
    assert dict(zip(node.tolist(), root.tolist())) == {x: m for x, m in below.items() if x != m}


def test_stars_of_parts_of_a_dense_group_are_few():
    rng = np.random.default_rng(3)
    a, b = np.triu_indices(400, 1)
    some = rng.random(len(a)) < .3
    a, b = a[some], b[some]
    part = rng.integers(0, 40, 400)[b]  # a task holds the links of some of the nodes
    rows = {x for p in range(40) for x in zip(*(y.tolist() for y in stars(a[part == p], b[part == p])))}
    assert len(a) > 20_000 and len(rows) < 10 * 400


def test_points_travel_in_half_a_byte_a_count():
    rng = np.random.default_rng(6)
    points = [rng.integers(0, most, J.GROUPS) for most in (1, 3, 16, 17, 256, 257, 70_000)]
    for p, most in zip(points, (0, 2, 15, 16, 255, 256, 69_999)):
        p[rng.integers(0, J.GROUPS)] = most
    raw = [J.packed(p) for p in points]
    assert [len(x) * 2 // J.GROUPS for x in raw] == [1, 1, 1, 2, 2, 8, 8]
    assert (J.unpacked(raw) == np.array(points)).all()


@pytest.mark.parametrize("chunk", [4096, 40, 7])
def test_cells_of_many_nodes_without_first_links(spark, monkeypatch, chunk):
    """Whole cells with a tree, and large ones in chunks: every component comes from the index."""
    ts = near_copies(90) + corpus(13, 10) + [" ".join(f"v{p}" for p in range(150)) + f" x{i}" for i in range(50)]
    monkeypatch.setattr(J, "CHUNK", chunk)
    original = J._first_pairs
    monkeypatch.setattr(J, "_first_pairs", lambda nodes, percent: original(nodes, percent).limit(0))
    assert got(J.jaccard_components(frame(spark, ts), 5, 80)) == brute(ts, range(len(ts)), 5, 80)


def test_an_action_passes_over_the_blocks_twice_at_most(spark, monkeypatch):
    """Directory, cells and verification are an action each: no shuffle files of one stand beside another's."""
    passes, run = [], type(spark.range(1)).checkpoint

    def checkpoint(df, *args, **more):
        passes.append(df._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInArrow"))
        return run(df, *args, **more)

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", checkpoint)
    J.jaccard_components(frame(spark, near_copies(20)), 5, 80, keyed=True)
    assert max(passes) == 2 and sum(passes[-1:]) <= 1


def test_families_in_parts_without_first_links(spark, monkeypatch):
    """Sets of a family meet within its parts, then across them where several components are left."""
    ts = near_copies(40) + corpus(14, 25)
    monkeypatch.setattr(J, "PART", 4)
    monkeypatch.setattr(J, "LEFT", 3)
    original = J._first_pairs
    monkeypatch.setattr(J, "_first_pairs", lambda nodes, percent: original(nodes, percent).limit(0))
    assert got(J.jaccard_components(frame(spark, ts), 4, 60)) == brute(ts, range(len(ts)), 4, 60)
