"""Operator 10, n-gram Jaccard join over count vectors: documents whose shingle sets link, by component.

A document's set are its distinct ``words``-word shingles.  Two sets link when
``100 * |A & B| >= percent * |A | B|``.  Tokens (shingles) are hashed into groups; a document's point
is its count in each group.  Overlap is at most the sum of the smaller counts, coordinate by
coordinate, so points bound it without the sets.

1. Equal sets are one node (grouped by a 128-bit digest and the set's size).
2. Cheap links.  Nodes that share one of a few double minhash keys are checked against the smallest
   node of that key: at most that many pairs a node, however large the group.  Verified pairs give
   first components; a large group of near copies becomes one component here.
3. The index.  Sizes fall into bands one ratio wide; a pair lies in one band or two neighbouring ones.
   For a band with largest possible set difference r, all groups are dealt into r + 1 (and a few
   more) cells.  A linking pair differs in at most r cells, so it agrees in the counts of a whole
   cell: cells are the directory under which points are stored, equal cell counts by equal keys.
   A cell whose members all belong to one component is settled; Spark finds the others.
4. The points of each unsettled cell form a packed R-tree (ordered by size, leaves of neighbouring
   points with their coordinate maxima and size range).  A query descends where the summed minima
   with the maxima reach the needed overlap, then compares points.  Pairs of one component are not
   queried.  Large cells are cut into chunks; queries meet each chunk.  Steps 3, 4 and 5 are an action
   each, so the shuffle files of one are gone when the next one writes its own.
5. Surviving pairs connect families of sets.  A family's sets meet part by part and are verified there,
   then across its parts if it is still of several components; components follow from all verified links.
6. Linked texts are of one component, so links are counted there: each component's sets meet in one
   group, or in one for each pair of its parts if it is large, and every pair of sets is compared once.
   Counts leave the group, pairs do not.

No link is lost: step 3 covers every linking pair, step 4 leaves out only pairs of one component, and
step 6 counts those.

Defined results.  Null or empty text: no set, linked with nothing, its own component.  Rows with a
null id take their set's component (null if no row of it has an id).  Repeated ids are rows of their
own.  Extra columns are ignored; an empty table gives no rows.  Shingles are compared by 64-bit
fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm import blocks as B
from fairsketch.llm.components import components, stars
from fairsketch.llm.words import SPACED, U64, Text, mix, sequence, texts, word_sums
from fairsketch.session import checkpoint_root

WORDS = 4
PERCENT = 85
KEYS = 4
GROUPS = 256
LEAF = 32
CHUNK = 4096
PART, PART_ITEMS = 2048, 1 << 20
SLICE_BYTES = 1 << 18
SHARES, PAIRS, LEFT = 8, 1 << 12, 256

_SALT = [mix(U64(0xD1B54A32D192ED03) * np.arange(i + 1, i + 2, dtype=U64))[0] for i in range(2 * KEYS + 4)]


class Sets:
    """Distinct shingle fingerprints of a slice's texts: text i has ``items[first[i]:first[i + 1]]``, sorted."""

    def __init__(self, t: Text, words: int):
        h = t.hashes()
        at, grams = t.grams(h, words)
        short = np.flatnonzero((t.counts > 0) & (t.counts < words))
        whole = sequence(word_sums(h), t.first[short], t.first[short + 1]) if len(short) else np.zeros(0, U64)
        doc = np.concatenate([t.doc[at], short])
        items = np.concatenate([grams, whole])
        order = np.argsort(items)
        small = doc[order].astype(np.uint16 if t.n <= 1 << 16 else np.int64)
        order = order[np.argsort(small, kind="stable")]
        doc, items = doc[order], items[order]
        new = np.ones(len(doc), bool)
        new[1:] = (items[1:] != items[:-1]) | (doc[1:] != doc[:-1])
        self.items, self.doc = items[new], doc[new]
        self.first = np.searchsorted(self.doc, np.arange(t.n + 1))
        self.sizes = np.diff(self.first)

    def total(self, values: np.ndarray) -> np.ndarray:
        s = np.zeros(len(values) + 1, U64)
        np.cumsum(values, out=s[1:])
        return s[self.first[1:]] - s[self.first[:-1]]

    def node(self) -> np.ndarray:
        return mix(self.total(mix(self.items ^ _SALT[0])) + self.sizes.astype(U64))

    def second(self) -> np.ndarray:
        return self.total(mix(self.items ^ _SALT[1]))

    def minhash_keys(self) -> list[np.ndarray]:
        out = []
        some = np.flatnonzero(self.sizes)
        for k in range(KEYS):
            key = np.zeros(len(self.sizes), U64)
            if len(some):
                a, b = (np.minimum.reduceat(mix(self.items ^ _SALT[2 + 2 * k + j]), self.first[some]) for j in (0, 1))
                key[some] = mix(a * U64(3) + b + U64(k))
            out.append(key)
        return out

    def of(self, i: int) -> np.ndarray:
        return self.items[self.first[i]:self.first[i + 1]]


def point(items: np.ndarray) -> np.ndarray:
    """A set's count in each of the fixed groups."""
    return np.bincount((mix(items ^ _SALT[2]) >> U64(56)).astype(np.int64), minlength=GROUPS)


def packed(counts: np.ndarray) -> bytes:
    """A point in half a byte a count, or in one or four if a count needs them."""
    most = counts.max(initial=0)
    if most < 16:
        half = counts.astype(np.uint8)
        return (half[::2] | half[1::2] << 4).tobytes()
    return counts.astype(np.uint8 if most < 256 else np.int32).tobytes()


def unpacked(raw: list[bytes]) -> np.ndarray:
    out = np.empty((len(raw), GROUPS), np.int32)
    at = [i for i, x in enumerate(raw) if len(x) == GROUPS // 2]
    if at:
        half = np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(-1, GROUPS // 2)
        out[at] = np.stack([half & 15, half >> 4], 2).reshape(-1, GROUPS)
    for width, kind in ((GROUPS, np.uint8), (4 * GROUPS, np.int32)):
        at = [i for i, x in enumerate(raw) if len(x) == width]
        if at:
            out[at] = np.frombuffer(b"".join(raw[i] for i in at), kind).reshape(-1, GROUPS)
    return out


def bands(percent: int, largest: int) -> np.ndarray:
    """Lower size limits of the bands, up to one beyond ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out + [out[-1] * 100 // percent + 1], np.int64)


def difference(smaller: np.ndarray, percent: int) -> np.ndarray:
    """The largest set difference of a linking pair whose smaller set has that size."""
    return smaller * (100 - percent) // percent


def cell_keys(s: Sets, docs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, key) of the directory cells that each of the given texts is stored in and looked up by.

    A band's instance holds pairs whose smaller set is in it, so a text is in its own band's
    instance and in the next lower one's.  Empty cells are left out, unless so many are empty
    that the others alone may not outnumber the differences.
    """
    chosen = np.zeros(len(s.sizes), bool)
    chosen[docs] = True
    use = np.flatnonzero(chosen[s.doc])
    if not len(use):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    doc, items = s.doc[use], s.items[use]
    limits = bands(percent, int(s.sizes.max()))
    band = np.searchsorted(limits, s.sizes, "right") - 1
    place, group = mix(items ^ _SALT[0]), mix(items ^ _SALT[1])
    out_doc, out_key = [], []
    for down in (0, 1):
        b = band - down
        differs = difference(limits[np.maximum(b, 0) + 1] - 1, percent)
        cells = differs + 3 + differs // 32
        mine = b[doc] >= 0
        d, m = doc[mine], cells[doc[mine]].astype(U64)
        # the upper half of the hash, scaled to 0..m-1
        cell = (((place[mine] >> U64(32)) * m) >> U64(32)).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(np.where(chosen & (b >= 0), cells, 0))])
        slot = first[d] + cell
        sums = np.zeros(first[-1], U64)
        np.add.at(sums, slot, group[mine])
        filled = np.zeros(first[-1], bool)
        filled[slot] = True
        owner = np.repeat(np.arange(len(s.sizes)), np.diff(first))
        n_filled = np.bincount(owner[filled], minlength=len(s.sizes))
        emit = np.flatnonzero(filled | (n_filled <= differs)[owner])
        own = owner[emit]
        out_doc.append(own)
        where = ((b[own] + 1).astype(U64) << U64(32)) + (emit - first[own]).astype(U64)
        out_key.append(mix(sums[emit] + mix(where ^ _SALT[3])))
    return np.concatenate(out_doc), np.concatenate(out_key)


def linked(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def needed(total: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a linking pair whose sizes add up to ``total``."""
    return -(-percent * total // (100 + percent))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left set with each right one."""
    out = np.zeros((len(left), len(right)), np.int64)
    own_a, own_b = (np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (left, right))
    codes, a = np.unique(np.concatenate(left), return_inverse=True)
    b = np.concatenate(right)
    place = np.minimum(np.searchsorted(codes, b), len(codes) - 1)
    hit = codes[place] == b
    b, own_b = place[hit], own_b[hit]
    held = np.bincount(b, minlength=len(codes))
    order = np.argsort(b, kind="stable")
    first = np.concatenate([[0], np.cumsum(held)])
    # items of many sets: a product of 0-1 matrices, some columns at a time
    many = held * 16 > len(right)
    column = np.cumsum(many) - 1
    x, y = many[a], many[b]
    ca, ra, cb, rb = column[a[x]], own_a[x], column[b[y]], own_b[y]
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ca, ra, cb, rb = ca[oa], ra[oa], cb[ob], rb[ob]
    for lo in range(0, int(many.sum()), 1024):
        m = np.zeros((len(left), 1024), np.float32), np.zeros((len(right), 1024), np.float32)
        for at, c, r in zip(m, (ca, cb), (ra, rb)):
            i, j = np.searchsorted(c, [lo, lo + 1024])
            at[r[i:j], c[i:j] - lo] = 1
        out += (m[0] @ m[1].T).astype(np.int64)
    # items of few: the sets that hold them, one left set after another
    few = ~many[a] & (held[a] > 0)
    a, own_a = a[few], own_a[few]
    o = np.argsort(own_a, kind="stable")
    a = a[o]
    ends = np.searchsorted(own_a[o], np.arange(len(left) + 1)).tolist()
    for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
        if hi > lo:
            n = held[a[lo:hi]]
            at = np.repeat(first[a[lo:hi]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            out[i] += np.bincount(own_b[order[at]], minlength=len(right))
    return out


class RTree:
    """A packed R-tree of count points: points in size order, leaves of ``LEAF`` with maxima and size range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # within a size order, neighbours in the heaviest group's count come together
        self.order = np.lexsort((points.argmax(1), sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        self.top = np.maximum.reduceat(self.points, starts, axis=0)
        self.low, self.high = self.sizes[starts], self.sizes[np.minimum(starts + LEAF, len(sizes)) - 1]

    def search(self, q: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Places of the points whose bound on the overlap with ``q`` allows a link."""
        near = np.flatnonzero((100 * self.high >= percent * size) & (percent * self.low <= 100 * size))
        near = near[np.minimum(self.top[near], q).sum(1) >= needed(self.low[near] + size, percent)]
        at = (near[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < len(self.sizes)]
        n = self.sizes[at]
        ok = (100 * np.minimum(n, size) >= percent * np.maximum(n, size)) & \
            (np.minimum(self.points[at], q).sum(1) >= needed(n + size, percent))
        return self.order[at[ok]]


def _wanted(rows: pa.Table, ids: pa.ChunkedArray) -> pa.Table:
    return rows.filter(pc.is_in(rows.column("doc_id"), value_set=ids.combine_chunks()))


def _sets(rows: pa.Table, words: int):
    for lo, hi, t in texts(rows.column("text"), SPACED, lower=True, slice_bytes=SLICE_BYTES):
        yield lo, hi, Sets(t, words)


def _long(x: np.ndarray) -> np.ndarray:
    return x.astype(U64).view(np.int64)


def _sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, block, same, n, node, second, k0.. for every row; ``same`` is equal for equal texts."""
    names = ["doc_id", "block", "same", "n", "node", "second", *(f"k{i}" for i in range(KEYS))]

    def run(batches):
        for b in batches:
            for lo, hi, s in _sets(pa.Table.from_batches([b]), words):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], b.column(2)[lo:hi], b.column(3)[lo:hi], pa.array(s.sizes, pa.int64()),
                     *(pa.array(_long(x)) for x in (s.node(), s.second(), *s.minhash_keys()))], names=names)

    return docs.mapInArrow(run, "doc_id long, block int, same long, n long, node long, second long, " + ", ".join(f"k{i} long" for i in range(KEYS)))


_ASKED = pa.schema([("block", pa.int32()), ("a", pa.int64()), ("a_id", pa.int64()), ("to", pa.list_(pa.int32())),
                    ("b", pa.int64()), ("b_id", pa.int64()), ("partners", pa.list_(pa.int64()))])
_SET = _ASKED.append(pa.field("items", pa.binary()))
ASKED = "block int, a long, a_id long, to array<int>, b long, b_id long, partners array<long>"


def _verified(rows: DataFrame, asked: DataFrame, words: int, percent: int) -> DataFrame:
    """The asked pairs that link, as stars (a, b) around the smallest node of what a block's pairs connect.

    A group of near copies has links in the square of its size; its stars are as many as the nodes a block
    meets, and equal ones of different blocks become one, so the components read rows in its size.

    Pairs come as lists, not as rows: a row of ``a`` (in its block) with the blocks ``to`` that hold
    partners, and a row of ``b`` (in its block) with its ``partners``.  The set of ``a`` travels once to
    each such block, not once a partner.
    """

    def carry(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        wanted: dict[int, set] = {}
        for a, to in zip(side.column("a").to_pylist(), side.column("to").to_pylist()):
            if a is not None:
                wanted.setdefault(a, set()).update(to)
        out: dict[str, list] = {f.name: [] for f in _SET}
        for _, _, s in _sets(_wanted(block_rows, side.filter(pc.is_valid(side.column("a"))).column("a_id")), words):
            for i, node in enumerate(_long(s.node()).tolist()):
                for to in sorted(wanted.pop(node, ())):
                    for name, x in zip(_SET.names, (to, node, None, None, None, None, None, s.of(i).tobytes())):
                        out[name].append(x)
        return B.table(out, _SET)

    def compare(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        sets, wanted = {}, {}
        for a, b, partners, items in zip(*(side.column(c).to_pylist() for c in ("a", "b", "partners")), side.column("items")):
            if items.is_valid:
                other = np.frombuffer(items.as_buffer(), U64)
                sets[a] = (other, point(other).astype(np.int32))
            elif b is not None:
                wanted.setdefault(b, set()).update(partners)
        left, right = [], []
        for _, _, s in _sets(_wanted(block_rows, side.filter(pc.is_valid(side.column("b"))).column("b_id")), words):
            for i, node in enumerate(_long(s.node()).tolist()):
                if node in wanted:
                    mine = s.of(i)
                    counts = point(mine)
                    for a in sorted(wanted.pop(node)):
                        other, theirs = sets[a]
                        if np.minimum(counts, theirs).sum() < needed(np.int64(len(mine) + len(other)), percent):
                            continue
                        small, large = (mine, other) if len(mine) < len(other) else (other, mine)
                        both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                        if linked(len(mine), len(other), both, percent):
                            left.append(a)
                            right.append(node)
        root, node = stars(np.array(left, np.int64), np.array(right, np.int64))
        return pa.table({"a": pa.array(root, pa.int64()), "b": pa.array(node, pa.int64())})

    asked = asked.repartition(B.partitions(rows.sparkSession), "block")  # one exchange for both passes
    sent = B.on_blocks(rows, asked, carry, ASKED + ", items binary")
    return B.on_blocks(rows, sent.unionByName(asked.withColumn("items", F.lit(None).cast("binary"))), compare, "a long, b long").distinct()


def _first_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Each node with the smallest node of each of its minhash keys, as asked for."""
    keyed = nodes.select("node", "n", "doc_id", "block", F.explode(F.array(*(f"k{i}" for i in range(KEYS)))).alias("key"))
    pivot = keyed.groupBy("key").agg(F.min(F.struct("node", "n", "doc_id", "block")).alias("p"), F.count("*").alias("c")) \
        .where("c > 1").select("key", "p")
    pairs = keyed.join(pivot, "key").where(f"node <> p.node and 100 * least(n, p.n) >= {percent} * greatest(n, p.n)").select(
        F.col("p.node").alias("a"), F.col("p.doc_id").alias("a_id"), F.col("p.block").alias("a_block"),
        F.col("node").alias("b"), F.col("doc_id").alias("b_id"), F.col("block").alias("b_block"))
    # at most all block numbers, and at most KEYS partners, in a list
    asks = pairs.groupBy(F.col("a_block").alias("block"), "a", "a_id").agg(F.collect_set("b_block").alias("to"))
    wants = pairs.groupBy(F.col("b_block").alias("block"), "b", "b_id").agg(F.collect_set("a").alias("partners"))
    return asks.unionByName(wants, allowMissingColumns=True).select("block", "a", "a_id", "to", "b", "b_id", "partners")


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("held", pa.binary())])
_SIDE = "block int, doc_id long, node long, component long, bucket int, bits binary, large binary"
_SIDE_ARROW = pa.schema([("block", pa.int32()), ("doc_id", pa.int64()), ("node", pa.int64()), ("component", pa.int64()),
                         ("bucket", pa.int32()), ("bits", pa.binary()), ("large", pa.binary())])
_MEMBER = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("component", pa.int64()), ("n", pa.int64()),
                     ("doc_id", pa.int64()), ("block", pa.int32()), ("point", pa.binary()), ("open", pa.bool_()),
                     ("n_stored", pa.int32()), ("n_open", pa.int32())])


def _cells(block_rows: pa.Table, side: pa.Table, words: int, percent: int, points: bool = False):
    """(keys, places, members): the block's cell keys, each with the place of its member."""
    wanted = {}
    for node, doc_id, component in zip(*(side.column(c).to_pylist() for c in ("node", "doc_id", "component"))):
        if node is not None:
            wanted[node] = (component, doc_id)
    keys, places, members = [np.zeros(0, U64)], [np.zeros(0, np.int64)], []
    for _, _, s in _sets(block_rows, words):
        at = np.full(len(s.sizes), -1)
        for i, node in enumerate(_long(s.node()).tolist()):
            if node in wanted:  # once, whatever copies the block holds
                at[i] = len(members)
                component, doc_id = wanted.pop(node)
                members.append((node, component, int(s.sizes[i]), doc_id, s.of(i) if points else None))
        doc, key = cell_keys(s, np.flatnonzero(at >= 0), percent)
        keys.append(key)
        places.append(at[doc])
    return np.concatenate(keys), np.concatenate(places), members


def _distinct_owned(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, owner) in key order, and where each input went."""
    order = np.lexsort((owners, keys))
    k, o = keys[order], owners[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    went = np.empty(len(k), np.int64)
    went[order] = np.cumsum(new) - 1
    return k[new], o[new], went


def _residual_pairs(rows: DataFrame, labels: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of different components whose points, in a common cell, allow a link, as stars that connect what they connect."""
    buckets, chunk = B.partitions(rows.sparkSession), CHUNK

    def send(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        keys, places, members = _cells(block_rows, side, words, percent)
        owner = np.array([m[1] for m in members], np.int64)
        k, o, went = _distinct_owned(keys, owner[places] if len(members) else places)
        held = np.bincount(went, minlength=len(k)).astype(np.int32)
        block = block_rows.column("block")[0].as_py()
        cut = B.parts(k, buckets)
        return B.table({"bucket": [b for b, _, _ in cut], "block": [block] * len(cut),
                        "keys": [k[x:y].tobytes() for _, x, y in cut], "owners": [B.coded(o[x:y]) for _, x, y in cut],
                        # how many nodes each key has here; nothing if one each
                        "held": [held[x:y].tobytes() if held[x:y].max() > 1 else b"" for _, x, y in cut]}, _SENT)

    def judge(sent: pa.Table) -> pa.Table:
        """Which keys are of several components; with a large cell's main component and its numbers of chunks."""
        bucket = sent.column("bucket")[0].as_py()
        keys = [np.frombuffer(x.as_buffer(), U64) for x in sent.column("keys")]
        owners = [x.as_buffer() for x in sent.column("owners")]
        held = sent.column("held").to_pylist()
        flags = [np.zeros(len(k), bool) for k in keys]
        large: list[list] = [[] for _ in keys]
        ends = [B.shares(k, bucket, buckets, SHARES) for k in keys]
        for share in range(SHARES):  # some keys at a time
            some = [(i, *e[share:share + 2]) for i, e in enumerate(ends) if e[share] < e[share + 1]]
            if not some:
                continue
            k = np.concatenate([keys[i][x:y] for i, x, y in some])
            order = np.argsort(k, kind="stable")
            k = k[order]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            cut = np.flatnonzero(new)
            long = np.diff(np.append(cut, len(k)))
            o = np.concatenate([B.decoded(owners[i], x, y) for i, x, y in some])[order]
            n = np.concatenate([np.frombuffer(held[i], np.int32)[x:y] if held[i] else np.ones(y - x, np.int32) for i, x, y in some])[order]
            mixed = np.minimum.reduceat(o, cut) != np.maximum.reduceat(o, cut)
            many = np.flatnonzero(mixed & (np.add.reduceat(n, cut, dtype=np.int64) > chunk))
            split = []
            for lo, size in zip(cut[many].tolist(), long[many].tolist()):
                of, place = np.unique(o[lo:lo + size], return_inverse=True)
                c = np.bincount(place, n[lo:lo + size]).astype(np.int64)
                split.append((of[c.argmax()], -(-c.max() // chunk), -(-(c.sum() - c.max()) // chunk)))
            cell = np.where(mixed, -1, -2).astype(np.int32)  # -2: of one component
            cell[many] = np.arange(len(many))
            at = np.empty(len(k), np.int32)
            at[order] = np.repeat(cell, long)
            for (i, x, y), got in zip(some, np.split(at, np.cumsum([y - x for _, x, y in some])[:-1])):
                flags[i][x:y] = got >= -1
                whose = np.flatnonzero(got >= 0)
                if len(whose):
                    large[i].append(np.column_stack([x + whose, np.array(split, np.int64)[got[whose]]]))
        out = {name: [] for name in _SIDE_ARROW.names}
        for block, flag, cells in zip(sent.column("block").to_pylist(), flags, large):
            if flag.any():
                for name, v in zip(out, (block, None, None, None, bucket, B.bits(flag), b"".join(x.tobytes() for x in cells))):
                    out[name].append(v)
        return B.table(out, _SIDE_ARROW)

    def open_members(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        """A row for each unsettled cell a node is in; ``open`` and the numbers of chunks are null but in large cells."""
        answers, large = {}, {}
        for b, x, y in zip(*(side.column(c).to_pylist() for c in ("bucket", "bits", "large"))):
            if b is not None:
                answers[b], large[b] = x, np.frombuffer(y, np.int64).reshape(-1, 4)
        if not answers:
            return _MEMBER.empty_table()
        keys, places, members = _cells(block_rows, side, words, percent, True)
        component = np.array([m[1] for m in members], np.int64)
        k, _, went = _distinct_owned(keys, component[places] if len(members) else places)
        split = np.full((len(k), 3), -1)
        for b, x, _ in B.parts(k, buckets):
            if b in large:
                split[x + large[b][:, 0]] = large[b][:, 1:]
        hit = np.flatnonzero(B.answered(k, buckets, answers)[went])
        main, n_stored, n_open = split[went[hit]].T
        own, place = np.unique(places[hit], return_inverse=True)
        mine = [members[p] for p in own.tolist()]
        whole = n_open < 0
        of = lambda values, kind: pa.array(values, kind).take(pa.array(place))
        return pa.table([
            pa.array(_long(keys[hit])), of([m[0] for m in mine], pa.int64()), of([m[1] for m in mine], pa.int64()),
            of([m[2] for m in mine], pa.int64()), of([m[3] for m in mine], pa.int64()),
            pa.array(np.full(len(hit), block_rows.column("block")[0].as_py(), np.int32)),
            of([packed(point(m[4])) for m in mine], pa.binary()),
            pa.array(component[places[hit]] != main, pa.bool_(), mask=whole),
            pa.array(n_stored.astype(np.int32), mask=whole), pa.array(n_open.astype(np.int32), mask=whole)], schema=_MEMBER)

    def search(cells: pa.Table) -> pa.Table:
        col = {c: cells.column(c).to_numpy() for c in ("key", "x", "y", "node", "component", "n", "side")}
        # one point a node, which stands in many cells; its first row speaks for it
        nodes, speaks, place = np.unique(col["node"], return_index=True, return_inverse=True)
        points = unpacked(cells.column("point").take(pa.array(speaks)).to_pylist())
        order = np.lexsort((col["y"], col["x"], col["key"]))
        new = np.ones(len(order), bool)
        new[1:] = np.any([col[c][order[1:]] != col[c][order[:-1]] for c in ("key", "x", "y")], axis=0)
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(order)))
        # cells of up to a leaf: all their pairs at once
        small = sizes <= LEAF
        s, base = sizes[small], first[small]
        total = np.concatenate([[0], np.cumsum(s * s)])
        cell = np.repeat(np.arange(len(s)), s * s)
        local = np.arange(total[-1]) - total[cell]
        i, j = local // s[cell], local % s[cell]
        a, b = order[base[cell[i < j]] + i[i < j]], order[base[cell[i < j]] + j[i < j]]
        side = col["side"]
        use = (col["component"][a] != col["component"][b]) & (((side[a] != 0) & (side[b] != 1)) | ((side[b] != 0) & (side[a] != 1)))
        a, b = a[use], b[use]
        once = np.unique(np.minimum(place[a], place[b]) * len(nodes) + np.maximum(place[a], place[b]), return_index=True)[1]
        a, b = a[once], b[once]
        na, nb = col["n"][a], col["n"][b]
        near = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
        a, b = a[near], b[near]
        left, right = [], []
        for lo in range(0, len(a), PAIRS):
            x, y = a[lo:lo + PAIRS], b[lo:lo + PAIRS]
            ok = np.minimum(points[place[x]], points[place[y]]).sum(1) >= needed(col["n"][x] + col["n"][y], percent)
            left.append(x[ok])
            right.append(y[ok])
        # larger ones: a tree each
        for lo, size in zip(first[~small].tolist(), sizes[~small].tolist()):
            rows = order[lo:lo + size]
            stored, queries = rows[side[rows] != 1], rows[side[rows] != 0]
            if len(stored) == len(queries) == size:  # the largest component is only searched
                of_row, n_rows = np.unique(col["component"][rows], return_counts=True)
                queries = rows[col["component"][rows] != of_row[n_rows.argmax()]]
            if len(stored) and len(queries):
                tree = RTree(points[place[stored]], col["n"][stored])
                for q in queries.tolist():
                    found = stored[tree.search(points[place[q]], int(col["n"][q]), percent)]
                    found = found[col["component"][found] != col["component"][q]]
                    left.append(np.full(len(found), q))
                    right.append(found)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        root, node = stars(col["node"][a], col["node"][b])
        return pa.table({"a": pa.array(root, pa.int64()), "b": pa.array(node, pa.int64())})

    none = {"bucket": F.lit(None).cast("int"), "bits": F.lit(None).cast("binary"), "large": F.lit(None).cast("binary")}
    side = labels.select("block", "doc_id", "node", "component").withColumns(none)
    mixed = B.on_blocks(rows, side, send, "bucket int, block int, keys binary, owners binary, held binary") \
        .groupBy("bucket").applyInArrow(judge, _SIDE).checkpoint()
    members = B.on_blocks(rows, side.unionByName(mixed), open_members,
                          "key long, node long, component long, n long, doc_id long, block int, point binary, "
                          "open boolean, n_stored int, n_open int") \
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(F.col("open"), F.col("n_open")).otherwise(F.col("n_stored"))).cast("int"))
    # a large cell's main component is only searched; the others search it and each other
    # cells (x, y): stored chunk x with open chunk y, and, with x below 0, open chunk -1 - x with open chunk y
    cells = F.expr("""if(n_open is null, array(struct(0 as x, 0 as y, 2 as side)), if(open,
        concat(transform(sequence(0, n_stored - 1), x -> struct(x as x, chunk as y, 1 as side)),
               transform(sequence(0, n_open - 1), o -> struct(-1 - least(o, chunk) as x, greatest(o, chunk) as y,
                         if(o = chunk, 2, if(o > chunk, 0, 1)) as side))),
        transform(sequence(0, n_open - 1), y -> struct(chunk as x, y as y, 0 as side))))""")
    placed = members.withColumn("cell", F.explode(cells)).select(
        "key", "cell.x", "cell.y", "cell.side", "node", "component", "n", "point")
    # many cells a task; a cell's chunks are bounded, so a bucket is a few of them
    return placed.withColumn("bucket", F.pmod(F.xxhash64("key", "x", "y"), F.lit(buckets * B.BLOCKS_A_PARTITION))).groupBy("bucket").applyInArrow(
        search, "a long, b long").distinct().checkpoint()


_MET = pa.schema([("family", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("part", pa.int32()),
                  ("node", pa.int64()), ("component", pa.int64()), ("items", pa.binary())])


def _met(rows: DataFrame, side: DataFrame, words: int, percent: int, across: bool) -> DataFrame:
    """Links, as stars, within each part of a family of sets; ``across``, between its parts.

    ``side`` has block, doc_id, node, component, family, part and parts.  A set travels once for each other
    part (once, if not ``across``), however many sets it may link with.
    """
    buckets = B.partitions(rows.sparkSession)

    def carry(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        wanted = {node: x for node, *x in zip(*(side.column(c).to_pylist() for c in ("node", "component", "family", "part", "parts")))}
        out: dict[str, list] = {f.name: [] for f in _MET}
        for _, _, s in _sets(_wanted(block_rows, side.column("doc_id")), words):
            for i, node in enumerate(_long(s.node()).tolist()):
                if node in wanted:  # once, whatever copies the block holds
                    component, family, part, parts = wanted.pop(node)
                    for other in range(parts) if across else (part,):
                        if other != part or not across:
                            for name, x in zip(out, (family, min(part, other), max(part, other), part, node, component, s.of(i).tobytes())):
                                out[name].append(x)
        return B.table(out, _MET)

    def compare(held: pa.Table) -> pa.Table:
        col = {c: held.column(c).to_numpy() for c in ("family", "x", "y", "part", "node", "component")}
        items = held.column("items").combine_chunks()
        order = np.lexsort((col["node"], col["part"], col["y"], col["x"], col["family"]))
        new = np.ones(len(order), bool)
        new[1:] = np.any([col[c][order[1:]] != col[c][order[:-1]] for c in ("family", "x", "y")], axis=0)
        cut = np.append(np.flatnonzero(new), len(order)).tolist()
        found = [(np.zeros(0, np.int64),) * 2]
        for lo, hi in zip(cut, cut[1:]):
            at = order[lo:hi]
            part, component = col["part"][at], col["component"][at]
            a, b = (at[part == part[0]], at[part != part[0]]) if across else (at, at)
            if not len(b) or (component == component[0]).all():
                continue
            right = [np.frombuffer(items[int(i)].as_buffer(), U64) for i in b]
            n = np.array([len(x) for x in right])
            for some in np.split(a, range(LEFT, len(a), LEFT)):
                left = [np.frombuffer(items[int(i)].as_buffer(), U64) for i in some]
                both = overlaps(left, right)
                i, j = np.nonzero(100 * both >= percent * (np.array([len(x) for x in left])[:, None] + n - both))
                x, y = some[i], b[j]
                use = col["component"][x] != col["component"][y]
                found.append(stars(col["node"][x[use]], col["node"][y[use]]))
        root, node = stars(*(np.concatenate(x) for x in zip(*found)))
        return pa.table({"a": pa.array(root, pa.int64()), "b": pa.array(node, pa.int64())})

    met = B.on_blocks(rows, side, carry, "family long, x int, y int, part int, node long, component long, items binary")
    return met.withColumn("bucket", F.pmod(F.xxhash64("family", "x", "y"), F.lit(buckets * B.BLOCKS_A_PARTITION))) \
        .groupBy("bucket").applyInArrow(compare, "a long, b long").distinct()


def _linked_families(rows: DataFrame, labels: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links, as stars, between the sets that ``pairs`` connect (a family): every pair of different components is checked.

    First within parts of a family.  Only what is then still of several components meets across parts.
    """
    family = components(pairs, "a", "b").withColumnRenamed("component", "family")
    family = family.union(family.select(F.col("family").alias("node"), "family").distinct())
    side = labels.join(family, "node")
    size = side.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("n") / PART_ITEMS)).cast("int").alias("parts"))
    side = side.join(size, "family").select("block", "doc_id", "node", "component", "family", F.expr(
        "cast(pmod(xxhash64(node), parts) as int)").alias("part"), "parts").checkpoint()
    within = _met(rows, side, words, percent, False).checkpoint()
    known = side.where("component <> node").select(F.col("node").alias("a"), F.col("component").alias("b"))
    joined = components(known.union(within), "a", "b").withColumnRenamed("component", "now")
    wide = side.where("parts > 1").join(joined, "node", "left").withColumn("component", F.coalesce("now", "node")).drop("now")
    several = wide.groupBy("family").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("family")
    wide = wide.join(several, "family").select(*side.columns).checkpoint()
    if wide.isEmpty():
        return within
    return within.union(_met(rows, wide, words, percent, True)).checkpoint()


_HELD = pa.schema([("component", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("part", pa.int32()),
                   ("node", pa.int64()), ("texts", pa.int64()), ("items", pa.binary())])


def _link_counts(rows: DataFrame, labels: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, n): how many texts of other nodes a node's texts link with; nodes without one are left out.

    ``labels`` has node, n, doc_id, block, texts (how many different ones) and the final component.
    """
    buckets = B.partitions(rows.sparkSession)

    def carry(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        wanted = {node: x for node, *x in zip(*(side.column(c).to_pylist() for c in ("node", "component", "texts", "part", "parts")))}
        out: dict[str, list] = {f.name: [] for f in _HELD}
        for _, _, s in _sets(_wanted(block_rows, side.column("doc_id")), words):
            for i, node in enumerate(_long(s.node()).tolist()):
                if node in wanted:  # once, whatever copies the block holds
                    component, texts, part, parts = wanted.pop(node)
                    for other in range(parts):
                        for name, x in zip(out, (component, min(part, other), max(part, other), part, node, texts, s.of(i).tobytes())):
                            out[name].append(x)
        return B.table(out, _HELD)

    def count(held: pa.Table) -> pa.Table:
        col = {c: held.column(c).to_numpy() for c in ("component", "x", "y", "part", "node", "texts")}
        items = held.column("items").to_pylist()
        order = np.lexsort((col["node"], col["part"], col["y"], col["x"], col["component"]))
        new = np.ones(len(order), bool)
        new[1:] = np.any([col[c][order[1:]] != col[c][order[:-1]] for c in ("component", "x", "y")], axis=0)
        cut = np.append(np.flatnonzero(new), len(order)).tolist()
        nodes, links = [], []
        for lo, hi in zip(cut, cut[1:]):
            at = order[lo:hi]
            part = col["part"][at]
            whole = col["x"][at[0]] == col["y"][at[0]]  # one part with itself
            a, b = (at, at) if whole else (at[part == part[0]], at[part != part[0]])
            if not len(b):
                continue
            left = [np.frombuffer(items[i], U64) for i in a]
            right = left if whole else [np.frombuffer(items[i], U64) for i in b]
            both = overlaps(left, right)
            total = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])
            link = 100 * both >= percent * (total - both)
            if whole:
                np.fill_diagonal(link, False)
            for own, other, grid in ((a, b, link), (b, a, link.T))[:1 if whole else 2]:
                nodes.append(col["node"][own])
                links.append(grid @ col["texts"][other])
        node, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (nodes, links))
        return pa.table({"node": pa.array(node[n > 0], pa.int64()), "n": pa.array(n[n > 0], pa.int64())})

    # a component's parts are bounded in sets and in items
    size = labels.groupBy("component").agg(F.count("*").alias("c"), F.sum("n").alias("t")).where("c > 1").select(
        "component", F.greatest(F.ceil(F.col("c") / PART), F.ceil(F.col("t") / PART_ITEMS)).cast("int").alias("parts"))
    side = labels.join(size, "component").select(
        "block", "doc_id", "node", "component", "texts", F.expr("cast(pmod(xxhash64(node), parts) as int)").alias("part"), "parts")
    held = B.on_blocks(rows, side, carry, "component long, x int, y int, part int, node long, texts long, items binary")
    return held.withColumn("bucket", F.pmod(F.xxhash64("component", "x", "y"), F.lit(buckets * B.BLOCKS_A_PARTITION))) \
        .groupBy("bucket").applyInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text", keyed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, and n_links (how many other, different texts the text links with) for every row of ``docs``.

    With ``keyed``, instead doc_id, text_hash (``xxhash64`` of the text) and component (a number that its rows
    share, null without a shingle) for every row; no links are counted.
    """
    checkpoint_root(docs.sparkSession)
    with B.dropping_shuffles(docs.sparkSession):  # every step ends in a checkpoint
        rows = B.in_blocks(docs, id_col, text_col)
        # the same block number, without moving the text
        sketch = _sketch(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn(
            "block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(B.partitions(docs.sparkSession) * B.BLOCKS_A_PARTITION)).cast("int"))
            .withColumn("same", F.xxhash64("text")), words).checkpoint()
        keys = [F.min(f"k{i}").alias(f"k{i}") for i in range(KEYS)]
        nodes = sketch.where("n > 0").groupBy("node", "second", "n", "same").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "block")).alias("r"), *keys).groupBy("node", "second", "n").agg(
            F.min("r").alias("r"), F.count("*").alias("texts"), *keys).select(
            "node", "n", "texts", "r.doc_id", "r.block", *(f"k{i}" for i in range(KEYS))).checkpoint()

        first = _verified(rows, _first_pairs(nodes, percent), words, percent).checkpoint()
        joined = components(first, "a", "b")
        labels = nodes.select("node", "n", "texts", "doc_id", "block").join(joined, "node", "left") \
            .withColumn("component", F.coalesce("component", "node")).checkpoint()
        more = _linked_families(rows, labels, _residual_pairs(rows, labels, words, percent), words, percent)
        known = labels.where("component <> node").select(F.col("node").alias("a"), F.col("component").alias("b"))
        whole = components(known.union(more), "a", "b")

    labels = labels.drop("component").join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if keyed:
        return sketch.where("n > 0").join(labels.select("node", "component"), "node") \
            .select("doc_id", F.col("same").alias("text_hash"), "component") \
            .union(sketch.where("n = 0").select("doc_id", "same", F.lit(None).cast("long")))
    degree = _link_counts(rows, labels, words, percent)
    least = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    found = labels.join(least, "component").select("node", "texts", "component_id").join(degree.withColumnRenamed("n", "linked"), "node", "left")
    own = sketch.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                       F.lit(0).cast("long").alias("n_links"))
    return sketch.where("n > 0").join(found, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.coalesce("linked", F.lit(0)) + F.col("texts") - 1).cast("long").alias("n_links")).union(own)
