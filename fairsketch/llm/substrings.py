"""Operator 4, substring dedup by recompression: words of long passages that an earlier document holds.

A word goes if some window of ``window`` consecutive words that covers it also starts in a document
with a smaller id.  Comparing all windows would move several times the input, so windows are
compared through symbols that a locally consistent grammar gives them:

* Words get names.  A first round names maximal runs of one word; further rounds split the names into
  left and right ones by a bit of the name and replace each left-right pair by a name of its own.
  Names are fingerprints of what they stand for, so equal pieces get equal names in every document
  without a dictionary to pass around.
* A symbol's extent depends on a few neighbouring words only (tracked exactly).  Inside a window, the
  symbols whose context lies within it are therefore the same wherever the window stands.  The
  smallest fingerprint of such a context is the window's anchor (without any, its own fingerprint).
* Round one: Spark groups anchors.  A window whose anchor occurs in one document only is unique.
* Round two: Spark groups the fingerprints of the remaining windows with the smallest id that holds
  them; this verifies long repeats exactly, window by window.
* Each document then cuts the words that found windows cover.

Blocks send distinct keys only, so a passage shared by a third of all documents arrives once a block.
The text is shuffled once and that exchange is reused by all three passes.

Defined results.  Null or empty text: no words, nothing removed.  Rows with a null id are kept whole
and remove nothing elsewhere.  Rows that repeat an id do not remove each other's words.  Extra columns
are carried only if named.  An empty table gives no rows.  Fingerprints have 64 bits; a wrong cut needs
a collision of a window's fingerprint and of its anchor's.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm import blocks as B
from fairsketch.llm.words import U64, Text, covered, mix, sequence, texts, word_sums

WINDOW = 13
ROUNDS = 3

_SALTS = [U64(x) for x in (0x8CB92BA72F3D8DD7, 0xAAD26B49B4A2E6B1, 0xD6E8FEB86659FD93, 0x9FB21C651E98DF25,
                           0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


class Symbols:
    """A level of the grammar: names, word spans [start, end), and the spans [first, last) they depend on."""

    def __init__(self, name, doc, first, last):
        self.name, self.doc, self.first, self.last = name, doc, first, last


def runs(t: Text, hashes: np.ndarray) -> Symbols:
    """The level of maximal runs of one word; each depends on the word before and the word after it."""
    n = len(hashes)
    edge = np.ones(n, bool)
    edge[1:] = (hashes[1:] != hashes[:-1]) | (t.doc[1:] != t.doc[:-1])
    start = np.flatnonzero(edge)
    end = np.append(start[1:], n)
    length = (end - start).astype(U64)
    name = np.where(length > 1, mix(hashes[start] + length * _SALTS[0]), hashes[start])
    return Symbols(name, t.doc[start], start - 1, end + 1)


def pairs(s: Symbols, salt: np.uint64, doc_first: np.ndarray) -> Symbols:
    """The next level: each left name followed by a right name becomes one symbol.

    A pair depends on what its parts depend on; a lone left symbol also on its successor, a lone
    right one on its predecessor.  At a text's end the missing neighbour counts as outside.
    """
    n = len(s.name)
    right = (mix(s.name ^ salt) >> U64(63)).astype(bool)
    joins = np.zeros(n, bool)  # with the next symbol
    joins[:-1] = ~right[:-1] & right[1:] & (s.doc[1:] == s.doc[:-1])
    taken = np.zeros(n, bool)
    taken[1:] = joins[:-1]
    first, last = s.first.copy(), s.last.copy()
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:] = s.doc[1:] != s.doc[:-1]
    after[:-1] = s.doc[1:] != s.doc[:-1]
    alone = ~joins & ~taken
    i = np.flatnonzero(alone & right)
    first[i] = np.where(before[i], doc_first[s.doc[i]] - 1, s.first[np.maximum(i - 1, 0)])
    i = np.flatnonzero(alone & ~right)
    last[i] = np.where(after[i], doc_first[s.doc[i] + 1] + 1, s.last[np.minimum(i + 1, n - 1)])
    i = np.flatnonzero(joins)
    name = s.name.copy()
    name[i] = mix(s.name[i] * U64(3) + s.name[i + 1] + salt)
    last[i] = s.last[i + 1]
    keep = ~taken
    return Symbols(name[keep], s.doc[keep], first[keep], last[keep])


def anchors(t: Text, hashes: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, anchors, fingerprints) of all windows of the slice."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    at = np.arange(n - window + 1)
    at = at[at + window <= t.first[t.doc[at] + 1]]
    if not len(at):
        return at, np.zeros(0, U64), np.zeros(0, U64)
    total = word_sums(hashes)
    prints = sequence(total, at, at + window)
    s = runs(t, hashes)
    for k in range(rounds):
        s = pairs(s, _SALTS[1 + k % 7], t.first)
    inner = (s.first >= 0) & (s.last <= n)
    context = np.full(len(s.name), ~U64(0))
    context[inner] = sequence(total, s.first[inner], s.last[inner])
    # symbols whose context lies within the window: from `lo` to `hi` (contexts are in order)
    lo = np.searchsorted(s.first, at, "left")
    hi = np.searchsorted(s.last, at + window, "right")
    best = np.full(len(at), ~U64(0))
    for k in range(int((hi - lo).max(initial=0))):
        some = np.flatnonzero(lo + k < hi)
        best[some] = np.minimum(best[some], context[lo[some] + k])
    return at, np.where(lo < hi, best, prints), prints


def _slices(rows: pa.Table):
    ids = rows.column("doc_id").combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for lo, hi, t in texts(rows.column("text")):
        yield lo, hi, t, names[lo:hi], known[lo:hi]


def _distinct_pairs(keys: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, id) pairs in order."""
    k = np.concatenate(keys) if keys else np.zeros(0, U64)
    d = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    order = np.lexsort((d, k))
    k, d = k[order], d[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return k[new], d[new]


def _block_anchors(rows: pa.Table, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct anchors in order, whether several documents of the block hold it)."""
    keys, docs = [], []
    for _, _, t, names, known in _slices(rows):
        at, anchor, _ = anchors(t, t.hashes(), window, rounds)
        doc = t.doc[at]
        # neighbouring windows mostly share their anchor
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        new &= known[doc]
        keys.append(anchor[new])
        docs.append(names[doc[new]])
    k, _ = _distinct_pairs(keys, docs)
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(first)
    return k[at], np.diff(np.append(at, len(k))) > 1


def _shared(rows: pa.Table, window: int, rounds: int, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    k, _ = _block_anchors(rows, window, rounds)
    return k[B.answered(k, buckets, answers)]


def _open_windows(t: Text, shared: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, fingerprints) of the windows whose anchor is shared."""
    at, anchor, prints = anchors(t, t.hashes(), window, rounds)
    if not len(shared):
        return at[:0], prints[:0]
    place = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
    hit = shared[place] == anchor
    return at[hit], prints[hit]


def _block_windows(rows: pa.Table, shared: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct fingerprints in order, the smallest id of the block that holds each)."""
    keys, docs = [], []
    for _, _, t, names, known in _slices(rows):
        at, prints = _open_windows(t, shared, window, rounds)
        ok = known[t.doc[at]]
        keys.append(prints[ok])
        docs.append(names[t.doc[at[ok]]])
    k, d = _distinct_pairs(keys, docs)
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    return k[first], d[first]


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])
_ANSWER = pa.schema([("block", pa.int32()), ("round", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
SENT = "bucket int, block int, keys binary, more binary"
ANSWER = "block int, round int, bucket int, bits binary"


def _send(block: int, keys: np.ndarray, more, buckets: int) -> pa.Table:
    cut = B.parts(keys, buckets)
    return B.table({"bucket": [b for b, _, _ in cut], "block": [block] * len(cut),
                    "keys": [keys[x:y].tobytes() for _, x, y in cut], "more": [more(x, y) for _, x, y in cut]}, _SENT)


def _answers(side: pa.Table, number: int) -> dict[int, bytes]:
    return {b: x for r, b, x in zip(side.column("round").to_pylist(), side.column("bucket").to_pylist(),
                                    side.column("bits").to_pylist()) if r == number}


def substring_dedup(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, id_col: str = "doc_id",
                    text_col: str = "text", others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text and ``others`` for every row of ``docs``.

    ``kept_sha256`` digests the kept words joined by one space; ``kept_text`` is the text with the
    removed words and the white space after each of them cut out.
    """
    buckets = B.partitions(docs.sparkSession)
    rows = B.in_blocks(docs, id_col, text_col, others)

    def send_anchors(block_rows: pa.Table) -> pa.Table:
        k, many = _block_anchors(block_rows, window, rounds)
        return _send(block_rows.column("block")[0].as_py(), k, lambda x, y: B.bits(many[x:y]), buckets)

    def find_shared(sent: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, U64) for x in sent.column("keys").to_pylist()]
        many = [B.flags(m, len(k)) for m, k in zip(sent.column("more").to_pylist(), keys)]
        return _judge(sent, keys, 1, lambda k, size, order, cut: (size > 1) | np.logical_or.reduceat(np.concatenate(many)[order], cut))

    def send_windows(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        block = block_rows.column("block")[0].as_py()
        shared = _shared(block_rows, window, rounds, buckets, _answers(side, 1))
        k, d = _block_windows(block_rows, shared, window, rounds)
        return _send(block, k, lambda x, y: B.coded(d[x:y]), buckets)

    def find_earlier(sent: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, U64) for x in sent.column("keys").to_pylist()]
        ids = np.concatenate([B.decoded(x) for x in sent.column("more").to_pylist()])
        return _judge(sent, keys, 2, lambda k, size, order, cut: np.minimum.reduceat(ids[order], cut), ids)

    def cut_words(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        first = _answers(side, 1)
        shared = _shared(block_rows, window, rounds, buckets, first) if first else np.zeros(0, U64)
        k, d = _block_windows(block_rows, shared, window, rounds)
        earlier = B.answered(k, buckets, _answers(side, 2))
        n_words, n_removed, digest, kept = [], [], [], []
        for lo, hi, t, names, known in _slices(block_rows):
            at, prints = _open_windows(t, shared, window, rounds)
            gone = np.zeros(len(t.starts), bool)
            if len(k) and len(at):
                place = np.minimum(np.searchsorted(k, prints), len(k) - 1)
                mine = names[t.doc[at]]
                found = known[t.doc[at]] & (k[place] == prints) & ((mine > d[place]) | earlier[place])
                gone = covered(len(t.starts), at[found], at[found] + window)
            cut = np.concatenate([[0], np.cumsum(gone)])
            raw = t.data.tobytes()
            for i in range(t.n):
                a, b = int(t.first[i]), int(t.first[i + 1])
                body = raw[t.offsets[i]:t.offsets[i + 1]]
                removed = int(cut[b] - cut[a])
                words = body.split()
                if removed:
                    keep = ~gone[a:b]
                    words = list(compress(words, keep.tolist()))
                    ends = np.append(t.starts[a + 1:b], t.offsets[i + 1])
                    body = raw[t.offsets[i]:t.starts[a]] + b"".join(
                        raw[x:y] for x, y in zip(t.starts[a:b][keep].tolist(), ends[keep].tolist()))
                n_words.append(b - a)
                n_removed.append(removed)
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                kept.append(body)
        out = {"doc_id": block_rows.column("doc_id"), "n_words": n_words, "n_removed": n_removed, "kept_sha256": digest,
               "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
        fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                  ("kept_text", pa.string()), *((c, block_rows.schema.field(c).type) for c in others)]
        return B.table(out | {c: block_rows.column(c) for c in others}, pa.schema(fields))

    shared = B.on_blocks(rows, None, send_anchors, SENT).groupBy("bucket").applyInArrow(find_shared, ANSWER)
    earlier = B.on_blocks(rows, shared, send_windows, SENT).groupBy("bucket").applyInArrow(find_earlier, ANSWER)
    extra = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return B.on_blocks(rows, shared.unionByName(earlier), cut_words,
                       f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string{extra}")


def _judge(sent: pa.Table, keys: list[np.ndarray], number: int, verdict, ids: np.ndarray | None = None) -> pa.Table:
    """Groups equal keys of all blocks and answers each block: ``verdict`` gives one value a group, a
    flag, or (with ``ids``) the smallest id, below which a block's own id must lie to be answered no."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    k = every[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    cut = np.flatnonzero(new)
    size = np.diff(np.append(cut, len(k)))
    value = np.empty(len(k), np.int64 if ids is not None else bool)
    value[order] = np.repeat(verdict(k, size, order, cut), size)
    flag = value < ids if ids is not None else value
    ends = np.cumsum([len(x) for x in keys]).tolist()
    block, bucket = sent.column("block").to_pylist(), sent.column("bucket").to_pylist()
    rows = [(b, number, c, B.bits(flag[x:y])) for b, c, x, y in zip(block, bucket, [0, *ends], ends) if flag[x:y].any()]
    return B.table(dict(zip(ANSWER_NAMES, map(list, zip(*rows)))) if rows else dict.fromkeys(ANSWER_NAMES, []), _ANSWER)


ANSWER_NAMES = [f.name for f in _ANSWER]
