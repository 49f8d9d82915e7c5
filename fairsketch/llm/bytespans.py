"""Operator 13, byte-level dedup with suffix arrays: bytes of long strings that an earlier document holds.

A byte goes if some string of ``window`` bytes that covers it also starts in a document with a smaller id.  Equal
strings are found by sorting suffixes, in shards that hold all occurrences of a string:

* Every window has a key, the smallest fingerprint of the ``gram`` byte strings inside it, which is the same
  wherever the window stands; neighbouring windows mostly share it.  A first scan sends each document's distinct
  keys, and a key of one document only is dropped with its windows: they are unique.
* Windows with the other keys travel as segments (the text under consecutive windows of one key), each different
  segment once a block, to the shard of their key.  A key with very many windows would make a hot shard, so its
  windows travel one by one under their own fingerprints.
* A shard drops a key's segments if one id sent them all.  If they are all equal, every window's smallest id is the
  smallest that sent them.  Of all others it builds the suffix array of the distinct segments by induced sorting
  (``suffixes.py``); the permuted common prefixes cut it into groups of windows that share all their bytes, and each
  group's smallest id is compared with the ids that sent it.  So strings are compared byte by byte, not by fingerprint.
* Each block cuts the bytes that found windows cover.

Keys and segments are plain rows, as many as the text has, whatever the number of partitions; texts are shuffled
once.  Rows alike in all columns that would fill a block are processed once.

Defined results.  Null or empty text: no bytes, nothing removed (the kept bytes are empty).  Texts shorter than a
window stay whole.  Rows with a null id are kept whole and remove nothing elsewhere; rows that repeat an id do
not remove each other's bytes.  Cuts may fall inside a character, so the kept bytes are binary.  Long texts are
processed whole, in one slice.  Extra columns are carried only if named.  An empty table gives no rows.
Segments that a block holds twice are recognised by 64-bit fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm import blocks as B
from fairsketch.llm.suffixes import permuted_prefixes, suffix_array
from fairsketch.llm.words import U64, buffers, byte_sums, covered, sequence, windows
from fairsketch.session import scratch_path

WINDOW, GRAM = 50, 16
#: Windows of a segment: one bit each in a shard's answer.
MOST = 63
#: A key with more different segments than this is split by window.
HOT_SEGMENTS = 20_000
SLICE_BYTES = 1 << 18
SHARD_BYTES = 1 << 20


class Runs:
    """Segments of a slice: ``first`` window, number of windows, document (row of the slice) and key of each."""

    def __init__(self, first, count, doc, key):
        self.first, self.count, self.doc, self.key = first, count, doc, key

    def where(self, ok: np.ndarray) -> "Runs":
        return Runs(self.first[ok], self.count[ok], self.doc[ok], self.key[ok])


def slices(col):
    """(lo, hi, bytes, offsets) of consecutive whole texts of about SLICE_BYTES."""
    if len(col) == 0:
        return
    data, offsets = buffers(col)
    lo = 0
    while lo < len(offsets) - 1:
        hi = min(max(int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1, lo + 1), len(offsets) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def runs(total: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Runs:
    """All windows of a slice as runs of at most MOST neighbours of one key; ``total`` from byte_sums."""
    n = len(total) - 1
    if n < window:
        return Runs(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, U64))
    least, wide = windows(total, gram), 1
    grams = window - gram + 1
    while wide * 2 <= grams:
        least, wide = np.minimum(least[:-wide], least[wide:]), wide * 2
    at = n - window + 1
    key = np.minimum(least[:at], least[grams - wide:grams - wide + at])
    # windows that pass a text's end, and the first ones of texts
    some = offsets[1:] > offsets[:-1]
    begin, end = offsets[:-1][some], offsets[1:][some]
    over = np.maximum(end[:, None] - np.arange(1, window), begin[:, None]).ravel()
    ok = np.ones(at, bool)
    ok[over[over < at]] = False
    new = np.empty(at, bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    new[begin[begin < at]] = True
    start = np.flatnonzero(new & ok)
    # a run ends where the next one begins or at its text's last window
    doc = np.searchsorted(end, start, "right")
    size = np.minimum(np.append(start[1:], at), end[doc] - window + 1) - start
    doc = np.flatnonzero(some)[doc]
    if size.max(initial=0) > MOST:
        pieces = -(-size // MOST)
        of = np.repeat(np.arange(len(start)), pieces)
        k = np.arange(len(of)) - (np.cumsum(pieces) - pieces)[of]
        start, size = start[of] + k * MOST, np.minimum(size[of] - k * MOST, MOST)
        doc = doc[of]
    return Runs(start, size, doc, key[start])


def _unlisted(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return x.to_numpy() if isinstance(x, pa.ChunkedArray) else x.to_numpy(zero_copy_only=False)


def _ids(rows) -> tuple[np.ndarray, np.ndarray]:
    col = rows.column("doc_id")
    return _unlisted(col.fill_null(0)), _unlisted(col.is_valid())


def _distinct(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The first of each run of equal keys, in ``order``."""
    k = key[order]
    return order[np.append(True, k[1:] != k[:-1])] if len(k) else order


class Segments:
    """A block's segments; ``mine`` is the smallest id of the block that holds the same text.

    ``keys`` and ``hot`` are the block's shared keys and whether each is split by window.  Without ``every`` only
    segments with these keys are taken; with it all are, and the keys need to hold the hot ones only.
    """

    def __init__(self, rows: pa.Table, keys: np.ndarray, hot: np.ndarray, window: int, gram: int, every: bool = False):
        order = np.argsort(keys)
        keys, hot = keys[order], hot[order]
        self.rows, self.window = rows, window
        ids, known = _ids(rows)
        part, first, count, doc, ident, mark, route = [], [], [], [], [], [], []
        self.parts = []
        for lo, hi, data, offsets in slices(rows.column("text")):
            self.parts.append((lo, hi, data, offsets))
            if not every and not len(keys):
                continue
            total = byte_sums(data)
            found = runs(total, offsets, window, gram)
            found = found.where(known[lo:hi][found.doc])
            split = np.zeros(len(found.key), bool)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, found.key), len(keys) - 1)
                shared = keys[place] == found.key
                split = shared & hot[place]
                if not every:
                    found, split = found.where(shared), split[shared]
            # windows of hot keys one by one
            times = np.where(split, found.count, 1)
            of = np.repeat(np.arange(len(times)), times)
            step = np.arange(len(of)) - (np.cumsum(times) - times)[of]
            a, n = found.first[of] + step, np.where(split[of], 1, found.count[of])
            prints = sequence(total, a, a + n + window - 1)
            part.append(np.full(len(a), len(self.parts) - 1))
            first.append(a)
            count.append(n)
            doc.append(found.doc[of])
            ident.append(ids[lo:hi][found.doc[of]])
            mark.append(prints)
            route.append(np.where(split[of], prints, found.key[of]))
        join = lambda x, kind=np.int64: np.concatenate(x) if x else np.zeros(0, kind)
        self.part, self.first, self.count, self.doc, self.ident = map(join, (part, first, count, doc, ident))
        self.mark, self.route = join(mark, U64), join(route, U64)
        self.heads = _distinct(np.lexsort((self.ident, self.mark)), self.mark)
        place = np.searchsorted(self.mark[self.heads], self.mark)
        self.mine = self.ident[self.heads][place]

    def texts(self) -> tuple[np.ndarray, pa.Array]:
        """(heads in order of place, their bytes)."""
        heads = np.sort(self.heads)
        out = []
        for k, (_, _, data, _) in enumerate(self.parts):
            some = heads[self.part[heads] == k]
            size = self.count[some] + self.window - 1
            limits = np.append(0, np.cumsum(size))
            at = np.arange(limits[-1]) + np.repeat(self.first[some] - limits[:-1], size)
            out.append(pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(limits), pa.py_buffer(data[at])]))
        return heads, pa.concat_arrays(out) if out else pa.array([], pa.large_binary())


ANSWER = "block int, key long, bits long"
ANSWER_ARROW = pa.schema([("block", pa.int32()), ("key", pa.int64()), ("bits", pa.int64())])
KEYS = "key long, block int, mark int"
KEYS_ARROW = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("mark", pa.int32())])
SHARED = "block int, key long, hot boolean"
SHARED_ARROW = pa.schema([("block", pa.int32()), ("key", pa.int64()), ("hot", pa.bool_())])
SENT = "route long, text binary, block int, mark long, doc long"
SENT_ARROW = pa.schema([("route", pa.int64()), ("text", pa.binary()), ("block", pa.int32()), ("mark", pa.int64()), ("doc", pa.int64())])


def keys_of(batch: pa.RecordBatch, window: int, gram: int) -> pa.RecordBatch:
    """Each document's distinct keys, with its block and a short mark of each different segment under the key."""
    _, known = _ids(batch)
    block = _unlisted(batch.column("block"))
    out = []
    for lo, hi, data, offsets in slices(batch.column("text")):
        total = byte_sums(data)
        found = runs(total, offsets, window, gram)
        found = found.where(known[lo:hi][found.doc])
        mark = sequence(total, found.first, found.first + found.count + window - 1).astype(np.uint32)
        order = np.lexsort((mark, found.key, found.doc))
        k, d, m = found.key[order], found.doc[order], mark[order]
        new = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (m[1:] != m[:-1]))[:len(k)]
        out.append((k[new], block[lo:hi][d[new]], m[new]))
    k, b, m = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, U64), np.zeros(0, np.int32), np.zeros(0, np.uint32))
    return pa.record_batch([pa.array(k.view(np.int64)), pa.array(b.astype(np.int32)), pa.array(m.view(np.int32))], schema=KEYS_ARROW)


def shared_keys(rows: pa.Table, hot_segments: int) -> pa.Table:
    """The keys that were sent more than once, for each block that holds them, and whether to split them by window.

    A key of one document alone that has several different segments under it counts as shared, too; its shard will
    find nothing.
    """
    key, block, mark = (_unlisted(rows.column(c)) for c in ("key", "block", "mark"))
    order = np.lexsort((mark, key))
    key, block, mark = key[order], block[order], mark[order]
    if not len(key):
        return SHARED_ARROW.empty_table()
    new = np.append(True, key[1:] != key[:-1])
    start = np.flatnonzero(new)
    many = np.diff(np.append(start, len(key))) > 1
    hot = np.add.reduceat(new | np.append(True, mark[1:] != mark[:-1]), start, dtype=np.int64) > hot_segments
    group = np.cumsum(new) - 1
    some = many[group]
    key, block, hot = key[some], block[some], hot[group[some]]
    order = np.lexsort((block, key))
    key, block, hot = key[order], block[order], hot[order]
    once = np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1]))[:len(key)]
    return pa.table([pa.array(block[once]), pa.array(key[once]), pa.array(hot[once])], schema=SHARED_ARROW)


def least_ids(texts: pa.Array, doc: np.ndarray, window: int) -> np.ndarray:
    """For each window of each text (a row a text), the smallest id that holds the same bytes; ids as given by text.

    The texts are distinct.  They are laid end to end with separators, their suffixes sorted, and the windows cut
    into groups where neighbours in order share fewer than ``window`` bytes.
    """
    texts = texts.cast(pa.large_binary())
    _, limits, flat = texts.buffers()
    limits = np.frombuffer(limits, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    flat = np.frombuffer(flat, np.uint8)
    size = np.diff(limits)
    start = limits[:-1] - limits[0] + np.arange(len(size))
    s = np.zeros(int(size.sum()) + len(size), np.uint8)
    of = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(of)) + of
    s[inside] = flat[limits[0]:limits[-1]] + np.uint8(1)  # no byte of UTF-8 is 255
    order = suffix_array(s)
    whole = size[of] - (inside - start[of]) >= window
    places = inside[whole]
    shared = np.zeros(len(s), np.int64)
    shared[places] = permuted_prefixes(s, order, places, window)
    is_window = np.zeros(len(s), bool)
    is_window[places] = True
    order = order[is_window[order]]
    text = np.empty(len(s), np.int64)
    text[inside] = of
    new = shared[order] < window
    new[:1] = True
    cut = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[text[order]], cut)[np.cumsum(new) - 1]
    out = np.full((len(size), int(size.max(initial=window)) - window + 1), np.iinfo(np.int64).max)
    out[text[order], order - start[text[order]]] = least
    return out


def _borders(route: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.append(True, route[1:] != route[:-1])), len(route))


def earlier_windows(rows: pa.Table, window: int) -> pa.Table:
    """For each sent segment, one bit a window that an earlier document holds (rows without any are left out)."""
    out = []

    def answer(some: np.ndarray, bits: np.ndarray) -> None:
        got = bits != 0
        out.append((block[some[got]], mark[some[got]], bits[got]))

    route, block, mark, doc = (_unlisted(rows.column(c)) for c in ("route", "block", "mark", "doc"))
    order = np.argsort(route)
    if len(order):  # what one id sent alone is nowhere else
        borders = _borders(route[order])
        several = np.minimum.reduceat(doc[order], borders[:-1]) < np.maximum.reduceat(doc[order], borders[:-1])
        order = order[np.repeat(several, np.diff(borders))]
    route, block, mark, doc = (x[order] for x in (route, block, mark, doc))
    texts = rows.column("text").take(pa.array(order)).combine_chunks()
    if len(order):
        borders = _borders(route)
        size = _unlisted(pa.compute.binary_length(texts)).astype(np.int64)
        code = texts.dictionary_encode().indices.to_numpy()
        equal = np.minimum.reduceat(code, borders[:-1]) == np.maximum.reduceat(code, borders[:-1])
        equal, least = (np.repeat(x, np.diff(borders)) for x in (equal, np.minimum.reduceat(doc, borders[:-1])))
        every = (np.uint64(1) << (size - window + 1).astype(U64)) - np.uint64(1)  # MOST windows at most
        some = np.flatnonzero(equal)
        answer(some, np.where(least[some] < doc[some], every[some], np.uint64(0)).view(np.int64))
        # the others, by suffix arrays
        rest = np.flatnonzero(~equal)
        route, block, mark, doc, size = (x[rest] for x in (route, block, mark, doc, size))
        texts = texts.take(pa.array(rest))
        ends = np.cumsum(size)
    lo = 0
    borders = _borders(route) if len(route) else np.zeros(1, np.int64)
    while lo < len(route):
        # as many whole routes as a shard's size holds, one at least
        most = np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SHARD_BYTES, "right")
        hi = int(borders[max(np.searchsorted(borders, most, "right") - 1, np.searchsorted(borders, lo, "right"))])
        some = texts.slice(lo, hi - lo).dictionary_encode()
        of = some.indices.to_numpy().astype(np.int64)
        by = np.lexsort((doc[lo:hi], of))
        head = by[np.append(True, of[by[1:]] != of[by[:-1]])]  # each text's smallest id
        least = least_ids(some.dictionary, doc[lo:hi][head], window)
        wide = least.shape[1]
        for a in range(lo, hi, 1 << 16):
            b = min(a + (1 << 16), hi)
            flags = np.zeros((b - a, 64), np.uint8)
            flags[:, :wide] = least[of[a - lo:b - lo]] < doc[a:b, None]
            answer(np.arange(a, b), np.packbits(flags, axis=1, bitorder="little").view(np.int64).ravel())
        lo = hi
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table([pa.array(cols[0].astype(np.int32)), pa.array(cols[1]), pa.array(cols[2])], schema=ANSWER_ARROW)


def cut(segments: Segments, mark: np.ndarray, bits: np.ndarray, texts: bool) -> dict:
    """n_bytes, n_removed, spans, kept_sha256 and (with ``texts``) kept of each row of the block, from the shards' answers."""
    window = segments.window
    order = np.argsort(mark)
    mark, bits = mark[order], bits[order]
    mask = np.zeros(len(segments.mark), np.int64)
    if len(mark):
        place = np.minimum(np.searchsorted(mark, segments.mark), len(mark) - 1)
        mask = np.where(mark[place] == segments.mark, bits[place], 0)
    whole = segments.ident > segments.mine
    out = {"n_bytes": [], "n_removed": [], "spans": [], "kept_sha256": [], "kept": []}
    for k, (lo, hi, data, offsets) in enumerate(segments.parts):
        own = segments.part == k
        a, n, all_of, some = segments.first[own], segments.count[own], whole[own], mask[own]
        piece = np.flatnonzero(~all_of & (some != 0))
        flags = np.unpackbits(some[piece].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") if len(piece) else np.zeros((0, 64))
        row, step = np.nonzero(flags)
        first = np.concatenate([a[all_of], a[piece[row]] + step])
        last = np.concatenate([a[all_of] + n[all_of] - 1, a[piece[row]] + step]) + window
        gone = covered(len(data), first, last)
        before = np.append(0, np.cumsum(gone))
        edge = np.zeros(len(data), bool)  # where a text begins
        edge[offsets[:-1][offsets[:-1] < len(data)]] = True
        begin = np.flatnonzero(gone & (edge | ~np.append(False, gone[:-1])))
        end = np.flatnonzero(gone & np.append(edge[1:] | ~gone[1:], True)) + 1
        kept = data[~gone].tobytes()
        limits = offsets - before[offsets]
        spans = np.searchsorted(begin, offsets)
        removed = np.diff(before[offsets])
        for i in range(hi - lo):
            body = kept[limits[i]:limits[i + 1]]
            x, y = spans[i], spans[i + 1]
            out["spans"].append([{"begin": b, "end": e} for b, e in
                                 zip((begin[x:y] - offsets[i]).tolist(), (end[x:y] - offsets[i]).tolist())] if y > x else [])
            out["kept_sha256"].append(hashlib.sha256(body).hexdigest())
            if texts:
                out["kept"].append(body)
        out["n_bytes"] += np.diff(offsets).tolist()
        out["n_removed"] += removed.tolist()
    if not texts:
        del out["kept"]
    return out


def byte_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
               others: tuple[str, ...] = (), texts: bool = True, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (begin and end byte of each removed run), kept_sha256, kept (binary; only with
    ``texts``) and ``others`` for every row of ``docs``."""
    if not 0 < gram <= window <= gram + MOST - 1:
        raise ValueError(f"a window holds 1 to {MOST} grams")
    spark = docs.sparkSession
    n = B.partitions(spark)
    rows = B.collapsed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *others))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", *others), F.lit(n)).cast("int"))

    def send_keys(batches):
        for batch in batches:
            yield keys_of(batch, window, gram)

    def find_shared(batches):
        yield from shared_keys(pa.Table.from_batches(batches, KEYS_ARROW), hot_segments).to_batches(1 << 16)

    def send_segments(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        s = Segments(block_rows, _unlisted(side.column("key")).view(U64), _unlisted(side.column("hot")), window, gram)
        heads, body = s.texts()
        block = block_rows.column("block")[0].as_py() if len(block_rows) else 0
        return pa.table([pa.array(s.route[heads].view(np.int64)), body.cast(pa.binary()), pa.array(np.full(len(heads), block, np.int32)),
                         pa.array(s.mark[heads].view(np.int64)), pa.array(s.ident[heads])], schema=SENT_ARROW)

    def find_earlier(batches):
        yield from earlier_windows(pa.Table.from_batches(batches, SENT_ARROW), window).to_batches(1 << 16)

    types = [("doc_id", pa.int64()), ("copies", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
             ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string()),
             *([("kept", pa.binary())] if texts else [])]

    def cut_bytes(block_rows: pa.Table, side: pa.Table) -> pa.Table:
        key, bits = _unlisted(side.column("key")).view(U64), _unlisted(side.column("bits"))
        hot = bits == 0  # an answer has a bit at least
        segments = Segments(block_rows, key[hot], hot[hot], window, gram, every=True)
        out = cut(segments, key[~hot], bits[~hot], texts)
        out |= {c: block_rows.column(c) for c in ("doc_id", "copies", *others)}
        return B.table(out, pa.schema([*types, *((c, block_rows.schema.field(c).type) for c in others)]))

    path = scratch_path(spark, "shared-keys")  # as Parquet, a third of a checkpoint's size
    with B.dropping_shuffles(spark):
        rows.select("doc_id", "text", "block").mapInArrow(send_keys, KEYS).repartition(n, "key") \
            .mapInArrow(find_shared, SHARED).write.parquet(path)
    shared = spark.read.schema(SHARED).parquet(path)
    dealt = rows.repartition(n, "block")
    found = B.on_blocks(dealt, shared, send_segments, SENT).repartition(n, "route").mapInArrow(find_earlier, ANSWER)
    extra = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    hot = shared.where("hot").select("block", "key", F.lit(0).cast("long").alias("bits"))
    out = B.on_blocks(dealt, hot.unionByName(found), cut_bytes,
                      "doc_id long, copies long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, "
                      f"kept_sha256 string{', kept binary' if texts else ''}{extra}")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("_copy", "copies")
