"""Operator 7, best-fit packing: minimum bin slack over the lengths of tokenised pieces.

1. One pass over the texts gives pieces: token ids, closing id, cut every ``capacity`` ids.
2. Spark counts the pieces of each length; at most ``capacity`` numbers reach the driver.
3. The plan is made of lengths only.  The longest length left opens a sequence; a bitset subset-sum
   over the other lengths (longest first, with their counts) finds the fullest filling, stopping at
   an exact one.  The filling is removed as often as the counts allow, so every step uses up one
   of its lengths, and the plan has a few rows a length at any input size.
4. Spark numbers the pieces of each length and the plan's rows turn a number into a sequence and an
   offset.  Long runs of one length are split by hash, counted, and numbered in short windows.

Defined results.  Null or empty text: one piece with the closing id.  Repeated rows are packed
like any others.  Null ids pass through.  An empty table gives no rows.  Only id and text are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairsketch.llm.words import SPACED, U64, Text, byte_table, texts
from fairsketch.session import checkpoint_root

CAPACITY = 4096
CLOSING_ID = 1
RUNS = 65536
RUN_ROWS = 256
SLICE = 2 << 20
CACHE_WORDS = 500_000
ENCODED = 4096  # words encoded at once
#: The normalisation and the cut into units that :func:`chunks` agrees with.
NORMAL = ["NFC", "Replace", "Lowercase"]
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 other ASCII; 0: never cut beside it
_KIND[0x21:0x7F] = 3
_KIND[byte_table((0x41, 0x5A), (0x61, 0x7A))] = 1
_KIND[byte_table((0x30, 0x39))] = 2
_KIND[[ord("'"), ord("|")]] = 0


class Vocabulary:
    """Token ids of words, each distinct word encoded once in a worker (bounded cache)."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        rules = json.loads(model)
        normal = [x["type"] for x in (rules.get("normalizer") or {}).get("normalizers", [])]
        cuts = [x["pattern"].get("Regex") for x in (rules.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
        if normal != NORMAL or cuts != [UNITS]:
            raise ValueError("the vocabulary normalises or cuts texts in another way; its ids would be wrong")
        tokenizer = Tokenizer.from_str(model)
        self.encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)  # without offsets where it can
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.n = self.n_ids = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start, self.size, self.uses = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def _add(self, encoded: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        n, k = self.n, int(sizes.sum())
        while self.n_ids + k > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(encoded) > len(self.start):
            self.start, self.size, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size, self.uses))
        self.ids[self.n_ids:self.n_ids + k] = np.fromiter((i for x in encoded for i in x), np.uint32, k)
        self.size[n:n + len(encoded)] = sizes
        self.start[n:n + len(encoded)] = self.n_ids + np.cumsum(sizes) - sizes
        self.uses[n:n + len(encoded)] = 0
        self.n, self.n_ids = n + len(encoded), self.n_ids + k

    def _forget(self) -> None:
        """Keeps the words met in most slices, at most half a cache; a word met once goes."""
        uses = self.uses[:self.n]
        least = max(2, int(np.partition(uses, -(CACHE_WORDS // 2))[-(CACHE_WORDS // 2)]) + 1)
        stay = np.flatnonzero(uses >= least)
        number = np.full(self.n, -1)
        number[stay] = np.arange(len(stay))
        numbers = number.tolist()
        place = {key: numbers[at] for key, at in self.place.items() if numbers[at] >= 0}
        start, size = self.start[stay], self.size[stay]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        self.clear()
        self.place, self.n, self.n_ids = place, len(stay), len(ids)
        self.ids = np.concatenate([ids, self.ids])
        self.start, self.size, self.uses = (np.concatenate([x, np.zeros(1 << 14, np.int64)]) for x in (total[:-1], size, uses[stay] // 2))

    def places(self, t: Text, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each span's place in the cache."""
        if self.n > CACHE_WORDS:
            self._forget()
        keys, at, inverse = np.unique(t.spans(starts, ends), return_index=True, return_inverse=True)
        known = self.place
        out = np.fromiter((known.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(out < 0)
        if len(new):
            raw = t.data.tobytes()
            words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
            first = self.n
            for lo in range(0, len(words), ENCODED):  # an encoding object is far larger than its ids
                self._add([e.ids for e in self.encode(words[lo:lo + ENCODED], add_special_tokens=False)])
            out[new] = np.arange(first, first + len(new))
            known.update(zip(keys[new].tolist(), out[new].tolist()))
        self.uses[out] += 1
        return out[inverse]


def chunks(t: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): words cut further where the vocabulary's own pattern always cuts.

    That is between ASCII letters, digits and signs, but not beside an apostrophe, a bar (both can
    belong to longer units) or a byte outside ASCII.  Encoding the parts equals encoding the text.
    """
    kind = _KIND[t.data]
    cut = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1
    edge = np.zeros(len(t.data) + 1, bool)
    edge[t.starts] = True
    inside = cut[~edge[cut] & (SPACED[t.data[cut]]) & ~np.isin(cut, t.offsets)]
    starts = np.sort(np.concatenate([t.starts, inside]))
    ends = np.sort(np.concatenate([t.ends, inside]))
    return starts, ends, np.searchsorted(starts, t.offsets)


_vocabularies: dict[int, Vocabulary] = {}


def token_ids(col, model: str, closing: int | None = CLOSING_ID) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, ids, limits): the ids of the texts lo..hi-1, text i's at limits[i - lo]:limits[i - lo + 1]."""
    vocabulary = _vocabularies.get(hash(model))
    if vocabulary is None:
        _vocabularies.clear()
        vocabulary = _vocabularies[hash(model)] = Vocabulary(model)
    for lo, hi, t in texts(col, slice_bytes=SLICE):
        marked = b"<|" in t.data.tobytes()
        if not marked:  # lower-casing is the vocabulary's own; special names are matched before it
            t.data = t.data.copy()
            upper = (t.data >= 65) & (t.data <= 90)
            t.data[upper] += 32
        starts, ends, first = chunks(t)
        place = vocabulary.places(t, starts, ends) if len(starts) else np.zeros(0, np.int64)
        size, start = vocabulary.size[place], vocabulary.start[place]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = vocabulary.ids[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        limits = total[first]
        if closing is not None:
            ids = np.insert(ids, limits[1:], closing)
            limits = limits + np.arange(len(limits))
        yield lo, hi, ids.astype("<u4", copy=False), limits


def tokenizer_model(path: str) -> str:
    """The tokenizer file's text, read on the driver; executors need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
           payload: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids with ``payload``) of every piece of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_model(vocabulary))

    def run(batches):
        for b in batches:
            names = b.column(0)
            for lo, hi, ids, limits in token_ids(b.column(1), shared.value):
                n = np.diff(limits)
                count = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                raw, at = ids.tobytes(), 4 * (limits[doc] + start)
                parts = [raw[a:z] for a, z in zip(at.tolist(), (at + 4 * length).tolist())]
                columns = [names.take(pa.array(doc + lo)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                if payload:
                    columns.append(pa.array(parts, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, PIECES + (", ids binary" if payload else ""))


def fullest(room: int, counts: dict[int, int]) -> dict[int, int]:
    """A filling of at most ``room`` from the counted lengths with the largest sum: length -> how many.

    Bit s of ``sums`` says that some choice of the lengths seen so far adds up to s.  Each step adds
    one bundle (1, 2, 4, ... of a length, what is left last); the first step at which the final sum
    appears tells how it was made.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        bundle = 1
        while left > 0:
            take = min(bundle, left)
            left -= take
            bundle *= 2
            steps.append((sums, length, take))
            sums |= (sums << (length * take)) & mask
        if sums >> room & 1:
            break
    at, out = sums.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= length * take
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, how many in a sequence, first sequence, offset) of every use of a length."""
    left = {k: v for k, v in counts.items() if v > 0}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        top = max(left)
        left[top] -= 1
        filling = fullest(capacity - top, {k: v for k, v in left.items() if v and k <= capacity - top})
        left[top] += 1
        filling[top] = filling.get(top, 0) + 1
        times = min(left[k] // m for k, m in filling.items())
        offset = 0
        for k in sorted(filling, reverse=True):
            m = filling[k]
            rows.append((k, used[k], m, sequence, offset))
            offset += k * m
            used[k] += m * times
            left[k] -= m * times
            if not left[k]:
                del left[k]
        sequence += times
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (a frame with doc_id, piece and length)."""
    spark: SparkSession = cut.sparkSession
    checkpoint_root(spark)
    cut = cut.checkpoint()
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    rows = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    key = (rows[:, 0] << 44) + rows[:, 1]

    run_rows = max(RUN_ROWS, -(-total // RUNS))
    many = [k for k, n in counts.items() if n > run_rows]
    n_runs = F.lit(1).cast("long")
    if many:
        table = F.create_map(*(x for k in many for x in (F.lit(k), F.lit(-(-counts[k] // run_rows)))))
        n_runs = F.coalesce(table[F.col("length")], n_runs)
    cut = cut.withColumn("_run", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), n_runs))
    # one row a run: at most RUNS + capacity
    before = Window.partitionBy("length").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut.groupBy("length", "_run").agg(F.count("*").alias("_n")) \
        .select("length", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_run").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.join(F.broadcast(runs), ["length", "_run"]) \
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside) - 1).drop("_run", "_before")

    def place(batches):
        for b in batches:
            length, rank = (np.asarray(b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False), np.int64)
                            for c in ("length", "_rank"))
            at = np.searchsorted(key, (length << 44) + rank, "right") - 1
            use = rows[at]
            step = rank - use[:, 1]
            columns = [b.column(i) for i, f in enumerate(b.schema.names) if f != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(use[:, 3] + step // use[:, 2], pa.int64()),
                 pa.array(use[:, 4] + step % use[:, 2] * length, pa.int64())],
                names=[f for f in b.schema.names if f != "_rank"] + ["sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("_rank").schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")
