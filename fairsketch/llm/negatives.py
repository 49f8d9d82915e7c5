"""Operator 11, hard-negative mining by inner products in a residue number system.

Components become integers, ``floor(scale * x)``.  A score is the integer inner product of an anchor and a row,
and it is exact: the component matrices are multiplied modulo small primes in float32 (balanced residues; 64
terms of primes below 1,024 stay under 2**24, so every partial sum is an exact float), longer vectors in strips of
64 components, and mixed-radix Chinese remaindering gives the signed value.  Each block takes as many primes as
its own norms need.

An anchor's positives are its best rows of the same label; for each positive, its negatives are the best rows of
other labels whose score lies between ``low`` and ``high`` hundredths of the positive's score.

All rows are searched, in passes of at most ``anchors_a_pass`` anchors: a pass's anchors are sent to all tasks
(their number is bounded, whatever the table's size), the tasks scan their own rows and keep the best few of
each anchor (and positive), and a window over those few per task selects the final ones.  Rows are never
shuffled.  A pass's result is checkpointed.  Work is anchors x rows, as the query set demands.

Defined results.  A row takes no part if its id, label or vector is null, if a component is null or not finite,
or if the squares of its integers sum to 2**62 or more (its scores could leave 64 bits).  Shorter vectors count as
filled up with zeros; an empty vector is all zeros.  Scores tie by smaller id; a row alike in id and score is
interchangeable.  Repeated rows count each on their own, as rows and as anchors; only the anchor's own row is not
its positive.  Fewer rows than asked for: all of them.  A negative positive score has no window, hence no
negatives.  An empty table gives no rows.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairsketch.session import checkpoint_root

#: The primes, largest first; all lie below 1,024, their product is about 2**79.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983, 977)
STRIP = 64
ANCHORS_A_PASS = 8192
#: Rows and anchors multiplied at once.
ROWS, COLUMNS = 2048, 1024
SQUARES = 1 << 62


class Vectors:
    """Rows with their ids, labels and integer components (``q``, zeros at the end of shorter ones)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        self.ids, self.labels, self.q = ids, labels, q
        self.norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, lo: int, hi: int) -> "Vectors":
        return Vectors(self.ids[lo:hi], self.labels[lo:hi], self.q[lo:hi])


def whole(batch: pa.RecordBatch | pa.Table, scale: float) -> Vectors:
    """The rows of a batch (id, label, vector; no nulls in these) that take part."""
    col = batch.column(2)
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    limits = col.offsets.to_numpy().astype(np.int64)
    flat = col.values.slice(limits[0], limits[-1] - limits[0]).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        flat = np.floor(np.asarray(flat, np.float64) * scale)
    limits = limits - limits[0]
    sizes = np.diff(limits)
    wide = int(sizes.max(initial=0))
    if len(sizes) and (sizes == wide).all():
        x = flat.reshape(len(sizes), wide)
    else:
        x = np.zeros((len(sizes), wide))
        row = np.repeat(np.arange(len(sizes)), sizes)
        x[row, np.arange(len(flat)) - limits[row]] = flat
    with np.errstate(invalid="ignore", over="ignore"):
        ok = np.isfinite(x).all(axis=1) & ((x * x).sum(axis=1) < SQUARES)
    ids, labels = (np.asarray(batch.column(k).to_numpy() if isinstance(batch, pa.Table)
                              else batch.column(k).to_numpy(zero_copy_only=False)) for k in (0, 1))
    return Vectors(ids[ok], labels[ok], x[ok].astype(np.int64))


def residues(q: np.ndarray, prime: int) -> np.ndarray:
    """Balanced residues, at most (prime - 1) / 2 in size, as float32."""
    r = q % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def products(rows: np.ndarray, others: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer inner products (rows x others) of absolute value at most ``bound``, as int64."""
    d = min(rows.shape[1], others.shape[1])
    rows, others = rows[:, :d], others[:, :d]
    count, span = 1, PRIMES[0]
    while span < 4 * (bound + 1):
        span *= PRIMES[count]
        count += 1
    digits: list[np.ndarray] = []
    for k, p in enumerate(PRIMES[:count]):
        a, b = residues(rows, p), residues(others, p)
        rest = np.zeros((len(rows), len(others)), np.int32)
        for j in range(0, max(d, 1), STRIP):
            rest = (rest + (a[:, j:j + STRIP] @ b[:, j:j + STRIP].T).astype(np.int32)) % np.int32(p)
        # mixed radix: take off the digits found so far, divide by their primes
        for before, digit in zip(PRIMES, digits):
            rest = (rest - digit) % np.int32(p) * np.int32(pow(before, -1, p)) % np.int32(p)
        digits.append(rest)
    value = np.zeros((len(rows), len(others)), np.int64)
    size, unit = np.zeros(value.shape), 1
    for p, digit in zip(PRIMES, digits):
        with np.errstate(over="ignore"):  # modulo 2**64
            value += digit.astype(np.int64) * np.uint64(unit % (1 << 64)).astype(np.int64)
        if count > 6:
            size += digit * float(unit)
        unit *= p
    if count > 6:  # the span passes 2**63: the leading digits tell the sign
        negative = size > span / 2
        with np.errstate(over="ignore"):
            return np.where(negative, value - np.uint64(span % (1 << 64)).astype(np.int64), value)
    return np.where(value > span // 2, value - span, value)


class Best:
    """The first ``k`` entries (score falling, then id rising) of each slot, over everything offered."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, np.iinfo(np.int64).min)  # an offer below it cannot get in

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.append(self.slot, slot), np.append(self.score, score), np.append(self.ids, ids)
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        full = place == self.k - 1
        self.least[slot[full]] = score[full]
        keep = place < self.k
        self.slot, self.score, self.ids = slot[keep], score[keep], ids[keep]


def _tiles(batches: Iterator, anchors: Vectors, scale: float):
    """(rows, first anchor of the tile, anchors of the tile, scores) over all batches."""
    parts = [(lo, anchors.part(lo, lo + COLUMNS)) for lo in range(0, len(anchors), COLUMNS)]
    for batch in batches:
        every = whole(batch, scale)
        for lo in range(0, len(every), ROWS):
            rows = every.part(lo, lo + ROWS)
            for first, some in parts:
                yield rows, first, some, products(rows.q, some.q, float(rows.norms.max() * some.norms.max()))


def _columns(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).alias("vector")).where("id is not null and label is not null and vector is not null")


_FOUND = "slot long, score long, id long"
_FOUND_ARROW = pa.schema([("slot", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])


def _given(best: Best) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x) for x in (best.slot, best.score, best.ids)], schema=_FOUND_ARROW)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k entries of each slot; tasks sent at most k each."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column | str, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0,
         anchors_a_pass: int = ANCHORS_A_PASS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on the rows.  A negative's score s satisfies
    low * positive_score <= 100 * s <= high * positive_score; ranks count from 1 for each anchor and positive.
    """
    spark = rows.sparkSession
    checkpoint_root(spark)
    every = _columns(rows, id_col, label_col, vector_col)
    chosen = _columns(rows.where(anchor), id_col, label_col, vector_col)
    passes = max(1, -(-chosen.count() // anchors_a_pass))
    out, waiting = None, []

    def one_pass(batch: list) -> DataFrame:
        table = pa.table({"id": pa.array([r[0] for r in batch], pa.int64()), "label": pa.array([r[1] for r in batch], pa.int64()),
                          "vector": pa.array([r[2] for r in batch], pa.list_(pa.float64()))})
        anchors = whole(table, scale)
        sent = spark.sparkContext.broadcast((anchors.ids, anchors.labels, anchors.q))  # at most anchors_a_pass vectors

        def best_positives(batches):
            some = Vectors(*sent.value)
            best = Best(len(some), positives + 1)  # the anchor's own row may be among them
            for part, first, tile, score in _tiles(batches, some, scale):
                r, a = np.nonzero((part.labels[:, None] == tile.labels) & (score >= best.least[first:first + len(tile)]))
                best.offer(first + a, score[r, a], part.ids[r])
            yield _given(best)

        found = _first(every.mapInArrow(best_positives, _FOUND), positives + 1).collect()  # a few rows an anchor
        own = (anchors.q * anchors.q).sum(axis=1)
        pairs: list[tuple[int, int, int]] = []
        seen = np.zeros(len(anchors), bool)
        for r in sorted(found, key=lambda r: (r["slot"], r["rank"])):
            if not seen[r["slot"]] and r["id"] == anchors.ids[r["slot"]] and r["score"] == own[r["slot"]]:
                seen[r["slot"]] = True
            else:
                pairs.append((r["slot"], r["id"], r["score"]))
        count: dict[int, int] = {}
        taken = []
        for slot, ident, score in pairs:
            count[slot] = count.get(slot, 0) + 1
            if count[slot] <= positives:
                taken.append((slot, count[slot] - 1, ident, score))
        # slot of a positive: anchor * positives + its place; limits in whole numbers, none for a missing positive
        floor = np.full(len(anchors) * positives, 1, np.int64)
        top = np.zeros(len(anchors) * positives, np.int64)
        known = np.zeros((2, len(floor)), np.int64)
        for slot, place, ident, score in taken:
            at = slot * positives + place
            floor[at], top[at] = -(-low * score // 100), high * score // 100
            known[:, at] = ident, score
        window = spark.sparkContext.broadcast((floor.reshape(-1, positives), top.reshape(-1, positives)))
        facts = spark.sparkContext.broadcast((np.repeat(anchors.ids, positives), *known))

        def best_negatives(batches):
            some = Vectors(*sent.value)
            lowest, highest = window.value
            best = Best(lowest.size, negatives)
            for part, first, tile, score in _tiles(batches, some, scale):
                end = first + len(tile)
                near = (part.labels[:, None] != tile.labels) & (score >= lowest[first:end].min(axis=1)) \
                    & (score <= highest[first:end].max(axis=1))
                r, a = np.nonzero(near)
                s = score[r, a]
                for place in range(lowest.shape[1]):
                    at = (first + a) * lowest.shape[1] + place
                    ok = (s <= highest[first + a, place]) & (s >= np.maximum(lowest[first + a, place], best.least[at]))
                    best.offer(at[ok], s[ok], part.ids[r[ok]])
            yield _given(best)

        def named(batches):
            ids, positive, score = facts.value
            for b in batches:
                slot = b.column("slot").to_numpy()
                yield pa.record_batch([pa.array(ids[slot]), pa.array(positive[slot]), b.column("rank"), b.column("id"),
                                       pa.array(score[slot]), b.column("score")],
                                      names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

        result = _first(every.mapInArrow(best_negatives, _FOUND), negatives).mapInArrow(
            named, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long").checkpoint()
        for b in (sent, window, facts):
            b.destroy()
        return result

    for row in chosen.repartition(passes).toLocalIterator():
        waiting.append(row)
        if len(waiting) == anchors_a_pass:
            out, waiting = one_pass(waiting) if out is None else out.unionByName(one_pass(waiting)), []
    if waiting or out is None:
        out = one_pass(waiting) if out is None else out.unionByName(one_pass(waiting))
    return out
