"""Operator 3, toxicity: a factorization machine over hashed terms.

A text's terms are its lower-cased words and their leading 4, 6 and 8 bytes (so inflected forms share a
term), hashed into ``2**SPACE`` places with the square root of their count as value.  The machine adds
to the linear weights one inner product for every pair of a text's terms, through factor vectors, so a
pair such as an insult beside a group's name can weigh more than its parts:
``score = sigmoid(w0 + sum w x + 1/2 sum_f [(sum v x)^2 - sum v^2 x^2])``.

Training takes a bounded sample: about ``PER_CLASS`` labelled rows of each label, spread by hash; their
sparse terms (not their texts) reach the driver, at any input size.  Rows whose crc32(id as text) is a
multiple of five are never learned from.  Terms too rare or too even in the sample are dropped, so the
model sent to the tasks holds at most ``MAX_TERMS`` terms.  Scoring reads every whole text once,
without a shuffle: terms outside the model fall away before anything is counted.

Defined results.  Null or empty text: the machine's score of no terms.  Without both labels in the
sample the score is 0.  Null ids are not learned from and not held out.  An id with several labels
counts once for each; labels of unknown ids are ignored.  Repeated rows score alike; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm.decontam import lower_texts
from fairsketch.llm.langid import held_out
from fairsketch.llm.words import U64

SPACE = 22
PREFIXES = (4, 6, 8)
FACTORS = 8
PER_CLASS = 4000
MIN_ROWS = 4
MIN_Z = 4.0
MAX_TERMS = 30_000
EPOCHS = 25
L2 = 1e-3

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def terms(t) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed term) of every occurrence, words and leading parts."""
    shift = U64(64 - SPACE)
    docs, out = [t.doc], [(t.hashes() >> shift).astype(np.int64)]
    size = t.ends - t.starts
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        # a leading part and a whole word of the same bytes are one term
        docs.append(t.doc[long])
        out.append((t.spans(t.starts[long], t.starts[long] + k) >> shift).astype(np.int64))
    return np.concatenate(docs), np.concatenate(out)


def counted(doc: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, terms, values) in compressed rows: distinct terms of each text with their values."""
    key, count = np.unique((doc << 32) + term, return_counts=True)
    return np.searchsorted(key >> 32, np.arange(n + 1)), key & 0xFFFFFFFF, np.sqrt(count)


@dataclass
class Machine:
    terms: np.ndarray    # hashed terms in order
    weights: np.ndarray
    factors: np.ndarray  # terms x FACTORS
    bias: float

    def score(self, first: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Probabilities of rows in compressed form over places in ``terms``."""
        def add(x):
            total = np.zeros((len(x) + 1, *x.shape[1:]))
            np.cumsum(x, axis=0, out=total[1:])
            return total[first[1:]] - total[first[:-1]]
        vx = self.factors[place] * value[:, None]
        z = self.bias + add(self.weights[place] * value) + 0.5 * (add(vx) ** 2 - add(vx ** 2)).sum(1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], shares: dict[int, float], seed: int = 5) -> Machine | None:
    """Trains on (label, terms, values) rows; ``shares``: the fraction of each label that was sampled."""
    y = np.array([r[0] for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        return None
    every = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    value = np.concatenate([r[2] for r in rows])
    known, inverse = np.unique(every, return_inverse=True)
    n1, n0 = y.sum(), len(y) - y.sum()
    c1 = np.bincount(inverse, weights=y[owner], minlength=len(known))
    c = np.bincount(inverse, minlength=len(known))
    p1, p0, p = c1 / n1, (c - c1) / n0, c / len(y)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    z[(c < MIN_ROWS) | (z < MIN_Z)] = 0
    chosen = np.sort(np.argsort(-z, kind="stable")[:MAX_TERMS])
    chosen = chosen[z[chosen] > 0]
    place = np.full(len(known), -1)
    place[chosen] = np.arange(len(chosen))
    use = place[inverse] >= 0
    place, owner, value = place[inverse][use], owner[use], value[use]
    first = np.searchsorted(owner, np.arange(len(rows) + 1))

    rng = np.random.default_rng(seed)
    k = len(chosen)
    theta = np.concatenate([np.zeros((k, 1)), rng.normal(0, 0.02, (k, FACTORS))], 1)
    bias, m, v = 0.0, np.zeros_like(theta), np.zeros_like(theta)
    mb = vb = 0.0
    weight = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * n0))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 128):
            pick = order[lo:lo + 128]
            size = first[pick + 1] - first[pick]
            cut = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(first[pick] - cut[:-1], size) + np.arange(cut[-1])
            i, x = place[at], value[at][:, None]
            row = np.repeat(np.arange(len(pick)), size)
            vx = theta[i, 1:] * x
            sums = np.zeros((len(pick), FACTORS))
            np.add.at(sums, row, vx)
            z_ = bias + np.bincount(row, theta[i, 0] * x[:, 0], len(pick)) + 0.5 * (
                (sums ** 2).sum(1) - np.bincount(row, (vx ** 2).sum(1), len(pick)))
            d = (1 / (1 + np.exp(-np.clip(z_, -30, 30))) - y[pick]) * weight[pick] / len(pick)
            touched, back = np.unique(i, return_inverse=True)
            g = np.zeros((len(touched), FACTORS + 1))
            each = np.concatenate([x, x * (sums[row] - vx)], 1) * d[row][:, None]
            np.add.at(g, back, each)
            g += L2 * theta[touched]
            step += 1
            m[touched] += 0.1 * (g - m[touched])
            v[touched] += 0.01 * (g * g - v[touched])
            theta[touched] -= 0.02 * m[touched] / (np.sqrt(v[touched]) + 1e-6)
            gb = d.sum()
            mb += 0.1 * (gb - mb)
            vb += 0.01 * (gb * gb - vb)
            bias -= 0.02 * mb / (vb ** 0.5 + 1e-6)
    # balanced weights and sampling made the labels even; the rows' own odds come back here
    bias += np.log((n1 / shares[1]) / (n0 / shares[0])) / 2
    return Machine(known[chosen], theta[:, 0].copy(), theta[:, 1:].copy(), float(bias))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = PER_CLASS) -> Machine | None:
    """Fits the machine on a sample of the labelled rows that are not held out, about ``per_class`` rows a label.

    Ids are drawn first; where ids repeat, their rows are drawn again, and rows alike in id and text count once.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id")).distinct()
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    shares = {k: min(1.0, per_class / n) for k, n in counts.items()}
    limit = F.when(F.col("label") == 1, shares[1]).otherwise(shares[0])
    chosen = marks.where(F.pmod(F.xxhash64("id", F.lit("toxicity sample")), F.lit(1 << 30)) < limit * (1 << 30))

    def run(batches):
        for b in batches:
            for lo, hi, t in lower_texts(b.column(0)):
                first, term, value = counted(*terms(t), t.n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(1)[lo:hi], pa.array([term[x:y].astype("<i4").tobytes() for x, y in zip(first, first[1:])], pa.binary()),
                     pa.array([value[x:y].astype("<f4").tobytes() for x, y in zip(first, first[1:])], pa.binary())],
                    names=["label", "terms", "values"])

    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null") \
        .join(F.broadcast(chosen), "id")
    found = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if max(found.values(), default=0) > 2 * per_class:  # an id of very many rows was drawn
        part = {k: min(1.0, per_class / found.get(k, 1)) for k in (0, 1)}
        again = F.when(F.col("label") == 1, part[1]).otherwise(part[0])
        shares = {k: shares[k] * part[k] for k in shares}
        sample = sample.withColumn("_row", F.xxhash64("id", "text", F.lit("toxicity rows"))) \
            .where(F.pmod("_row", F.lit(1 << 30)) < again * (1 << 30)).dropDuplicates(["_row", "label"])
    rows = sample.select("text", "label").mapInArrow(run, "label int, terms binary, values binary").collect()
    return fit([(a, np.frombuffer(b, "<i4").astype(np.int64), np.frombuffer(c, "<f4").astype(np.float64))
                for a, b, c in sorted((r["label"], bytes(r["terms"]), bytes(r["values"])) for r in rows)], shares)


def toxicity(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""

    def run(batches):
        place = np.full(1 << SPACE, -1, np.int32)
        if machine is not None:
            place[machine.terms] = np.arange(len(machine.terms))
        for b in batches:
            for lo, hi, t in lower_texts(b.column(2)):
                score = np.zeros(t.n)
                if machine is not None:
                    doc, term = terms(t)
                    known = place[term] >= 0
                    first, term, value = counted(doc[known], term[known], t.n)
                    score = machine.score(first, place[term], value)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], b.column(1)[lo:hi], pa.array(score, pa.float64()), pa.array(score >= 0.5).cast(pa.int32())],
                    names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
