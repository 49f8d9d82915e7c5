"""Operator 2, benchmark decontamination: BM25 over an inverted index of test items, block-max WAND.

The index holds the test items: for each term its items with their BM25 impacts, divided by the item's
score for its own words, so a passage that holds all of an item scores 1 whatever the item.  Items stand
in blocks of ``BLOCK``; the index keeps each term's largest impact in each block.

Item count, document frequencies and mean length are those of the whole table of items.  Items fall into
classes of similar length, and for each class every text is cut into overlapping passages wide enough that
any of its items lies whole inside one; each passage is a query.  For a batch of passages at once:

1. Terms are ordered by their largest impact; the longest prefix whose impacts add up to less than the
   threshold can reach it alone for no item.  A passage without any other term is skipped.
2. For the others, summed block maxima bound the score in each block; blocks below the threshold are
   skipped.
3. The items of the remaining blocks are scored exactly from their postings; all at or above the
   threshold are retrieved.
4. A retrieved item is a leak if enough of the word n-grams of its question and of its answer stand
   in the passage; a part without words asks for none.

The index is sent to the tasks in shards of at most ``SHARD`` items (a bounded table), one pass over the
texts a shard; the texts are never shuffled, and a hot item or source costs its own rows only.  Which items
share a shard changes no result: statistics and passage widths come from one aggregate over all items, of
which the driver reads a shard's own words.

An item's answer is what follows its last question mark; without one, its last sentence; if that is all,
its last quarter of words.

Defined results.  Null or empty texts and items match nothing.  Null ids pass through.  A text that holds
an item several times gives one row, its best passage (the earliest on ties).  Repeated rows are scored
alike; repeated items give a row each.  Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm.words import LETTERS_DIGITS, U64, Text, sequence, string_column, texts, word_sums
from fairsketch.session import checkpoint_root

K1, B_LENGTH = 1.2, 0.75
THRESHOLD = 0.5
QUESTION, ANSWER = 0.5, 0.5
GRAM = 3
BLOCK = 8
SHARD = 1024
MIN_STRIDE = 32
FIRST_CLASS = 64

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long, last_word long"


def question_and_answer(text: str) -> tuple[str, str]:
    """The item's two parts; both non-empty if it has at least two words."""
    cut = text.rfind("?") + 1
    if not (cut and text[cut:].strip()):
        ends = [m.end() for m in re.finditer(r"[.!?](?=\s)", text.rstrip())]
        cut = ends[-1] if ends else 0
    if not text[:cut].strip():
        spaces = [m.start() for m in re.finditer(r"\s+(?=\S)", text.strip())]
        lead = len(text) - len(text.lstrip())
        cut = lead + (spaces[len(spaces) * 3 // 4] if spaces else 0)
    return text[:cut], text[cut:]


def lower_texts(col) -> Iterator[tuple[int, int, Text]]:
    """Slices of a column in lower case (all alphabets, so that copies in other case match)."""
    return texts(pc.utf8_lower(string_column(col)), LETTERS_DIGITS)


def _words(text: str) -> np.ndarray:
    for _, _, t in lower_texts(pa.array([text])):
        return t.hashes()


def _grams(h: np.ndarray) -> np.ndarray:
    k = min(GRAM, len(h))
    if not k:
        return np.zeros(0, U64)
    at = np.arange(len(h) - k + 1)
    return np.unique(sequence(word_sums(h), at, at + k))


@dataclass
class Index:
    ids: list
    vocabulary: np.ndarray   # term fingerprints in order
    first: np.ndarray        # postings of term t: first[t]..first[t + 1]
    items: np.ndarray
    impacts: np.ndarray
    block_max: np.ndarray    # terms x blocks
    essential: np.ndarray    # terms without which no score reaches the threshold
    question: list[np.ndarray]
    answer: list[np.ndarray]
    stride: int
    threshold: float


@dataclass
class Statistics:
    n: int                   # items with a word
    mean: float              # their mean length
    longest: dict[int, int]  # by length class
    terms: np.ndarray        # in order; at least those of the items to be indexed
    df: np.ndarray


def length_class(n: int) -> int:
    """0 up to ``FIRST_CLASS`` words; each further class is twice as wide."""
    return max(0, (-(-n // FIRST_CLASS) - 1).bit_length())


def build(items: list[tuple], threshold: float = THRESHOLD, whole: Statistics | None = None) -> Index | None:
    """The index of (id, text) items; items without a word are left out.

    Without ``whole``, the items are the whole table.  With it, they are of one length class.
    """
    kept = [(i, t, w) for i, t in items if t for w in [_words(t)] if len(w)]
    if not kept:
        return None
    # items of similar length side by side, so that block maxima stay close to their items
    kept.sort(key=lambda x: (len(x[2]), x[1], str(x[0])))
    lengths = np.array([len(w) for _, _, w in kept])
    owner = np.repeat(np.arange(len(kept)), lengths)
    vocabulary, term = np.unique(np.concatenate([w for _, _, w in kept]), return_inverse=True)
    key, tf = np.unique(term.astype(np.int64) * len(kept) + owner, return_counts=True)
    term, item = key // len(kept), key % len(kept)
    if whole:
        n, mean, df = whole.n, whole.mean, whole.df[np.searchsorted(whole.terms, vocabulary)]
        longest = whole.longest[length_class(int(lengths.max()))]
    else:
        n, mean, df = len(kept), lengths.mean(), np.bincount(term, minlength=len(vocabulary))
        longest = int(lengths.max())
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B_LENGTH + B_LENGTH * lengths[item] / mean))
    impact /= np.bincount(item, weights=impact, minlength=len(kept))[item]
    blocks = -(-len(kept) // BLOCK)
    top = np.zeros((len(vocabulary), blocks), np.float32)
    np.maximum.at(top, (term, item // BLOCK), impact)
    best = top.max(1).astype(np.float64)
    order = np.argsort(best, kind="stable")
    essential = np.ones(len(vocabulary), bool)
    essential[order[np.cumsum(best[order]) < threshold - 1e-6]] = False
    parts = [question_and_answer(t) for _, t, _ in kept]
    return Index([i for i, _, _ in kept], vocabulary, np.searchsorted(term, np.arange(len(vocabulary) + 1)), item, impact,
                 top, essential, [_grams(_words(q)) for q, _ in parts], [_grams(_words(a)) for _, a in parts],
                 max(MIN_STRIDE, longest), threshold)


def _overlap(have: np.ndarray, grams: np.ndarray) -> float:
    return float(np.isin(grams, have).mean()) if len(grams) else 0.0


def retrieved(t: Text, index: Index) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item's place, score, first word, end word) of every passage and item at or above the threshold."""
    h = t.hashes()
    if not len(h):
        return
    place = np.minimum(np.searchsorted(index.vocabulary, h), len(index.vocabulary) - 1)
    known = np.flatnonzero(index.vocabulary[place] == h)
    term, doc = place[known], t.doc[known]
    # passage p of a text: words p * stride .. (p + 2) * stride
    count = np.maximum(-(-t.counts // index.stride) - 1, 1)
    base = np.concatenate([[0], np.cumsum(count)])
    part = (known - t.first[doc]) // index.stride
    passage = np.concatenate([base[doc] + np.minimum(part, count[doc] - 1), base[doc] + part - 1])
    both = np.concatenate([np.ones(len(part), bool), (part >= 1) & (part - 1 < count[doc] - 1)])
    term = np.concatenate([term, term])[both]
    passage = passage[both]
    live = np.zeros(base[-1], bool)
    live[passage[index.essential[term]]] = True
    use = live[passage]
    if not use.any():
        return
    pair = np.unique(passage[use] * len(index.vocabulary) + term[use])
    passage, term = pair // len(index.vocabulary), pair % len(index.vocabulary)
    cut = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    ends = np.append(cut[1:], len(passage))
    step = max(1, (1 << 22) // index.block_max.shape[1])  # term rows gathered at a time
    lo = 0
    while lo < len(cut):
        hi = max(lo + 1, int(np.searchsorted(ends, cut[lo] + step, "right")))
        bound = np.add.reduceat(index.block_max[term[cut[lo]:ends[hi - 1]]], cut[lo:hi] - cut[lo], axis=0)
        reach = bound >= index.threshold - 1e-4  # block maxima are rounded
        for i in np.flatnonzero(reach.any(1)).tolist():
            p = int(passage[cut[lo + i]])
            score = np.zeros(len(index.ids))
            for x in term[cut[lo + i]:ends[lo + i]].tolist():
                a, b = index.first[x], index.first[x + 1]
                score[index.items[a:b]] += index.impacts[a:b]
            d = int(np.searchsorted(base, p, "right")) - 1
            a = int(t.first[d] + (p - base[d]) * index.stride)
            b = int(min(a + 2 * index.stride, t.first[d + 1]))
            score[~np.repeat(reach[i], BLOCK)[:len(score)]] = 0
            for k in np.flatnonzero(score >= index.threshold - 1e-9).tolist():
                yield d, k, float(score[k]), a, b
        lo = hi


def leaks_of(t: Text, index: Index, question: float, answer: float) -> dict[tuple[int, int], tuple]:
    """(text, item's place) -> (score, question overlap, answer overlap, first word, last word), places within the text."""
    out: dict[tuple[int, int], tuple] = {}
    total = word_sums(t.hashes())
    for d, k, score, a, b in retrieved(t, index):
        have = np.concatenate([sequence(total, at, at + g) for g in range(1, GRAM + 1) if b - a >= g
                               for at in [np.arange(a, b - g + 1)]])
        q, w = _overlap(have, index.question[k]), _overlap(have, index.answer[k])
        # one-word items have no question, and an answer may be signs only
        if (q >= question or not len(index.question[k])) and (w >= answer or not len(index.answer[k])) and ((d, k) not in out or score > out[d, k][0] + 1e-12):
            out[d, k] = (score, q, w, a - int(t.first[d]), b - 1 - int(t.first[d]))
    return out


def _statistics(items: DataFrame) -> DataFrame:
    """(kind, key, n, most) over all items: 0 a term's document frequency, 1 a length class's items and longest length, 2 all words."""
    names = ["kind", "key", "n", "most"]

    def run(batches):
        for b in batches:
            for _, _, t in lower_texts(b.column(0)):
                h = t.hashes()
                order = np.lexsort((h, t.doc))
                d, w = t.doc[order], h[order]
                new = np.ones(len(w), bool)
                new[1:] = (d[1:] != d[:-1]) | (w[1:] != w[:-1])
                terms, df = np.unique(w[new], return_counts=True)
                out = [(0, x, n, 0) for x, n in zip(terms.view(np.int64).tolist(), df.tolist())]
                out += [(1, length_class(n), 1, n) for n in t.counts.tolist() if n] + [(2, 0, len(h), 0)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)

    return items.mapInArrow(run, "kind long, key long, n long, most long").groupBy("kind", "key").agg(
        F.sum("n").alias("n"), F.max("most").alias("most"))


def shards(items: DataFrame, id_col: str, text_col: str, threshold: float) -> Iterator[list[Index]]:
    """Indexes of at most ``SHARD`` items together, one a length class, read one after another."""
    spark = items.sparkSession
    checkpoint_root(spark)
    counted = _statistics(items.select(F.col(text_col).cast("string").alias("text"))).checkpoint()
    sizes = counted.where("kind > 0").collect()  # a row a length class, and one
    n = sum(r.n for r in sizes if r.kind == 1)
    if not n:
        return
    mean = sum(r.n for r in sizes if r.kind == 2) / n
    longest = {r.key: r.most for r in sizes if r.kind == 1}

    def indexes(held):
        held = [(i, t, w) for i, t in held if t for w in [_words(t)] if len(w)]
        if not held:
            return []
        terms = np.unique(np.concatenate([w for _, _, w in held]))
        asked = spark.createDataFrame([(x,) for x in terms.view(np.int64).tolist()], "key long")
        found = counted.where("kind = 0").join(F.broadcast(asked), "key").select("key", "n").toArrow()
        key = found.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        whole = Statistics(n, mean, longest, key[order], found.column("n").to_numpy()[order])
        by: dict[int, list] = {}
        for i, t, w in held:
            by.setdefault(length_class(len(w)), []).append((i, t))
        return [build(by[c], threshold, whole) for c in sorted(by)]

    held = []
    for r in items.select(id_col, F.col(text_col).cast("string")).toLocalIterator():
        held.append((r[0], r[1]))
        if len(held) == SHARD:
            if out := indexes(held):
                yield out
            held = []
    if out := indexes(held):
        yield out


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER,
               id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each text and test item that it leaks."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for indexes in shards(items, item_id_col, item_text_col, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def run(batches, shared=shared):
            for b in batches:
                for lo, hi, t in lower_texts(b.column(1)):
                    hits = [(d, index.ids[k], v) for index in shared.value
                            for (d, k), v in sorted(leaks_of(t, index, question, answer).items())]
                    if hits:
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array([lo + d for d, _, _ in hits])),
                             pa.array([i for _, i, _ in hits], pa.int64()),
                             *(pa.array([v[i] for _, _, v in hits], pa.float64() if i < 3 else pa.int64()) for i in range(5))],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word", "last_word"])

        part = rows.mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionAll(part)
    return docs.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION,
                  answer: float = ANSWER, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that leak an item; columns unchanged, one pass a shard, no shuffle."""
    out = docs
    place = docs.columns.index(text_col)
    for indexes in shards(items, item_id_col, item_text_col, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def run(batches, shared=shared):
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for lo, hi, t in lower_texts(b.column(place)):
                    for index in shared.value:
                        for d, _ in leaks_of(t, index, question, answer):
                            clean[lo + d] = False
                yield b.filter(pa.array(clean))

        out = out.mapInArrow(run, docs.schema)
    return out
