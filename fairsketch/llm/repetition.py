"""Operator 9, quality rules: repetition measured on a suffix array of each whole text.

Each Arrow batch is cut into slices of whole texts.  For a slice, one suffix array holds the word
suffixes of all its texts (prefix doubling; only suffixes whose order is still open are sorted
again).  Neighbours in it give the longest-common-prefix intervals, so each word knows the longest
sequence that starts there and starts again elsewhere in the same text.  The spans of at least
``min_repeat`` words are united; a text fails if they cover more than ``max_covered`` of its words
or if one of them is longer than ``longest`` words.

Work and memory follow the text; rows are independent, so there is no shuffle and no hot key.

Defined results.  Null or empty text: no words, all counts 0, base_failed (under 50 words), not
kept.  Null ids are passed through.  Repeated rows and ties: each row is judged alone.  Extra
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairsketch.llm.words import LETTERS_DIGITS, Text, byte_table, covered, groups, mix, sequence, sums, texts, word_sums

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_WINDOW = 3
MAX_REPEAT_PERCENT = 50

# Limits of the suffix-array rules.
MIN_REPEAT = 10
MAX_COVERED = 0.3
LONGEST = 100

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, covered_words long, longest_repeat long")

_IS_SYMBOL = byte_table(*((b, b) for b in SYMBOLS))
_STEP = np.uint64(0xA24BAED4963EE407)


def of_text(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that are equal for equal values of the same text only."""
    return mix(values ^ ((doc.astype(np.uint64) + np.uint64(1)) * _STEP))


def suffix_array(keys: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions 0..n-1 in suffix order; position i's suffix is keys[i:end[i]].

    ``keys`` of different texts must differ, so that suffixes of one text stay together wherever
    they share a prefix.  Ranks are places of a group's first member; a round of width h orders
    the members of each group by the rank of the suffix h places on.
    """
    n = len(keys)
    order, limits = groups(keys)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(limits[:-1], np.diff(limits))
    open_ = order[np.repeat(np.diff(limits) > 1, np.diff(limits))]
    h = 1
    while len(open_):
        ahead = open_ + h
        inside = ahead < end[open_]
        second = np.zeros(len(open_), np.int64)
        second[inside] = rank[ahead[inside]] + 1
        by, cut = groups(rank[open_] * (n + 1) + second)
        open_, sizes = open_[by], np.diff(cut)
        old = rank[open_]
        base, base_cut = np.unique(old, return_index=True)
        starts = np.repeat(cut[:-1], sizes)
        rank[open_] = old + starts - base_cut[np.searchsorted(base, old)]
        open_ = open_[np.repeat(sizes > 1, sizes)]
        h *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def longest_repeats(text: Text, hashes: np.ndarray, min_repeat: int) -> np.ndarray:
    """For each word, the length of the longest sequence that starts there and elsewhere in its text;
    0 if under ``min_repeat`` words.

    Only words whose first ``min_repeat`` words repeat can have one; when none does, no suffix
    array is needed.
    """
    best = np.zeros(len(hashes), np.int64)
    at, grams = text.grams(hashes, min_repeat)
    if not len(at):
        return best
    order, limits = groups(of_text(grams, text.doc[at]))
    sizes = np.diff(limits)
    if not (sizes > 1).any():
        return best
    # the texts that repeat anything, as one array of words
    some = np.zeros(text.n, bool)
    some[text.doc[at[order[np.repeat(sizes > 1, sizes)]]]] = True
    words = np.flatnonzero(some[text.doc])
    h, doc = hashes[words], text.doc[words]
    counts = text.counts[some]
    end = np.repeat(np.cumsum(counts), counts)
    sa = suffix_array(of_text(h, doc), end)
    a, b = sa[:-1], sa[1:]
    near = doc[a] == doc[b]
    a, b = a[near], b[near]
    # common prefix of neighbours: doubling widths, then halving, on sequence fingerprints
    total = word_sums(h)
    room = np.minimum(end[a] - a, end[b] - b)
    lcp = np.zeros(len(a), np.int64)
    live = np.flatnonzero(room >= min_repeat)
    live = live[sequence(total, a[live], a[live] + min_repeat) == sequence(total, b[live], b[live] + min_repeat)]
    width = 1
    while len(live) and width <= int(room[live].max()):
        width *= 2
    while len(live) and width:
        to = lcp[live] + width
        ok = to <= room[live]
        i, t = live[ok], to[ok]
        same = sequence(total, a[i], a[i] + t) == sequence(total, b[i], b[i] + t)
        lcp[i[same]] = t[same]
        width //= 2
    lcp[lcp < min_repeat] = 0
    longest = np.zeros(len(h), np.int64)
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    best[words] = longest
    return best


def _judge(ids, col, min_repeat: int, max_covered: float, longest: int) -> Iterator[pa.RecordBatch]:
    for lo, hi, t in texts(col):
        hashes = t.hashes()
        n = t.counts
        points = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
        word_chars = sums(points[t.ends] - points[t.starts], t.first)
        n_symbols = sums(_IS_SYMBOL[t.data], t.offsets)

        breaks = np.flatnonzero(t.data == 10)
        ls = np.unique(np.concatenate([t.offsets[:-1], breaks + 1]))
        ls = ls[ls < len(t.data)]
        line_doc = np.searchsorted(t.offsets, ls, "right") - 1
        at_break = np.searchsorted(breaks, ls)
        le = np.where(at_break < len(breaks), np.append(breaks, 0)[np.minimum(at_break, len(breaks))], len(t.data))
        le = np.minimum(le, t.offsets[line_doc + 1])
        wordy = np.searchsorted(t.starts, le) > np.searchsorted(t.starts, ls)
        keys = of_text(t.spans(ls[wordy], le[wordy]), line_doc[wordy])
        _, once = np.unique(keys, return_index=True)
        n_lines = np.bincount(line_doc[wordy], minlength=t.n)
        n_dup_lines = n_lines - np.bincount(line_doc[wordy][once], minlength=t.n)

        at, grams = t.grams(hashes, REPEAT_WINDOW)
        order, limits = groups(of_text(grams, t.doc[at]))
        sizes = np.diff(limits)
        twice = at[order[np.repeat(sizes > 1, sizes)]]
        n_repeat = sums(covered(len(hashes), twice, twice + REPEAT_WINDOW), t.first)

        reps = longest_repeats(t, hashes, min_repeat)
        where = np.flatnonzero(reps)
        n_covered = sums(covered(len(hashes), where, where + reps[where]), t.first)
        top = np.zeros(t.n, np.int64)
        np.maximum.at(top, t.doc[where], reps[where])

        failed = (n < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n)
        kept = ~failed & (n_covered <= max_covered * n) & (top <= longest)
        yield pa.RecordBatch.from_arrays(
            [ids[lo:hi], *(pa.array(x, pa.int64()) for x in (n, word_chars, n_symbols, n_dup_lines, n_repeat)),
             pa.array(failed), pa.array(kept), pa.array(n_covered, pa.int64()), pa.array(top, pa.int64())],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   "base_failed", "kept", "covered_words", "longest_repeat"])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT,
                  max_covered: float = MAX_COVERED, longest: int = LONGEST) -> DataFrame:
    """One row per row of ``docs``: counts, the base rules' verdict, and ``kept``."""

    def run(batches):
        for b in batches:
            yield from _judge(b.column(0), b.column(1), min_repeat, max_covered, longest)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
