"""Operator 6, language identification: a byte convolutional network trained in numpy.

Bytes fall into 128 classes (folded ASCII letters, space, digit, sign, lead and continuation bytes).
A window of ``WINDOW`` bytes is embedded, convolved with filters of several widths, rectified, pooled
to each filter's maximum and classified by softmax.  Every text is cut whole into such windows (the
last one padded); a text's prediction is the mean of its windows' probabilities weighted by letters.

Training takes a bounded sample: about ``PER_LANGUAGE`` labelled rows of each language, spread by a hash of
id and text, with at most ``TRAIN_WINDOWS`` windows each.  Rows alike in id, text and language count once, so
neither a hot id nor a row of very many copies decides the sample's size.  That many short byte strings reach
the driver at any input size; more than ``MAX_LANGUAGES`` labels are refused.  Rows whose crc32(id as text) is a multiple of ``HOLD_OUT`` are held out.  The model (a few
thousand numbers) goes to the tasks; scoring is one pass without a shuffle.

In scoring, embedding and filters are folded into tables over byte-class pairs, so a window costs a
few table rows a byte and no multiplication.

Defined results.  Null text, or a text without any letter: ``und`` with score 0.  Without labelled rows
every prediction is ``und``.  Null ids are not learned from and are not held out.  Repeated rows are
scored alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairsketch.llm.words import buffers, byte_table, sums

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
CLASSES = 128
PER_LANGUAGE = 800
MAX_LANGUAGES = 1000
TRAIN_WINDOWS = 3
EPOCHS = 6
HOLD_OUT = 5
BLOCK = 256  # windows scored at a time

_PAD = 26
_BYTE_CLASS = np.full(256, 28, np.uint8)
_BYTE_CLASS[97:123] = np.arange(26)
_BYTE_CLASS[65:91] = np.arange(26)
_BYTE_CLASS[byte_table((0x20, 0x20), (0x09, 0x0D))] = _PAD
_BYTE_CLASS[48:58] = 27
_BYTE_CLASS[0xC0:] = 32 + (np.arange(0xC0, 0x100) & 63) // 2
_BYTE_CLASS[0x80:0xC0] = 64 + np.arange(64)
_LETTER = byte_table((65, 90), (97, 122), (0xC0, 0xFF))
_ASCII_LETTER = byte_table((65, 90), (97, 122))


def held_out(id_col: str) -> Column:
    """True for ids whose crc32 (of the id as text) is a multiple of five; false for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray            # CLASSES x EMBED
    filters: list[np.ndarray]    # width x EMBED x FILTERS
    bias: list[np.ndarray]
    dense: np.ndarray            # len(WIDTHS) * FILTERS x languages
    out_bias: np.ndarray


def _unfold(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` neighbouring embeddings: (windows, places, width * EMBED)."""
    n, places, e = x.shape
    return np.lib.stride_tricks.sliding_window_view(x, width, axis=1).transpose(0, 1, 3, 2).reshape(n, places - width + 1, width * e)


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Trains by Adam on cross entropy.  windows: byte classes (n, WINDOW); labels: places in ``languages``."""
    rng = np.random.default_rng(seed)
    k, hidden = len(languages), len(WIDTHS) * FILTERS
    params = [rng.normal(0, 0.5, (CLASSES, EMBED))]
    params += [rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)) for w in WIDTHS]
    params += [np.zeros(FILTERS) for _ in WIDTHS] + [rng.normal(0, hidden ** -0.5, (hidden, k)), np.zeros(k)]
    params = [p.astype(np.float32) for p in params]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.bincount(labels, minlength=k).astype(np.float32)
    weight = (len(labels) / np.maximum(share, 1) / k)[labels]
    step, nw = 0, len(WIDTHS)
    for _ in range(EPOCHS if len(labels) else 0):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), 64):
            pick = order[lo:lo + 64]
            x, y, n = windows[pick], labels[pick], len(pick)
            # a third of the windows are shown as short texts
            show = np.where(rng.random(n) < 0.33, rng.integers(6, WINDOW, n), WINDOW)
            x = np.where(np.arange(WINDOW) < show[:, None], x, _PAD)
            e = params[0][x]
            unfolded = [_unfold(e, w) for w in WIDTHS]
            raw = [u @ params[1 + i] + params[1 + nw + i] for i, u in enumerate(unfolded)]
            where = [r.argmax(1) for r in raw]
            top = np.concatenate([np.take_along_axis(r, a[:, None], 1)[:, 0] for r, a in zip(raw, where)], 1)
            pooled = np.maximum(top, 0)
            z = pooled @ params[-2] + params[-1]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            dz = p
            dz[np.arange(n), y] -= 1
            dz *= (weight[pick] / n)[:, None]
            grads = [np.zeros_like(q) for q in params]
            grads[-2], grads[-1] = pooled.T @ dz, dz.sum(0)
            dtop = (dz @ params[-2].T) * (top > 0)
            for i, w in enumerate(WIDTHS):
                d = dtop[:, i * FILTERS:(i + 1) * FILTERS]                      # n x FILTERS
                at = where[i]
                rows = unfolded[i][np.arange(n)[:, None], at]                   # n x FILTERS x w*EMBED
                grads[1 + i] = np.einsum("nf,nfk->kf", d, rows)
                grads[1 + nw + i] = d.sum(0)
                back = (d[:, :, None] * params[1 + i].T[None]).reshape(n, FILTERS, w, EMBED)
                cls = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(w)]
                np.add.at(grads[0], cls, back)
            step += 1
            for q, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= 0.004 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return Network(languages, params[0], [params[1 + i].reshape(w, EMBED, FILTERS) for i, w in enumerate(WIDTHS)],
                   params[1 + nw:1 + 2 * nw], params[-2], params[-1])


class Scorer:
    """The network as tables over pairs of byte classes."""

    def __init__(self, net: Network):
        self.net = net
        single = [[net.embed @ f[j] for j in range(len(f))] for f in net.filters]
        first, self.rest = [], []
        for i, parts in enumerate(single):
            first.append(self._pair(parts[0] + net.bias[i], parts[1]))
            more = []
            for j in range(2, len(parts), 2):
                more.append((j, self._pair(parts[j], parts[j + 1]) if j + 1 < len(parts) else parts[j], j + 1 < len(parts)))
            self.rest.append(more)
        self.first = np.ascontiguousarray(np.concatenate(first, 1), np.float32)

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray((a[:, None] + b[None]).reshape(CLASSES * CLASSES, FILTERS), np.float32)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.languages)))
        for lo in range(0, len(windows), BLOCK):
            x = windows[lo:lo + BLOCK].astype(np.int64)
            pair = x[:, :-1] * CLASSES + x[:, 1:]
            base = self.first[pair]
            pooled = []
            for i, w in enumerate(WIDTHS):
                places = WINDOW - w + 1
                r = base[:, :places, i * FILTERS:(i + 1) * FILTERS]
                for j, part, double in self.rest[i]:
                    r = r + part[(pair if double else x)[:, j:j + places]]
                pooled.append(r.max(1))
            z = np.maximum(np.concatenate(pooled, 1), 0) @ self.net.dense + self.net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            out[lo:lo + BLOCK] = p / p.sum(1, keepdims=True)
        return out


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, text of each, letters of each): all bytes of all texts, each text's last window padded."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    start = offsets[text] + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < offsets[text + 1][:, None]
    raw = data[np.where(inside, at, 0)] if len(data) else np.zeros(at.shape, np.uint8)
    windows = np.where(inside, _BYTE_CLASS[raw], _PAD).astype(np.uint8)
    return windows, text, (inside & _LETTER[raw]).sum(1)


def _batches(col, size: int = 1 << 20):
    data, offsets = buffers(col)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, min(len(offsets) - 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Network:
    """Fits the network on a bounded sample of the labelled rows that are not held out."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")) \
        .where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    counts = {r["lang"]: max(1, r["n"]) for r in labelled.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("id", "text")).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values: not a language label")
    if not counts:
        return fit(np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), [])
    limit = F.create_map(*(F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, per_language / n))))[F.col("lang")]
    chosen = labelled.where(F.pmod(F.xxhash64("id", "text", F.lit("language sample")), F.lit(1 << 30)) < limit * (1 << 30)) \
        .dropDuplicates(["id", "text", "lang"])

    def run(batches):
        for b in batches:
            for lo, hi, data, offsets in _batches(b.column(0)):
                windows, text, letters = cut_windows(data, offsets)
                windows, text = windows[letters >= 4], text[letters >= 4]
                nth = np.arange(len(text)) - np.searchsorted(text, text)
                total = np.bincount(text, minlength=hi - lo)[text]
                # evenly spread over the text
                use = np.unique(text * (1 << 32) + nth * TRAIN_WINDOWS // np.maximum(total, TRAIN_WINDOWS), return_index=True)[1]
                yield pa.RecordBatch.from_arrays([b.column(1).take(pa.array(text[use] + lo)),
                                                  pa.array([w.tobytes() for w in windows[use]], pa.binary())], names=["lang", "window"])

    rows = sorted((r["lang"], bytes(r["window"])) for r in chosen.select("text", "lang").mapInArrow(run, "lang string, window binary").collect())
    languages = sorted({lang for lang, _ in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    return fit(windows, np.array([place[lang] for lang, _ in rows], np.int64), languages)


def score_column(col, scorer: Scorer) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    names, scores = [], []
    languages = scorer.net.languages
    for lo, hi, data, offsets in _batches(col):
        if not languages:
            names += [UNKNOWN] * (hi - lo)
            scores += [0.0] * (hi - lo)
            continue
        windows, text, letters = cut_windows(data, offsets)
        some = letters > 0
        p = scorer.probabilities(windows[some]) * letters[some][:, None]
        first = np.searchsorted(text[some], np.arange(hi - lo + 1))
        total = np.concatenate([np.zeros((1, len(languages))), np.cumsum(p, axis=0)])
        mass = sums(letters[some], first)
        mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(mass, 1)[:, None]
        best = mean.argmax(1)
        ascii_letters = sums(_ASCII_LETTER[data], offsets)
        for i in range(hi - lo):
            # without ASCII letters, ask the characters themselves
            known = ascii_letters[i] > 0 or (mass[i] > 0 and any(
                c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")))
            names.append(languages[best[i]] if known else UNKNOWN)
            scores.append(min(1.0, max(0.0, float(mean[i, best[i]]))) if known else 0.0)
    return names, np.array(scores)


def identify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, the ``others`` (and with them the text) for every row of ``docs``.

    Only texts go to Python and only predictions come back; the other columns wait in the JVM.
    """

    @F.arrow_udf("lang_pred string, score double")
    def told(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(net)
        for column in columns:
            names, scores = score_column(column, scorer)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    # not deterministic, so that a filter on the prediction does not ask for it a second time
    told = told.asNondeterministic()
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), told(text).alias("told"),
                       *([text.alias(text_col)] if others else []), *others) \
        .select("doc_id", "held_out", "told.*", *([text_col] if others else []), *others)
