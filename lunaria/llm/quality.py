"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts in numpy; trees are grown on the driver from a bounded labelled
sample, flattened into heap-ordered arrays, and scored by indexing all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, bounded_sample, held_out, text_chunks

#: Documented bound of the labelled rows that the trees are fitted on (all other steps cover all data).
FIT_ROWS = 20_000
THRESHOLD = 0.3
WINDOW = 32

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_ALPHA[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46, 59, 58, 63, 39, 34, 40, 41, 45]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL &= ~(_UPPER | _DIGIT | _ALPHA | _STOP)

NAMES = ("words", "word_mean", "word_sd", "upper", "digit", "symbol", "stop", "ends_symbol", "bare_symbol", "repeat", "distinct", "top_word", "short", "lines", "line_repeat", "window_worst", "window_bad", "window_mean", "window_short")


def _per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over consecutive ranges (empty ranges give 0)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of NAMES for each document; a text without words gives zeros."""
    docs = len(offsets) - 1
    w = Words(data, offsets, fold=False)
    first, n = w.doc_first, np.maximum(np.diff(w.doc_first), 1)
    size = np.maximum(np.diff(offsets), 1)
    total = len(w.starts)
    doc_of = np.repeat(np.arange(docs), np.diff(first))
    last_byte = data[w.starts + w.lengths - 1]  # words hold no white space
    ends_symbol = _SYMBOL[last_byte]
    bare = ends_symbol & (w.lengths == 1)
    repeat = np.zeros(total, bool)
    repeat[1:] = (w.hashes[1:] == w.hashes[:-1]) & (doc_of[1:] == doc_of[:-1])
    short = w.lengths <= 3
    upper_at = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shouted = (upper_at[w.starts + w.lengths] - upper_at[w.starts]) * 2 > w.lengths
    shouted &= w.lengths > 1
    key = np.sort((doc_of.astype(np.uint64) << np.uint64(44)) | (w.hashes >> np.uint64(20)))
    fresh = np.ones(total, bool)
    fresh[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, total))
    distinct = np.bincount((key[at] >> np.uint64(44)).astype(np.int64), minlength=docs)
    top = np.zeros(docs)
    np.maximum.at(top, (key[at] >> np.uint64(44)).astype(np.int64), runs)
    newline = data == 10
    line_of_word = np.concatenate([[0], np.cumsum(newline)])[w.starts]
    line_key = np.zeros(0, np.uint64)
    line_docs = np.zeros(0, np.int64)
    if total:
        new = np.ones(total, bool)
        new[1:] = (line_of_word[1:] != line_of_word[:-1]) | (doc_of[1:] != doc_of[:-1])
        starts = np.flatnonzero(new)
        line_docs = doc_of[starts]
        sums = np.add.reduceat(w.hashes * (np.arange(total, dtype=np.uint64) - np.repeat(starts, np.diff(np.append(starts, total))).astype(np.uint64) + np.uint64(1)), starts)
        line_key = np.sort((line_docs.astype(np.uint64) << np.uint64(44)) | (sums >> np.uint64(20)))
    line_fresh = np.ones(len(line_key), bool)
    line_fresh[1:] = line_key[1:] != line_key[:-1]
    lines = np.bincount(line_docs, minlength=docs)
    own_lines = np.bincount((line_key[line_fresh] >> np.uint64(44)).astype(np.int64), minlength=docs)
    junk = (ends_symbol | repeat | shouted).astype(np.float64)
    count = -(-np.diff(first) // WINDOW)
    wdoc = np.repeat(np.arange(docs), count)
    within = np.arange(len(wdoc)) - np.repeat(np.cumsum(count) - count, count)
    ws = first[:-1][wdoc] + within * WINDOW
    we = np.minimum(ws + WINDOW, first[1:][wdoc])
    cum, cum_short = (np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)]) for x in (junk, short))
    share = (cum[we] - cum[ws]) / np.maximum(we - ws, 1)
    share_short = (cum_short[we] - cum_short[ws]) / np.maximum(we - ws, 1)
    worst, least_short, bad = np.zeros(docs), (count > 0) * 1.0, np.bincount(wdoc, share > 0.5, docs)
    np.maximum.at(worst, wdoc, share)
    np.minimum.at(least_short, wdoc, share_short)
    mean = _per_doc(w.lengths, first) / n
    spread = np.sqrt(np.maximum(_per_doc(w.lengths.astype(np.float64) ** 2, first) / n - mean**2, 0))
    windows = np.maximum(count, 1)
    out = [
        np.log1p(np.diff(first)), mean, spread,
        _per_doc(_UPPER[data], offsets) / size, _per_doc(_DIGIT[data], offsets) / size, _per_doc(_SYMBOL[data], offsets) / size, _per_doc(_STOP[data], offsets) / size,
        _per_doc(ends_symbol, first) / n, _per_doc(bare, first) / n, _per_doc(repeat, first) / n, distinct / n, top / n, _per_doc(short, first) / n,
        lines / n, (lines - own_lines) / np.maximum(lines, 1), worst, bad / windows, np.bincount(wdoc, share, docs) / windows, least_short,
    ]
    return np.column_stack(out).astype(np.float32)


class Trees:
    """Flattened trees: node k of a tree has children 2k+1 and 2k+2; leaves hold values."""

    def __init__(self, depth: int, base: float):
        self.depth, self.base = depth, base
        self.feature = np.zeros((0, 2**depth - 1), np.int32)
        self.threshold = np.zeros((0, 2**depth - 1), np.float32)
        self.value = np.zeros((0, 2**depth), np.float64)

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, trees = len(x), len(self.value)
        if not trees or not rows:
            return np.full(rows, 1 / (1 + np.exp(-self.base)))
        node, t, r = np.zeros((rows, trees), np.int64), np.arange(trees)[None, :], np.arange(rows)[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[r, self.feature[t, node]] > self.threshold[t, node])
        return 1 / (1 + np.exp(-(self.base + self.value[t, node - (2**self.depth - 1)].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, smooth: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss over histograms. Without rows the score is 0.5;
    with one class only it is that class's smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Trees(depth, float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])  # code > k means x > cuts[k]
    width, k = bins, x.shape[1]
    flat = codes + np.arange(k) * width
    margin = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(2**depth - 1, np.int32), np.full(2**depth - 1, np.inf, np.float32)
        for level in range(depth):
            here = 2**level
            at = ((node - (here - 1)) * (k * width))[:, None] + flat
            hg, hh = (np.bincount(at.ravel(), np.repeat(v, k), here * k * width).reshape(here, k, width) for v in (g, h))
            lg, lh = np.cumsum(hg, 2), np.cumsum(hh, 2)
            tg, th = lg[:, :1, -1:], lh[:, :1, -1:]
            gain = lg**2 / (lh + smooth) + (tg - lg) ** 2 / (th - lh + smooth) - tg**2 / (th + smooth)
            gain[(lh < 1) | (th - lh < 1)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c) :] = 0
            best = gain.reshape(here, -1).argmax(1)
            for i, b in enumerate(best):
                if gain.reshape(here, -1)[i, b] > 1e-6:
                    feature[here - 1 + i], threshold[here - 1 + i] = b // width, cuts[b // width][b % width]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - (2**depth - 1)
        value = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + smooth)
        margin += value[leaf]
        model.feature = np.vstack([model.feature, feature])
        model.threshold = np.vstack([model.threshold, threshold])
        model.value = np.vstack([model.value, value])
    return model


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_chunks(batch.column(1)):
            x = statistics(data, offsets)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], flat], ["label", "x"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int = FIT_ROWS) -> DataFrame:
    """(label double, text) of about `most` labelled, not held-out documents: only the sampled ids are
    broadcast, and only their texts leave the scan. Of repeated labels of an id the largest counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(~held_out()).groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    chosen = bounded_sample(known, "doc_id", most).select(F.col("doc_id").alias("__id"), "label")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("label", "text")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = FIT_ROWS) -> Trees:
    rows = labelled_sample(docs, labels, label, most).mapInArrow(_statistic_rows, "label double, x array<float>").toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, len(NAMES)), np.float32), np.zeros(0))
    rows = rows.combine_chunks()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
    y = (rows.column("label").to_numpy() > 0).astype(np.float64)
    order = np.lexsort([*x.T, y])  # the order of arrival must not matter
    return fit(x[order], y[order])


def with_score(docs: DataFrame, model, column: str = "score", text_col: str = "text") -> DataFrame:
    """docs, all columns and rows unchanged, with the model's score (0 to 1) of the whole text.
    `model` has score_texts(data, offsets) or is a Trees."""
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    rate = model.score_texts if hasattr(model, "score_texts") else (lambda d, o: model.score(statistics(d, o)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.concatenate([rate(d, o) for _, _, d, o in text_chunks(batch.column(at))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Learns from labels of documents that are not held out; scores use the text alone. A null text is
    scored as the empty one (all statistics 0). Null labels and labels of unknown documents are
    ignored; without labels every score is 0.5. Repeated rows get equal scores. An empty table gives
    an empty result.
    """
    own = docs.select("doc_id", "text")
    scored = with_score(own, train(own, labels, label))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
