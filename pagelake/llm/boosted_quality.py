"""Operator 5: quality classifier, histogram gradient-boosted trees over document statistics.

Statistics come from the bytes of the whole text alone.  Trees are grown in
numpy on the driver from a bounded sample of labelled rows (``PER_CLASS`` of
each class), flattened into three arrays of complete trees, and broadcast; tasks
walk all rows of a batch through a tree level by level.

Defined cases: null and empty texts have zero statistics and get the score the
model gives them; with labels of one class only the score is that class, with
none 0.5; null ids are held out or not by the crc32 of ``''``; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_split, documents_of, materialize, runs, span_hashes, text_blocks, with_row
from .labelled import prior_shift, training_labels

PER_CLASS = 8000
BINS = 64
DEPTH = 4
TREES = 60
RATE = 0.2

_KINDS = {  # byte classes whose share of the text is a statistic
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "blank": [9, 32],
    "line": [10, 13],
    "stop": [46],
    "comma": [44],
    "bang": [33, 63],
    "pipe": [124, 92, 47, 95, 126],
    "symbol": [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 94],
    "bracket": [40, 41, 91, 93, 123, 125],
    "quote": [34, 39, 45, 58, 59, 96],
    "high": [*range(128, 256)],
    "control": [*range(0, 9), 11, 12, *range(14, 32), 127],
}
STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "longest_word", "words_per_line", "distinct_words", "top_word", "repeats_previous",
    "distinct_pairs", "distinct_lines", "symbol_words", "upper_words", *(f"share_{k}" for k in _KINDS),
]
_CLASS = np.full(256, len(_KINDS), np.uint8)
for _i, _bytes in enumerate(_KINDS.values()):
    _CLASS[_bytes] = _i
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """float32 (texts, statistics) of a byte block."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)), np.float32)
    size = np.diff(offsets)
    kind = _CLASS[data]
    owner = np.repeat(np.arange(n), size)
    share = np.bincount(owner * (len(_KINDS) + 1) + kind, minlength=n * (len(_KINDS) + 1)).reshape(n, -1)[:, : len(_KINDS)]
    starts, ends = runs(~_SPACE[data], offsets)
    first = np.searchsorted(starts, offsets)
    words = np.diff(first)
    hashes = span_hashes(data, starts, ends)
    length = ends - starts
    odd = np.concatenate([[0], np.cumsum((kind == 9) | (kind == 7) | (kind == 8), dtype=np.int64)])
    upper = np.concatenate([[0], np.cumsum(kind == 0, dtype=np.int64)])
    odd_word, upper_word = odd[ends] > odd[starts], 2 * (upper[ends] - upper[starts]) > length
    lines, line_ends = runs(data != 10, offsets)
    line_first = np.searchsorted(lines, offsets)
    line_hash = span_hashes(data, lines, line_ends)
    for t in range(n):
        a, b = first[t], first[t + 1]
        if a == b:
            continue
        w, count = hashes[a:b], int(b - a)
        _, times = np.unique(w, return_counts=True)
        pairs = w[1:] * np.uint64(3) + w[:-1]
        la, lb = line_first[t], line_first[t + 1]
        out[t, 2:12] = (
            length[a:b].mean(), np.log1p(length[a:b].max()), count / (lb - la), len(times) / count, times.max() / count,
            (w[1:] == w[:-1]).mean() if count > 1 else 0, len(np.unique(pairs)) / (count - 1) if count > 1 else 1,
            len(np.unique(line_hash[la:lb])) / (lb - la), odd_word[a:b].mean(), upper_word[a:b].mean(),
        )
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(words)
    out[:, 12:] = share / np.maximum(size, 1)[:, None]
    return out


class BoostedTrees:
    """Complete trees of one depth in flat arrays: (trees, nodes) feature and threshold, (trees, leaves) value."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, base: float):
        self.feature, self.threshold, self.value, self.base = feature, threshold, value, base

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        nodes = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < nodes:
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += value[at - nodes]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, l2: float = 1.0, shift: float = 0.0) -> BoostedTrees:
    """Logistic gradient boosting; each level finds every node's best split from (node, bin) histograms."""
    n, m = x.shape
    nodes, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, nodes), np.int64)
    threshold = np.full((trees, nodes), np.inf)
    value = np.zeros((trees, leaves))
    if not len(set(y.tolist())) == 2:
        base = 0.0 if not n else (20.0 if y[0] else -20.0)
        return BoostedTrees(feature[:0], threshold[:0], value[:0], base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            pick, cut = np.zeros(width, np.int64), np.full(width, -1)
            total_g, total_h = np.bincount(at - first, g, width), np.bincount(at - first, h, width)
            for j in range(m):
                slot = (at - first) * bins + binned[:, j]
                left_g = np.bincount(slot, g, width * bins).reshape(width, bins).cumsum(1)
                left_h = np.bincount(slot, h, width * bins).reshape(width, bins).cumsum(1)
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - (total_g**2 / (total_h + l2))[:, None]
                gain[(left_h < 1e-3) | (right_h < 1e-3)] = 0
                gain[:, len(edges[j]) :] = 0
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best + 1e-9
                best[better], pick[better], cut[better] = gain[np.arange(width), top][better], j, top[better]
            for k in range(width):
                feature[t, first + k] = pick[k]
                threshold[t, first + k] = edges[pick[k]][cut[k]] if cut[k] >= 0 else np.inf
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > threshold[t, at])
        leaf = at - nodes
        value[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        margin += value[t][leaf]
    return BoostedTrees(feature, threshold, value, base + shift)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(row, doc_id, stats array<float>) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                x = statistics(data, offs)
                flat = pa.array(x.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)
                yield pa.RecordBatch.from_pydict({"row": batch.column("row").slice(lo, hi - lo), "doc_id": batch.column("doc_id").slice(lo, hi - lo), "stats": lists})

    return with_row(documents_of(docs)).select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, stats array<float>")


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Per document: row, doc_id, held_out, score (likelihood of label 1)."""
    stats = materialize(document_statistics(docs), "quality-stats")
    chosen, counts = training_labels(labels, stats, "quality", per_class)
    # of a repeated doc_id the row lowest in hash order, combined before the shuffle: at most per_class rows of a class
    least = stats.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("stats").alias("h"), "stats", "label")).alias("r"))
    sample = least.orderBy("doc_id").select("r.*").toPandas()
    x = np.array(sample["stats"].tolist(), np.float32).reshape(-1, len(STATISTICS))
    model = stats.sparkSession.sparkContext.broadcast(fit_trees(x, sample["label"].to_numpy(np.float64), shift=prior_shift(counts, per_class)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "score": pa.array(model.value.score(x))})

    scored = stats.mapInArrow(run, "row long, doc_id long, score double")
    return scored.select("row", "doc_id", crc_split(F.col("doc_id")).alias("held_out"), "score")
