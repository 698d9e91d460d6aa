"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts (sizes, shares of character classes, repetition of words and lines) are computed in
vectorised form on Arrow batches. Trees grow level by level on binned statistics, their leaves fit the gradient of the
logistic loss. The trained trees are flattened into arrays, so that a batch walks down all trees in a few numpy steps.

Training uses at most ``SAMPLE`` labelled rows, those with the smallest hash of their key (a documented bound); scoring
covers every row. A text without words or lines has zeros for their statistics, null counts as empty; both get a
score. Labels that are null, or given for keys without document, are not used; a key with several labels counts with
each. With no labelled rows, or labels of one kind only, the score is the share of label 1 (0.5 if there are none).
Extra columns are not read. Very long texts are processed alone. Equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import SpanHash, distinct_items, slices, table, text_bytes, word_spans

SAMPLE = 16_000
BINS, TREES, DEPTH, RATE, LEAF, PENALTY = 64, 40, 4, 0.2, 20, 1.0

_CLASSES = {
    "lower": [*range(97, 123)],
    "upper": [*range(65, 91)],
    "digit": [*range(48, 58)],
    "space": [9, 10, 13, 32],
    "stop": [33, 46, 63],
    "comma": [44, 58, 59],
    "quote": [34, 39, 40, 41, 45],
    "symbol": [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "!.?,:;\"'()-"],
    "beyond": [*range(128, 256)],
}
STATISTICS = (
    "log_bytes", "log_words", "log_lines", *_CLASSES, "word_bytes", "word_spread", "short_words", "long_words", "distinct_words",
    "top_word", "same_as_last", "distinct_lines", "top_line", "line_bytes", "stopped_lines",
)


def _group_shares(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's items: the share of distinct ones, and the share of the most frequent one."""
    _, own, runs = distinct_items(hashes, text)
    total = np.maximum(np.bincount(text, minlength=n), 1)
    most = np.zeros(n)
    np.maximum.at(most, own, runs)
    return np.bincount(own, minlength=n) / total, most / total


def statistics(column: pa.Array) -> np.ndarray:
    """One row per text, one column per entry of STATISTICS."""
    data, offsets = text_bytes(column)
    n, size = len(column), np.diff(offsets)
    some = np.maximum(size, 1)
    out = [np.log1p(size)]
    hashes = SpanHash(data)

    starts, ends, text = word_spans(data, offsets)
    words = np.bincount(text, minlength=n)
    each = np.maximum(words, 1)
    newline = np.flatnonzero(data == 10)
    line_starts = np.unique(np.r_[offsets[:-1][size > 0], newline + 1])
    line_starts = line_starts[line_starts < len(data)]
    line_text = np.searchsorted(offsets, line_starts, "right") - 1
    line_ends = np.r_[line_starts[1:], len(data)] if len(line_starts) else line_starts
    line_ends = line_ends - (data[line_ends - 1] == 10 if len(line_ends) else 0)
    lines = np.bincount(line_text, minlength=n)
    out += [np.log1p(words), np.log1p(lines)]

    for members in _CLASSES.values():
        inside = np.zeros(256, bool)
        inside[members] = True
        running = np.r_[0, np.cumsum(inside[data])]
        out.append((running[offsets[1:]] - running[offsets[:-1]]) / some)

    length = (ends - starts).astype(np.float64)
    mean = np.bincount(text, length, n) / each
    spread = np.sqrt(np.maximum(np.bincount(text, length * length, n) / each - mean * mean, 0))
    word = hashes(starts, ends)
    again = np.r_[False, (word[1:] == word[:-1]) & (text[1:] == text[:-1])][: len(word)]
    out += [mean, spread, np.bincount(text, length <= 3, n) / each, np.bincount(text, length >= 15, n) / each]
    out += [*_group_shares(word, text, n), np.bincount(text, again, n) / each]

    per_line = np.maximum(lines, 1)
    out += _group_shares(hashes(line_starts, line_ends), line_text, n)
    out.append(np.bincount(line_text, line_ends - line_starts, n) / per_line)
    filled = line_ends > line_starts
    ended = filled.copy()
    ended[filled] = np.isin(data[line_ends[filled] - 1], [33, 46, 63])
    out.append(np.bincount(line_text, ended, n) / per_line)
    return np.stack(out, axis=1)


@dataclass
class Trees:
    """Complete binary trees as arrays: inner node i of a tree has the children 2 i + 1 and 2 i + 2."""

    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # values up to the limit go left
    leaf: np.ndarray  # trees x leaves
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), np.int64)
        tree, row = np.arange(trees), np.arange(len(x))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            right = x[row, self.feature[tree, node]] > self.limit[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - inner].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    n, inner = len(y), (1 << DEPTH) - 1
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, inner + 1)), base)
    features = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    cell = binned + np.arange(features) * BINS
    trees, raw = ([], [], []), np.full(n, base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = y - p, p * (1 - p)
        feature, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, here = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (features * BINS) + cell).ravel()
            sums = [
                np.bincount(at, np.repeat(v, features), here * features * BINS).reshape(here, features, BINS).cumsum(-1)
                for v in (gradient, weight, np.ones(n))
            ]
            (g, w, c), (gt, wt, ct) = sums, (s[..., -1:] for s in sums)
            gain = g**2 / (w + PENALTY) + (gt - g) ** 2 / (wt - w + PENALTY) - gt**2 / (wt + PENALTY)
            gain = np.where((c >= LEAF) & (ct - c >= LEAF), gain, 0).reshape(here, -1)
            best = gain.argmax(1)
            for k in np.flatnonzero(gain[np.arange(here), best] > 1e-6):
                f, b = divmod(int(best[k]), BINS)
                if b < len(edges[f]):
                    feature[first + k], limit[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
        slot = node - inner
        leaf = RATE * np.bincount(slot, gradient, inner + 1) / (np.bincount(slot, weight, inner + 1) + PENALTY)
        raw += leaf[slot]
        for to, part in zip(trees, (feature, limit, leaf), strict=True):
            to.append(part)
    return Trees(*(np.stack(t) for t in trees), base)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most SAMPLE rows."""
    usable = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, F.col(label).cast("int").alias("label"))
    chosen = usable.orderBy(F.xxhash64(key), key, "label").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            x = statistics(batch.column(text))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("label"), rows], [key, "label", "x"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(key, text).join(F.broadcast(chosen), key).select(key, "label", text)  # at most SAMPLE small rows
    found = rows.mapInArrow(run, f"`{key}` {kind}, label int, x array<double>").orderBy(F.xxhash64(key), key, "label").toArrow()
    x = np.array(found["x"].to_pylist(), np.float64).reshape(-1, len(STATISTICS))
    return x, found["label"].to_numpy().astype(np.float64)


def scored(docs: DataFrame, model: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and score, the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            p = sent.value.probability(statistics(batch.column(text)))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(p)], [key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = train(*sample(docs, labels, "quality", "doc_id", "text"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
