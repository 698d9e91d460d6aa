"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models on the presence of words and of five-byte pieces of words
(which find a stem under any ending). The model of a category also gets the probabilities of the earlier categories;
in training these are out-of-fold predictions, so that later models see them as good or as bad as they are in use.

The chain is fitted on at most ``SAMPLE`` labelled documents, those with the smallest hash of their key (a documented
bound). Features are hashed into ``2 ** BITS`` buckets; Spark counts in how many of these documents of each label each
is, and the ``FEATURES`` buckets that tell most (likelihood ratio) are kept. Scoring covers every document and its
whole text.

Null and empty texts have no features and get the chain's base rates. Labels that are null or without a document are
not used. Without labels of both kinds, the probability of a category is the share of its positives. Repeated rows get
equal results. Extra columns stay where the caller keeps them and are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.common import WORD_BYTE, SpanHash, mixed, slices, staged, table, text_bytes, word_spans

BITS, FEATURES, SAMPLE, FOLDS, PIECE = 18, 2_000, 20_000, 4, 5
LEAST_DOCUMENTS = 5
STEPS, PENALTY = 200, 0.1
THRESHOLD = 0.5

# Words whose presence in a toxic document makes it one of the category. The table marks toxicity as a
# whole only; these two weak categories come first in the chain, the table's own label last.
INSULTS = ("idiot", "moron", "stupid", "loser", "clown")
CONTEMPT = ("worthless", "scum", "disgusting", "trash", "pathetic")


def features(column: pa.Array, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every distinct feature of every text; with ``only``, those of its buckets (a mask)."""
    data, offsets = text_bytes(column)
    hashes = SpanHash(data)
    starts, ends, text = word_spans(data, offsets)
    inside = np.r_[0, np.cumsum(~WORD_BYTE[data])]
    cut = np.zeros(len(data) + 1, np.int64)
    np.add.at(cut, offsets[1:-1], 1)
    cuts = np.cumsum(cut)  # texts that ended up to here
    at = np.arange(max(len(data) - PIECE + 1, 0))
    at = at[(inside[at + PIECE] == inside[at]) & (cuts[at + PIECE - 1] == cuts[at])]
    word = hashes(starts, ends) >> np.uint64(64 - BITS)
    piece = mixed(hashes(at, at + PIECE) + np.uint64(1)) >> np.uint64(64 - BITS)
    bucket = np.r_[word, piece].astype(np.int64)
    owner = np.r_[text, np.searchsorted(offsets, at, "right") - 1]
    if only is not None:
        known = only[bucket]
        bucket, owner = bucket[known], owner[known]
    both = np.unique((owner << BITS) | bucket)
    return both >> BITS, both & ((1 << BITS) - 1)


@dataclass
class Chain:
    columns: np.ndarray  # bucket -> column of the weights, -1 for buckets that are not used
    weights: list[np.ndarray]  # by category: weight of each column, then of each earlier probability, then the constant

    def probabilities(self, texts: int, owner: np.ndarray, column: np.ndarray) -> np.ndarray:
        """One row per text, one column per category."""
        out = np.zeros((texts, len(self.weights)))
        for k, w in enumerate(self.weights):
            out[:, k] = _predict(w, texts, owner, column, out[:, :k])
        return out


def _predict(w: np.ndarray, texts: int, owner: np.ndarray, column: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    n = len(w) - 1 - earlier.shape[1]
    raw = np.bincount(owner, w[column], texts) + earlier @ w[n:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def _fit(texts: int, owner: np.ndarray, column: np.ndarray, n: int, earlier: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a squared penalty: gradient steps with momentum, each weight scaled by its feature's frequency."""
    w = np.zeros(n + earlier.shape[1] + 1)
    share = (y.sum() + 0.5) / (texts + 1)
    w[-1] = np.log(share / (1 - share))
    if not texts or y.min() == y.max():
        return w
    seen = np.bincount(column, minlength=n)
    scale = 1 / (np.r_[seen, (earlier**2).sum(0), texts] * 0.25 + PENALTY)
    step = np.zeros_like(w)
    rate = 1 / max(1.0, np.sqrt(len(column) / texts))
    for _ in range(STEPS):
        ahead = w + 0.9 * step
        gap = y - _predict(ahead, texts, owner, column, earlier)
        gradient = np.r_[np.bincount(column, gap[owner], n), gap @ earlier, gap.sum()]
        gradient[:-1] -= PENALTY * ahead[:-1]
        step = 0.9 * step + rate * scale * gradient
        w = w + step
    return w


def fit_chain(keep: np.ndarray, fold: np.ndarray, owner: np.ndarray, bucket: np.ndarray, labels: np.ndarray) -> Chain:
    """``labels``: one column per category, in the chain's order."""
    columns = np.full(1 << BITS, -1, np.int32)
    columns[keep] = np.arange(len(keep))
    column, texts = columns[bucket], len(labels)
    earlier, weights = np.zeros((texts, 0)), []
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(np.float64)
        weights.append(_fit(texts, owner, column, len(keep), earlier, y))
        if k + 1 == labels.shape[1]:
            break
        held = np.zeros(texts)
        for f in range(FOLDS):
            out = fold == f
            number = np.cumsum(~out) - 1
            used = ~out[owner]
            w = _fit(int((~out).sum()), number[owner[used]], column[used], len(keep), earlier[~out], y[~out])
            held[out] = _predict(w, texts, owner, column, earlier)[out]
        earlier = np.c_[earlier, held]
    return Chain(columns, weights)


def telling_buckets(labelled: DataFrame, text: str = "text", label: str = "label") -> np.ndarray:
    """The FEATURES buckets with the highest likelihood ratio between label 1 and label 0, counted over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), np.int64)
        for batch in slices(batches, text):
            owner, bucket = features(batch.column(text))
            np.add.at(sums, (batch.column(label).to_numpy()[owner], bucket), 1)
        used = np.flatnonzero(sums.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[0, used]), pa.array(sums[1, used])], ["bucket", "zeros", "ones"])

    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    parts = labelled.select(text, label).mapInArrow(count, "bucket long, zeros long, ones long")
    found = parts.groupBy("bucket").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()  # at most 2 ** BITS rows
    bucket, a0, a1 = (found[c].to_numpy().astype(np.float64) for c in ("bucket", "zeros", "ones"))
    if not n0 or not n1:
        return np.empty(0, np.int64)

    def part(a: np.ndarray, n: float, total: np.ndarray) -> np.ndarray:
        expected = total * n / (n0 + n1)
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / expected), 0)

    total = a0 + a1
    ratio = part(a0, n0, total) + part(a1, n1, total) + part(n0 - a0, n0, n0 + n1 - total) + part(n1 - a1, n1, n0 + n1 - total)
    ratio[total < LEAST_DOCUMENTS] = 0
    best = np.lexsort((bucket, -ratio))[:FEATURES]
    return np.sort(bucket[best[ratio[best] > 0]].astype(np.int64))


def train(labelled: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text") -> Chain:
    """``labelled``: key, text, and one 0/1 column per category in the chain's order; the last chooses the features.

    Its rows are read twice and the values of their kept features come to the driver, so their number must be bounded.
    """
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(categories[-1]).alias("label"), F.array(*categories).alias("y"))
    keep = telling_buckets(rows)
    mask = np.zeros(1 << BITS, bool)
    mask[keep] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, bucket = features(batch.column("text"), mask)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("y"), lists], ["key", "y", "x"])

    kind = rows.schema["key"].dataType.simpleString()
    found = rows.select("key", "text", "y").mapInArrow(run, f"key {kind}, y array<int>, x array<int>")
    found = found.orderBy(F.xxhash64("key"), "key", "y").toArrow()
    x = found["x"].combine_chunks()
    sizes = np.array([len(v) for v in found["x"].to_pylist()], np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bucket = x.flatten().to_numpy().astype(np.int64)
    labels = np.array(found["y"].to_pylist(), np.int64).reshape(-1, len(categories))
    return fit_chain(keep, np.arange(len(sizes)) % FOLDS, owner, bucket, labels)


def scored(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The columns of ``docs`` as c0, c1, .. (whatever they are called), then the categories' probabilities as p0, p1, .."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    column, categories = docs.columns.index(text), len(chain.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, f"c{column}"):
            owner, bucket = features(batch.column(column), model.columns >= 0)
            p = model.probabilities(batch.num_rows, owner, model.columns[bucket])
            for k in range(categories):
                batch = batch.append_column(f"p{k}", pa.array(np.ascontiguousarray(p[:, k])))
            yield batch

    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *(T.StructField(f"p{k}", T.DoubleType()) for k in range(categories))]))


def has_word(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike(rf"(?i)(?<![\p{{L}}\p{{N}}])({'|'.join(words)})(?![\p{{L}}\p{{N}}])")


CATEGORIES = ["insult", "contempt", "toxic"]


def train_on_tables(docs: DataFrame, labels: DataFrame) -> Chain:
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumns(  # at most SAMPLE small rows
        {
            "insult": F.when(has_word(F.coalesce("text", F.lit("")), INSULTS), F.col("toxic")).otherwise(0),
            "contempt": F.when(has_word(F.coalesce("text", F.lit("")), CONTEMPT), F.col("toxic")).otherwise(0),
        }
    )
    return train(staged(rows, "labelled"), CATEGORIES)


def judged(docs: DataFrame, chain: Chain) -> DataFrame:
    """Per document: doc_id, the probabilities, and toxic."""
    rows = scored(docs.select("doc_id", "text"), chain)
    p = [F.col(f"p{k}").alias(f"p_{c}") for k, c in enumerate(CATEGORIES)]
    return rows.select(F.col("c0").alias("doc_id"), *p, (F.col("p2") >= THRESHOLD).alias("toxic"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(docs, train_on_tables(docs, table(spark, sf_dir, "labels")))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that are not toxic, with the columns they came with."""
    chain = train_on_tables(docs, table(spark, sf_dir, "labels"))
    return scored(docs, chain).filter(F.col("p2") < THRESHOLD).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
