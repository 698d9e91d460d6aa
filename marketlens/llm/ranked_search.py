"""Ranked lexical search, reversed: the items are indexed and broadcast, the documents stream through.

The items (queries) come in blocks of bounded size. A block's index holds, per term, the items that have it and how
often. A first pass over the documents counts the block's terms in every document and stores the counts; from them come
the corpus figures (documents, terms, documents per term) and with these the weights. The second pass streams the
stored counts through the index. Every task keeps a heap of the ``k`` best documents of each item; a document enters
only if it reaches the worst of a full heap. The heaps of all tasks are merged in two steps, first among shares of the
documents, so that no task gets the heaps of all tasks for an item. Every document meets every item with which it
shares a term; nothing is cut off but what the heaps exclude.

All of the score is integer arithmetic, so it does not depend on the order of the rows. Terms are compared byte by byte.

Terms: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. A null or empty text has none;
such a document is not counted, such an item has no result. Very long texts are cut into pieces between words. Repeated
rows are documents (or items) of their own; equal scores are ordered by key, a null key last. Empty tables give an empty
result. Extra columns are not read. An item is never split: a block holds one item at least, however long.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import WORD_BYTE, in_runs, slices, staged, table, text_bytes
from marketlens.llm.pieces import Vocabulary, windows, words_between

BEST = 10
# A block of items ends when it has so many items, or so many bytes of distinct terms over its items.
BLOCK_ITEMS, BLOCK_BYTES = 8_192, 32 << 20
# Numbers that one vectorised step of the second pass holds.
CELLS = 1 << 21
# Shares of the documents whose heaps are merged first.
SHARES = 64
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_INT64 = 1 << 63


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Per item with terms: key, terms (distinct), repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, offsets = text_bytes(batch.column(text))
            raw = data.tobytes()
            counts = [Counter(_TERM.findall(raw[a:b].lower())) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            terms = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
            repeats = pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(key), terms, repeats], ["key", "terms", "repeats"])

    kind = items.schema[key].dataType.simpleString()
    return items.select(key, text).mapInArrow(run, f"key {kind}, terms array<binary>, repeats array<long>").filter("size(terms) > 0")


class ItemIndex:
    """The inverted index of a block of items: for each term the items that have it and how often."""

    def __init__(self, rows: list):
        words = sorted({bytes(term) for row in rows for term in row.terms})
        number = {word: k for k, word in enumerate(words)}
        self.items = len(rows)
        self.vocabulary = Vocabulary(words)
        term = np.array([number[bytes(t)] for row in rows for t in row.terms], np.int64)
        item = np.repeat(np.arange(len(rows)), [len(row.terms) for row in rows])
        repeats = np.array([n for row in rows for n in row.repeats], np.int64)
        order = np.argsort(term, kind="stable")
        self.item, self.repeats = item[order], repeats[order]
        self.first = np.searchsorted(term[order], np.arange(len(words) + 1))


def blocks(items: DataFrame, most_items: int, most_bytes: int) -> Iterator[list]:
    """The items in blocks. Only one block is on the driver at a time."""
    block, held = [], 0
    for row in items.toLocalIterator():
        size = sum(len(term) + 16 for term in row.terms)
        if block and (len(block) == most_items or held + size > most_bytes):
            yield block
            block, held = [], 0
        block.append(row)
        held += size
    if block:
        yield block


def term_counts(docs: DataFrame, key: str, text: str, index) -> DataFrame:
    """Per row: key, n (its terms with repeats), term and tf (those of its terms that are in the index, and how often)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = index.value.vocabulary
        for batch in slices(batches, text):
            data, offsets = text_bytes(batch.column(text))
            n = np.zeros(batch.num_rows, np.int64)
            cells, counts = [], []
            for start, end in windows(data, offsets, WORD_BYTE):
                starts, ends, row = words_between(data, offsets, WORD_BYTE, start, end)
                n += np.bincount(row, minlength=batch.num_rows)
                hit, term = vocabulary.find(data[start:end], starts, ends)
                cell, count = np.unique(row[hit] * vocabulary.size + term, return_counts=True)
                cells.append(cell)
                counts.append(count)
            cell, place = np.unique(np.concatenate([np.empty(0, np.int64), *cells]), return_inverse=True)
            tf = np.zeros(len(cell), np.int64)
            np.add.at(tf, place, np.concatenate([np.empty(0, np.int64), *counts]))
            row, term = np.divmod(cell, max(vocabulary.size, 1))
            ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array(n),
                    pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tf)),
                ],
                ["key", "n", "term", "tf"],
            )

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, "key long, n long, term array<int>, tf array<long>")


class Heaps:
    """The ``k`` best documents of each of a number of items."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.floor = np.ones(items, np.int64)  # scores below this cannot enter
        self.item, self.doc, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.bare = np.empty(0, bool)  # documents without key

    def offer(self, scores: np.ndarray, docs: np.ndarray, bare: np.ndarray) -> None:
        """``scores``: a row per document, a column per item."""
        if len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
            self.floor = np.maximum(self.floor, kth)
        row, item = np.nonzero(scores >= self.floor)
        if not len(row):
            return
        item, doc = np.r_[self.item, item], np.r_[self.doc, docs[row]]
        score, bare = np.r_[self.score, scores[row, item[len(self.item) :]]], np.r_[self.bare, bare[row]]
        order = np.lexsort((doc, bare, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[rank < self.k]
        self.item, self.doc, self.score, self.bare = item[rank < self.k], doc[order], score[order], bare[order]
        full = np.flatnonzero(rank == self.k - 1)
        at = np.searchsorted(self.item, item[full], "right") - 1
        self.floor[item[full]] = np.maximum(self.floor[item[full]], self.score[at])


def saturated(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """8 * (100 - 75 + (75 * n * N) div L) for each document length n."""
    if len(n) and 75 * int(n.max()) * documents >= _INT64:
        return np.array([8 * (25 + 75 * int(x) * documents // terms) for x in n], np.int64)
    return 8 * (25 + 75 * n * documents // terms)


def best_documents(counts: DataFrame, index, weights, documents: int, terms: int, k: int) -> DataFrame:
    """The heaps of every task: item (its place in the block), key, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, weight = index.value, weights.value
        heaps = Heaps(idx.items, k)
        fan = np.diff(idx.first)
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False)
            bare = np.asarray(batch.column("key").is_null())
            docs = batch.column("key").fill_null(0).to_numpy(zero_copy_only=False)
            lists, tf = batch.column("term"), batch.column("tf").flatten().to_numpy(zero_copy_only=False)
            term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
            row = np.repeat(np.arange(len(n)), np.diff(ends))
            gain = weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + saturated(n, documents, terms)[row]))
            load = np.r_[0, np.cumsum(fan[term])][ends] + np.arange(len(ends)) * idx.items
            start = 0
            while start < len(n):
                stop = max(start + 1, int(np.searchsorted(load, load[start] + CELLS, "right")) - 1)
                part = slice(ends[start], ends[stop])
                each = fan[term[part]]
                place = np.repeat(idx.first[term[part]], each) + in_runs(each)
                scores = np.zeros((stop - start) * idx.items, np.int64)
                cell = np.repeat((row[part] - start) * idx.items, each) + idx.item[place]
                np.add.at(scores, cell, np.repeat(gain[part], each) * idx.repeats[place])
                heaps.offer(scores.reshape(stop - start, idx.items), docs[start:stop], bare[start:stop])
                start = stop
        yield pa.RecordBatch.from_arrays(
            [pa.array(heaps.item, pa.int32()), pa.array(heaps.doc, mask=heaps.bare), pa.array(heaps.score)], ["item", "key", "score"]
        )

    return counts.mapInArrow(run, "item int, key long, score long")


def first_ranks(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    k: int = BEST,
    most_items: int = BLOCK_ITEMS,
    most_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per item its ``k`` best documents with a score above 0: ``item_key``, rank, ``key``, score."""
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType
    wanted = staged(item_terms(items, item_key, text), "item-terms")
    found, documents, terms = [], None, None
    for block in blocks(wanted, most_items, most_bytes):
        index = spark.sparkContext.broadcast(ItemIndex(block))
        counts = staged(term_counts(docs, key, text, index), "term-counts")
        if documents is None:
            documents, terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        # As many rows as the block has terms.
        df = counts.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        weight = np.zeros(index.value.vocabulary.size, np.int64)
        for row in df:
            weight[row.term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row.df + 1)))
        weights = spark.sparkContext.broadcast(weight)
        heaps = best_documents(counts, index, weights, documents, max(terms, 1), k)
        shares = first_ranks(heaps.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(SHARES))), k, "item", "share")
        best = staged(first_ranks(shares.drop("rank", "share"), k, "item"), "best-documents")
        index.destroy()
        weights.destroy()
        names = spark.createDataFrame([(i, row.key) for i, row in enumerate(block)], f"item int, `{item_key}` {kind.simpleString()}")
        found.append(best.join(names, "item").select(item_key, "rank", F.col("key").alias(key), "score"))
    if not found:
        return spark.createDataFrame([], f"`{item_key}` {kind.simpleString()}, rank int, `{key}` long, score long")
    return reduce(DataFrame.unionByName, found)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_SMALL}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

OP11_SQL = f"""
WITH doc_terms AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_WORDS} AS term FROM documents) GROUP BY ALL
),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM doc_terms, corpus GROUP BY term
),
item_terms AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, {_WORDS} AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // terms)))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN doc_terms USING (term) JOIN lengths USING (doc_id), corpus GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
