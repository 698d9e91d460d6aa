"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns the training documents into index segments. A segment holds whole documents, a bounded number of
words unless one document has more, and for every term of the test vocabulary its ascending word positions there. The
segments are a table: they can be stored, and are searched where they lie, so postings are never shuffled, and a
frequent term is split over all segments.

``find_phrases`` and ``find_near`` search every segment for all test items. A phrase is found by taking the postings of
its rarest term in the segment, shifting them by the term's offset in the phrase, and intersecting the shifted
postings of the next terms, from rare to frequent; what is left are exactly the phrase's occurrences.

Test items reach the tasks as broadcast blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_CHARS`` characters; further
blocks are further searches of the stored index. (An item longer than that is a block alone.)

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Null and empty texts have no words and are
not contaminated; items without words match nothing. Items with equal texts all match. Rows with equal keys are one
document if several blocks are searched, which needs a key in every row. Extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import TO_WORDS, in_runs, staged, table, text_bytes

WINDOW = 13
SEGMENT_WORDS = 1_000_000
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000

Items = list[tuple[str, list[bytes]]]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[Items]:
    """(item id as string, words) of all items, in blocks of bounded size."""
    block, chars = [], 0
    for row in items.select(F.col(item).cast("string"), text).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or chars + len(row[1] or "") > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((row[0], words_of(row[1])))
        chars += len(row[1] or "")
    if block:
        yield block


SEGMENT = "doc_ids array<long>, starts array<int>, lengths array<int>, terms array<int>, counts array<int>, positions binary"


def build_index(docs: DataFrame, vocabulary: list[bytes], key: str = "doc_id", text: str = "text", gap: int = WINDOW) -> DataFrame:
    """Index segments of the documents. ``key`` is an integer; terms are numbers in the ``vocabulary``.

    Positions number a segment's words; ``gap`` unused positions lie between documents, so no phrase of up to that many
    words can cross them.
    """
    number = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})
    other = len(vocabulary)

    def segment(keys: list, found: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(f) for f in found], np.int64)
        starts = np.cumsum(sizes + gap) - sizes - gap
        terms = np.concatenate(found)
        at = np.repeat(starts, sizes) + in_runs(sizes)
        known = terms != other
        terms, at = terms[known], at[known]
        order = np.argsort(terms, kind="stable")
        names, counts = np.unique(terms[order], return_counts=True)
        columns = [pa.array([keys], pa.list_(pa.int64()))]
        columns += [pa.array([x], pa.list_(pa.int32())) for x in (starts, sizes, names, counts)]
        positions = pa.array([at[order].astype(np.int32).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([*columns, positions], ["doc_ids", "starts", "lengths", "terms", "counts", "positions"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, keys, found, size = number.value, [], [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            raw, offsets = data.tobytes().translate(TO_WORDS), offsets.tolist()
            for i, k in enumerate(batch.column(key).to_pylist()):
                words = raw[offsets[i] : offsets[i + 1]].split()
                found.append(np.array([known.get(w, other) for w in words], np.int32))
                keys.append(k)
                size += len(words)
                if size >= SEGMENT_WORDS:
                    yield segment(keys, found)
                    keys, found, size = [], [], 0
        if keys:
            yield segment(keys, found)

    return docs.select(F.col(key).cast("long").alias("key"), text).withColumnRenamed("key", key).mapInArrow(index, SEGMENT)


class Segment:
    """One segment's postings by term."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.starts = np.array(row["starts"], np.int64)
        self.lengths = np.array(row["lengths"], np.int64)
        ends = np.cumsum(row["counts"], dtype=np.int64)
        at = np.frombuffer(row["positions"], np.int32)
        self.postings = {t: at[e - n : e] for t, n, e in zip(row["terms"], row["counts"], ends.tolist(), strict=True)}

    def phrase(self, terms: tuple[int, ...]) -> np.ndarray:
        """Positions where the terms follow one another."""
        lists = [self.postings.get(t) for t in terms]
        if any(x is None for x in lists):
            return np.empty(0, np.int32)
        order = sorted(range(len(terms)), key=lambda k: len(lists[k]))
        found = lists[order[0]] - order[0]
        for k in order[1:]:
            if not len(found):
                break
            wanted, there = found + k, lists[k]
            found = found[there[np.minimum(np.searchsorted(there, wanted), len(there) - 1)] == wanted]
        return found

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1

    def near(self, terms: list[int], within: int) -> set[int]:
        """Documents with a stretch of ``within`` words that holds all of the distinct terms."""
        lists = [self.postings.get(t) for t in set(terms)]
        if not lists or any(x is None for x in lists):
            return set()
        lists.sort(key=len)
        # A stretch that holds all terms can be shifted until it begins at one of them.
        starts = np.unique(np.concatenate(lists))
        for at in lists:
            k = np.searchsorted(at, starts)
            end = at[np.minimum(k, len(at) - 1)].astype(np.int64)
            same = (k < len(at)) & (end - starts < within) & (self.document(end) == self.document(starts))
            starts = starts[same]
        return set(self.document(starts).tolist())


def _search(index: DataFrame, look: Callable[[Segment], list[tuple]], schema: str) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, _KINDS[n]) for n in names])
        for batch in batches:
            for i in range(batch.num_rows):
                rows = look(Segment(batch.slice(i, 1).to_pylist()[0]))
                columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    return index.mapInArrow(run, schema)


_KINDS = {
    "doc_id": pa.int64(), "n_words": pa.int64(), "item_ids": pa.list_(pa.string()), "item_id": pa.string(),
    "first_words": pa.list_(pa.int64()), "last_words": pa.list_(pa.int64()),
}


def phrases_of(items: Items, number: dict[bytes, int], window: int) -> dict[tuple[int, ...], list[str]]:
    """Every run of ``window`` words of an item, or the whole of a shorter item, with the items that have it."""
    out = defaultdict(set)
    for name, words in items:
        ids = [number[w] for w in words]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            out[tuple(ids[i : i + window])].add(name)
    return {k: sorted(v) for k, v in out.items()}


def find_phrases(index: DataFrame, phrases: dict[tuple[int, ...], list[str]]) -> DataFrame:
    """Per document: doc_id, n_words, item_ids, and the first and last word numbers of the maximal stretches that hits cover."""
    wanted = index.sparkSession.sparkContext.broadcast(phrases)

    def look(segment: Segment) -> list[tuple]:
        starts, ends, names = [], [], defaultdict(set)
        for terms, items in wanted.value.items():
            found = segment.phrase(terms)
            if len(found):
                starts.append(found.astype(np.int64))
                ends.append(found.astype(np.int64) + len(terms))
                for d in set(segment.document(found).tolist()):
                    names[d].update(items)
        spans = defaultdict(list)
        if starts:
            first, last = np.concatenate(starts), np.concatenate(ends)
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order])
            fresh = np.r_[True, first[1:] > last[:-1]]
            merged = zip(first[fresh].tolist(), last[np.r_[np.flatnonzero(fresh)[1:] - 1, len(last) - 1]].tolist(), strict=True)
            for a, b in merged:
                d = int(segment.document(np.array([a]))[0])
                spans[d].append((a - int(segment.starts[d]), b - 1 - int(segment.starts[d])))
        return [
            (k, n, sorted(names.get(d, ())), [a for a, _ in spans.get(d, ())], [b for _, b in spans.get(d, ())])
            for d, (k, n) in enumerate(zip(segment.doc_ids, segment.lengths.tolist(), strict=True))
        ]

    return _search(index, look, "doc_id long, n_words long, item_ids array<string>, first_words array<long>, last_words array<long>")


def find_near(index: DataFrame, items: Items, number: dict[bytes, int], within: int) -> DataFrame:
    """Pairs doc_id, item_id: all words of the item stand, in any order, within ``within`` words of the document."""
    wanted = index.sparkSession.sparkContext.broadcast([(name, [number[w] for w in words]) for name, words in items])

    def look(segment: Segment) -> list[tuple]:
        return [(segment.doc_ids[d], name) for name, terms in wanted.value for d in sorted(segment.near(terms, within))]

    return _search(index, look, "doc_id long, item_id string")


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, item: str = "item_id", item_text: str = "text", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, item_ids, and the stretches hit (``first_words``, ``last_words``).

    ``docs`` are read once per block of items to build that block's index, which is stored and then searched.
    """
    parts = []
    for block in item_blocks(items, item, item_text) if items.take(1) else [[]]:
        vocabulary = sorted({w for _, words in block for w in words})
        index = staged(build_index(docs, vocabulary, key, text, window), "postings")
        parts.append(find_phrases(index, phrases_of(block, {w: i for i, w in enumerate(vocabulary)}, window)))
    found = parts[0] if len(parts) == 1 else merged_blocks(reduce(DataFrame.unionByName, parts))
    spans = F.zip_with("first_words", "last_words", lambda a, b: b - a + 1)
    return found.withColumn("n_hit", F.aggregate(spans, F.lit(0).cast("long"), lambda x, y: x + y))


def merged_blocks(found: DataFrame) -> DataFrame:
    """One row per document of the rows that it has from several blocks of items."""
    spans = F.flatten(F.collect_list(F.arrays_zip("first_words", "last_words")))
    rows = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.array_sort(spans).alias("spans")
    )
    # Stretches in order of their first word; one that touches the last joins it.
    empty = F.array().cast("array<struct<first_words: bigint, last_words: bigint>>")
    joined = F.aggregate(
        "spans",
        empty,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["last_words"] >= x["first_words"] - 1),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.get(acc, F.size(acc) - 1)["first_words"].alias("first_words"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["last_words"], x["last_words"]).alias("last_words"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return rows.withColumn("spans", joined).select("doc_id", "n_words", "item_ids", F.col("spans.first_words").alias("first_words"), F.col("spans.last_words").alias("last_words"))


def with_verdict(found: DataFrame) -> DataFrame:
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_verdict(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` that are not contaminated, with the columns they came with."""
    found = with_verdict(contamination(docs, table(spark, sf_dir, "benchmark"))).filter("contaminated")
    return docs.join(found.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
