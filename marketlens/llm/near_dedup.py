"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is the set of its runs of ``SHINGLE`` words. ProbMinHash draws for every shingle a Poisson process of
arrivals whose rate is the shingle's weight. Each arrival falls into a random one of ``REGISTERS`` registers, which
remembers the shingle that came first; a process ends when it is later than all registers. Two documents agree in a
register with the probability that is the probability Jaccard similarity of their weighted sets. All weights are 1,
however often a shingle is repeated, so that is the Jaccard similarity of the sets, by which pairs are verified.

The registers form ``BANDS`` bands. Documents that agree in a whole band share a bucket; at a similarity of 0.8 two
documents share none with a probability of 5e-8. Documents are not paired within buckets: each is compared with the pivot
of its buckets, exactly, by the Jaccard similarity of both shingle sets. Linked documents form classes. In buckets in which
several classes meet, pairs of different classes remain; those that can be similar enough are found by what their sets do
not share with the pivot (``remaining_pairs``), and are verified. The shingles that a whole family of documents shares
bring no pairs about. Documents with equal shingle sets are one document in all of this, so copies cost nothing.

Words: A-Z lower-cased, runs of ASCII letters, digits and all characters beyond ASCII. A text of fewer words is one
shingle; a text without words (null and empty ones too) is compared as a whole, so such texts are in one class if they
are equal. The key is an integer; a class is named by its smallest key. Rows with equal keys must be equal and count as one
document; rows without a key are in no class (null). Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import (
    SpanHash, distinct_items, mixed, random_table, slices, staged, table, text_bytes, word_hashes,
)
from marketlens.llm.links import components, delta_pairs, with_pivots

SHINGLE, SIMILARITY = 5, 0.8
REGISTERS, BANDS = 128, 32
# A document is far from a pivot if they differ by more than so many times the pivot's shingles.
FAR = 0.5
# Up to so many documents that share a bucket, their keys (some tens of MB) are broadcast to the scan of the texts; beyond,
# the texts are shuffled once.
BROADCAST_KEYS = 1_000_000
_RAW = random_table(5)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _steps(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) % (1 << 64))




def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and count of every distinct shingle of every text. Each text has at least one."""
    data, offsets = text_bytes(column)
    word, text = word_hashes(data, offsets)
    words = np.bincount(text, minlength=len(column))
    runs = word[: max(len(word) - size + 1, 0)].copy()
    for k in range(1, size):
        runs = mixed(runs * _STEP + word[k : len(word) - size + 1 + k])
    whole = text[: len(runs)] == text[size - 1 :] if len(runs) else np.empty(0, bool)
    hashes, owner = [runs[whole]], [text[: len(runs)][whole]]
    first = np.cumsum(words) - words
    for n in range(1, size):  # short texts
        short = np.flatnonzero(words == n)
        h = np.full(len(short), n, np.uint64)
        for k in range(n):
            h = mixed(h * _STEP + word[first[short] + k])
        hashes.append(h)
        owner.append(short)
    bare = np.flatnonzero(words == 0)
    hashes.append(mixed(SpanHash(data, _RAW)(offsets[:-1][bare], offsets[1:][bare]) + np.uint64(7)))
    owner.append(bare)
    return distinct_items(np.concatenate(hashes), np.concatenate(owner).astype(np.int64))


def registers(item: np.ndarray, text: np.ndarray, weight: np.ndarray, texts: int, size: int = REGISTERS) -> np.ndarray:
    """The item that came first in each register of each text."""
    came, who = np.full(texts * size, np.inf), np.zeros(texts * size, np.uint64)
    time, active = np.zeros(len(item)), np.arange(len(item))
    arrival = 0
    while len(active):
        arrival += 1
        draw = mixed(item[active] + _steps(arrival))
        time[active] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weight[active]
        slot = text[active] * size + (mixed(draw) & np.uint64(size - 1)).astype(np.int64)
        now = time[active]
        np.minimum.at(came, slot, now)
        won = came[slot] == now
        who[slot[won]] = item[active[won]]
        there, number = np.unique(text[active], return_inverse=True)
        last = came.reshape(texts, size)[there].max(axis=1)
        active = active[now < last[number]]
    return who.reshape(texts, size)


def bands(who: np.ndarray, count: int = BANDS) -> np.ndarray:
    per = who.shape[1] // count
    out = np.broadcast_to(np.arange(count, dtype=np.uint64), (len(who), count)).copy()
    for k in range(per):
        out = mixed(out * _STEP + who[:, k::per])
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc, same_low and same_high (a 128-bit hash of the shingle set), n (distinct shingles), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            item, text, _ = shingles(batch.column("text"), size)
            texts = batch.num_rows
            same = np.zeros((2, texts), np.uint64)
            for k in (0, 1):
                np.add.at(same[k], text, mixed(item + _steps(k + 1)))
            found = bands(registers(item, text, np.ones(len(item)), texts))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(texts + 1) * BANDS, pa.int32()), pa.array(found.ravel().view(np.int64)))
            n = np.bincount(text, minlength=texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(same[0].view(np.int64)), pa.array(same[1].view(np.int64)), pa.array(n, pa.int64()), lists],
                ["doc", "same_low", "same_high", "n", "bands"],
            )

    return docs.mapInArrow(run, "doc long, same_low long, same_high long, n long, bands array<long>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc, items (its distinct shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            item, text, _ = shingles(batch.column("text"), size)
            order = np.argsort(text, kind="stable")
            ends = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(item[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), lists], ["doc", "items"])

    return docs.mapInArrow(run, "doc long, items array<long>")


def compared(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Of pairs a, b: a, b, n and m (sizes of their sets), overlap, similar."""
    a = sets.select(F.col("doc").alias("a"), F.col("items").alias("of_a"))
    b = sets.select(F.col("doc").alias("b"), F.col("items").alias("of_b"))
    met = pairs.join(a, "a").join(b, "b")
    rows = met.select("a", "b", F.size("of_a").alias("n"), F.size("of_b").alias("m"), F.size(F.array_intersect("of_a", "of_b")).alias("overlap"))
    return staged(rows.withColumn("similar", q * F.col("overlap") >= p * (F.col("n") + F.col("m") - F.col("overlap"))), "compared")


def remaining_pairs(met: DataFrame, found: DataFrame, roots: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs a < b of documents that share a bucket, are of different classes and may be similar.

    Around the pivot of each bucket in which classes meet, documents are near (they differ from it by few shingles) or
    far. The zones overlap by more than similar documents can differ, so each such pair is in one of them together. Near
    ones are told apart by what they do not share with the pivot, far ones by their whole sets. Neither document is the
    pivot, so a bucket matters if others than it are of several classes.
    """
    rows = met.filter("id != pivot").join(roots.withColumnRenamed("doc", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed_ones = rows.groupBy("segment").agg((F.min("root") != F.max("root")).alias("mixed")).filter("mixed").select("segment")
    around = rows.join(mixed_ones, "segment")
    around = around.select(F.col("id").alias("a"), F.col("pivot").alias("b"), "root").distinct().join(found, ["a", "b"])
    around = staged(around.select("a", "b", "root", "n", "m", (F.col("n") + F.col("m") - 2 * F.col("overlap")).alias("delta")), "mixed")
    a = sets.select(F.col("doc").alias("a"), F.col("items").alias("of_a"))
    b = sets.select(F.col("doc").alias("b"), F.col("items").alias("of_b"))
    # Of two similar sets with one within FAR * m of the pivot, the other is within FAR * m and what both may differ by.
    reach = FAR + (1 + FAR) * (q - p) / p
    near = around.filter(F.col("delta") <= reach * F.col("m")).join(a, "a").join(b, "b")
    items = F.concat(F.array_except("of_a", "of_b"), F.array_except("of_b", "of_a"))
    far = around.filter(F.col("delta") > FAR * F.col("m")).join(a, "a")
    zones = [
        near.select(F.xxhash64("b", F.lit(0)).alias("pivot"), F.col("a").alias("id"), "root", "n", "delta", F.explode(items).alias("item")),
        far.select(F.xxhash64("b", F.lit(1)).alias("pivot"), F.col("a").alias("id"), "root", "n", F.col("n").alias("delta"), F.explode("of_a").alias("item")),
    ]
    return delta_pairs(staged(zones[0].unionByName(zones[1]), "deltas"), p, q)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """Per row: ``key``, class_id (the smallest key of its class)."""
    p, q = Fraction(similarity).limit_denominator(1_000).as_integer_ratio()
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    bare = rows.filter("doc IS NULL").select(F.col("doc").alias(key), F.lit(None).cast("long").alias("class_id"))
    rows = rows.filter("doc IS NOT NULL")
    drawn = staged(sketches(rows, size), "sketches")
    same = ["same_low", "same_high", "n"]
    groups = staged(drawn.groupBy(*same).agg(F.min("doc").alias("rep")), "equal-sets")
    # The first document of each group of equal sets goes on with its bands; all know their first document.
    members = drawn.join(groups, same).select("doc", "rep", F.when(F.col("doc") == F.col("rep"), F.col("bands")).alias("bands"))
    members = staged(members, "members")

    met = with_pivots(members.filter("doc = rep").select(F.col("doc").alias("id"), F.explode("bands").alias("segment")))
    needed = met.select(F.col("id").alias("doc")).distinct()
    if needed.count() <= BROADCAST_KEYS:
        needed = F.broadcast(needed)
    sets = staged(shingle_sets(rows.join(needed, "doc", "left_semi"), size), "shingle-sets")
    if not sets.groupBy("doc").count().filter("count > 1").isEmpty():  # repeated rows
        sets = staged(sets.dropDuplicates(["doc"]), "shingle-sets")

    found = compared(met.filter("id != pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), sets, p, q)
    links = found.filter("similar").select("a", "b")
    classes = members.select("doc", F.col("doc").alias("root")).limit(0) if links.isEmpty() else staged(components(links), "classes")
    new = compared(remaining_pairs(met, found, classes, sets, p, q), sets, p, q).filter("similar").select("a", "b")
    if not new.isEmpty():
        known = classes.filter("doc != root").select(F.col("doc").alias("a"), F.col("root").alias("b"))
        classes = staged(components(known.unionByName(new)), "classes")
    named = members.select("doc", "rep").join(classes.withColumnRenamed("doc", "rep"), "rep", "left")
    return named.select(F.col("doc").alias(key), F.coalesce("root", "rep").alias("class_id")).unionByName(bare)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the first document of every class (and rows without doc_id), with the columns it came with."""
    return docs.join(near_duplicates(docs).filter("doc_id != class_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
