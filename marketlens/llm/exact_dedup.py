"""Exact deduplication by content-defined chunk recipes.

Every text is cut where a rolling hash of its last 16 bytes says so, hence alike wherever the same passage stands. The
chunks are deduplicated once, by digest and content, which verifies that a digest names one content. From then on a
document is its recipe, the ordered list of its chunks' identifiers: equal recipes are equal texts. Grouping, counting
and joining move recipes (16 bytes per chunk of about 2 KB), never the documents again.

Should one digest name several contents, the identifiers of those contents get their rank among them appended, so the
result is exact for any digest.

Texts are equal when identical after no change. Null counts as empty; empty texts equal one another. Ties have one
answer, as of equal texts the row with the largest key stays. Extra columns are not read. An empty table gives an empty
result. Very long texts are many chunks of at most ``MOST`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import random_table, slices, staged, table, text_bytes

# Chunk lengths in bytes: a cut is looked for from LEAST on, comes after about 1 << MEAN_BITS more, and by MOST at the latest.
LEAST, MEAN_BITS, MOST = 512, 11, 16_384
_VALUE = random_table(7).astype(np.uint32)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions after which a chunk may end: the low bits of the hash of the last 16 bytes are zero."""
    h = _VALUE[data]
    for reach in (1, 2, 4, 8):
        h[reach:] += h[:-reach] << np.uint32(reach)
    return np.flatnonzero((h >> np.uint32(12)) & np.uint32((1 << MEAN_BITS) - 1) == 0) + 1


def chunk_ends(cuts: np.ndarray, start: int, end: int) -> list[int]:
    out = []
    while end - start > LEAST:
        k = int(np.searchsorted(cuts, start + LEAST))
        start = min(int(cuts[k]) if k < len(cuts) else end, start + MOST, end)
        out.append(start)
    if start < end:
        out.append(end)
    return out


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_bytes: int = 16) -> DataFrame:
    """Per row: key, text_sha256, recipe (digests in order, joined), chunks (digest and content)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, offsets = text_bytes(batch.column(text))
            cuts, raw = cut_points(data), data.tobytes()
            shas, lists, found, counts = [], [], [], [0]
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                shas.append(hashlib.sha256(raw[start:end]).hexdigest())
                digests = []
                for stop in chunk_ends(cuts, start, end):
                    digests.append(hashlib.blake2b(raw[start:stop], digest_size=digest_bytes).digest())
                    found.append((digests[-1], raw[start:stop]))
                    start = stop
                lists.append(b"".join(digests))
                counts.append(len(found))
            chunks = pa.StructArray.from_arrays(
                [pa.array([d for d, _ in found], pa.binary()), pa.array([c for _, c in found], pa.binary())], ["digest", "content"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(shas), pa.array(lists, pa.binary()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), chunks)],
                [key, "text_sha256", "recipe", "chunks"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        cut, f"`{key}` {kind}, text_sha256 string, recipe binary, chunks array<struct<digest: binary, content: binary>>"
    )


def contents(cut: DataFrame) -> DataFrame:
    """The distinct chunks. Copies are merged before the shuffle, so a chunk of a third of all rows is one row per task."""
    return cut.select(F.inline("chunks")).groupBy("digest", "content").agg(F.lit(1).alias("one")).drop("one")


def ambiguous(cut: DataFrame) -> DataFrame:
    """Digests that name several contents. Usually none."""
    return contents(cut).groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")


def with_ranks(cut: DataFrame, several: DataFrame, key: str) -> DataFrame:
    """Recipes in which every identifier is a digest with the rank of its content."""
    named = contents(cut).join(several, "digest").groupBy("digest").agg(F.array_sort(F.collect_list("content")).alias("contents"))
    several = named.select("digest", F.posexplode("contents").alias("rank", "content"))
    rows = cut.withColumn("row", F.monotonically_increasing_id())  # tells repeated rows apart
    pieces = rows.select("row", key, "text_sha256", F.posexplode_outer("chunks").alias("pos", "chunk"))
    pieces = pieces.select("row", key, "text_sha256", "pos", F.col("chunk.digest").alias("digest"), F.col("chunk.content").alias("content"))
    ids = pieces.join(several, ["digest", "content"], "left").withColumn(
        "id", F.struct("pos", F.concat(F.hex("digest"), F.lit("."), F.coalesce("rank", F.lit(0)).cast("string")).alias("name"))
    )
    lists = ids.groupBy("row", key, "text_sha256").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return lists.select(key, "text_sha256", F.array_join("ids.name", " ", "").cast("binary").alias("recipe"))


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_bytes: int = 16) -> DataFrame:
    """Per row: key, keep_id, group_size, kept, text_sha256.

    Rows with equal keys and texts stay or go together. A null key is smaller than any other.
    """
    cut = staged(recipes(docs, key, text, digest_bytes), "recipes")
    several = staged(ambiguous(cut), "digests")
    lists = cut.select(key, "text_sha256", "recipe") if several.isEmpty() else with_ranks(cut, several, key)
    # Stored, so that both sides of the join are plain shuffles and Spark can split a recipe that very many rows have.
    groups = staged(lists.groupBy("recipe").agg(F.max(key).alias("keep_id"), F.count("*").alias("group_size")), "recipe-groups")
    return lists.join(groups, "recipe").select(
        key, "keep_id", "group_size", F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts the row with the largest doc_id (and rows without doc_id), with the columns it came with."""
    return docs.join(exact_duplicates(docs).filter("NOT kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
