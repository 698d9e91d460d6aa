"""Removal of repeated substrings by a depth-limited radix sort of suffixes.

A window is a suffix cut off after ``depth`` bytes. Windows that are equal through all ``depth`` bytes are repeats; the
first one (smallest document, then position) stays, the bytes under the others go. The windows are ordered digit by
digit, most significant first, and only groups that still have several members reach the next pass.

A window's most significant digit is its anchor: of the runs of ``anchor`` bytes inside the window, the one with the
smallest hash. It depends on the window's bytes only, so equal windows have equal anchors at equal places. Neighbouring
windows share their anchor, so the first pass handles a stretch of windows as one row (about one row per 32 bytes).
In each later pass a stretch is cut at fixed distances from its anchor into blocks of ``WIDTHS`` windows; the digit of a
block is all that its windows have in common, which grows from pass to pass until, at one window per block, it is the
whole window. In every pass

* equal stretches collapse into the earliest, all windows of the others are repeats,
* stretches whose digit nobody else has are done: none of their windows is a repeat,
* different stretches with the same digit go to the next pass.

Digits and stretches are compared by two independent 64-bit hashes. Every task first settles its own rows, so it sends
at most one row per digit, and a digit that a third of all stretches have is no hot key.

The key is an integer; rows with equal keys must be equal and count as one document, rows without a key lose nothing
and are compared with none. Null counts as empty; texts shorter than ``depth`` have no windows and lose nothing.
Matches never cross documents. Of equal texts the one with the smallest key stays whole. Extra columns are not read. Long texts are processed in overlapping
parts of ``PART`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import SpanHash, in_runs, mixed, random_table, slices, staged, table, text_bytes

DEPTH, ANCHOR = 100, 32
WIDTHS = (18, 4, 1)
PART = 2 << 20
# Rows that a task settles together.
SETTLED = 500_000

_FIRST, _SECOND = random_table(2), random_table(3)
_PLACE = np.uint64(PART * 2 - 1)
_BITS = 7  # a stretch has at most DEPTH - ANCHOR + 1 < 128 windows

# digit, whole: hashes. place: first window's start, then windows - 1, then the anchor's distance, _BITS each.
# kind: SENT and SURE rows are compared with other tasks' (SURE: others with this digit are known), REPEATED ones go to
# the next pass as they are, GONE ones are stretches of removed bytes from place up to whole.
SENT, SURE, REPEATED, GONE = range(4)
ROW = "digit long, whole long, doc long, place long, kind int"


def pack(lo: np.ndarray, n: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return (lo << (2 * _BITS)) | ((n - 1) << _BITS) | distance


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << _BITS) - 1
    return place >> (2 * _BITS), ((place >> _BITS) & low) + 1, place & low


def stretches(data: np.ndarray, offsets: np.ndarray, depth: int, anchor: int) -> tuple[np.ndarray, ...]:
    """digit, whole, text number, first window's start (in data), windows, anchor's distance; of at most 2 * PART bytes."""
    if len(data) < depth:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, *[np.int64] * 4))
    per = depth - anchor + 1
    at = np.arange(len(data) - anchor + 1)
    digit = SpanHash(data, _FIRST)(at, at + anchor)
    # The smallest of every `per` neighbours, from smallest-so-far in both directions within blocks. Ties: the first.
    order = np.concatenate([(digit & ~_PLACE) | at.astype(np.uint64), np.full(-len(at) % per, 2**64 - 1, np.uint64)]).reshape(-1, per)
    ahead = np.minimum.accumulate(order, axis=1).ravel()
    back = np.minimum.accumulate(order[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(len(data) - depth + 1)
    least = (np.minimum(back[start], ahead[start + per - 1]) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    own = text[start] == text[start + depth - 1]
    start, least = start[own], least[own]
    if not len(start):
        return stretches(data[:0], offsets, depth, anchor)
    first = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1)])
    n = np.diff(np.r_[first, len(start)])
    lo, a = start[first], least[first]
    return digit[a], SpanHash(data, _SECOND)(lo, lo + n - 1 + depth), text[lo], lo, n, a - lo


def document_stretches(data: np.ndarray, offsets: np.ndarray, depth: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The same with starts counted from each text's beginning; a long text in parts that overlap by depth - 1 bytes."""
    if len(data) <= PART or len(offsets) > 2:
        digit, whole, text, lo, n, distance = stretches(data, offsets, depth, anchor)
        yield digit, whole, text, lo - offsets[text], n, distance
        return
    for begin in range(0, len(data) - depth + 1, PART):
        part = data[begin : begin + PART + depth - 1]
        digit, whole, text, lo, n, distance = stretches(part, np.array([0, len(part)]), depth, anchor)
        yield digit, whole, text, lo + begin, n, distance


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal stretches that the given ones cover together."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    number = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    most = int(end.max()) + 2
    reach = np.maximum.accumulate(number * most + end)
    first = np.flatnonzero(np.r_[True, number[1:] * most + start[1:] > reach[:-1]])
    last = np.r_[first[1:] - 1, len(doc) - 1]
    return doc[first], start[first], reach[last] - number[last] * most


def settled(digit: np.ndarray, whole: np.ndarray, doc: np.ndarray, place: np.ndarray, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of ROW for one task's rows, and which given row each comes from (-1: none)."""
    order = np.lexsort((place, doc, whole, digit))
    digit, whole, doc, place = digit[order], whole[order], doc[order], place[order]
    fresh = np.r_[True, digit[1:] != digit[:-1]][: len(digit)]
    new = fresh | np.r_[True, whole[1:] != whole[:-1]][: len(digit)]
    again = np.r_[False, (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])][: len(digit)]  # of a repeated row
    several = np.bincount(np.cumsum(fresh) - 1, new) > 1 if len(digit) else np.empty(0, bool)
    kind = np.where(fresh, np.where(several[np.cumsum(fresh) - 1], SURE, SENT), REPEATED)
    later = ~new & ~again
    lo, n, _ = unpack(place[later])
    gone = merged(doc[later], lo, lo + n - 1 + depth)
    columns = [
        np.r_[digit[new].view(np.int64), mixed(gone[0].astype(np.uint64)).view(np.int64)],
        np.r_[whole[new].view(np.int64), gone[2]],
        np.r_[doc[new], gone[0]],
        np.r_[place[new], gone[1]],
        np.r_[kind[new], np.full(len(gone[0]), GONE)].astype(np.int32),
    ]
    # Rows that need no comparison are dealt out by document.
    free = columns[4] == REPEATED
    columns[0][free] = mixed(columns[2][free].astype(np.uint64)).view(np.int64)
    return columns, np.r_[order[new], np.full(len(gone[0]), -1)]


def first_pass(docs: DataFrame, depth: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            columns, _ = settled(*(np.concatenate(c) for c in zip(*parts, strict=True)), depth)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["digit", "whole", "doc", "place", "kind"])

        for batch in slices(batches, "text", PART):
            keys = batch.column("doc").to_numpy()
            data, offsets = text_bytes(batch.column("text"))
            for digit, whole, text, lo, n, distance in document_stretches(data, offsets, depth, anchor):
                parts.append((digit, whole, keys[text], pack(lo, n, distance)))
                size += len(lo)
                if size >= SETTLED:
                    yield flush()
                    size = 0
        if parts:
            yield flush()

    return docs.mapInArrow(run, ROW)


def with_bytes(docs: DataFrame, rows: DataFrame, depth: int) -> DataFrame:
    """doc, place, span (the bytes under the stretch's windows) of ``rows`` (doc, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("places")
            place, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            lo, n, _ = unpack(place)
            lo, raw = lo + np.repeat(offsets[:-1], sizes), data.tobytes()
            spans = [raw[a:b] for a, b in zip(lo.tolist(), (lo + n - 1 + depth).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("doc").to_numpy(), sizes)), pa.array(place), pa.array(spans, pa.binary())], ["doc", "place", "span"]
            )

    lists = rows.groupBy("doc").agg(F.collect_list("place").alias("places"))
    return docs.join(lists, "doc").select("doc", "text", "places").mapInArrow(run, "doc long, place long, span binary")


def next_pass(rows: DataFrame, width: int, depth: int) -> DataFrame:
    """Cuts stretches (doc, place, span) into blocks of ``width`` windows and settles each task's: ROW and span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "span", PART):
            data, offsets = text_bytes(batch.column("span"))
            doc, place = batch.column("doc").to_numpy(), batch.column("place").to_numpy()
            lo, n, distance = unpack(place)
            low = (distance - n + 1) // width
            blocks = distance // width - low + 1
            row = np.repeat(np.arange(len(doc)), blocks)
            block = low[row] + in_runs(blocks)
            near = np.maximum(block * width, (distance - n + 1)[row])
            far = np.minimum(block * width + width - 1, distance[row])
            start = distance[row] - far
            count, at = far - near + 1, offsets[:-1][row]
            common = at + distance[row] - block * width
            digit = mixed(SpanHash(data, _FIRST)(common, common - width + 1 + depth) + block.astype(np.uint64))
            begin, end = at + start, at + start + count - 1 + depth
            whole = mixed(SpanHash(data, _SECOND)(begin, end) + far.astype(np.uint64))
            columns, source = settled(digit, whole, doc[row], pack(lo[row] + start, count, far), depth)
            raw, begin, end = data.tobytes(), begin.tolist(), end.tolist()
            spans = [raw[begin[k] : end[k]] if k >= 0 else None for k in source.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c) for c in columns), pa.array(spans, pa.binary())], ["digit", "whole", "doc", "place", "kind", "span"]
            )

    return rows.mapInArrow(run, ROW + ", span binary")


def compared(rows: DataFrame, depth: int) -> DataFrame:
    """What a pass decides: ``kind`` GONE (doc, place up to whole) and REPEATED (doc, place, ...)."""
    sent = F.col("kind") <= SURE
    by_digit = Window.partitionBy("digit")
    same = Window.partitionBy("digit", "whole", sent).orderBy("doc", "place")
    # Other kinds only pass through; a digit of theirs that equals one of the compared rows' is told apart by the kind.
    rows = rows.repartition("digit").withColumn("whole_sent", F.when(sent, F.col("whole")))
    judged = rows.select(
        "*",
        F.min("whole_sent").over(by_digit).alias("low"),
        F.max("whole_sent").over(by_digit).alias("high"),
        F.max(F.col("kind") == SURE).over(by_digit).alias("sure"),
        F.count("*").over(by_digit).alias("members"),
    ).filter(~sent | (F.col("members") > 1) | F.col("sure"))
    judged = judged.withColumn("place_in_group", F.rank().over(same))
    repeat = sent & (F.col("place_in_group") > 1)
    start = F.shiftright("place", 2 * _BITS)
    end = start + F.shiftright("place", _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)) + depth
    kind = F.when(~sent, F.col("kind")).when(repeat, GONE).when(F.col("sure") | (F.col("low") != F.col("high")), REPEATED)
    return judged.select(
        "doc",
        F.when(repeat, start).otherwise(F.col("place")).alias("place"),
        F.when(repeat, end).otherwise(F.col("whole")).alias("whole"),
        kind.alias("kind"),
        *(["span"] if "span" in rows.columns else []),
    ).filter("kind IS NOT NULL")


def removed_stretches(docs: DataFrame, depth: int = DEPTH, anchor: int = ANCHOR) -> DataFrame:
    """doc, start, end of bytes to remove; stretches may overlap. ``docs``: doc, text."""
    found = staged(compared(first_pass(docs, depth, anchor), depth), "radix-pass")
    gone = [found.filter(F.col("kind") == GONE)]
    rows = with_bytes(docs, found.filter(F.col("kind") == REPEATED), depth)
    for width in WIDTHS:
        found = staged(compared(next_pass(rows, width, depth), depth), "radix-pass")
        gone.append(found.filter(F.col("kind") == GONE))
        rows = found.filter(F.col("kind") == REPEATED).select("doc", "place", "span")
    spans = [part.select("doc", F.col("place").alias("start"), F.col("whole").alias("end")) for part in gone]
    return reduce(DataFrame.unionByName, spans)


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, anchor: int = ANCHOR
) -> DataFrame:
    """Per row: ``key``, n_bytes, starts and ends of the maximal removed stretches, kept (the remaining bytes)."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    lists = removed_stretches(rows.filter("doc IS NOT NULL"), depth, anchor).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            data, offsets = text_bytes(batch.column("text"))
            raw, gone, bounds = data.tobytes(), batch.column("gone").to_pylist(), offsets.tolist()
            starts, ends, kept = [], [], []
            for i, some in enumerate(gone):
                a, b = _bounds(some or [])
                own, at, parts = raw[bounds[i] : bounds[i + 1]], 0, []
                for s, e in zip(a, b, strict=True):
                    parts.append(own[at:s])
                    at = e
                parts.append(own[at:])
                starts.append(a)
                ends.append(b)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(np.diff(offsets)), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
                [key, "n_bytes", "starts", "ends", "kept"],
            )

    joined = rows.join(lists, "doc", "left").select("doc", "text", "gone")
    return joined.mapInArrow(run, f"`{key}` long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def _bounds(stretches: list[dict]) -> tuple[list[int], list[int]]:
    starts, ends = [], []
    for s, e in sorted((x["start"], x["end"]) for x in stretches):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    lengths = F.zip_with("starts", "ends", lambda a, b: b - a)
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda x, y: x + y).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
