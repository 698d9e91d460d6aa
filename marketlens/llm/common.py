"""Shared parts: reading tables, staging results, and vectorised work on the bytes of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from marketlens.session import work_dir

# Most bytes of text that one vectorised step holds, unless a single text is longer.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: lineage ends here, a lost executor loses nothing."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string (as UTF-8) or binary column and its n + 1 offsets. Null counts as empty."""
    texts = column.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text comes alone."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_table(seed: int, n: int = 256) -> np.ndarray:
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Letters, digits and every byte of a character beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# For bytes.translate(): lower-cases A-Z, turns all that is in no word into a space.
TO_WORDS = bytes(_LOWER[b] if WORD_BYTE[b] else 32 for b in range(256))

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = random_table(1)[_LOWER]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class SpanHash:
    """Hashes of any spans of a byte array in constant time each: differences of running polynomial sums.

    ``values`` gives each byte's 64-bit value; the default makes A-Z and a-z the same.
    """

    def __init__(self, data: np.ndarray, values: np.ndarray = _BYTE_VALUE):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * _powers(_BASE, len(data)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; no word crosses texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = WORD_BYTE[data]
    cuts = np.zeros(len(data) + 1, bool)
    cuts[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cuts[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cuts[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, A-Z lower-cased."""
    starts, ends, text = word_spans(data, offsets)
    return SpanHash(data)(starts, ends), text


def in_runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. for each length, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def distinct_items(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (hash, text) pairs in some order, and how often each occurs."""
    order = np.argsort(mixed(hashes ^ mixed(text.astype(np.uint64))), kind="stable")
    h, t = hashes[order], text[order]
    fresh = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])][: len(h)])
    return h[fresh], t[fresh], np.diff(np.r_[fresh, len(h)])
