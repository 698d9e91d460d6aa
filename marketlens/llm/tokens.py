"""Token counts of whole texts.

Texts are encoded in Arrow functions that return lengths only. A text is split at boundaries where the tokenizer
never joins what lies on both sides (one space between two characters that are no white space: its pattern takes such
a space with what follows), so that a text of any length is encoded in small parts and each distinct part only once
per batch. Batches hold about ``batch_bytes`` of text, whatever the number of rows.

Null and empty texts have 0 tokens. Repeated rows stay. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import slices, table

# A space between two characters that are not white space.
SAFE = re.compile(r"(?<=\S) (?=\S)")
# Distinct parts whose lengths a worker remembers; past that it starts anew. Only speed depends on it.
REMEMBERED = 1_000_000


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Lengths(dict):
    """Tokens of each part, looked up by the part; ``lead`` stands before every part."""

    def __init__(self, path: str, lead: str):
        super().__init__()
        self.encode, self.lead = tokenizer(path).encode_batch_fast, lead

    def learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(parts)
        for start in range(0, len(new), 4096):
            some = new[start : start + 4096]
            encoded = self.encode([self.lead + p for p in some], add_special_tokens=False)
            self.update(zip(some, map(len, encoded), strict=True))


@cache
def _lengths(path: str, lead: str) -> _Lengths:
    return _Lengths(path, lead)


def lengths(texts: list[str], path: str) -> list[int]:
    """Number of tokens of each text."""
    first, later = _lengths(path, ""), _lengths(path, " ")
    split = [SAFE.split(t) for t in texts]
    first.learn({p[0] for p in split})
    heads = [first[p[0]] for p in split]
    later.learn({x for p in split for x in p[1:]})
    return [head + sum(map(later.__getitem__, p[1:])) for head, p in zip(heads, split, strict=True)]


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 1024, key: str = "doc_id", text: str = "text", batch_bytes: int = 1 << 20
) -> DataFrame:
    """Per row: ``key``, n_bytes, n_tokens, over_limit (more than ``limit`` tokens). The file must be on every executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, batch_bytes):
            texts = pc.fill_null(batch.column(text), "")
            found = pa.array(lengths(texts.to_pylist(), tokenizer_path), pa.int64())
            sizes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), sizes, found, pc.greater(found, limit)], [key, "n_bytes", "n_tokens", "over_limit"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
