"""Packing of documents into training sequences by lexical retrieval.

Documents become token ids. Whole windows of a long document are sequences by themselves; what is left of each document
(less than a window) is packed with its lexical neighbours. For that the rests are range-partitioned by a sketch of
their rarer tokens, so that documents with common vocabulary come together, and each partition is worked through in
shards of ``SHARD`` rests. A shard has an inverted index with BM25 weights. The next unused rest is a seed; the index
returns unused neighbours by their score for the seed's most telling terms; they fill the seed's window in that order,
and the last one is cut where the window ends, its remainder staying unused. So every sequence is full but the last of
a partition.

A sequence's tokens are at most ``window``; each token is in exactly one piece. Null and empty texts are the end token
alone. Equal texts are neighbours like any others. Keys are integers; equal keys are distinct documents with their own
pieces. Extra columns are not read. An empty table gives an empty result.

Texts are encoded in parts between white space (the tokenizer drops white space and joins nothing across it), each
distinct part once per piece of a text, so no text is too long; the parts' ids are gathered by array operations. The
tokenizer must be of that kind, with a sign at words' ends.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import in_runs, mixed, slices, staged, table, text_bytes
from marketlens.llm.pieces import _eights, distinct_words, equal_spans, windows, word_keys, words_between

WINDOW, END = 2048, 1
SHARD = 2048
QUERY_TERMS = 24
K1, B = 1.2, 0.75
# Tokens with smaller ids were merged first and are in most texts; they say little about which texts are alike.
COMMON_IDS = 2_000
# Distinct parts whose ids a worker remembers, some 50 bytes each; of more, the half not used for longest goes. Only speed
# depends on it.
REMEMBERED = 600_000
# Bytes of text that are encoded in one step.
STEP_BYTES = 1 << 20
_IN_PART = np.ones(256, bool)
_IN_PART[[32, *range(9, 14)]] = False

# Words of Latin letters that no normalisation turns into anything else than a letter, with at most one mark. The
# tokenizer cuts between letters and marks, and its last token of either carries the sign of a word's end.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-įıĲ-ſ]+[.,;:!?]?")
MARKS = b".,;:!?"
# So many plain words are encoded as one text.
TOGETHER = 64

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECE.split(", ")]


class Growing:
    """An array that is added to at its end."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1024, kind), 0

    def __len__(self) -> int:
        return self.n

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.n]

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            room = np.empty(2 * (self.n + len(more)), self.room.dtype)
            room[: self.n] = self.values
            self.room = room
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)


class Known:
    """Parts and their ids in arrays. A part is found by its hash and then compared byte by byte."""

    def __init__(self):
        self.clock = 0
        self._empty()

    def _empty(self) -> None:
        self.text, self.ids = Growing(np.uint8), Growing("<u2")
        self.start, self.length, self.id_start, self.id_length, self.used = (Growing(np.int64) for _ in range(5))
        self.keys, self.number = np.empty(0, np.uint64), np.empty(0, np.int64)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The number of every part, -1 where it is not known."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        maybe = np.flatnonzero(self.keys[at] == keys)
        number = self.number[at[maybe]]
        same = equal_spans(data, starts[maybe], ends[maybe], self.text.values, self.start.values[number], self.length.values[number])
        out[maybe[same]] = number[same]
        return out

    def add(self, keys: np.ndarray, parts: list[bytes], ids: list[bytes]) -> np.ndarray:
        """The numbers that the parts get."""
        number = np.arange(len(self.start), len(self.start) + len(parts))
        for values, starts, lengths, new, width in ((self.text, self.start, self.length, parts, 1), (self.ids, self.id_start, self.id_length, ids, 2)):
            size = np.fromiter(map(len, new), np.int64, len(new)) // width
            starts.add(len(values) + np.cumsum(size) - size)
            lengths.add(size)
            values.add(np.frombuffer(b"".join(new), values.room.dtype))
        self.used.add(np.full(len(parts), self.clock))
        self._index(np.r_[self.keys, keys], np.r_[self.number, number])
        return number

    def _index(self, keys: np.ndarray, number: np.ndarray) -> None:
        self.keys, first = np.unique(keys, return_index=True)  # of parts with equal hashes one is found
        self.number = number[first]

    def shrink(self, most: int) -> None:
        if len(self.start) <= most:
            return
        used, keys, number = self.used.values, self.keys, self.number
        kept = used[number] > np.partition(used[number], len(number) // 2)[len(number) // 2]
        keys, number = keys[kept], number[kept]
        old = self.text.values, self.ids.values, *(x.values[number] for x in (self.start, self.length, self.id_start, self.id_length, self.used))
        text, ids, start, length, id_start, id_length, used = old
        self._empty()
        self.text.add(text[np.repeat(start, length) + in_runs(length)])
        self.ids.add(ids[np.repeat(id_start, id_length) + in_runs(id_length)])
        self.start.add(np.cumsum(length) - length)
        self.id_start.add(np.cumsum(id_length) - id_length)
        for mine, values in ((self.length, length), (self.id_length, id_length), (self.used, used)):
            mine.add(values)
        self._index(keys, np.arange(len(keys)))


class Encoder:
    """The ids of texts, from those of their parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("token ids need 16 bits")
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.known = Known()

    def encode(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each of some distinct parts, as little-endian 16-bit numbers."""
        out: dict[bytes, bytes] = {}
        texts = [p.decode() for p in parts]
        plain = [i for i, t in enumerate(texts) if PLAIN.fullmatch(t)]
        for start in range(0, len(plain), TOGETHER * 64):
            some = plain[start : start + TOGETHER * 64]
            lines = [some[k : k + TOGETHER] for k in range(0, len(some), TOGETHER)]
            found = self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in line) for line in lines], add_special_tokens=False)
            for line, e in zip(lines, found, strict=True):
                self._cut(e.ids, [parts[i] for i in line], out)
        rest = [p for p in parts if p not in out]
        for start in range(0, len(rest), 4096):
            some = rest[start : start + 4096]
            found = self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
            out.update(zip(some, (np.array(e.ids, "<u2").tobytes() for e in found), strict=True))
        return [out[p] for p in parts]

    def _cut(self, ids: list[int], words: list[bytes], out: dict[bytes, bytes]) -> None:
        """Ids of words that were encoded together: each letters with at most one mark, and so one or two word ends."""
        found = np.array(ids, "<u2")
        ends = np.flatnonzero(self.ends[found]) + 1
        last = np.cumsum([1 if w[-1] not in MARKS else 2 for w in words]) - 1
        if len(ends) != last[-1] + 1:  # not as expected: these are encoded one by one
            return
        bounds, raw = (2 * ends[last]).tolist(), found.tobytes()
        for w, a, b in zip(words, [0, *bounds], bounds, strict=False):
            out[w] = raw[a:b]

    def __call__(self, raw: bytes, bounds: list[int]) -> Iterator[np.ndarray]:
        """The ids of each text and the end token. ``bounds``: where texts start and end in ``raw``."""
        data, offsets = np.frombuffer(raw, np.uint8), np.asarray(bounds, np.int64)
        sizes = np.zeros(len(bounds) - 1, np.int64)
        found = [np.empty(0, "<u2")]
        for start, end in windows(data, offsets, _IN_PART, STEP_BYTES):
            starts, ends, text = words_between(data, offsets, _IN_PART, start, end)
            if not len(starts):
                continue
            piece = data[start:end]
            one, group = distinct_words(piece, starts, ends)
            starts, ends = starts[one], ends[one]
            keys = word_keys(_eights(piece), starts, ends)
            known = self.known
            known.shrink(REMEMBERED)
            known.clock += 1
            number = known.find(piece, starts, ends, keys)
            new = np.flatnonzero(number < 0)
            if len(new):
                parts = [raw[a:b] for a, b in zip((starts[new] + start).tolist(), (ends[new] + start).tolist(), strict=True)]
                number[new] = known.add(keys[new], parts, self.encode(parts))
            known.used.values[number] = known.clock
            each = known.id_length.values[number][group]
            found.append(known.ids.values[np.repeat(known.id_start.values[number][group], each) + in_runs(each)])
            np.add.at(sizes, text, each)
        whole, stops = np.concatenate(found), np.cumsum(sizes)
        end_token = np.array([END], "<u2")
        for a, b in zip((stops - sizes).tolist(), stops.tolist(), strict=True):
            yield np.concatenate([whole[a:b], end_token])


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_TOKEN_HASH = mixed(np.arange(1 << 16, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(1)


def sketch(ids: np.ndarray) -> int:
    rare = ids[ids >= COMMON_IDS]
    return int(_TOKEN_HASH[rare if len(rare) else ids].min())


def encoded(docs: DataFrame, path: str, window: int) -> DataFrame:
    """Whole windows as pieces; the rest of each document (sequence_id null) with its ids and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(path), TaskContext.get().partitionId() << 40
        for batch in slices(batches, most=4 * STEP_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            rows = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), encode(data.tobytes(), offsets.tolist()), strict=True):
                whole = len(ids) - len(ids) % window
                for start in range(0, whole, window):
                    rows.append((key, start, window, crc(ids[start : start + window]), len(ids), 2 * number, 0, None, None))
                    number += 1
                if whole < len(ids):
                    rest = ids[whole:]
                    rows.append((key, whole, len(rest), None, len(ids), None, None, rest.tobytes(), sketch(rest)))
            kinds = [*[pa.int64()] * 7, pa.binary(), pa.int64()]
            columns = zip(*rows, strict=True) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*NAMES, "ids", "sketch"])

    return docs.mapInArrow(run, PIECE + ", ids binary, sketch long")


class Shard:
    """An inverted index of a shard's rests with BM25 weights."""

    def __init__(self, texts: list[np.ndarray]):
        n = len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        pairs, counts = np.unique(np.concatenate(texts).astype(np.int64) * n + np.repeat(np.arange(n), sizes), return_counts=True)
        term, self.doc = pairs // n, pairs % n
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        frequency = np.diff(np.r_[first, len(term)])
        slot = np.repeat(np.arange(len(first)), frequency)
        idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))
        self.weight = idf[slot] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * sizes[self.doc] / sizes.mean()))
        self.first, self.frequency = first, frequency
        # Of each rest the QUERY_TERMS terms of most weight that another rest has too.
        order = np.lexsort((-self.weight, frequency[slot] < 2, self.doc))
        place = in_runs(np.bincount(self.doc, minlength=n))
        kept = order[(place < QUERY_TERMS) & (frequency[slot[order]] > 1)]
        self.terms = slot[kept]
        self.bounds = np.searchsorted(self.doc[kept], np.arange(n + 1))
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[self.bounds[seed] : self.bounds[seed + 1]]
        size = self.frequency[terms]
        at = np.repeat(self.first[terms], size) + in_runs(size)
        return np.bincount(self.doc[at], self.weight[at], self.n)

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused rests by falling score (ties: in order), then those without common terms in order."""
        score = np.where(unused, self.scores(seed), -1)
        few = min(32, self.n)
        least = max(float(-np.partition(-score, few - 1)[few - 1]), 0.0)
        for some in (np.flatnonzero(score > least), np.flatnonzero((score <= least) & unused)):
            yield from some[np.argsort(-score[some], kind="stable")].tolist()


def packed_rests(rests: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        offset, rows, waiting = 0, [], []

        def put(row: dict, at: int, size: int) -> None:
            nonlocal offset, number
            ids = np.frombuffer(row["ids"], "<u2")[at : at + size]
            rows.append((row["doc_id"], row["start"] + at, size, crc(ids), row["doc_tokens"], 2 * number + 1, offset))
            offset += size
            if offset == window:
                offset, number = 0, number + 1

        def pack(shard: list[dict]) -> None:
            index = Shard([np.frombuffer(r["ids"], "<u2") for r in shard])
            used = np.zeros(len(shard), np.int64)
            unused = np.ones(len(shard), bool)

            def take(k: int) -> None:
                size = min(shard[k]["length"] - int(used[k]), window - offset)
                put(shard[k], int(used[k]), size)
                used[k] += size
                unused[k] = used[k] < shard[k]["length"]

            for seed in range(len(shard)):
                while unused[seed]:
                    take(seed)
                    if not offset:
                        continue
                    for k in index.neighbours(seed, unused):
                        take(k)
                        if not offset:
                            break
                    else:
                        break  # nothing unused is left: the window goes on with the next shard

        def flush() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(NAMES)
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)
            rows.clear()
            return out

        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= SHARD:
                pack(waiting[:SHARD])
                waiting = waiting[SHARD:]
                yield flush()
        if waiting:
            pack(waiting)
        yield flush()

    return rests.mapInArrow(run, PIECE)


def packed(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. The file must be on every executor."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = staged(encoded(rows, tokenizer_path, window), "token-ids")
    rests = found.filter("sequence_id IS NULL").select("doc_id", "start", "length", "doc_tokens", "ids", "sketch")
    near = rests.repartitionByRange("sketch", "doc_id", "start").sortWithinPartitions("sketch", "doc_id", "start")
    return found.filter("sequence_id IS NOT NULL").select(*NAMES).unionByName(packed_rests(near.drop("sketch"), window))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def packed_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents as pieces of sequences."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))
