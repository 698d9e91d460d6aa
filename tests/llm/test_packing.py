import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlens.llm import packing as P
from marketlens.llm import pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, pieces, window):
    """Every id is in exactly one piece, every piece gapless in its sequence. Returns the sequences' lengths."""
    whole, by_doc, by_sequence = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert by_doc.keys() == {k for k, _ in rows}
    for key, text in rows:
        ids, at = whole.encode(text or "", add_special_tokens=False).ids + [1], 0
        for p in sorted(by_doc[key], key=lambda p: p.start):
            part = np.array(ids[at : at + p.length], "<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes())) and p.length > 0
            at += p.length
        assert at == len(ids)
    sizes = []
    for some in by_sequence.values():
        at = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes.append(at)
    assert max(sizes, default=0) <= window
    return sizes


@pytest.mark.parametrize("window, shard", [(2048, 2048), (64, 3)])
def test_odd_rows(monkeypatch, spark, odd_docs, odd_rows, window, shard):
    monkeypatch.setattr(P, "SHARD", shard)
    rows = {r[:2] for r in odd_rows}
    pieces = P.packed(odd_docs.dropDuplicates(["doc_id"]), PATH, window).collect()
    check(rows, pieces, window)


def test_whole_table_is_nearly_without_padding(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    sizes = check(rows, P.op8_packing(spark, sf).collect(), 2048)
    assert sum(2048 - s for s in sizes) < 0.02 * sum(sizes) + 8 * 2048


def test_empty_and_keyless(spark, no_docs, keyless):
    assert P.packed(no_docs, PATH).count() == 0
    assert sum(p.length for p in P.packed(keyless, PATH).collect()) > 3


def test_parts_give_the_ids_of_whole_texts():
    rng = random.Random(2)
    pieces = ["a", "B", " ", "\n", "'s", "1", "<|endoftext|>", "É", "́", "\xa0", "日", ".", ",", "Σ", "İ", "word", "H̱"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(16))) for _ in range(2_000)]
    encode = P.Encoder(PATH)
    raw = [t.encode() for t in texts]
    found = encode(b"".join(raw), [0, *np.cumsum([len(r) for r in raw]).tolist()])
    for t, ids in zip(texts, found, strict=True):
        assert ids.tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids + [1]


def test_scores_are_bm25_and_neighbours_come_by_score():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 60, rng.integers(5, 40)).astype("<u2") for _ in range(30)]
    index = P.Shard(texts)
    mean = np.mean([len(t) for t in texts])
    want = np.zeros(30)
    query = {t for t in set(texts[3].tolist()) if sum(t in x for x in texts) > 1}
    assert len(query) <= P.QUERY_TERMS
    for t in query:
        n = sum(t in x for x in texts)
        for d, x in enumerate(texts):
            f = (x == t).sum()
            want[d] += np.log1p((30 - n + 0.5) / (n + 0.5)) * f * (P.K1 + 1) / (f + P.K1 * (1 - P.B + P.B * len(x) / mean))
    assert np.allclose(index.scores(3), want)
    unused = rng.random(30) < 0.7
    order = list(index.neighbours(3, unused))
    assert sorted(order) == np.flatnonzero(unused).tolist() and (np.diff(want[order]) <= 1e-12).all()


@pytest.mark.parametrize("weak", [False, True])
def test_ids_with_little_memory_and_equal_hashes(monkeypatch, weak):
    """Parts are forgotten and encoded anew; parts with equal hashes are told apart."""
    monkeypatch.setattr(P, "REMEMBERED", 40)
    monkeypatch.setattr(P, "STEP_BYTES", 300)
    if weak:
        for module in (P, pieces):
            monkeypatch.setattr(module, "word_keys", lambda eights, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(5))
    rng = random.Random(6)
    words = [f"word{rng.randrange(300)}" + rng.choice(["", ".", "é", "-and-a-longer-end"]) for _ in range(1_500)]
    texts = [" ".join(words[i : i + 40]) for i in range(0, 1_500, 40)]
    encode = P.Encoder(PATH)
    raw = [t.encode() for t in texts]
    found = encode(b"".join(raw), [0, *np.cumsum([len(r) for r in raw]).tolist()])
    for t, ids in zip(texts, found, strict=True):
        assert ids.tolist() == encode.tokenizer.encode(t, add_special_tokens=False).ids + [1]
    assert len(encode.known.start) < 200
