import hashlib
import random

import duckdb
import numpy as np
import pytest

from marketlens.llm import substrings as S


def brute(rows, depth):
    """doc -> (bytes, removed, stretches, kept)."""
    seen, out = set(), {}
    for key, text in sorted(set(rows)):
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - depth + 1):
            w = b[i : i + depth]
            if w in seen:
                gone[i] += 1
                gone[min(i + depth, len(b))] -= 1
            seen.add(w)
        gone = gone.cumsum()[: len(b)] > 0
        starts = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[key] = (len(b), int(gone.sum()), starts, np.frombuffer(b, np.uint8)[~gone].tobytes())
    return out


def found(df):
    rows = df.collect()
    return {r.doc_id: (r.n_bytes, sum(e - s for s, e in zip(r.starts, r.ends, strict=True)), len(r.starts), bytes(r.kept)) for r in rows}


@pytest.mark.parametrize("settled", [500_000, 7])
def test_against_brute_force(monkeypatch, spark, odd_docs, odd_rows, settled):
    monkeypatch.setattr(S, "SETTLED", settled)
    assert found(S.without_repeats(odd_docs)) == brute([r[:2] for r in odd_rows], 100)


@pytest.mark.parametrize("seed", range(4))
def test_dense_repeats(monkeypatch, spark, seed):
    """Few letters, periods, shared pieces, and parts shorter than the texts."""
    monkeypatch.setattr(S, "PART", 256)
    monkeypatch.setattr(S, "_PLACE", np.uint64(511))
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("ab", k=rng.randrange(5, 90))) for _ in range(12)] + ["ab" * 40, "a" * 60]
    rows = [(rng.randrange(10**6) * 100 + i, "".join(rng.choices(pieces, k=rng.randrange(0, 12)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(S.without_repeats(docs, depth=24, anchor=8)) == brute(rows, 24)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    want = {k: (n, r, s, hashlib.sha256(kept).hexdigest()) for k, (n, r, s, kept) in brute(rows, 100).items()}
    assert {r[0]: tuple(r)[1:] for r in S.op10_substring_dedup(spark, sf).collect()} == want


def test_no_rows_and_no_keys(spark, no_docs, keyless):
    assert S.without_repeats(no_docs).count() == 0
    text = "same " * 50
    rows = spark.createDataFrame([(None, text), (None, text), (4, text), (4, text)], "doc_id long, text string")
    kept = [(r.doc_id, len(r.kept)) for r in S.without_repeats(rows).collect()]
    assert sorted(k for k in kept if k[0] is None) == [(None, 250)] * 2
    assert len(set(k for k in kept if k[0])) == 1 and len(kept) == 4 and S.without_repeats(keyless).count() == 3
