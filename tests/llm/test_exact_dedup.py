import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from marketlens.llm import exact_dedup as E


def brute(rows):
    groups = defaultdict(list)
    for k, t in rows:
        groups[t or ""].append(k)
    top = {t: max((k for k in ks if k is not None), default=None) for t, ks in groups.items()}
    return sorted(
        ((k, top[t or ""], len(groups[t or ""]), k == top[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for k, t in rows), key=str
    )


@pytest.mark.parametrize("digest_bytes", [16, 1])  # one byte: most digests name many contents
def test_against_brute_force(spark, odd_docs, odd_rows, digest_bytes):
    found = sorted(map(tuple, E.exact_duplicates(odd_docs, digest_bytes=digest_bytes).collect()), key=str)
    assert found == brute([r[:2] for r in odd_rows])


@pytest.mark.parametrize("digest_bytes", [16, 1])
def test_whole_table(spark, digest_bytes):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf}/documents.parquet'")
    found = E.exact_duplicates(spark.read.parquet(f"{sf}/documents.parquet"), digest_bytes=digest_bytes)
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(E.OP7_SQL).fetchall())


def test_no_rows_and_no_keys(spark, no_docs, keyless):
    assert E.exact_duplicates(no_docs).count() == 0
    found = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in E.exact_duplicates(keyless).collect())
    assert found == [(0, 0, 1, True), (0, 5, 2, False), (5, 5, 2, True)]


def test_cuts_follow_the_content():
    data = np.random.default_rng(0).integers(0, 256, 200_000, dtype=np.uint8)
    ends = E.chunk_ends(E.cut_points(data), 0, len(data))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= E.MOST and sizes[:-1].min() >= E.LEAST
    moved = np.concatenate([np.zeros(777, np.uint8), data])
    shifted = E.chunk_ends(E.cut_points(moved), 0, len(moved))
    assert len({e - 777 for e in shifted} & set(ends)) > 0.9 * len(ends)
    assert E.chunk_ends(np.empty(0, np.int64), 5, 5) == []
    assert E.chunk_ends(np.empty(0, np.int64), 0, 40_000) == [16_384, 32_768, 40_000]


def test_long_documents_move_as_recipes(spark, odd_docs):
    rows = E.recipes(odd_docs).select("doc_id", "recipe", "chunks").collect()
    assert max(len(r.recipe) for r in rows) < 0.05 * max(sum(len(c.content) for c in r.chunks) for r in rows)


def test_stage_keeps_rows_and_columns(spark, odd_docs, keyless):
    kept = E.without_copies(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(set(texts)) == len({r.text or "" for r in odd_docs.collect()})
    assert E.without_copies(spark, keyless, "").count() == 3  # rows without doc_id stay
