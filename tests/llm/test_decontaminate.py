import hashlib

import duckdb
import pytest

from marketlens.llm import decontaminate as D

ITEMS = "item_id long, text string, doc_id string"


def brute(docs, items, size=13):
    windows = {}
    for name, text in items:
        w = D.words_of(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(name))
    lengths = {len(k) for k in windows}
    for key, text in docs:
        w, hit, names = D.words_of(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        yield key, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.fixture
def op9(spark, monkeypatch):
    def run(docs, items):
        monkeypatch.setattr(D, "table", lambda s, d, name: {"documents": docs, "benchmark": items}[name])
        return [tuple(r) for r in D.op9_decontaminate(spark, "").collect()]

    return run


@pytest.fixture
def items(spark, odd_rows):
    base, passage = odd_rows[9][1], " ".join(odd_rows[15][1].split()[:60])
    rows = [
        (10, base, "x"), (9, base, "x"), (2, passage, "x"), (3, "one TWO", "x"), (4, None, "x"), (5, "", "x"), (6, "...", "x"), (7, "é" * 300, "x"),
        (8, " ".join(base.split()[5:17]), "x"), (11, odd_rows[13][1][100:3000], "x"), (12, "aa aa aa", "x"),
    ]
    return spark.createDataFrame(rows, ITEMS)


@pytest.mark.parametrize("block_items, segment_words", [(20_000, 1_000_000), (3, 50)])
def test_against_brute_force(monkeypatch, op9, odd_docs, odd_rows, items, block_items, segment_words):
    monkeypatch.setattr(D, "BLOCK_ITEMS", block_items)
    monkeypatch.setattr(D, "SEGMENT_WORDS", segment_words)
    docs = odd_docs if block_items > 3 else odd_docs.dropDuplicates(["doc_id"])
    rows = {r[:2] for r in odd_rows} if block_items == 3 else [r[:2] for r in odd_rows]
    want = sorted(brute(rows, [(r.item_id, r.text) for r in items.collect()]))
    assert sorted(op9(docs, items)) == want
    assert any(w[5] for w in want) and any(w[2] and not w[5] for w in want) and any(not w[2] for w in want)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (duckdb.sql(f"select {k}, text from '{sf}/{t}.parquet'").fetchall() for k, t in (("doc_id", "documents"), ("item_id", "benchmark")))
    assert sorted(tuple(r) for r in D.op9_decontaminate(spark, sf).collect()) == sorted(brute(docs, items))


def test_no_rows_and_no_keys(op9, odd_docs, no_docs, keyless, items):
    assert op9(no_docs, items) == []
    assert len(op9(keyless, items)) == 3
    empty = hashlib.sha256(b"").hexdigest()
    assert {r[2:] for r in op9(odd_docs, items.limit(0))} == {(0, 0, empty, False)}


def test_words_in_order_and_near_one_another(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "c b a"), (3, "a b x x x x c"), (4, "a b"), (5, "c a b")], "doc_id long, text string")
    items = [("i", [b"a", b"b", b"c"])]
    index = D.build_index(docs, [b"a", b"b", b"c"])
    number = {b"a": 0, b"b": 1, b"c": 2}
    assert sorted(r.doc_id for r in D.find_near(index, items, number, 5).collect()) == [1, 2, 5]
    assert sorted(r.doc_id for r in D.find_near(index, items, number, 7).collect()) == [1, 2, 3, 5]
    found = {r.doc_id: (r.first_words, r.last_words) for r in D.find_phrases(index, {(0, 1): ["ab"]}).collect()}
    assert found == {1: ([], []), 2: ([], []), 3: ([0], [1]), 4: ([0], [1]), 5: ([1], [2])}


def test_stage(spark, odd_docs, items, monkeypatch):
    monkeypatch.setattr(D, "table", lambda s, d, name: items)
    kept = D.not_contaminated(spark, odd_docs, "")
    bad = {r[0] for r in brute([r[:2] for r in odd_docs.collect()], [(r.item_id, r.text) for r in items.collect()]) if r[5]}
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in odd_docs.collect() if r.doc_id not in bad)
