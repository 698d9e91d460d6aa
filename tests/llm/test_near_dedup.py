import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from marketlens.llm import links
from marketlens.llm import near_dedup as N
from marketlens.llm.decontaminate import words_of


def brute(rows, similarity=0.8, size=5):
    """doc -> smallest document of its class, by all pairs."""
    sets = {}
    for key, text in rows:
        w = words_of(text)
        sets[key] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w) or (text or "")}
    keys, root = sorted(sets), {k: k for k in sets}
    having = defaultdict(set)
    for k, s in sets.items():
        for x in s:
            having[x].add(k)
    for a in keys:
        for b in {b for x in sets[a] for b in having[x] if b > a}:
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, keyless):
    found = N.near_duplicates(odd_docs).collect()
    assert len(found) == len(odd_rows)
    assert {r.doc_id: r.class_id for r in found} == brute([r[:2] for r in odd_rows])
    assert N.near_duplicates(no_docs).count() == 0
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in N.near_duplicates(keyless).collect()) == [(0, 0), (0, 0), (5, 5)]
    assert N.without_near_duplicates(spark, odd_docs, "").columns == odd_docs.columns


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    found = N.op5_near_duplicates(spark, sf).collect()
    assert {r.doc_id: r.class_id for r in found} == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in found)


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(139, 300), (300, 290)]
    found = {r.doc: r.root for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in [*range(100, 140), 290, 300]}}


@pytest.mark.parametrize("shared", [0, 30, 80])
def test_registers_estimate_probability_jaccard(shared):
    rng = np.random.default_rng(shared)
    items = rng.integers(0, 2**63, 100, dtype=np.uint64)
    a, b = np.arange(0, 60 + shared // 2), np.arange(60 - shared // 2, 100)
    weight = [rng.uniform(0.5, 3, 100), rng.uniform(0.5, 3, 100)]
    text = np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)]
    who = N.registers(np.r_[items[a], items[b]], text, np.r_[weight[0][a], weight[1][b]], 2, size=4096)
    full = [np.zeros(100), np.zeros(100)]
    full[0][a], full[1][b] = weight[0][a], weight[1][b]
    both = np.flatnonzero((full[0] > 0) & (full[1] > 0))
    want = sum(1 / np.maximum(full[0] / full[0][d], full[1] / full[1][d]).sum() for d in both)
    assert abs((who[0] == who[1]).mean() - want) < 0.03


def test_similar_pairs_among_templates(spark):
    """Thousands of documents at 0.75 to each other, which fill each other's buckets, and some pairs at 0.8 and more."""
    rng = random.Random(11)
    # A shared passage of 94 words (90 shingles), then own words: 15 own shingles (with those across the joint) give 90 / 120.
    passage = [f"p{i}" for i in range(94)]
    rows = [(i, " ".join([*passage, *(f"w{rng.randrange(10**9)}" for _ in range(15))])) for i in range(3_000)]
    for i in range(5, 3_000, 250):  # the same passage and the first of the own words
        words = rows[i][1].split()
        rows.append((10_000 + i, " ".join([*words[:98], *(f"w{rng.randrange(10**9)}" for _ in range(11))])))
    # Own words are of no other document, so 94 of 116 shingles are common to each such pair, and 90 of 120 to all others.
    want = {i: i for i in range(3_000)} | {i: i - 10_000 for i, _ in rows[3_000:]}
    assert len(want) == 3_012 and brute(rows[:20] + rows[3_000:3_001]) == {k: want[k] for k in [*range(20), 10_005]}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()} == want


def test_remaining_pairs_are_all_similar_pairs_of_different_classes(spark):
    rng = random.Random(12)
    pool = list(range(60))
    sets = {d: set(rng.sample(pool, k)) | {1000 * d + j for j in range(rng.randrange(3))} for d in range(150) for k in [rng.choice([1, 4, 5, 20, 50, 54, 57])]}
    root = {d: d % 40 for d in sets}
    want = {(a, b) for a in sets for b in sets if a < b and root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    # Around a pivot without shingles, and around one that is among the sets.
    for pivot in (set(), sets[7]):
        rows = [(0, d, root[d], len(s), len(s ^ pivot), x) for d, s in sets.items() for x in s ^ pivot]
        pairs = links.delta_pairs(spark.createDataFrame(rows, "pivot long, id long, root long, n int, delta int, item long"), 4, 5).collect()
        linked = {d for d, s in sets.items() if pivot and len(s & pivot) >= 0.8 * len(s | pivot)}
        assert len(want) > 20 and {(a, b) for a, b in want if not {a, b} <= linked} <= {tuple(p) for p in pairs}
        assert all(root[a] != root[b] for a, b in pairs)


@pytest.mark.parametrize("edits", [12, 45])
def test_variants_of_a_template(spark, monkeypatch, edits):
    """The pairs that are compared grow like the family, not like its square."""
    counts, whole = {}, N.compared
    monkeypatch.setattr(N, "compared", lambda pairs, *rest: counts.__setitem__(size, counts.get(size, 0) + pairs.count()) or whole(pairs, *rest))
    for size in (150, 600):
        rng = random.Random(14)
        template = [f"w{i}" for i in range(200)]
        rows = []
        for i in range(size):
            words = list(template)
            for at in rng.sample(range(200), rng.randrange(edits)):
                words[at] = f"x{rng.randrange(10**9)}"
            rows.append((i, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()} == brute(rows)
    assert counts[600] < 5 * counts[150] + 1_000


def test_lines_repeated_in_one_copy(spark):
    """A count does not matter: sets of 100 common and 12 own shingles each, with 20 of them thousands of times in one text."""
    rng = random.Random(13)
    rows = []
    for i in range(30):
        line, rest = ([f"w{rng.randrange(10**9)}" for _ in range(n)] for n in (20, 80))
        own = [[f"w{rng.randrange(10**9)}" for _ in range(12)] for _ in range(2)]
        rows += [(2 * i, " ".join([*line * 2, *rest, *own[0]])), (2 * i + 1, " ".join([*line * 1_000, *rest, *own[1]]))]
    want = brute(rows)
    assert want == {k: k // 2 * 2 for k in range(60)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in N.near_duplicates(docs).collect()} == want
