import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, p=9, q=10, size=3):
    """(key, set size, smallest key of the component) per row, by all pairs that share a shingle."""
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in having[x] if j > i}:
            both = len(s & sets[j])
            if q * both >= p * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, len(s), least.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def found(df, **options):
    result = J.jaccard_components(df, **options)
    assert dict(result.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    return sorted((tuple(r) for r in result.collect()), key=str)


def test_odd_rows(spark, odd_docs, odd_rows, keyless, no_docs):
    """Null, empty, long texts, copies, repeated rows and keys, null keys, clashing names."""
    rows = [r[:2] for r in odd_rows] + [(None, "same text of one row"), (None, None), (5, "same text of one row")]
    docs = odd_docs.unionByName(keyless)
    assert found(docs) == brute(rows)
    assert found(docs, p=1, q=2, size=2) == brute(rows, 1, 2, 2)
    assert J.jaccard_components(no_docs).count() == 0
    assert found(keyless) == brute(rows[-3:])


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [f"n{rng.randrange(10**6)}"], [out[at], f"m{rng.randrange(50)}"]])
    return out


def families(rng, sizes, length=60, most=8):
    """Documents by random edits of a template, so that similarities lie on both sides of the threshold."""
    rows = []
    for size in sizes:
        template = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, length))]
        rows += [" ".join(edited(rng, template, rng.randrange(most))) for _ in range(size)]
    rng.shuffle(rows)
    return [(100 + 3 * i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_families_like_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = families(rng, [120, 60, *[rng.randrange(2, 12) for _ in range(40)]]) + [(5, "same key"), (5, "other text here"), (5, "other text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df) == brute(rows)
    assert found(df, p=3, q=5) == brute(rows, 3, 5)


def test_large_family_without_all_pairs(spark, monkeypatch):
    """The pairs that are compared grow like the family, not like its square."""
    compared = {}
    whole = J.differences

    def counted(pairs, cut):
        compared[size] = compared.get(size, 0) + pairs.count()
        return whole(pairs, cut)

    monkeypatch.setattr(J, "differences", counted)
    for size in (300, 1_200):
        rng = random.Random(4)
        template = [f"w{i}" for i in range(150)]
        rows = [(i, " ".join(edited(rng, template, rng.randrange(12)))) for i in range(size)]
        assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert compared[1_200] < 6 * compared[300] and compared[1_200] < 12 * 1_200


def test_chains_across_pivots(spark):
    """Neighbours are similar, the ends share nothing."""
    words = [f"w{i}" for i in range(400)]
    rows = [(900 - i, " ".join(words[2 * i : 2 * i + 100])) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)
    assert {r[2] for r in found(df)} == {801}


def test_very_long_texts(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(150_000)]
    rows = [(1, " ".join(long)), (2, " ".join(edited(rng, long, 500))), (3, " ".join(edited(rng, long, 9_000))), (4, "x" * 3_000_000), (5, "X" * 3_000_000)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_words_longer_than_a_step(monkeypatch):
    data = np.frombuffer(b"abcdefgh" * 40 + b"ABCDefgh" * 40 + b"abcdefg", np.uint8)
    starts, ends = np.array([0, 320, 0, 8, 640]), np.array([320, 640, 319, 328, 647])
    plain = J.hashes_of_words(data, starts, ends)
    monkeypatch.setattr(J, "STRETCH", 16)
    assert (J.hashes_of_words(data, starts, ends) == plain).all()
    assert plain[0] == plain[1] == plain[3] and len(set(plain.tolist())) == 3


def test_size_classes_hold_all_similar_sizes():
    for p, q in ((9, 10), (4, 5), (1, 2)):
        least, fragments = J.size_classes(p, q)
        sizes = np.arange(1, 900)
        kind, cut = J.cuts_of(sizes, p, q)
        for n, k in zip(sizes.tolist(), kind.tolist(), strict=True):
            most = n * q // p
            top = np.searchsorted(least, most, "right") - 1
            assert top - k <= 1
            assert (cut[1][n - 1] > 0) == (top > k and fragments[top] > 0) and cut[0][n - 1] == fragments[k]
            allowed = (n + most) * (q - p) // (q + p)
            assert allowed == 0 or fragments[top] >= allowed + J.EQUAL
    assert J.cuts_of(np.array([0]), 9, 10)[1] == [0, 0]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_similar_sets_share_a_segment(edits):
    rng = random.Random(edits)
    seen = 0
    for _ in range(300):
        a = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 200 * edits))]
        texts = [" ".join(a), " ".join(edited(rng, a, edits))]
        sets = [shingles(t) for t in texts]
        both = len(sets[0] & sets[1])
        shingle, text = J.shingle_sets(pa.array(texts), 3)
        n = np.bincount(text)
        assert n.tolist() == [len(s) for s in sets]
        kind, cut = J.cuts_of(n, 9, 10)
        names = [set(), set()]
        for k in (0, 1):
            for name, owner in zip(*J.segment_names(shingle, text, kind + k, cut[k])[:2], strict=True):
                names[owner].add(int(name))
        if sets[0] != sets[1] and 10 * both >= 9 * (len(sets[0]) + len(sets[1]) - both):
            assert names[0] & names[1]
            seen += 1
    assert seen > 20


def test_texts_are_shuffled_when_too_many_are_compared(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_KEYS", 0)
    rows = families(random.Random(5), [40, 10]) + [(5, "same key"), (5, "other text here"), (None, "a b c d"), (None, "a b c d e")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_few_that_share_a_passage_have_no_deltas(spark, monkeypatch):
    """Sets that share segments with few others, and are similar to none of them, are told apart without their shingles."""
    made = []
    whole = J.delta_pairs

    def counted(deltas, p, q):
        made.append(deltas.count())
        return whole(deltas, p, q)

    monkeypatch.setattr(J, "delta_pairs", counted)
    rng = random.Random(6)
    rows = []
    for family in range(30):
        passage = [f"p{family}x{i}" for i in range(60)]
        rows += [" ".join(passage + [f"o{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(6)]
    rows = list(enumerate(rows))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert sum(made) == 0


@pytest.mark.parametrize(("few", "p", "q"), [(0, 9, 10), (2, 4, 5)])
def test_deltas_like_brute_force(spark, monkeypatch, few, p, q):
    """The same components where more of the pairs are found by deltas."""
    monkeypatch.setattr(J, "FEW", few)
    rows = families(random.Random(7 + few), [60, 25, 6, 5, 4])
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), p=p, q=q) == brute(rows, p, q)
