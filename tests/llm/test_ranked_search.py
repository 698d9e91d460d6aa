import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import pieces
from marketlens.llm import ranked_search as R
from marketlens.llm.common import WORD_BYTE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=10):
    bags = [(key, bag) for key, text in docs if (bag := terms(text))]
    df = Counter(t for _, bag in bags for t in bag)
    n_docs, n_terms = len(bags), sum(sum(bag.values()) for _, bag in bags)
    rows = []
    for item, text in items:
        scores = []
        for key, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n_docs // n_terms
            score = 0
            for t, repeats in terms(text).items():
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += repeats * w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        rows += [(item, rank + 1, None if bare else key, -score) for rank, (score, bare, key) in enumerate(sorted(scores)[:k])]
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ITEMS = "item_id int, text string, rank string, score int"


@pytest.fixture(scope="module")
def queries(odd_rows):
    rng = random.Random(8)
    long = odd_rows[13][1].split()
    texts = [
        None, "", "### \n", "one", "ONE Two one", "tail zzz", "nowhere to be found", odd_rows[9][1], odd_rows[9][1] + " tail tail", "é" * 300,
        "a" * 5_000 + " a", " ".join(rng.sample(long, 300)), "alpha1 alpha2 alpha3", "alpha1 alpha2 alpha3", "x endoftext",
    ]
    return [(None if i == 4 else i, t) for i, t in enumerate(texts)] + [(7, odd_rows[9][1])]


@pytest.mark.parametrize("most_items", [R.BLOCK_ITEMS, 3, 1])
def test_odd_rows(spark, odd_docs, odd_rows, keyless, queries, most_items):
    """Null and repeated keys, null, empty and long texts, ties and clashing names, in one block and in many."""
    docs = [r[:2] for r in odd_rows] + [(None, "same text of one row"), (None, None), (5, "same text of one row")]
    items = spark.createDataFrame([(i, t, "r", 1) for i, t in queries], ITEMS)
    found = R.ranked_documents(odd_docs.unionByName(keyless), items, most_items=most_items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(found.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert rows_of(found) == brute(docs, queries)


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two", "r", 1)], ITEMS)
    assert R.ranked_documents(no_docs, items).count() == 0
    assert R.ranked_documents(odd_docs, items.limit(0)).count() == 0
    assert R.ranked_documents(odd_docs, spark.createDataFrame([(1, None, "", 1)], ITEMS)).count() == 0


def test_ties_and_full_heaps(spark, monkeypatch):
    """Equal scores by key, over many tasks and steps of one document."""
    monkeypatch.setattr(R, "CELLS", 1)
    docs = [(k, "red blue") for k in range(60)] + [(100 + k, "red red green blue") for k in range(7)] + [(None, "red blue")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    items = [(1, "red"), (2, "green red red"), (3, "blue")]
    assert rows_of(R.ranked_documents(df, spark.createDataFrame(items, "item_id int, text string"))) == brute(docs, items)


def test_heaps_keep_the_best():
    rng = np.random.default_rng(2)
    heaps, offered = R.Heaps(4, 3), []
    for _ in range(30):
        scores, docs = rng.integers(0, 12, (5, 4)), rng.integers(0, 1_000, 5)
        offered += [(i, -int(scores[d, i]), int(docs[d])) for d in range(5) for i in range(4) if scores[d, i] > 0]
        heaps.offer(scores, docs, np.zeros(5, bool))
    expected = [x for i in range(4) for x in sorted(y for y in offered if y[0] == i)[:3]]
    assert list(zip(heaps.item.tolist(), (-heaps.score).tolist(), heaps.doc.tolist(), strict=True)) == expected


def test_length_figure_beyond_64_bits():
    n = np.array([1, 10**8])
    big = 10**12
    assert R.saturated(n, big, 7 * big).tolist() == [8 * (25 + 75 * int(x) * big // (7 * big)) for x in n]


def test_words_are_found_piece_by_piece():
    rng = random.Random(1)
    texts = [" ".join("wx€"[rng.randrange(3)] * rng.randrange(1, 40) for _ in range(rng.randrange(30))) for _ in range(40)] + ["", "y" * 70_000, "", "z"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    found = [[] for _ in texts]
    for start, end in pieces.windows(data, offsets, WORD_BYTE, 50):
        for a, b, t in zip(*pieces.words_between(data, offsets, WORD_BYTE, start, end), strict=True):
            found[t].append(data[start:end][a:b].tobytes().decode())
    assert found == [t.split() for t in texts]


@pytest.mark.parametrize("weak", [False, True])
def test_vocabulary_compares_bytes(monkeypatch, weak):
    """Also if all words of one length have the same hash."""
    if weak:
        monkeypatch.setattr(pieces, "word_keys", lambda eights, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    words = [b"a", b"b", b"ab", b"eight888", b"eight889", b"seventeen-letters", b"seventeen-letterz", b"middle-A-differs-here", b"middle-b-differs-here".lower()]
    words = [w.lower() for w in words]
    texts = [*words, b"A", b"EIGHT888", b"c", b"eight88", b"middle-c-differs-here", b"seventeen-letter"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    at, number = pieces.Vocabulary(words).find(data, ends - [len(t) for t in texts], ends)
    found = dict(zip(at.tolist(), number.tolist(), strict=True))
    assert found == {i: words.index(t.lower()) for i, t in enumerate(texts) if t.lower() in words}
    assert len(pieces.Vocabulary([]).find(data, ends - 1, ends)[0]) == 0


@pytest.mark.parametrize("weak", [False, True])
def test_distinct_words_compares_bytes(monkeypatch, weak):
    if weak:
        monkeypatch.setattr(pieces, "word_keys", lambda eights, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    rng = random.Random(7)
    words = [rng.choice(["a", "bb", "eight888", "eight889", "seventeen-letters", "seventeen-lettars", "x" * 40 + "y", "x" * 40 + "z"]) for _ in range(200)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    one, group = pieces.distinct_words(data, ends - [len(w) for w in words], ends)
    assert [words[i] for i in one[group]] == words and len(one) == len(set(words))
