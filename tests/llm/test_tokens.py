import random

import public_tokenizers
from tokenizers import Tokenizer

from marketlens.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_lengths_equal_those_of_whole_texts():
    rng = random.Random(5)
    pieces = ["a", "b", " ", "  ", "\n", "'s", "1", "<|endoftext|>", "é", "é", "\x1c", "\xa0", "日", ".", "\t", "word"]
    texts = ["", *("".join(rng.choices(pieces, k=rng.randrange(16))) for _ in range(2_000))]
    whole = Tokenizer.from_file(PATH)
    assert tokens.lengths(texts, PATH) == [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    memory = tokens._Lengths(PATH, " ")
    for parts in ({"a", "b"}, {"c", "word"}, {"a", "c", "long parts", "d"}):
        memory.learn(parts)
        assert parts <= memory.keys()


def test_rows(spark, odd_docs, odd_rows, no_docs, keyless):
    whole = Tokenizer.from_file(PATH)
    found = tokens.token_counts(odd_docs, PATH, limit=100).collect()
    want = sorted((r[0], len((r[1] or "").encode()), n := len(whole.encode(r[1] or "", add_special_tokens=False).ids), n > 100) for r in odd_rows)
    assert sorted(map(tuple, found)) == want
    assert tokens.token_counts(no_docs, PATH).count() == 0
    assert tokens.token_counts(keyless, PATH).count() == 3
