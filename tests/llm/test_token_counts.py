import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabledocs.llm.token_counts import TokenOptions, WordCounter, count_merged, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_like_the_library():
    library, own = Tokenizer.from_file(PATH), WordCounter(PATH)
    rng = random.Random(4)
    parts = ["'s", "'T", "'ll", "ſ", "K", "İ", "Σ", "ς", "é", "ﬁ", "\x1c", "\x85", "\xa0", "​", "　", "①", "½", "日本", "한", "😀", "̸",
             "<|endoftext|>", "<|startoftext|>", "<|", " ", "\n", "\t", "ab", "THE", "123", "!!", "\x00", "ß", "thth", "ering"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)] + ["a" * 5000, "thering" * 700, ""]
    assert [own.count(t) for t in texts] == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_merging_like_rescanning():
    rng = random.Random(5)
    for _ in range(300):
        ranks, symbols = {}, [rng.choice("ab") for _ in range(rng.randint(1, 12))]
        known = ["a", "b"]
        for k in range(6):
            left, right = rng.choice(known), rng.choice(known)
            ranks.setdefault((left, right), k)
            known.append(left + right)
        slow = list(symbols)
        while pairs := [(ranks[p], i) for i, p in enumerate(zip(slow, slow[1:])) if p in ranks]:
            _, i = min(pairs)
            slow[i : i + 2] = [slow[i] + slow[i + 1]]
        assert count_merged(list(symbols), ranks) == len(slow)


def test_rows(documents):
    rows = [(1, None), (2, ""), (None, "é"), (3, "word " * 3000), (3, "word " * 3000)]
    got = sorted(token_counts(documents(*rows), TokenOptions(PATH)).collect(), key=str)
    assert sorted(tuple(r)[1:] for r in got) == [(0, 0, False), (0, 0, False), (2, 1, False), (15000, 3000, True), (15000, 3000, True)]
    assert token_counts(documents(), TokenOptions(PATH)).count() == 0


def test_other_kind():
    with pytest.raises((ValueError, KeyError, TypeError)):
        WordCounter(public_tokenizers.path("byte_bpe_50k.json"))
