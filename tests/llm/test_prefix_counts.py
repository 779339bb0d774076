import random

import numpy as np
import public_tokenizers
import pytest
from cases import ODD_TEXTS, documents, prose
from tokenizers import Tokenizer

from authlytics.llm import byte_pairs, prefix_counts
from authlytics.llm.byte_pairs import BytePairs, read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ALPHABET = [chr(c) for c in range(300)]
ALPHABET += list("\x85\xa0  　中\U0001f600́٠᠎​\x1c\x1f﻿")
ALPHABET += ["'s", "'re", "'ll", "'ve", " ", "  ", "\n\n", "\n", "the", "<|endoftext|>", "tion"] * 8


def mixed(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(ALPHABET) for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(PATH)


def n_tokens(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_has_the_count_of_its_own_encoding(vocabulary):
    counter = prefix_counts.PrefixCounter(vocabulary)
    for text in [mixed(seed, 40) for seed in range(150)] + [prose(1, 60), "=" * 200, " " * 90, ""]:
        counts = np.cumsum(counter.of(text), dtype=np.int64).tolist()
        assert counts == n_tokens([text[:k] for k in range(1, len(text) + 1)])


def test_words_computed_together_agree_with_single_ones(vocabulary):
    texts = [mixed(seed, 300) for seed in range(60)] + [prose(5, 800), "", "x" * 90, "<|endoftext|>a"]
    together = prefix_counts.PrefixCounter(vocabulary).of_many(texts)
    single = prefix_counts.PrefixCounter(vocabulary)
    assert all((a == single.of(t)).all() and len(a) == len(t) for a, t in zip(together, texts))


def test_forgotten_words_and_pairs_are_computed_again(vocabulary, monkeypatch):
    texts = [mixed(seed, 200) for seed in range(40)]
    expected = [prefix_counts.PrefixCounter(vocabulary).of(t) for t in texts]
    monkeypatch.setattr(prefix_counts, "_KEPT_WORDS", 20)
    monkeypatch.setattr(byte_pairs, "_KEPT_PAIRS", 300)
    counter = prefix_counts.PrefixCounter(vocabulary)
    for i in range(0, 40, 4):
        found = counter.of_many(texts[i : i + 4])
        assert all((a == b).all() for a, b in zip(found, expected[i : i + 4]))


def test_long_words_agree_with_plain_merging(vocabulary):
    pairs = BytePairs(vocabulary)
    for word in (b"ab" * 300, b"a" * 1000, prose(3, 80).replace(" ", "").encode()):
        assert pairs.encode(word) == pairs._merge(word)


def test_rows(spark, vocabulary):
    rows = ODD_TEXTS + [(100 + i, mixed(i, 700)) for i in range(30)] + [(200, prose(1, 20_000))]
    found = prefix_counts.prefix_counts(documents(spark, rows), vocabulary, 50).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for row in found:
        if row["doc_id"] is None:
            continue
        text, steps = texts[row["doc_id"]], np.frombuffer(row["steps"], dtype=np.int8)
        assert [row["n_tokens"]] == n_tokens([text])
        assert row["n_bytes"] == len(text.encode()) and len(steps) == len(text)
        cut = row["chars_within"]
        assert prefix_counts.tokens_at(steps, cut) <= 50
        fits = [k for k in range(len(text) + 1) if k < 400 and n_tokens([text[:k]])[0] <= 50]
        assert cut >= max(fits, default=0) if len(text) > 400 else cut == max(fits, default=0)


def test_empty_table(spark, vocabulary):
    docs = documents(spark, ODD_TEXTS).limit(0)
    assert prefix_counts.prefix_counts(docs, vocabulary).count() == 0
