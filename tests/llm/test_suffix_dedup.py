import random

import numpy as np
import pytest
from cases import ODD_TEXTS, documents
from reference import repeats

from authlytics.llm import suffix_dedup
from authlytics.llm.common import Work


def common_prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("seed", range(40))
def test_longest_previous_factor(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 2, rng.integers(1, 40)).tolist()
    suffixes = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0] + [common_prefix(text[a:], text[b:]) for a, b in zip(suffixes, suffixes[1:])]
    found = suffix_dedup.longest_previous_factor(np.array(suffixes), np.array(lcp))
    expected = [max((common_prefix(text[i:], text[j:]) for j in range(i)), default=0) for i in suffixes]
    assert found.tolist() == expected


@pytest.mark.parametrize("length", [1, 7, 8, 9, 20, 100])
def test_prefix_ranks_order_suffixes(length):
    rng = np.random.default_rng(length)
    text = np.tile(rng.integers(0, 3, 150), 3).astype(np.uint8)
    ranks = suffix_dedup.prefix_ranks(text, length)
    prefixes = [text[i : i + length].tobytes() for i in range(len(text) - length + 1)]
    assert len(ranks) == len(prefixes)
    for i in range(0, len(prefixes), 7):
        for j in range(0, len(prefixes), 5):
            assert (ranks[i] < ranks[j]) == (prefixes[i] < prefixes[j])
            assert (ranks[i] == ranks[j]) == (prefixes[i] == prefixes[j])


def test_equal_windows_have_equal_anchors():
    rng = random.Random(1)
    passage = bytes(rng.randrange(256) for _ in range(900))
    texts = [bytes(rng.randrange(256) for _ in range(n)) + passage for n in (0, 10, 333)]
    hashes = []
    for text in texts:
        own = {}
        for h, first, n in zip(*suffix_dedup.contexts(np.frombuffer(text, np.uint8), 400)):
            own |= {text[i : i + 400]: h for i in range(first, first + n)}
        assert len(own) == len(text) - 399
        hashes.append(own)
    for i in range(501):
        window = passage[i : i + 400]
        assert len({own[window] for own in hashes}) == 1


def test_long_texts_are_cut_between_windows(monkeypatch):
    text = np.frombuffer(bytes(random.Random(2).randrange(256) for _ in range(5000)), np.uint8)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    _, firsts, counts = suffix_dedup.contexts(text, 400)
    assert firsts.tolist() == (np.cumsum(counts) - counts).tolist() and counts.sum() == 4601


def rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [prose(n) for n in (60, 90, 100, 120, 300)]
    found = []
    for i in range(40):
        first, second = rng.choice(passages), rng.choice(passages)[rng.randrange(50) :]
        found.append((i, f"{prose(rng.randrange(200))} {first} {prose(rng.randrange(100))}{second}"))
    found += [(100 + i, found[i][1]) for i in range(4)] + [(None, found[3][1]), (7, found[7][1])]
    found += [(202, "a" * 1500), (203, "ab" * 900), (204, passages[1][:399]), (204, passages[1][:400])]
    return found + [(300 + i, t) for i, (_, t) in enumerate(ODD_TEXTS)]


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("cell_bytes", [1 << 20, 2000])
def test_removed_bytes(spark, monkeypatch, keep_first, cell_bytes):
    monkeypatch.setattr(suffix_dedup, "CELL_BYTES", cell_bytes)
    docs = documents(spark, rows())
    found = suffix_dedup.remove_repeats(docs, Work(spark), 400, keep_first).collect()
    result = []
    for r in found:
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        assert removed == r["n_bytes"] - len(r["kept"])
        result.append((r["doc_id"], r["n_bytes"], removed, len(r["spans"]), bytes(r["kept"])))
    assert sorted(result, key=repr) == repeats(rows(), 400, keep_first)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = suffix_dedup.remove_repeats(docs, Work(spark), 400, False).collect()
    expected = repeats([(r["doc_id"], r["text"]) for r in docs.collect()], 400, False)
    result = [(r["doc_id"], bytes(r["kept"])) for r in found]
    assert sorted(result, key=repr) == [(r[0], r[4]) for r in expected]


def test_empty_table(spark):
    docs = documents(spark, ODD_TEXTS)
    assert suffix_dedup.remove_repeats(docs.limit(0), Work(spark)).count() == 0
    assert suffix_dedup.remove_repeats(docs, Work(spark)).filter("size(spans) = 0").count() == len(ODD_TEXTS)
