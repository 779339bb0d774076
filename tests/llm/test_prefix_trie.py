import random

import pytest
from reference import trie_nodes

from authlytics.llm import prefix_trie
from authlytics.llm.common import Work

ROWS = "conv_id long, turn long, role string, text string, root string, depth long, path string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 9, "p") for r in rows], ROWS).repartition(3)


def nodes(spark, rows, most=prefix_trie.CHUNK):
    found = prefix_trie.prefix_trie(table(spark, rows), Work(spark), most).collect()
    return sorted((tuple(r) for r in found), key=repr)


def talk(seed, conversations, longest):
    """Conversations over few texts, so that many start alike."""
    rng, rows = random.Random(seed), []
    for i in range(conversations):
        for turn in range(rng.randrange(longest)):
            rows.append((rng.randrange(3) * 100 + i, turn, "ab"[turn % 2], rng.choice(["x", "yy", "é"])))
    return rows


@pytest.mark.parametrize("most", [2, 8, 1024])
def test_nodes_and_totals(spark, most):
    rows = talk(1, 60, 12)
    assert nodes(spark, rows, most) == trie_nodes(rows)


def test_a_conversation_over_many_chunks(spark):
    rows = [(200, i, "user", str(i % 7)) for i in range(150)]
    rows += [(201, i, "user", str(i % 7)) for i in range(90)] + talk(2, 20, 5)
    assert nodes(spark, rows, 4) == trie_nodes(rows)


def test_a_common_conversation(spark):
    rows = [(i, turn, "user", "same") for i in range(300) for turn in range(3)]
    assert nodes(spark, rows) == trie_nodes(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "dropped"),
        (0, None, "user", "first"),
        (0, 1, None, "no role"),
        (0, 1, None, "no role"),
        (0, 1, "b", "tie"),
        (0, 1, "a", "tie"),
        (0, 2, "user", None),
        (7, 0, "user", ""),
        (7, 1, "user", "x" * 100_000),
        (-7, 0, None, None),
        (-107, 0, "user", "below zero"),
        (1103, 3, "user", "absent base"),
    ]
    assert nodes(spark, rows) == trie_nodes(rows)


def test_empty_table(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "x")]) == []


def test_names_agree_however_a_path_is_cut():
    path = bytes(range(40)) * 3 + bytes(40) * 8
    names = prefix_trie.prefix_names(b"r", path, 11)
    assert names == [prefix_trie.prefix_name(b"r", path, d) for d in range(11)]
    lower = prefix_trie.prefix_names(names[8], path[8 * 40 :], 3)
    assert lower == names[8:]


def test_a_common_beginning_is_one_row_from_the_first_cut_on(spark):
    rows = [(100 * i, turn, "user", str(turn)) for i in range(200) for turn in range(8)]
    work = Work(spark)
    prefix_trie.prefix_trie(table(spark, rows), work).count()
    for height in (8, 4, 2, 1):
        pieces = spark.read.parquet(f"{work.folder}/pieces-0-{height}")
        assert pieces.count() <= 16 // height + 1
