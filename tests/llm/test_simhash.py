import numpy as np
import pytest
from cases import ODD_TEXTS, documents, edited, prose
from reference import simhash_components

from authlytics.llm import simhash
from authlytics.llm.common import Work


def found(spark, rows, **options):
    result = simhash.simhash(documents(spark, rows), Work(spark), **options).collect()
    return sorted(((r["doc_id"], r["value"] % (1 << 64), r["component_id"]) for r in result), key=repr)


def near_rows():
    rows = [(10 * base + i, edited(prose(base, 120), i, i)) for base in range(15) for i in range(8)]
    rows += [(1000 + i, edited(prose(99, 900, 5000), i, i % 9)) for i in range(150)]
    return rows + [(2000 + i, prose(2000 + i, 30)) for i in range(100)]


@pytest.mark.parametrize("block", [16, simhash.BLOCK])
def test_components(spark, block):
    rows = near_rows()
    assert found(spark, rows, block=block) == simhash_components(rows)


def test_other_parameters(spark):
    rows = near_rows()[:200]
    assert found(spark, rows, width=1, distance=9, block=32) == simhash_components(rows, 1, 9)


def test_odd_rows(spark):
    rows = ODD_TEXTS + [(20, "B A"), (21, "b  a"), (30, "A b c D"), (31, "a B c d"), (32, "a b c")]
    assert found(spark, rows) == simhash_components(rows)


def test_empty_table_and_one_row(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, None)]) == [(5, 0, 5)]


def test_a_long_text_is_read_in_pieces(monkeypatch):
    text = prose(3, 3000).encode()
    whole = simhash.fingerprint(text)
    for size in (1, 7, 1000):
        monkeypatch.setattr(simhash, "_PIECE", size)
        assert simhash.fingerprint(text) == whole


def test_neighbours_in_gray_order_differ_in_one_bit(spark):
    top = spark.range(256).select("id", simhash.gray_rank(simhash.F.col("id")).alias("rank"))
    order = [r["id"] for r in top.orderBy("rank").collect()]
    assert all((a ^ b).bit_count() == 1 for a, b in zip(order, order[1:]))
    highest = spark.range(4).select(simhash.F.expr("shiftleft(id, 62) AS id"))
    ranked = highest.select("id", simhash.gray_rank(simhash.F.col("id")).alias("rank"))
    assert [r["id"] >> 62 for r in ranked.orderBy("rank").collect()] == [0, 1, -1, -2]


def test_close_pairs_are_all_pairs_within_the_distance():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 63, (2, 1200)).astype(np.uint64)
    values = np.sort(np.concatenate([np.tile(base, 30) ^ flips[0] ^ flips[1], base]))
    index = simhash._index(values)
    pairs = {(int(a), int(b)) for i, j in simhash.close_pairs(index, index, 4) for a, b in zip(i, j)}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    assert pairs == {(int(a), int(b)) for a, b in np.argwhere(apart <= 4) if a <= b}


def test_a_group_of_near_copies_is_never_expanded_into_pairs(spark):
    rows = [(i, edited(prose(7, 900, 5000), i, i % 9)) for i in range(400)]
    work = Work(spark)
    simhash.simhash(documents(spark, rows), work, block=32).count()
    blocks = spark.read.parquet(f"{work.folder}/blocks").count()
    assert spark.read.parquet(f"{work.folder}/links").count() <= 2 * blocks * blocks
