import numpy as np
import pytest
from cases import ODD_TEXTS, documents, prose
from reference import exact_groups

from authlytics.llm import exact_dedup
from authlytics.llm.common import Work


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
def test_golomb_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n).astype(np.uint64))
    k, code = exact_dedup.golomb_encode(values)
    assert (exact_dedup.golomb_decode(k, len(values), code) == values).all()


def test_golomb_code_is_near_the_entropy():
    values = np.unique(np.random.default_rng(5).integers(0, 1 << 48, 50_000).astype(np.uint64))
    _, code = exact_dedup.golomb_encode(values)
    gap_bits = np.log2((1 << 48) / len(values)) + 1.4427
    assert 8 * len(code) / len(values) < gap_bits + 0.6


def found(rows):
    return sorted(
        (
            (r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex())
            for r in rows.collect()
        ),
        key=repr,
    )


@pytest.mark.parametrize("partitions,owners", [(1, 1), (3, 5), (9, 2)])
def test_groups(spark, partitions, owners):
    rows = ODD_TEXTS + [(100 + i, prose(i % 9, 30).replace(" ", " " * (1 + i % 3))) for i in range(40)]
    rows += [(200 + i, "hot text") for i in range(50)] + [(300, prose(1, 50_000))] * 2
    docs = documents(spark, rows, partitions)
    assert found(exact_dedup.exact_dedup(docs, Work(spark), owners)) == exact_groups(rows)


def test_keeping_leaves_one_row_of_each_text(spark):
    docs = documents(spark, ODD_TEXTS)
    kept = exact_dedup.keep_first(docs, Work(spark))
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([3, 6, 7, 8], key=repr)


def test_empty_table(spark):
    docs = documents(spark, ODD_TEXTS).limit(0)
    assert exact_dedup.exact_dedup(docs, Work(spark)).count() == 0
    assert exact_dedup.keep_first(docs, Work(spark)).count() == 0
