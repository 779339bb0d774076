import random

import numpy as np
import pytest
from reference import clustered

from authlytics.llm import centroids
from authlytics.llm.common import Work

ROWS = "vec_id long, embedding array<double>, cluster string, key int, ids string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "i") for r in rows], ROWS).repartition(3)


def found(spark, rows, **options):
    result = centroids.cluster(table(spark, rows), Work(spark), **options).collect()
    return sorted((tuple(r) for r in result), key=repr)


def vectors(seed, n, size=64):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(middles)]) for i in range(n)]


def test_clusters(spark):
    rows = vectors(1, 400)
    assert found(spark, rows) == clustered(rows)


def test_other_parameters(spark):
    rows = vectors(2, 90, 5)
    assert found(spark, rows, k=3, rounds=5, size=5) == clustered(rows, 3, 5, 5)


def test_odd_rows(spark):
    zero = [0.0] * 64
    rows = vectors(3, 30) + [
        (100, None),
        (101, []),
        (102, [0.1] * 63),
        (103, [0.1] * 65),
        (104, [None] + [0.1] * 63),
        (105, [float("nan")] + [0.1] * 63),
        (106, [float("-inf")] + [0.1] * 63),
        (107, [1e300] + [-1e300] * 63),
        (108, [3e6] * 64),
        (None, [0.5] * 64),
        (109, zero),
        (109, zero),
        (109, [0.25] * 64),
    ]
    assert found(spark, rows) == clustered(rows)


def test_a_frequent_vector_and_ties(spark):
    rows = [(i, [0.5] * 64) for i in range(300)] + [(1000 + i, [-0.5] * 64) for i in range(20)]
    assert found(spark, rows) == clustered(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(4, 3)
    assert found(spark, rows) == clustered(rows)
    assert found(spark, []) == found(spark, [(1, None)]) == []


def test_hilbert_neighbours_are_one_step_apart():
    cells = np.array([(x, y, z) for x in range(4) for y in range(4) for z in range(4)])
    order = np.argsort(centroids.hilbert_keys(cells, 2))
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("seed", range(5))
def test_candidates_hold_every_nearest_centroid(seed):
    rng = np.random.default_rng(seed)
    block, centres = rng.integers(-6, 6, (30, 4)), rng.integers(-99, 99, (12, 4))
    few = centroids.candidates(block.min(axis=0), block.max(axis=0), centres)
    best, distance = centroids.nearest(block, centres)
    assert set(best) <= set(few) and len(few) < 12
    again, same = centroids.nearest(block, centres[few])
    assert (few[again] == best).all() and (same == distance).all()
