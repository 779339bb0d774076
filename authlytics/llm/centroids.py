"""K-means on integer vectors over zone maps in the order of a Hilbert curve.

Vectors are sorted along a space-filling curve through all components, so that neighbours in the
order are near each other, and cut into blocks, each with the smallest and the largest value of
every component.  In each round a block's box bounds its distances to every centroid from below and
above: only centroids whose lower bound does not exceed the least upper bound can be nearest to a
vector of the block.  Those are the block's candidates, and its vectors are compared with them alone
and exactly, all in integers.  A task sends one sum a centroid; the centroids, whose number is a
parameter, are all that goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.llm.common import Work

SCALE = 64
LIMIT = 1 << 27  # components beyond are moved to it, so that every distance fits 64 bits
_STORED = np.int32
CURVE_BITS = 3  # of a component on the curve
BLOCK = 128  # vectors of a block
_DOUBLES = 1 << 22  # components up to which sums of products are exact in doubles
_BLOCK = "ids array<long>, low binary, high binary, vectors binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of rows of cell numbers below 2**bits, as bytes that sort alike.

    The axes are turned into the transposed index of the curve, whose bits are then read across the
    axes, the highest bit of every axis first.
    """
    x = cells.astype(np.int64).T.copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for axis in range(len(x)):
            turned = (x[axis] & bit) != 0
            swapped = np.where(turned, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(turned, below, swapped)
            x[axis] ^= swapped
        bit >>= 1
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flips = np.zeros(x.shape[1], dtype=np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flips ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flips
    places = [(x >> b) & 1 for b in reversed(range(bits))]
    packed = np.packbits(np.concatenate(places).astype(np.uint8), axis=0)
    return [row.tobytes() for row in np.ascontiguousarray(packed.T)]


def _usable(size: int) -> Column:
    """The embedding has so many components, and all of them are numbers."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return (F.size("embedding") == size) & finite


def _matrix(embeddings: pa.Array, size: int) -> np.ndarray:
    """Rows of integer components."""
    flat = embeddings.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT).astype(np.int64)


def _ranges(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The least and the largest value of each component in a task."""
        ends = None
        for batch in batches:
            found = _matrix(batch.column(1), size)
            if len(found):
                found = found if ends is None else np.concatenate([found, ends])
                ends = np.stack([found.min(axis=0), found.max(axis=0)])
        if ends is not None:
            columns = [pa.array(range(size), pa.int32()), *(pa.array(e) for e in ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["axis", "low", "high"])

    return task


def _with_keys(low: np.ndarray, high: np.ndarray):
    size, cells = len(low), 1 << CURVE_BITS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), size)
            place = (vectors - low) * cells // (high - low + 1)
            rows = [row.tobytes() for row in vectors.astype(_STORED)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(hilbert_keys(place, CURVE_BITS), pa.binary()),
                    pa.array(rows, pa.binary()),
                ],
                names=["vec_id", "key", "vector"],
            )

    return task


def _cut(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of consecutive vectors with their boxes."""
        for batch in batches:
            raw = b"".join(x.as_py() for x in batch.column(1))
            vectors = np.frombuffer(raw, dtype=_STORED).reshape(-1, size)
            parts = [vectors[i : i + BLOCK] for i in range(0, len(vectors), BLOCK)]
            ids = [batch.column(0).slice(i, BLOCK) for i in range(0, len(vectors), BLOCK)]
            columns = [
                [x.min(axis=0).tobytes() for x in parts],
                [x.max(axis=0).tobytes() for x in parts],
                [x.tobytes() for x in parts],
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x.to_pylist() for x in ids], pa.list_(pa.int64())),
                    *(pa.array(c, pa.binary()) for c in columns),
                ],
                names=["ids", "low", "high", "vectors"],
            )

    return task


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that can be nearest to a vector of the box, in ascending order."""
    short = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    least, most = (short * short).sum(axis=1), (far * far).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each vector; ties to the smaller."""
    apart = np.zeros((len(vectors), len(centroids)), dtype=np.int64)
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) < _DOUBLES:
        a, b = vectors.astype(float), centroids.astype(float)
        products = (a @ b.T).astype(np.int64)
        apart += (vectors * vectors).sum(axis=1)[:, None] - 2 * products
        apart += (centroids * centroids).sum(axis=1)
    else:
        for number, centroid in enumerate(centroids):
            apart[:, number] = ((vectors - centroid) ** 2).sum(axis=1)
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(vectors)), best]


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray):
    """(ids, vectors, cluster, distance) of each block."""
    for ids, low, high, vectors in zip(*(batch.column(c) for c in range(4))):
        low, high, vectors = (
            np.frombuffer(x.as_py(), dtype=_STORED).astype(np.int64) for x in (low, high, vectors)
        )
        vectors = vectors.reshape(-1, centroids.shape[1])
        few = candidates(low, high, centroids)
        best, distance = nearest(vectors, centroids[few])
        yield ids.values, vectors, few[best], distance


def _sums(centroids: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a centroid and task: how many vectors it has and their sums."""
        counts, sums = np.zeros(len(centroids), dtype=np.int64), np.zeros_like(centroids)
        for batch in batches:
            for _, vectors, cluster, _ in _assigned(batch, centroids):
                counts += np.bincount(cluster, minlength=len(centroids))
                np.add.at(sums, cluster, vectors)
        for number in np.flatnonzero(counts):
            row = [[number] * sums.shape[1], range(sums.shape[1]), [counts[number]] * sums.shape[1]]
            columns = [pa.array(x, pa.int64()) for x in (*row, sums[number])]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "axis", "n", "total"])

    return task


def _answers(centroids: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, cluster, distance in _assigned(batch, centroids):
                columns = [ids, pa.array(cluster, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return task


def _first_centroids(usable: DataFrame, k: int, size: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; repeated ids by their vectors."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = usable.withColumn("hash", F.sha2(name.cast("binary"), 256))
    chosen = rows.orderBy("hash", "embedding").limit(k).select("embedding").toArrow()
    return _matrix(chosen.column(0).combine_chunks(), size)


def zone_maps(embeddings: DataFrame, working: Work, size: int) -> DataFrame:
    """Blocks of the usable vectors along the curve, written: ids, box and vectors."""
    usable = embeddings.filter(_usable(size))
    ends = usable.mapInArrow(_ranges(size), "axis int, low long, high long")
    ends = ends.groupBy("axis").agg(F.min("low"), F.max("high")).orderBy("axis").collect()
    low, high = (np.array([row[i] for row in ends], dtype=np.int64) for i in (1, 2))
    if not len(low):
        low = high = np.zeros(size, dtype=np.int64)
    keyed = usable.mapInArrow(_with_keys(low, high), "vec_id long, key binary, vector binary")
    keyed = working.write(keyed, "keyed")
    # Equal vectors have equal keys; a frequent one goes on over several tasks by its ids.
    order = ["key", F.xxhash64("vec_id")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ordered.select("vec_id", "vector").mapInArrow(_cut(size), _BLOCK)
    return working.write(blocks, "blocks")


def cluster(
    embeddings: DataFrame, working: Work, k: int = 16, rounds: int = 3, size: int = 64
) -> DataFrame:
    """A row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid.

    Usable are embeddings of exactly `size` components, none null or non-finite; others have no
    row.  A component x counts as floor(64 * x), moved into [-2**27, 2**27].  The first centroids are
    the k vectors with the smallest SHA-256 of `1:<vec_id>` (fewer vectors: all of them; a null id
    is empty), in that order.  A round assigns each vector to the nearest centroid by squared
    Euclidean distance, ties to the smaller number, and replaces each centroid that has vectors by
    the floor of their mean; after the rounds vectors are assigned once more.  cluster_inertia and
    inertia sum the distances of the cluster and of all; centroid is an array of the cluster's
    components.  Repeated rows count and stay; an empty table gives no rows; other columns are
    not read.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    centroids = _first_centroids(vectors.filter(_usable(size)), k, size)
    blocks = zone_maps(vectors, working, size)
    for _ in range(rounds if len(centroids) else 0):
        found = blocks.mapInArrow(_sums(centroids), "cluster long, axis long, n long, total long")
        totals = found.groupBy("cluster", "axis").agg(F.sum("n"), F.sum("total"))
        centroids = centroids.copy()
        for number, axis, n, total in totals.collect():  # k * size rows at most
            centroids[number, axis] = total // n
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        centroids = np.zeros((1, size), dtype=np.int64)
    assigned = working.write(blocks.mapInArrow(_answers(centroids), schema), "assigned")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    clusters = spark.createDataFrame(
        [
            (number, inertia.get(number), sum(inertia.values()), components)
            for number, components in enumerate(centroids.tolist())
        ],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    # A row per centroid.
    joined = assigned.join(F.broadcast(clusters), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(components: Column) -> Column:
    """SHA-256 of components as decimal integers joined by commas."""
    return F.sha2(F.array_join(components.cast("array<string>"), ",").cast("binary"), 256)
