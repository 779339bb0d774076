"""Near-duplicates by SimHash, found through a hierarchical index in Gray order.

Fingerprints are sorted by their rank in the reflected Gray code, in which neighbours differ in few
bits, and cut into blocks.  A node of the index stands for consecutive fingerprints and carries the
bits that all of them share, as two masks (`ones`, `zeros`).  Two nodes differ at least where one
has a shared 1 and the other a shared 0; going down, nodes share more bits, so differences only
accumulate, and a pair of nodes with more than the allowed differences drops out with everything
below it.  Above the blocks the pairs of nodes are rows that Spark joins with their children, level
by level; below, a pair of blocks is one row and its task goes on down to single fingerprints.

Fingerprints of one block that links connect are tied together when the block is made, so a pair of
blocks reports links between such groups only, never its pairs of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.llm.common import LOWER, Work, broadcast_if_few, connected, utf8

SEED = 42
WORDS = 4
DISTANCE = 4
BLOCK = 8192  # fingerprints of a block
PART_BLOCKS = 4  # blocks that a partition is meant to hold
FAN_OUT = 64  # nodes under a node above the blocks
LEVELS = (512, 64, 8)  # fingerprints of a node, below the blocks
_PAIRS = 1 << 14  # of nodes that a task takes a level down at a time
_PIECE = 1 << 20  # bytes of a text that are split at a time

# -- fingerprints --------------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words `[^\\x20\\x09-\\x0D]+` of the text, piece by piece."""
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[start:end].split()
        start = end


def _bit_counts(words: list[bytes], width: int) -> np.ndarray:
    """How many shingles of the words have each bit, the lowest first, and their number."""
    line = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts, starts[width:])
    hashes = np.array([digest(line[a : b - 1], SEED) for a, b in cuts], dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.append(bits.sum(axis=0, dtype=np.int64), len(hashes))


def fingerprint(text: bytes, width: int = WORDS) -> int:
    """The 64-bit fingerprint of a text; bounded memory however long the text is."""
    counts, carried = np.zeros(65, dtype=np.int64), []
    for words in _pieces(text.translate(LOWER)):
        words = carried + words
        if len(words) >= width:
            counts += _bit_counts(words, width)
            carried = words[1 - width :] if width > 1 else []
        else:
            carried = words
    if not counts[64] and carried:
        counts = _bit_counts(carried, len(carried))
    bits = (2 * counts[:64] > counts[64]).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), width) for text in batch.column(1)]
            values = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "value"])

    return compute


def gray_rank(value: Column) -> Column:
    """The place of a 64-bit value in the reflected Gray code, as a number that sorts as signed."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value.bitwiseXOR(F.lit(-(1 << 63)))


# -- the index within blocks ---------------------------------------------------------


def _nodes(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ones, zeros) of every so many consecutive values."""
    starts = np.arange(0, len(values), size)
    return np.bitwise_and.reduceat(values, starts), np.bitwise_and.reduceat(~values, starts)


def _index(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [_nodes(values, size) for size in (*LEVELS, 1)]


def _differences(a, i: np.ndarray, b, j: np.ndarray) -> np.ndarray:
    ones_a, zeros_a = a
    ones_b, zeros_b = b
    return np.bitwise_count((ones_a[i] & zeros_b[j]) | (zeros_a[i] & ones_b[j]))


def close_pairs(a: list, b: list, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the values of two indexes that differ in at most so many bits; of an index
    with itself, those with i <= j."""
    top_a, top_b = (np.arange(len(x[0][0])) for x in (a, b))
    waiting = [(0, np.repeat(top_a, len(top_b)), np.tile(top_b, len(top_a)))]
    steps = [u // v for u, v in zip(LEVELS, (*LEVELS[1:], 1))]
    while waiting:
        level, i, j = waiting.pop()
        if len(i) > _PAIRS:
            waiting.append((level, i[_PAIRS:], j[_PAIRS:]))
            i, j = i[:_PAIRS], j[:_PAIRS]
        near = _differences(a[level], i, b[level], j) <= distance
        if a is b:
            near &= i <= j
        i, j = i[near], j[near]
        if not len(i):
            continue
        if level == len(LEVELS):
            yield i, j
            continue
        step, ends = steps[level], (len(a[level + 1][0]), len(b[level + 1][0]))
        below = np.arange(step)
        i = (i[:, None, None] * step + below[:, None] + 0 * below).reshape(-1)
        j = (j[:, None, None] * step + 0 * below[:, None] + below).reshape(-1)
        there = (i < ends[0]) & (j < ends[1])
        waiting.append((level + 1, i[there], j[there]))


def _tie(groups: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the groups of i and j in place; a group is named by its least place."""
    while True:
        low = np.minimum(groups[i], groups[j])
        if (groups[i] == low).all() and (groups[j] == low).all():
            return
        for side in (groups[i], groups[j]):
            np.minimum.at(groups, side, low)
        while not np.array_equal(groups, groups[groups]):
            groups[:] = groups[groups]


def _blocks(distance: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of consecutive values with the value that stands for each value's group."""
        part, number, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            while sum(map(len, held)) >= size:
                values = np.concatenate(held)
                yield block(part, number, values[:size])
                number, held = number + 1, [values[size:]]
        if sum(map(len, held)):
            yield block(part, number, np.concatenate(held))

    def block(part: int, number: int, values: np.ndarray) -> pa.RecordBatch:
        values = values.view(np.uint64)
        index, groups = _index(values), np.arange(len(values))
        for i, j in close_pairs(index, index, distance):
            _tie(groups, i, j)
        ones, zeros = _nodes(values, len(values))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int64()),
                pa.array([values.tobytes()], pa.binary()),
                pa.array([values[groups].tobytes()], pa.binary()),
                pa.array(ones.view(np.int64)),
                pa.array(zeros.view(np.int64)),
            ],
            names=["part", "number", "values", "groups", "ones", "zeros"],
        )

    return cut


_BLOCK = "part int, number long, values binary, groups binary, ones long, zeros long"


def _unpack(packed: pa.Scalar) -> np.ndarray:
    return np.frombuffer(packed.as_py(), dtype=np.uint64)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for values, groups in zip(batch.column("values"), batch.column("groups")):
            columns = [pa.array(_unpack(x).view(np.int64)) for x in (values, groups)]
            yield pa.RecordBatch.from_arrays(columns, names=["value", "tied"])


def _links(distance: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links that connect the groups of two blocks: fewer than they have groups."""
        for batch in batches:
            for columns in zip(*(batch.column(c) for c in ("av", "ag", "bv", "bg"))):
                a, a_groups, b, b_groups = map(_unpack, columns)
                names, place = np.unique(np.concatenate([a_groups, b_groups]), return_inverse=True)
                ties = np.arange(len(names))
                for i, j in close_pairs(_index(a), _index(b), distance):
                    _tie(ties, place[i], place[len(a) + j])
                tied = np.flatnonzero(ties != np.arange(len(ties)))
                pairs = (names[tied].view(np.int64), names[ties[tied]].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], names=["a", "b"])

    return link


# -- the index above blocks ----------------------------------------------------------


def _differ(a: str, b: str) -> Column:
    def shared(one: str, other: str) -> Column:
        return F.col(f"{one}.ones").bitwiseAND(F.col(f"{other}.zeros"))

    return F.bit_count(shared(a, b).bitwiseOR(shared(b, a)))


def _near_blocks(blocks: DataFrame, n: int, working: Work, distance: int) -> DataFrame:
    """(low, high): pairs of different blocks, numbered below n, whose shared bits differ little.

    Goes down from one root, FAN_OUT nodes under each: a pair of nodes meets the pairs of their
    children, joined on the parents' numbers.
    """
    spark = blocks.sparkSession
    nodes = [blocks.select("id", "ones", "zeros")]
    while n > 1:
        up = nodes[-1].groupBy(F.floor(F.col("id") / FAN_OUT).alias("id"))
        up = up.agg(F.bit_and("ones").alias("ones"), F.bit_and("zeros").alias("zeros"))
        nodes.append(working.write(up, f"nodes-{len(nodes)}"))
        n = -(-n // FAN_OUT)
    near = spark.range(1).select(F.col("id").alias("low"), F.col("id").alias("high"))
    for level in reversed(range(len(nodes) - 1)):
        below = nodes[level].withColumn("parent", F.floor(F.col("id") / FAN_OUT))
        near = (
            near.join(below.alias("a"), F.col("low") == F.col("a.parent"))
            .join(below.alias("b"), F.col("high") == F.col("b.parent"))
            .filter((F.col("a.id") <= F.col("b.id")) & (_differ("a", "b") <= distance))
            .select(F.col("a.id").alias("low"), F.col("b.id").alias("high"))
        )
        near = working.write(near, f"near-{level}")
    return near.filter("low < high")


def simhash(
    docs: DataFrame,
    working: Work,
    width: int = WORDS,
    distance: int = DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """A row per document: doc_id, value (the fingerprint as a signed long), component_id.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a shingle is `width` of them, joined by
    blanks, and counts as often as it occurs; a text of fewer words is one shingle.  A bit is set
    where it is in more than half of the shingles' hashes.  A null text, or one without words, has
    fingerprint zero and is linked like any other.  Fingerprints with at most `distance` different
    bits are linked; component_id is the smallest doc_id that links reach, null ids counting only
    where there is no other.  Repeated rows stay, an empty table gives no rows, and other columns
    are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    rows = working.write(rows.mapInArrow(_fingerprints(width), "doc_id long, value long"), "rows")
    distinct = working.write(
        rows.groupBy("value").agg(F.min("doc_id").alias("first_id")), "distinct"
    )
    parts = -(-distinct.count() // (PART_BLOCKS * block)) or 1
    rank = gray_rank(F.col("value"))
    ordered = distinct.select("value", rank.alias("rank")).repartitionByRange(parts, "rank")
    blocks = ordered.sortWithinPartitions("rank").mapInArrow(_blocks(distance, block), _BLOCK)
    blocks = working.write(blocks, "blocks")
    # Numbers in Gray order, with gaps after partitions of fewer blocks than the largest.
    parts, most = blocks.agg(F.max("part") + 1, F.max("number") + 1).first()
    blocks = blocks.withColumn("id", F.col("part") * F.lit(most or 0) + F.col("number"))
    near = _near_blocks(blocks, (parts or 0) * (most or 0), working, distance)

    def side(end: str, letter: str) -> DataFrame:
        return blocks.select(
            F.col("id").alias(end),
            F.col("values").alias(f"{letter}v"),
            F.col("groups").alias(f"{letter}g"),
        )

    cells = near.join(side("low", "a"), "low").join(side("high", "b"), "high")
    links = cells.select("av", "ag", "bv", "bg").mapInArrow(_links(distance), "a long, b long")
    links = working.write(links.distinct(), "links")
    roots = connected(links, working, "components").withColumnRenamed("node", "tied")
    members = blocks.select("values", "groups").mapInArrow(_members, "value long, tied long")
    placed = working.write(
        distinct.join(members, "value")
        .join(broadcast_if_few(working.write(roots, "roots")), "tied", "left")
        .select("value", "first_id", F.coalesce("root", "tied").alias("root")),
        "placed",
    )
    ids = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = working.write(placed.join(ids, "root").select("value", "component_id"), "answer")
    return rows.join(answer, "value").select("doc_id", "value", "component_id")
