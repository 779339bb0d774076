"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authlytics.plans.storage import WorkingTables

T = TypeVar("T")

# Lower-cases A-Z in UTF-8 bytes and leaves every other byte alone.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

# The bytes that `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` leaves out become blanks, after A-Z
# are lower-cased.  Every byte of a character beyond ASCII belongs to a word.
WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 65 <= b <= 90 else 0x20
    for b in range(256)
)

BITMAP_BITS = 1 << 26  # 8 MB on the driver and in each worker, whatever the size of the input
BROADCAST_ROWS = 1 << 20
_BUCKET_BITS = 32768  # of one row of bitmap_construct_agg


BATCH_ROWS = 2000  # that a job of an operator sends Python at a time
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send Python so many rows at a time."""
    before = spark.conf.get(_ARROW_ROWS, None)
    spark.conf.set(_ARROW_ROWS, rows)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ARROW_ROWS)
        else:
            spark.conf.set(_ARROW_ROWS, before)


_held: list = [None, None]


def worker_cache(name: object, make: Callable[[], T]) -> T:
    """What a task of the same name has left in this Python worker, else a new one.

    A worker keeps one at a time, so that operators that run one after the other in the same
    workers do not add up.
    """
    if _held[0] != name:
        _held[:] = [None, None]
        _held[:] = [name, make()]
    return _held[1]


_shipped: set[str] = set()


# Python workers live as long as the executor and are used by one operator after the other: they
# give large blocks back to the system instead of keeping them for the next.
_WORKER_SETTINGS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    A session that has not chosen the size of Arrow batches gets BATCH_ROWS, for jobs that run
    after an operator has returned.
    """
    context = spark.sparkContext
    if spark.conf.get(_ARROW_ROWS, None) is None:
        spark.conf.set(_ARROW_ROWS, BATCH_ROWS)
    if context.applicationId not in _shipped:
        context.environment.update(_WORKER_SETTINGS)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root, name = os.path.split(package)
        archive = os.path.join(tempfile.mkdtemp(), name)
        context.addPyFile(shutil.make_archive(archive, "zip", root, name))
        _shipped.add(context.applicationId)


class Work(WorkingTables):
    """Working tables for jobs whose tasks run code of this package."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        ship(spark)

    def write(self, rows: DataFrame, name: str, *partition_columns: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with arrow_rows(self.spark, BATCH_ROWS):
            rows.write.partitionBy(*partition_columns).option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def write_bucketed(
        self, rows: DataFrame, name: str, column: str, batch_rows: int = BATCH_ROWS
    ) -> DataFrame:
        """Write the rows so that grouping them by the column needs no shuffle.

        The catalog learns of the buckets only until the table has been read by name: files and the
        returned rows don't depend on its entry.
        """
        table_name = f"working_{uuid.uuid4().hex}"
        with arrow_rows(self.spark, batch_rows):
            (
                rows.write.bucketBy(shuffle_partitions(self.spark), column)
                .option("path", f"{self.folder}/{name}")
                .option("compression", "zstd")
                .saveAsTable(table_name)
            )
        written = self.spark.table(table_name)
        self.spark.sql(f"DROP TABLE {table_name}")
        return written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """The bytes of a text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def fresh_name(rows: DataFrame, name: str) -> str:
    """A column name that the rows don't have, whatever its case."""
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name += "_"
    return name


def row_key() -> Column:
    """Tells rows of a table of documents apart; repeated rows have the same key."""
    return F.struct(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"),
    )


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents, with all their columns, whose key is not in the one column `key` of gone."""
    name = fresh_name(docs, "key")
    gone = gone.select(F.col("key").alias(name))
    return docs.withColumn(name, row_key()).join(gone, name, "left_anti").drop(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_words(text: bytes) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split()


def split_blanks(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text after lower-casing A-Z."""
    return text.translate(LOWER).split()


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64 on unsigned 64-bit integers: one-to-one and well spread."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bitmap(rows: DataFrame, key: Column, bits: int = BITMAP_BITS) -> np.ndarray:
    """The 64-bit keys as a bitmap of fixed size, for leaving out most rows before a shuffle.

    A key that is there always has its bit set; others rarely, until the bitmap fills up.  A
    full one lets all rows pass, so it never changes a result.
    """
    place = F.pmod(key, F.lit(bits))
    parts = (
        rows.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()  # at most bits / 32768 rows of 4 KB
    )
    whole = np.zeros(bits // 8 + _BUCKET_BITS // 8, dtype=np.uint8)
    for bucket, code in parts:
        start = bucket * (_BUCKET_BITS // 8)
        whole[start : start + len(code)] = np.frombuffer(code, dtype=np.uint8)
    return whole


def broadcast_if_few(written: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be sent to every executor where it is small enough.

    The check is the table's own row count: at most BROADCAST_ROWS rows of some 50 bytes are sent,
    and beyond that the join shuffles both sides.
    """
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit keys may be in the bitmap."""
    place = np.mod(keys.astype(np.int64), np.int64(8 * len(bits) - _BUCKET_BITS))
    bucket, position = _bucket(place)
    return (bits[bucket * (_BUCKET_BITS // 8) + (position >> 3)] >> (position & 7)) & 1 == 1


def _bucket(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spark's bitmap_bucket_number and bitmap_bit_position, for values of 0 and above."""
    bucket = np.where(place > 0, 1 + (place - 1) // _BUCKET_BITS, 0)
    position = np.where(place > 0, (place - 1) % _BUCKET_BITS, 0)
    return bucket, position


def int_lists(flat: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list per length, cut from consecutive values."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def connected(links: DataFrame, working: Work, name: str) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node of its component.

    Alternates large stars and small stars until nothing changes: in each round a node's
    neighbours are tied to the least of them, so paths shrink by about half.  Each round is
    written, so that a lost executor costs no more than a round.  Nodes of any orderable type.
    """
    spark = links.sparkSession
    edges = working.write(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        f"{name}-0",
    )
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    step = 0
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = working.write(
            least.select("u", F.least("u", "m").alias("m")), f"{name}-{step}-least"
        )
        # Large star: larger neighbours of u go to the least neighbour of u.
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        large = working.write(large, f"{name}-{step}-large")
        # Small star: smaller neighbours of u, and u itself, go to the least of them.
        small_least = working.write(
            large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{step}-small"
        )
        joined = large.join(small_least, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small_least.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        step += 1
        new = working.write(small, f"{name}-{step}")
        # Stars only: every left node has one neighbour, which is no left node.
        lefts = new.groupBy("u").agg(F.count("*").alias("n"))
        chained = new.join(lefts.select(F.col("u").alias("v")), "v", "left_semi")
        if lefts.filter("n > 1").isEmpty() and chained.isEmpty():
            break
        edges = new
    roots = new.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
