"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each part (a bounded chunk of one input partition) sorts the fingerprints of its texts and sends
every owner of a fingerprint range one Golomb-Rice coded list.  Owners answer with a bitmap: which
of the sent fingerprints other parts also sent.  Only the texts behind set bits, the suspects, are
shuffled and compared byte by byte.  A part sends a fingerprint once however often it holds it, and
sends one copy of a suspect text per batch, so a text that makes up a third of the corpus is one
entry per part, not one per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authlytics.llm.common import Work, bitmap, fresh_name, in_bitmap, shuffle_partitions, utf8

# Fixed values: `[\x20\x09-\x0D]` is not part of a text's identity.
BLANKS = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))

FINGERPRINT_BITS = 48
PART_ROWS = 1 << 16


# -- Golomb-Rice coding --------------------------------------------------------------


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """(k, code) of ascending distinct unsigned integers.

    Gaps are coded with divisor 2**k, near their mean: quotients in unary, then the remainders.
    """
    if not len(values):
        return 0, b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    k = max(0, int(int(values[-1]) // len(values)).bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(values), dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(k, dtype=np.uint64)
    remainders = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes() + np.packbits(remainders.ravel()).tobytes()


def golomb_decode(k: int, n: int, code: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.uint64)
    tail = (n * k + 7) // 8
    unary = np.unpackbits(np.frombuffer(code[: len(code) - tail], dtype=np.uint8))
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(code[len(code) - tail :], dtype=np.uint8))
        powers = np.uint64(1) << np.arange(k, dtype=np.uint64)
        gaps += bits[: n * k].reshape(n, k).astype(np.uint64) @ powers
    return np.cumsum(gaps, dtype=np.uint64)


# -- texts ---------------------------------------------------------------------------


def normalised(text: bytes) -> bytes:
    return text.translate(None, BLANKS)


def _n_chars(text: bytes) -> int:
    return len(text.translate(None, _CONTINUATION))


def fingerprints(digests: list[bytes]) -> np.ndarray:
    """The leading bits of SHA-256 digests."""
    head = np.frombuffer(b"".join(d[:8] for d in digests), dtype=">u8").astype(np.uint64)
    return head >> np.uint64(64 - FINGERPRINT_BITS)


def _owner(prints: np.ndarray, owners: int) -> np.ndarray:
    return (prints >> np.uint64(FINGERPRINT_BITS - 31)).astype(np.int64) * owners >> 31


# -- the exchange --------------------------------------------------------------------

_PART = """part long, doc_ids array<long>, chars array<long>, digests array<binary>,
    messages array<struct<owner: int, n: int, k: int, code: binary>>"""


def _pack_parts(owners: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, chunk = TaskContext.get().partitionId(), 0
        ids: list = []
        chars: list[int] = []
        digests: list[bytes] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids.append(doc_id)
                chars.append(_n_chars(text))
                digests.append(hashlib.sha256(normalised(text)).digest())
                if len(ids) == PART_ROWS:
                    yield _part(partition << 32 | chunk, ids, chars, digests, owners)
                    chunk, ids, chars, digests = chunk + 1, [], [], []
        if ids:
            yield _part(partition << 32 | chunk, ids, chars, digests, owners)

    return pack


def _part(part: int, ids: list, chars: list, digests: list, owners: int) -> pa.RecordBatch:
    sent = np.unique(fingerprints(digests))
    cuts = np.searchsorted(_owner(sent, owners), np.arange(owners + 1))
    messages = []
    for owner in np.flatnonzero(np.diff(cuts)):
        values = sent[cuts[owner] : cuts[owner + 1]]
        k, code = golomb_encode(values)
        messages.append({"owner": int(owner), "n": len(values), "k": k, "code": code})
    kind = pa.struct(
        [("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()), ("code", pa.binary())]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part]),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([chars], pa.list_(pa.int64())),
            pa.array([digests], pa.list_(pa.binary())),
            pa.array([messages], pa.list_(kind)),
        ],
        names=["part", "doc_ids", "chars", "digests", "messages"],
    )


def _answer(messages: pa.Table) -> pa.Table:
    """One owner's bitmaps: per message, which fingerprints other parts have sent as well."""
    columns = (messages.column(c).to_pylist() for c in ("n", "k", "code"))
    lists = [golomb_decode(k, n, code) for n, k, code in zip(*columns)]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
    return pa.table(
        {
            "part": messages.column("part"),
            "owner": messages.column("owner"),
            "bits": pa.array(bitmaps, pa.binary()),
        }
    )


_ROW = "doc_id long, chars long, digest binary, print long, suspect boolean, address long"


def _receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part's rows, each with whether its fingerprint occurs again, here or elsewhere."""
    for batch in batches:
        for row in batch.to_pylist():
            prints = fingerprints(row["digests"])
            sent, back, counts = np.unique(prints, return_inverse=True, return_counts=True)
            bits = {m["owner"]: m["bits"] for m in row["bitmaps"]}
            answer = [
                np.unpackbits(np.frombuffer(bits[m["owner"]], dtype=np.uint8))[: m["n"]]
                for m in row["messages"]
            ]
            suspect = (np.concatenate(answer) > 0) | (counts > 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["chars"], pa.int64()),
                    pa.array(row["digests"], pa.binary()),
                    pa.array(prints.astype(np.int64)),
                    pa.array(suspect[back]),
                    pa.array(row["part"] * PART_ROWS + np.arange(len(prints))),
                ],
                names=["doc_id", "chars", "digest", "print", "suspect", "address"],
            )


def _suspect_texts(bits: np.ndarray):
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            texts = [normalised(x.as_py()) for x in batch.column(0)]
            digests = [hashlib.sha256(x).digest() for x in texts]
            if not digests:
                continue
            for i in np.flatnonzero(in_bitmap(bits, fingerprints(digests))):
                found.setdefault(texts[i], []).append(int(i))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digests[rows[0]] for rows in found.values()], pa.binary()),
                    pa.array(list(found), pa.binary()),
                    pa.array([len(rows) for rows in found.values()], pa.int64()),
                ],
                names=["digest", "normalised", "copies"],
            )

    return select


def exact_dedup(docs: DataFrame, working: Work, owners: int | None = None) -> DataFrame:
    """A row per document: doc_id, chars, digest, keep_id, keep_chars, group_size, kept.

    Texts are equal when their bytes are, without blanks `[\\x20\\x09-\\x0D]`; a null text is
    empty.  Of equal texts the row with the most code points stays, then the smallest doc_id (null
    ids last), then any one of repeated rows.  An empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    owners = owners or shuffle_partitions(docs.sparkSession)
    parts = working.write(
        docs.select("doc_id", utf8("text").alias("text")).mapInArrow(_pack_parts(owners), _PART),
        "parts",
    )
    bitmaps = (
        parts.select("part", F.explode("messages").alias("m"))
        .select("part", "m.*")
        .groupBy("owner")
        .applyInArrow(_answer, "part long, owner int, bits binary")
        .groupBy("part")
        .agg(F.collect_list(F.struct("owner", "bits")).alias("bitmaps"))
    )
    sent = F.transform("messages", lambda m: F.struct(m["owner"], m["n"]))
    asking = parts.select("part", "doc_ids", "chars", "digests", sent.alias("messages"))
    rows = working.write(asking.join(bitmaps, "part").mapInArrow(_receive, _ROW), "rows")
    suspects = rows.filter("suspect")
    texts = docs.select(utf8("text").alias("text")).mapInArrow(
        _suspect_texts(bitmap(suspects, F.col("print"))),
        "digest binary, normalised binary, copies long",
    )
    # Bytes decide: a group is a digest and the whole normalised text.
    equal = texts.groupBy("digest", "normalised").agg(F.sum("copies").alias("group_size"))
    equal = equal.filter("group_size > 1").select("digest", "group_size")
    first = F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "address")
    best = suspects.groupBy("digest").agg(F.min(first).alias("best"))
    groups = working.write(
        equal.join(best, "digest").select(
            "digest",
            "group_size",
            F.col("best.doc_id").alias("keep_id"),
            (-F.col("best.col1")).alias("keep_chars"),
            F.col("best.address").alias("keep_address"),
        ),
        "groups",
    )
    grouped = F.col("group_size").isNotNull()
    return rows.join(groups, "digest", "left").select(
        "doc_id",
        "chars",
        "digest",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("keep_chars", "chars").alias("keep_chars"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("address") == F.col("keep_address"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, working: Work) -> DataFrame:
    """The rows that exact_dedup keeps, with all their columns."""
    decided = working.write(exact_dedup(docs, working), "decided")
    name = fresh_name(docs, "key")
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")
    keyed = docs.withColumn(
        name,
        F.struct(
            F.unhex(F.sha2(bare.cast("binary"), 256)).alias("digest"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
        ),
    )
    key = F.struct("digest", "doc_id", "chars").alias(name)
    gone = decided.filter("NOT kept")
    same_as_kept = "doc_id <=> keep_id AND chars = keep_chars"
    kept = keyed.join(gone.filter(f"NOT ({same_as_kept})").select(key), name, "left_anti")
    repeated = working.write(gone.filter(same_as_kept).select(key).distinct(), "repeated")
    if not repeated.isEmpty():
        one_each = kept.join(repeated, name, "left_semi").dropDuplicates([name])
        kept = kept.join(repeated, name, "left_anti").unionByName(one_each)
    return kept.drop(name)
