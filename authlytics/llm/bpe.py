"""Byte-pair encoding through a table of distinct words, and decoding.

Spark splits texts into words.  Each segment (documents of one partition with about SEGMENT_WORDS
words) numbers its distinct words by frequency and keeps its documents as runs of those numbers, so
a word that makes up a third of all words costs a byte per occurrence and is sent once per segment.
Distinct words go to the owner of their hash, which encodes each of them once, however many segments
sent it, and answers
with its ids; a segment then replaces numbers by ids, position by position.  Runs are bucketed by
segment and stay where they are; only words and their ids are shuffled.  Decoding joins ids
with the table of pieces, whose size is that of the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.llm.byte_pairs import PATTERN, BytePairs
from authlytics.llm.common import Work, row_key, shuffle_partitions, worker_cache

SEGMENT_WORDS = 3_000_000

_SPLIT = """segment long, place int,
    doc struct<doc_id: long, key: struct<doc_id: long, text: long>>,
    numbers binary, owner int, owned binary, lengths binary, words binary"""


# -- runs of small numbers -----------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers below 2**28 in groups of seven bits, the least significant first."""
    values = values.astype(np.uint32)
    size = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    starts = ends - size
    for i in range(4):
        has = size > i
        more = (size[has] > i + 1).astype(np.uint8) << 7
        out[starts[has] + i] = ((values[has] >> np.uint32(7 * i)) & 127).astype(np.uint8) | more
    return out.tobytes()


def unpack(code: bytes) -> np.ndarray:
    raw = np.frombuffer(code, dtype=np.uint8)
    last = raw < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else ends
    values = np.zeros(len(ends), dtype=np.int64)
    for i in range(4):
        has = ends - starts >= i
        values[has] |= (raw[starts[has] + i].astype(np.int64) & 127) << (7 * i)
    return values


# -- splitting -----------------------------------------------------------------------


def split_words(text: Column, specials: list[str]) -> Column:
    """The words of a text in order; special tokens are words of their own."""
    pattern = F.lit(PATTERN)
    plain = F.regexp_extract_all(text, pattern, F.lit(0))
    if not specials:
        return plain
    either = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    found = F.regexp_extract_all(text, F.lit(either), F.lit(0))
    pieces = F.zip_with(
        F.split(text, either, -1),
        found,
        lambda piece, special: F.concat(
            F.regexp_extract_all(piece, pattern, F.lit(0)),
            F.when(special.isNotNull(), F.array(special)).otherwise(
                F.array().cast("array<string>")
            ),
        ),
    )
    return F.when(text.rlike(either), F.flatten(pieces)).otherwise(plain)


def _number(owners: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, chunk, words = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, pa.DictionaryArray]] = []
        for batch in batches:
            lists = batch.column(1)
            coded = lists.flatten().dictionary_encode()
            held.append((batch.column(0), np.diff(lists.offsets.to_numpy()), coded))
            words += len(coded)
            if words >= SEGMENT_WORDS:
                yield from _segment(partition << 32 | chunk, held, owners)
                chunk, words, held = chunk + 1, 0, []
        if held:
            yield from _segment(partition << 32 | chunk, held, owners)

    return number


def _segment(segment: int, held: list, owners: int) -> Iterator[pa.RecordBatch]:
    """The documents of a segment as runs of numbers, then its words for each owner."""
    unified = pa.chunked_array([coded for _, _, coded in held]).unify_dictionaries()
    dictionary = unified.chunk(0).dictionary
    counts = np.zeros(len(dictionary), dtype=np.int64)
    for chunk in unified.chunks:
        counts += np.bincount(chunk.indices.to_numpy(), minlength=len(counts))
    by_count = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), dtype=np.int32)
    rank[by_count] = np.arange(len(counts))
    for (docs, lengths, _), chunk in zip(held, unified.chunks):
        numbers, ends = rank[chunk.indices.to_numpy()], np.cumsum(lengths)
        runs = [pack(numbers[i:j]) for i, j in zip(ends - lengths, ends)]
        yield _split_rows(segment, len(lengths), docs, runs, None)
    words = [w.encode() for w in dictionary.take(pa.array(by_count)).to_pylist()]
    owner = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % owners
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(owners + 1))
    sent = []
    for k in np.flatnonzero(np.diff(cuts)):
        own = order[cuts[k] : cuts[k + 1]]
        mine = [words[i] for i in own]
        sizes = pack(np.array([len(w) for w in mine]))
        sent.append((int(k), pack(np.diff(own, prepend=0)), sizes, b"".join(mine)))
    if sent:
        docs = pa.nulls(len(sent), held[0][0].type)
        yield _split_rows(segment, len(sent), docs, None, list(zip(*sent)))


def _split_rows(segment: int, n: int, docs, runs, sent) -> pa.RecordBatch:
    owner, owned, lengths, words = sent or [[None] * n] * 4
    return pa.RecordBatch.from_arrays(
        [
            pa.array([segment] * n, pa.int64()),
            pa.array(range(n), pa.int32()),
            docs,
            pa.array(runs or [None] * n, pa.binary()),
            pa.array(owner, pa.int32()),
            pa.array(owned, pa.binary()),
            pa.array(lengths, pa.binary()),
            pa.array(words, pa.binary()),
        ],
        names="segment place doc numbers owner owned lengths words".split(),
    )


# -- encoding ------------------------------------------------------------------------


def _loaded(vocabulary: str) -> BytePairs:
    return worker_cache(("bpe", zlib.crc32(vocabulary.encode())), lambda: BytePairs(vocabulary))


def _encode_distinct(vocabulary):
    def encode(batch: pa.Table) -> pa.Table:
        """One owner's words, each encoded once, and the ids for every segment that sent it."""
        pairs = _loaded(vocabulary.value)
        table: dict[bytes, list[int]] = {w.encode(): [i] for w, i in pairs.specials.items()}
        answers = []
        for sizes, words in zip(*(batch.column(c).to_pylist() for c in ("lengths", "words"))):
            ids, counts, at = [], [], 0
            for size in unpack(sizes).tolist():
                word = words[at : at + size]
                at += size
                if word not in table:
                    table[word] = pairs.encode(word)
                ids += table[word]
                counts.append(len(table[word]))
            answers.append((pack(np.array(counts)), pack(np.array(ids))))
        counts, ids = zip(*answers)
        return pa.table(
            {
                "segment": batch.column("segment"),
                "owned": batch.column("owned"),
                "counts": pa.array(counts, pa.binary()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    return encode


def _place(vocabulary):
    """Documents with their ids, and, given a vocabulary, with what these decode to."""

    def place(docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _place_ids(docs, answers)
        if vocabulary is None:
            return rows
        texts = _join_pieces(rows.column("ids"), _pieces(_loaded(vocabulary.value)))
        return rows.append_column("decoded", pa.array(texts, pa.string()))

    return place


def _place_ids(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a segment with their ids, by the number of each word."""
    numbers, counts, ids = [], [], []
    for row in answers.to_pylist():
        numbers.append(np.cumsum(unpack(row["owned"])))
        counts.append(unpack(row["counts"]))
        ids.append(unpack(row["ids"]))
    none = np.zeros(0, dtype=np.int64)
    number, count, flat = (np.concatenate(x or [none]) for x in (numbers, counts, ids))
    size, start = np.zeros(len(number), dtype=np.int64), np.zeros(len(number), dtype=np.int64)
    size[number], start[number] = count, np.cumsum(count) - count
    encoded, n_tokens = [], []
    for run in docs.column("numbers").to_pylist():
        words = unpack(run)
        ends = np.cumsum(size[words])
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(start[words] - ends + size[words], size[words])
        encoded.append(flat[at].astype("<u4").tobytes())
        n_tokens.append(total)
    return pa.table(
        {
            "doc_id": pa.compute.struct_field(docs.column("doc"), "doc_id"),
            "key": pa.compute.struct_field(docs.column("doc"), "key"),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "ids": pa.array(encoded, pa.binary()),
        }
    )


def encode(
    docs: DataFrame, vocabulary: str, working: Work, decoded: bool = False
) -> DataFrame:
    """A row per document: doc_id, key (tells rows apart), n_tokens, ids; with `decoded` also what
    `decode` makes of the ids, in the same task.

    `vocabulary` is the JSON text of a byte-level vocabulary.  ids are the whole text's token ids as
    little-endian unsigned 32-bit integers, as the vocabulary's own library gives them without added
    special tokens; special tokens inside texts are found as it finds them.  A null text is empty
    and has no ids.  Repeated rows stay, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    specials = list(BytePairs(vocabulary).specials)
    sent = spark.sparkContext.broadcast(vocabulary)
    doc = F.struct(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key().alias("key"),
    )
    words = split_words(F.coalesce("text", F.lit("")), specials)
    split = docs.select(doc.alias("doc"), words.alias("words"))
    split = split.mapInArrow(_number(shuffle_partitions(spark)), _SPLIT)
    # A document's words take many times its own room.
    split = working.write_bucketed(split, "split", "segment", batch_rows=500)
    answers = (
        split.filter("owner IS NOT NULL")
        .select("segment", "owner", "owned", "lengths", "words")
        .groupBy("owner")
        .applyInArrow(
            _encode_distinct(sent), "segment long, owned binary, counts binary, ids binary"
        )
    )
    runs = split.filter("owner IS NULL").select("segment", "doc", "numbers")
    return (
        runs.groupBy("segment")
        .cogroup(answers.groupBy("segment"))
        .applyInArrow(
            _place(sent if decoded else None),
            "doc_id long, key struct<doc_id: long, text: long>, n_tokens long, ids binary"
            + ", decoded string" * decoded,
        )
    )


# -- decoding ------------------------------------------------------------------------


def decode(encoded: DataFrame, vocabulary: str, name: str = "decoded") -> DataFrame:
    """The rows with the text that their ids stand for; ids without a piece stand for nothing.

    Every id is joined with the table of pieces, which has a row per id of the vocabulary.  Bytes
    that are no UTF-8 become the replacement character.  Null ids give a null text.
    """
    spark = encoded.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    at = encoded.columns.index("ids")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(_loaded(sent.value))
        for batch in batches:
            texts = _join_pieces(batch.column(at), pieces)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name]
            )

    return encoded.mapInArrow(join, f"{fields}, `{name}` string")


def _pieces(pairs: BytePairs) -> pa.Array:
    """The table of pieces: the bytes of each id, in order."""
    size = max(pairs.pieces) + 1
    return pa.array([pairs.pieces.get(i, b"") for i in range(size)], pa.large_binary())


def _join_pieces(codes: pa.Array, pieces: pa.Array) -> list[str | None]:
    texts, size = [], len(pieces)
    for code in codes:
        if code.as_py() is None:
            texts.append(None)
            continue
        ids = np.frombuffer(code.as_py(), dtype="<u4")
        found = pieces.take(pa.array(np.where(ids < size, ids, 0)))
        known = found.filter(pa.array(ids < size)) if (ids >= size).any() else found
        texts.append(_joined(known).decode("utf-8", "replace"))
    return texts


def _joined(pieces: pa.LargeBinaryArray) -> bytes:
    """All pieces in a row: the values as they lie in memory."""
    if not len(pieces):
        return b""
    _, offsets, values = pieces.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    return values[int(ends[0]) : int(ends[-1])].to_pybytes() if values else b""
