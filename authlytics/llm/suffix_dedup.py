"""Repeated passages by longest-previous-factor arrays over suffix arrays.

A window is a string of `least` bytes.  Every window has an anchor: the start of its Q-gram with the
smallest hash.  Equal windows have equal anchors at the same place, so windows are only compared
within the group of an anchor's hash, and hashes that occur once in the corpus rule their windows
out.  The windows of one anchor in one document form a context, a string little longer than a
window; equal contexts are counted as one before anything is grouped.

The distinct contexts of whole groups are packed into cells of bounded size.  In a cell the windows
are sorted as suffixes (prefix doubling, up to the window's length), and from the previous and next
smaller positions in suffix order follow each window's longest earlier match and, from the larger
ones, its longest later match.  A group too large for a cell, such as that of a passage in a third
of all documents, is compared window by window instead: digests of its windows are counted by a
plain aggregate, which Spark combines before it shuffles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.llm.common import Work, bitmap, in_bitmap, mix, row_key, utf8

LEAST = 400
Q = 64
CELL_BYTES = 1 << 20
_PIECE = 1 << 20  # windows of a document that are hashed at a time
_BASE = 0x9E3779B97F4A7C15
_KEY = "struct<doc_id: long, text: long>"


# -- anchors -------------------------------------------------------------------------


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, np.uint64(base))
    powers[0] = 1
    return np.multiply.accumulate(powers)


_UP = _powers(_BASE, _PIECE + LEAST)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _PIECE + LEAST)


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of all Q-grams: a polynomial over the bytes, modulo 2**64, then mixed."""
    n = len(text)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=sums[1:])
    return mix((sums[Q:] - sums[:-Q]) * _DOWN[: n - Q + 1])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def contexts(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, number of windows) of each run of windows with one anchor."""
    found = []
    for start in range(0, max(0, len(text) - least + 1), _PIECE):
        hashes = _gram_hashes(text[start : start + _PIECE + least - 1])
        # The smallest hash, by its high bits, and of equal ones the leftmost.
        place = np.arange(len(hashes), dtype=np.uint64)
        packed = (hashes & ~np.uint64(0x1FFFFF)) | place
        anchors = (_sliding_least(packed, least - Q + 1) & np.uint64(0x1FFFFF)).astype(np.int64)
        firsts = np.flatnonzero(np.diff(anchors, prepend=-1))
        counts = np.diff(firsts, append=len(anchors))
        found.append((hashes[anchors[firsts]].view(np.int64), start + firsts, counts))
    if not found:
        return tuple(np.zeros((3, 0), dtype=np.int64))
    return tuple(np.concatenate(column) for column in zip(*found))


def _bytes(text: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer(), dtype=np.uint8)


def _anchor_rows(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [contexts(_bytes(text), least)[0] for text in batch.column(0)]
            if found:
                hashes = pa.array(np.concatenate(found), pa.int64())
                yield pa.RecordBatch.from_arrays([hashes], names=["hash"])

    return rows


_CONTEXT = f"""doc_id long, key {_KEY}, start int, windows int, hash long, context_id binary,
    context binary"""


def _context_rows(least: int, repeated: np.ndarray):
    """The contexts of anchors that may be repeated."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [contexts(_bytes(text), least) for text in batch.column(2)]
            if not found:
                continue
            places = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            hashes, starts, counts = (np.concatenate(column) for column in zip(*found))
            keep = np.flatnonzero(in_bitmap(repeated, hashes))
            for part in np.array_split(keep, len(keep) // 4096 + 1):
                strings, ids = [], []
                for i in part.tolist():
                    text = _bytes(batch.column(2)[int(places[i])])
                    string = text[starts[i] : starts[i] + counts[i] + least - 1].tobytes()
                    strings.append(string)
                    head = int(hashes[i]).to_bytes(8, "little", signed=True)
                    ids.append(hashlib.blake2b(head + string, digest_size=16).digest())
                at = pa.array(places[part], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array(starts[part], pa.int32()),
                        pa.array(counts[part], pa.int32()),
                        pa.array(hashes[part], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(strings, pa.binary()),
                    ],
                    names="doc_id key start windows hash context_id context".split(),
                )

    return rows


# -- suffix order --------------------------------------------------------------------


def _split(ranks: np.ndarray, active: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Rank the active suffixes by their rank so far, then by what follows; returns those that
    still share a rank.

    A rank is the place of the first suffix with that prefix, so the ranks of a group's parts lie
    between the group's and the next one's, and suffixes that are alone keep theirs.
    """
    own = ranks[active]
    # One number a suffix is sorted much faster than two; the first ranks are all zero.
    keys = own * (int(following.max(initial=0)) + 1) + following if own.any() else following
    order = np.argsort(keys)
    own, following = own[order], following[order]
    n = len(order)
    new_group = np.ones(n, dtype=bool)
    new_group[1:] = own[1:] != own[:-1]
    new_part = new_group.copy()
    new_part[1:] |= following[1:] != following[:-1]
    place = np.arange(n)
    group_start = np.maximum.accumulate(np.where(new_group, place, 0))
    part_start = np.maximum.accumulate(np.where(new_part, place, 0))
    ranks[active[order]] = own + part_start - group_start
    shared = ~new_part
    shared[:-1] |= ~new_part[1:]
    return active[order[shared]]


def prefix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """For every suffix with `length` bytes or more, the rank of its prefix of that length.

    Prefix doubling: ranks by 8 bytes, then by 16, 32 and so on; the last step joins two overlapping
    prefixes.  Only suffixes that still share their rank are sorted again.
    """
    size = min(8, length)
    n = len(text) - size + 1
    first = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        first = first << np.uint64(8) | text[i : i + n]
    ranks = np.zeros(n, dtype=np.int64)
    active = _split(ranks, np.arange(n), first)
    while size < length:
        step = min(size, length - size)
        active = active[active + step < len(ranks)]
        following = ranks[active + step]
        # What is cut off at the end has no prefix of that length and is no longer compared.
        active = _split(ranks, active, following)
        size += step
    return ranks[: len(text) - length + 1]


def longest_previous_factor(positions: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order, the longest prefix that an earlier position has as well.

    `positions` are the suffixes' places in the text and lcp[i] is the common prefix of suffixes i-1
    and i.  The earlier positions with the longest match are the nearest smaller ones before and
    after in suffix order; both are found by following pointers.
    """
    before = _nearest_smaller(positions, lcp)
    turned = np.append(0, lcp[:0:-1])
    after = _nearest_smaller(positions[::-1], turned)[::-1]
    return np.maximum(before, after)


def _nearest_smaller(positions: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The common prefix with the nearest suffix before that has a smaller position, else 0."""
    n = len(positions)
    to = np.arange(n) - 1
    common = lcp.copy()
    if n:
        common[0] = 0
    while True:
        # A pointer at a larger position takes over that one's pointer; what lies between is larger.
        todo = np.flatnonzero((to >= 0) & (common > 0))
        todo = todo[positions[to[todo]] > positions[todo]]
        if not len(todo):
            return np.where(to >= 0, common, 0)
        over = to[todo]
        common[todo] = np.minimum(common[todo], common[over])
        to[todo] = to[over]
        common[todo[to[todo] < 0]] = 0


# -- cells ---------------------------------------------------------------------------


def _marks(ids: list[bytes], strings: list[bytes], order: np.ndarray, least: int):
    """Per context, bits of its windows: has an earlier match, has any match in the cell.

    `order` ranks the contexts by where they first occur.
    """
    text = np.frombuffer(b"".join(strings), dtype=np.uint8)
    lengths = np.array([len(s) for s in strings])
    counts = lengths - least + 1
    context = np.repeat(np.arange(len(strings)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(np.cumsum(lengths) - lengths, counts) + offset
    ranks = prefix_ranks(text, least)[starts]
    positions = order[context] * int(lengths.max()) + offset
    suffixes = np.lexsort((positions, ranks))
    lcp = np.zeros(len(suffixes), dtype=np.int64)
    ordered = ranks[suffixes]
    lcp[1:] = np.where(ordered[1:] == ordered[:-1], least, 0)
    own = positions[suffixes]
    earlier = np.zeros(len(suffixes), dtype=bool)
    later = np.zeros(len(suffixes), dtype=bool)
    earlier[suffixes] = longest_previous_factor(own, lcp) >= least
    later[suffixes] = longest_previous_factor(-own, lcp) >= least
    cuts = np.cumsum(counts)[:-1]
    for name, e, l in zip(ids, np.split(earlier, cuts), np.split(later, cuts)):
        yield name, np.packbits(e).tobytes(), np.packbits(e | l).tobytes()


_MARK = "context_id binary, earlier binary, any binary"


def _mark_batch(marks) -> pa.RecordBatch:
    columns = list(zip(*marks)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary()) for c in columns], names=["context_id", "earlier", "any"]
    )


def _mark_cells(least: int):
    """Marks of contexts that come sorted by hash; cells hold whole groups."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    # Windows only match windows of their own group.
                    held += group if len(group) > 1 else []
                    group = []
                    if size >= CELL_BYTES:
                        yield cell(held)
                        held, size = [], 0
                group.append(row)
                size += len(row[2])
        held += group if len(group) > 1 else []
        if held:
            yield cell(held)

    def cell(rows: list[tuple]) -> pa.RecordBatch:
        _, ids, strings, firsts = zip(*rows)
        rank = {first: i for i, first in enumerate(sorted(set(firsts)))}
        order = np.array([rank[first] for first in firsts])
        return _mark_batch(_marks(list(ids), list(strings), order, least))

    return mark


def _of_groups(wanted: np.ndarray, unwanted: np.ndarray):
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            keep = in_bitmap(wanted, hashes) & ~in_bitmap(unwanted, hashes)
            yield batch.filter(pa.array(keep))

    return select


# -- groups too large for a cell -----------------------------------------------------


def _window_rows(least: int):
    """A row (digest, context_id, first, place) per window of a context."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                hashed, name, string, first = (c[row].as_py() for c in batch.columns)
                head = hashed.to_bytes(8, "little", signed=True)
                count = len(string) - least + 1
                digests = [
                    hashlib.blake2b(head + string[i : i + least], digest_size=16).digest()
                    for i in range(count)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests, pa.binary()),
                        pa.array([name] * count, pa.binary()),
                        pa.array([first] * count, pa.decimal128(38, 0)),
                        pa.array(range(count), pa.int32()),
                    ],
                    names=["digest", "context_id", "first", "place"],
                )

    return rows


def _window_marks(contexts_: DataFrame, working: Work, least: int) -> DataFrame:
    windows = working.write(
        contexts_.mapInArrow(
            _window_rows(least),
            "digest binary, context_id binary, first decimal(38,0), place int",
        ),
        "windows",
    )
    at = F.col("first") + F.col("place")
    seen = windows.groupBy("digest").agg(F.count("*").alias("n"), F.min(at).alias("least_at"))
    seen = working.write(seen.filter("n > 1").drop("n"), "repeated-windows")
    matched = windows.join(seen, "digest").withColumn("is_later", at > F.col("least_at"))
    places = matched.groupBy("context_id").agg(
        F.collect_list("place").alias("any"),
        F.collect_list(F.when(F.col("is_later"), F.col("place"))).alias("earlier"),
    )
    return places.mapInArrow(_pack_places, _MARK)


def _pack_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def bits(places: list[int], size: int) -> bytes:
        flags = np.zeros(size, dtype=bool)
        flags[places] = True
        return np.packbits(flags).tobytes()

    for batch in batches:
        marks = []
        for row in batch.to_pylist():
            size = max(row["any"]) + 1
            marks.append((row["context_id"], bits(row["earlier"], size), bits(row["any"], size)))
        yield _mark_batch(marks)


# -- documents -----------------------------------------------------------------------


def _ranges(least: int, keep_first: bool):
    """Rows (key, start, end): the bytes that repeated windows of a context cover."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, count, n = (batch.column(c).to_numpy() for c in ("start", "windows", "n"))
            whole = n > 1
            if keep_first:
                whole &= ~batch.column("is_first").to_numpy(zero_copy_only=False)
            keys = np.flatnonzero(whole).tolist()
            starts = start[whole].tolist()
            ends = (start + count - 1 + least)[whole].tolist()
            marked = ~whole & ~batch.column("mark").is_null().to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(marked).tolist():
                packed = np.frombuffer(batch.column("mark")[i].as_py(), dtype=np.uint8)
                found = np.unpackbits(packed)[: count[i]]
                steps = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
                edges = np.flatnonzero(steps).tolist()
                for a, b in zip(edges[::2], edges[1::2]):
                    keys.append(i)
                    starts.append(int(start[i]) + a)
                    ends.append(int(start[i]) + b - 1 + least)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(keys, pa.int32())),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                ],
                names=["key", "start", "end"],
            )

    return ranges


_RESULT = f"""doc_id long, key {_KEY}, n_bytes long,
    spans array<struct<start: int, end: int>>, kept binary"""
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _touched(wanted: np.ndarray, there: bool):
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = in_bitmap(wanted, pa.compute.struct_field(batch.column(1), "text").to_numpy())
            yield batch.filter(pa.array(maybe == there))

    return select


def merged(spans: list[dict]) -> list[dict]:
    """Maximal runs of overlapping or touching spans."""
    runs: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if runs and span["start"] <= runs[-1]["end"]:
            runs[-1]["end"] = max(runs[-1]["end"], span["end"])
        else:
            runs.append(dict(span))
    return runs


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_spans, kept, sizes = [], [], []
        for text, spans in zip(batch.column(2), batch.column(3)):
            text, runs = text.as_py(), merged(spans.as_py() or [])
            edges = [0, *(x for run in runs for x in (run["start"], run["end"])), len(text)]
            pieces = (text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            all_spans.append(runs)
            kept.append(b"".join(pieces))
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(all_spans, _SPANS),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "key", "n_bytes", "spans", "kept"],
        )


def _position(doc_id: Column, start: Column) -> Column:
    """Where a string starts, as one number that sorts by document (null ids last) and place."""
    place = F.coalesce(doc_id, F.lit((1 << 63) - 1)).cast("decimal(20,0)")
    return (place * F.lit(1 << 31).cast("decimal(12,0)") + start).cast("decimal(38,0)")


def remove_repeats(
    docs: DataFrame, working: Work, least: int = LEAST, keep_first: bool = True
) -> DataFrame:
    """A row per document: doc_id, key (tells rows apart), n_bytes, spans, kept.

    Texts are UTF-8 bytes, a null one is empty; matches never cross documents.  A byte goes if it
    lies in a string of `least` bytes that also starts anywhere earlier (by doc_id, null ids last,
    then by place) or, without keep_first, anywhere else.  Strings are judged on the input and may
    overlap.  spans are the maximal runs of removed bytes, ends excluded; kept is what is left.
    Repeated rows all stay rows: without keep_first they repeat each other, with it those that share
    id and text are first together.  An empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key().alias("key"),
        utf8("text").alias("text"),
    )
    anchors = texts.select("text").mapInArrow(_anchor_rows(least), "hash long")
    repeated = anchors.groupBy("hash").count().filter("count > 1")
    repeated = bitmap(working.write(repeated.select("hash"), "hashes"), F.col("hash"))
    rows = working.write(texts.mapInArrow(_context_rows(least, repeated), _CONTEXT), "contexts")

    at = _position(F.col("doc_id"), F.col("start"))
    distinct = rows.groupBy("hash", "context_id", "context").agg(
        F.count("*").alias("n"), F.min(at).alias("first")
    )
    distinct = working.write(distinct, "distinct")
    groups = distinct.groupBy("hash").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("context")).alias("bytes")
    )
    groups = working.write(groups.filter("n > 1"), "groups")
    several = bitmap(groups, F.col("hash"))
    large = bitmap(groups.filter(F.col("bytes") > CELL_BYTES), F.col("hash"))
    strings = distinct.select("hash", "context_id", "context", "first")
    in_cells = strings.mapInArrow(_of_groups(several, large), strings.schema)
    marks = (
        in_cells.repartition("hash")
        .sortWithinPartitions("hash")
        .mapInArrow(_mark_cells(least), _MARK)
    )
    if large.any():
        alone = strings.mapInArrow(_of_groups(large, np.zeros_like(large)), strings.schema)
        marks = marks.union(_window_marks(alone, working, least))
    marks = working.write(marks, "marks")

    known = distinct.select("context_id", "n", "first").join(marks, "context_id", "left")
    mark = F.col("earlier" if keep_first else "any").alias("mark")
    known = working.write(
        known.select("context_id", "n", "first", mark).filter("n > 1 OR mark IS NOT NULL"), "known"
    )
    placed = rows.select("key", "start", "windows", "context_id", at.alias("at"))
    is_first = (F.col("at") == F.col("first")).alias("is_first")
    ranges = (
        placed.join(known, "context_id")
        .select("key", "start", "windows", "n", is_first, "mark")
        .mapInArrow(_ranges(least, keep_first), f"key {_KEY}, start int, end int")
        .distinct()
    )
    spans = ranges.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = working.write(spans, "spans")
    touched = bitmap(spans, F.col("key.text"))
    cut = texts.mapInArrow(_touched(touched, True), texts.schema).join(spans, "key", "left")
    cut = cut.select("doc_id", "key", "text", "spans").mapInArrow(_cut, _RESULT)
    whole = texts.mapInArrow(_touched(touched, False), texts.schema).select(
        "doc_id",
        "key",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start: int, end: int>>").alias("spans"),
        F.col("text").alias("kept"),
    )
    return whole.union(working.write(cut, "cut"))
