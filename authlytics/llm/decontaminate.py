"""Benchmark decontamination over a positional inverted index of the training texts.

The index is cut into segments: runs of whole documents with about SEGMENT_WORDS words.  A segment
holds, for each of its terms, the ascending positions at which the term occurs, stored as gaps;
positions count through the segment, with one left out between documents.  Segments are built,
stored and searched apart from each other, so a term that makes up a third of all words is a list of
bounded length in each.

The windows of the test items are a table, dealt to blocks of bounded size and keyed by their rarest
term, and reach only the segments that hold that term.  There a window starts from the list of its
rarest term, shifted by the term's offset, and is intersected with the shifted lists of the others,
rarest first; what is left are the places of the phrase, or, with slop, places near which every term
lies close to where the phrase has it.  All blocks are searched in one job: the lists of the index are
read once, whatever the number of items.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.llm.common import (
    Work,
    broadcast_if_few,
    int_lists,
    row_key,
    split_words,
    utf8,
    without,
)

SEGMENT_WORDS = 1 << 21
BLOCK_WINDOWS = 1 << 16  # that a task looks for in a segment at a time
WINDOW = 10

_POSTINGS = """segment long, term binary, n long, gaps array<int>,
    documents array<struct<doc_id: long, key: struct<doc_id: long, text: long>, n_words: int>>"""


# -- index ---------------------------------------------------------------------------


class _Terms(dict):
    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


class _Segment:
    def __init__(self):
        self.terms, self.codes, self.documents, self.words = _Terms(), [], [], 0

    def add(self, document: dict, text: bytes) -> None:
        words = split_words(text)
        codes = np.fromiter(map(self.terms.__getitem__, words), dtype=np.int32, count=len(words))
        self.codes.append(codes)
        self.documents.append(document | {"n_words": len(words)})
        self.words += len(words)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """The documents in a row without a term, then a row per term."""
        lengths = np.array([len(x) for x in self.codes])
        starts = np.cumsum(lengths + 1) - lengths - 1
        codes = np.concatenate(self.codes)
        places = np.arange(len(codes)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        order = np.argsort(codes, kind="stable")
        counts = np.bincount(codes, minlength=len(self.terms))
        gaps = np.diff(places[order], prepend=0).astype(np.int32)
        firsts = (np.cumsum(counts) - counts)[counts > 0]
        gaps[firsts] = places[order][firsts]
        kinds = _arrow_kinds()
        empty = pa.array([[]], kinds["gaps"])
        yield _batch(
            [number], [None], [self.words], empty, pa.array([self.documents], kinds["documents"])
        )
        terms = list(self.terms)
        for i in range(0, len(terms), 10_000):
            part = counts[i : i + 10_000]
            start = int(counts[:i].sum())
            lists = int_lists(gaps[start : start + int(part.sum())], part, pa.int32())
            nothing = pa.nulls(len(part), kinds["documents"])
            yield _batch([number] * len(part), terms[i : i + 10_000], part, lists, nothing)


def _arrow_kinds() -> dict[str, pa.DataType]:
    key = pa.struct([("doc_id", pa.int64()), ("text", pa.int64())])
    document = pa.struct([("doc_id", pa.int64()), ("key", key), ("n_words", pa.int32())])
    return {"gaps": pa.list_(pa.int32()), "documents": pa.list_(document)}


def _batch(segments, terms, counts, gaps, documents) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(segments, pa.int64()),
            pa.array(terms, pa.binary()),
            pa.array(counts, pa.int64()),
            gaps,
            documents,
        ],
        names=["segment", "term", "n", "gaps", "documents"],
    )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    partition, chunk, segment = TaskContext.get().partitionId(), 0, _Segment()
    for batch in batches:
        keys = batch.column(2).to_pylist()
        for doc_id, text, key in zip(batch.column(0).to_pylist(), batch.column(1), keys):
            segment.add({"doc_id": doc_id, "key": key}, text.as_py())
            if segment.words >= SEGMENT_WORDS:
                yield from segment.rows(partition << 32 | chunk)
                chunk, segment = chunk + 1, _Segment()
    if segment.documents:
        yield from segment.rows(partition << 32 | chunk)


def build_index(docs: DataFrame, working: Work) -> DataFrame:
    """The positional index of all words of the documents, written to a working table."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8("text").alias("text"),
        row_key().alias("key"),
    )
    return working.write(rows.mapInArrow(_segments, _POSTINGS), "index")


def documents(index: DataFrame) -> DataFrame:
    """segment, place, doc_id, key, n_words: a row per document of the index."""
    return (
        index.filter("term IS NULL")
        .select("segment", F.posexplode("documents").alias("place", "document"))
        .select("segment", "place", "document.*")
    )


# -- search --------------------------------------------------------------------------


def windows(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    """Every run of `width` words; fewer words are one window, none none."""
    if not words:
        return []
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


_WINDOWS = "window binary, item_id long, terms array<binary>"
_MATCHES = """segment long, place int, item_id long,
    spans array<struct<start: int, end: int>>, exact boolean"""


def _window_rows(width: int):
    """A row per window of an item; `window` tells items with different words or ids apart."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = windows(split_words(text.as_py()), width)
                for i in range(0, len(found), 4096):
                    part = found[i : i + 4096]
                    # No word holds a comma.
                    names = [
                        hashlib.blake2b(b",".join((b"%r" % item_id, *w)), digest_size=16).digest()
                        for w in part
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, pa.binary()),
                            pa.array([item_id] * len(part), pa.int64()),
                            pa.array(part, pa.list_(pa.binary())),
                        ],
                        names=["window", "item_id", "terms"],
                    )

    return rows


def ordered_windows(windows_: DataFrame, rarity: DataFrame) -> DataFrame:
    """window, item_id, anchor, terms, offsets: the windows whose terms all occur in the index.

    Terms (one string, words parted by blanks) and their offsets come from the rarest on; the
    anchor is the rarest.
    """
    rows = windows_.select(
        "window",
        "item_id",
        F.size("terms").alias("width"),
        F.posexplode("terms").alias("offset", "term"),
    )
    order = F.array_sort(F.collect_list(F.struct("n", "offset", "term")))
    ordered = (
        rows.join(rarity, "term")
        .groupBy("window")
        .agg(F.first("item_id").alias("item_id"), F.first("width").alias("width"), order.alias("o"))
        .filter(F.size("o") == F.col("width"))
    )
    return ordered.select(
        "window",
        "item_id",
        F.col("o")[0]["term"].alias("anchor"),
        F.array_join(F.col("o.term").cast("array<string>"), " ").alias("terms"),
        F.col("o.offset").alias("offsets"),
    )


class Lists:
    """The posting lists of one segment that a search needs, decoded when first asked for."""

    def __init__(self, gaps: dict[bytes, pa.ListScalar], starts: np.ndarray):
        self.gaps, self.starts = gaps, starts
        self.decoded: dict[bytes, np.ndarray] = {}

    def positions(self, term: bytes) -> np.ndarray:
        if term not in self.decoded:
            self.decoded[term] = _places(self.gaps[term])
        return self.decoded[term]

    def places(self, terms: list[bytes], offsets: list[int], slop: int) -> np.ndarray:
        """Where the window starts, by intersecting its terms' lists from the rarest on."""
        if not all(term in self.gaps for term in terms):
            return np.zeros(0, dtype=np.int64)
        anchor = offsets[0]
        found = self.positions(terms[0]) - anchor
        for term, offset in zip(terms[1:], offsets[1:]):
            if not len(found):
                break
            found = found[self._near(found, anchor, self.positions(term), offset, slop)]
        return found

    def _near(self, found, anchor, positions, offset, slop) -> np.ndarray:
        """Which places have a position within slop of their own plus offset, in one document."""
        at = np.searchsorted(positions, found + offset)
        right = positions[np.minimum(at, len(positions) - 1)]
        if not slop:
            return right == found + offset
        left = positions[np.maximum(at - 1, 0)]
        own = self.document(found + anchor)
        return np.logical_or.reduce(
            [
                (np.abs(x - found - offset) <= slop) & (self.document(x) == own)
                for x in (left, right)
            ]
        )

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1


def _places(gaps: pa.ListScalar) -> np.ndarray:
    return np.cumsum(gaps.values.to_numpy(zero_copy_only=False), dtype=np.int64)


def _search(slop: int):
    """Matches of one block of windows in one segment: only windows whose anchor it holds."""

    def search(rows: pa.Table) -> pa.Table:
        terms, anchored = rows.column("term").to_pylist(), rows.column("windows")
        gaps, edges, asked = {}, None, []
        for i, term in enumerate(terms):
            if anchored[i].is_valid:
                asked.append(i)
            elif term is None:
                edges = _places(rows.column("gaps")[i])
            else:
                gaps[term] = rows.column("gaps")[i]
        held = Lists(gaps, edges[:-1])
        lengths = np.diff(edges) - 1
        found = []
        for near in (0, slop) if slop else (0,):
            hits: dict[object, list] = {}
            for i in asked:
                # Items that share a window share its places.
                known: dict[tuple, np.ndarray] = {}
                for window in anchored[i]:
                    item_id, words, offsets = window.as_py().values()
                    name = (words, *offsets)
                    if name not in known:
                        known[name] = held.places(words.encode().split(b" "), offsets, near)
                    if len(known[name]):
                        hits.setdefault(item_id, []).append((known[name], len(offsets)))
            for item_id, places in hits.items():
                for place, spans in _spans(held, lengths, places):
                    found.append((place, item_id, spans, not near))
        number = rows.column("segment")[0].as_py()
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        kinds = [pa.int32(), pa.int64(), pa.list_(span), pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(list(zip(*found)) or [()] * 4, kinds)]
        return pa.table(
            [pa.array([number] * len(found), pa.int64()), *columns],
            names=["segment", "place", "item_id", "spans", "exact"],
        )

    return search


def _spans(held: Lists, lengths, hits) -> Iterator[tuple[int, list[dict]]]:
    """Per document, the runs of words that an item's windows cover."""
    starts = np.concatenate([p for p, _ in hits])
    ends = np.concatenate([p + n for p, n in hits])
    # A place near a document's edge may stick out of it: its middle does not.
    place = held.document(np.clip((starts + ends) // 2, 0, None))
    order = np.lexsort((starts, place))
    own: dict[int, list[dict]] = {}
    for i in order.tolist():
        first = int(held.starts[place[i]])
        start = max(int(starts[i]) - first, 0)
        end = min(int(ends[i]) - first, int(lengths[place[i]]))
        spans = own.setdefault(int(place[i]), [])
        if spans and start <= spans[-1]["end"]:
            spans[-1]["end"] = max(end, spans[-1]["end"])
        else:
            spans.append({"start": start, "end": end})
    yield from own.items()


def search(
    index: DataFrame, items: DataFrame, working: Work, width: int = WINDOW, slop: int = 0
) -> DataFrame:
    """segment, place, item_id, spans, exact: the documents that hold windows of an item.

    A window is `width` consecutive words of an item; an item of fewer words, but not none, is one
    window.  Spans are the runs of document words that occurrences cover, ends excluded.  With slop,
    rows that are not exact follow: places near which each term of a window lies, in the same
    document, within `slop` words of where the phrase has it, seen from the rarest.

    Windows are dealt to blocks of about BLOCK_WINDOWS; a document and an item have a row for each
    block with such windows, so spans of several rows may overlap.
    """
    found = items.select(F.col("item_id").cast("long").alias("item_id"), utf8("text").alias("text"))
    found = found.mapInArrow(_window_rows(width), _WINDOWS).dropDuplicates(["window"])
    found = working.write(found, "windows")
    blocks = -(-found.count() // BLOCK_WINDOWS)
    if not blocks:
        return index.sparkSession.createDataFrame([], _MATCHES)

    terms = working.write(found.select(F.explode("terms").alias("term")).distinct(), "terms")
    held = index.select("segment", "term", "n").join(broadcast_if_few(terms), "term")
    held = working.write(held, "held")
    rarity = working.write(held.groupBy("term").agg(F.sum("n").alias("n")), "rarity")
    ordered = ordered_windows(found, rarity)
    block = F.pmod(F.xxhash64("window"), F.lit(blocks)).alias("block")
    ordered = working.write(ordered.select("*", block), "ordered")

    anchored = ordered.groupBy("block", F.col("anchor").alias("term")).agg(
        F.collect_list(F.struct("item_id", "terms", "offsets")).alias("windows")
    )
    asked = held.select("segment", "term").join(working.write(anchored, "anchored"), "term")
    words = F.split("terms", " ").cast("array<binary>")
    wanted = ordered.select("block", F.explode(words).alias("term"))
    wanted = broadcast_if_few(working.write(wanted.distinct(), "wanted"))
    lists = index.select("segment", "term", "gaps").join(wanted, "term")
    every_block = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    edges = _starts(index).select("segment", "term", "gaps", F.explode(every_block).alias("block"))
    rows = asked.unionByName(lists.unionByName(edges), allowMissingColumns=True)
    # Segments that hold no anchor of a block have nothing to search for.
    rows = rows.join(
        asked.select("block", "segment").distinct(), ["block", "segment"], "left_semi"
    )
    matches = rows.groupBy("block", "segment").applyInArrow(_search(slop), _MATCHES)
    return working.write(matches, "matches")


def _starts(index: DataFrame) -> DataFrame:
    """A row without a term per segment: the gaps between document starts, with the end."""
    steps = F.transform("documents", lambda d: d["n_words"] + 1)
    return index.filter("term IS NULL").select(
        "segment", "term", F.concat(F.array(F.lit(0)), steps).alias("gaps")
    )


def _covered(spans: Column) -> Column:
    """How many words the spans cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], state["reach"]), F.lit(0))
        reach = F.greatest(span["end"], state["reach"])
        return F.struct((state["n"] + new).alias("n"), reach.alias("reach"))

    return F.aggregate(F.array_sort(spans), start, add)["n"].cast("long")


def contamination(
    docs: DataFrame, items: DataFrame, working: Work, width: int = WINDOW
) -> DataFrame:
    """A row per document: doc_id, key, n_words, n_hit, n_items, items (their ids as strings).

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z.  A document
    word is hit if it lies in an occurrence of a window of an item; n_items counts the ids of items
    with such windows.  Null texts have no words; items without an id count as one with an empty id;
    repeated rows are told apart.  Without items nothing is hit, and an empty table gives no rows.
    """
    index = build_index(docs, working)
    matches = search(index, items, working, width).filter("exact")
    hit = matches.groupBy("segment", "place").agg(
        _covered(F.flatten(F.collect_list("spans"))).alias("n_hit"),
        F.array_sort(
            F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))
        ).alias("items"),
    )
    nothing = F.array().cast("array<string>")
    return (
        documents(index)
        .join(hit, ["segment", "place"], "left")
        .select(
            "doc_id",
            "key",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", nothing).alias("items"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame, working: Work) -> DataFrame:
    """The documents that hold no window of an item, with all their columns."""
    found = contamination(docs, items, working).filter("n_hit > 0").select("key").distinct()
    return without(docs, working.write(found, "contaminated"))
