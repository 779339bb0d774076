"""The trie of conversations that start alike, by van Emde Boas recursion.

A piece of the trie has a root and a height: it holds the nodes at depths below that height under
the root, and its rows are the distinct ways on from the root, with the number of conversations
that go each way.  A piece is cut at half its height: the first halves of its rows are the upper
piece, and every distinct first half names the root of a lower piece, which holds what followed it.
All pieces of one height are cut by one job, halves that are equal by then count as one row, and
shorter rows come in at the height that they reach, so a common beginning is a single row from the
first cut on.  At height 1 a piece is a node.  Totals go back up in the opposite order: each root
that a cut has named gives the total of its own piece to the nodes above it in the upper piece, so
a node's total crosses every height once instead of every depth.

A turn is known by the SHA-256 of role and text and by its length.  The prefix of length d is named
by the prefix whose length lacks the lowest bit of d, and the turns after that; names are SHA-256
again, so pieces need no shared numbering and a lost task can be run again by itself.  Long
conversations are stored as rows of at most CHUNK turns; the roots of such chunks come from the
same naming over the chunks' names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authlytics.llm.common import Work, broadcast_if_few

CHUNK = 1024  # turns of a row: the greatest height of a piece
BASE = 100  # a conversation starts like that whose id is a multiple of this
SHARED = 6  # and shares fewer turns with it than this
ROOT = b""
_STEP = 40  # bytes of a turn: SHA-256 and length


def prefix_names(root: bytes, path: bytes, count: int) -> list[bytes]:
    """Names of the first `count` prefixes of a path, the root's own first."""
    names = [root]
    for d in range(1, count):
        up = d & (d - 1)
        names.append(_name(names[up], path[_STEP * up : _STEP * d]))
    return names


def prefix_name(root: bytes, path: bytes, d: int) -> bytes:
    """The name of the path's prefix of length d."""
    name, start = root, 0
    while start < d:
        end = start + (1 << ((d - start).bit_length() - 1))
        name = _name(name, path[_STEP * start : _STEP * end])
        start = end
    return name


def _name(root: bytes, path: bytes) -> bytes:
    return hashlib.sha256(root + path).digest()


def _joined(give):
    """The same rows in larger batches."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in give(batches):
            held.append(batch)
            if len(held) >= 256:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return joined


# -- turns ---------------------------------------------------------------------------


def ordered_turns(rows: DataFrame, working: Work) -> DataFrame:
    """(conv_id, place, step): the turns of each conversation by turn (null first), role and digest.

    Places come from a sort over all rows: a partition's first place in a conversation follows from
    the rows that earlier partitions hold of it, so a conversation may go on over many tasks.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    said = F.concat(role.cast("binary"), F.lit(b"\0"), text.cast("binary"))
    known = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.concat(F.unhex(F.sha2(said, 256)), _eight_bytes(F.length(text))).alias("step"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "step", "row"]
    known = working.write(known, "turns")
    sorted_rows = known.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = working.write(
        sorted_rows.select(
            "conv_id",
            "step",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sorted",
    )
    parts = working.write(
        placed.groupBy("conv_id", "part").agg(
            F.min("row").alias("first"), F.count("*").alias("n")
        ),
        "parts",
    )
    # At most a row per partition in a window.
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = parts.select("conv_id", "part", (before - F.col("first")).alias("shift"))
    starts = working.write(starts, "shifts")
    return placed.join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") + F.col("shift")).alias("place"), "step"
    )


def _eight_bytes(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(number.cast("long")), 16, "0"))


def rebuilt(turns: DataFrame, working: Work) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id), and (conv_id, place, step): they start with turns of their base.

    Conversation c starts with the first h turns of c - c % BASE (all if fewer, none if absent),
    h being crc32 of its decimal id modulo SHARED, and goes on with its own turns after the first h.
    """
    turns = working.write(turns, "placed")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    convs = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % BASE).alias("base"), shared.alias("h")
    )
    convs = working.write(convs, "convs")
    heads = turns.filter((F.col("conv_id") % BASE == 0) & (F.col("place") < SHARED - 1)).select(
        F.col("conv_id").alias("base"), "place", "step"
    )
    starts = working.write(
        convs.join(heads, "base").filter("place < h").select("conv_id", "place", "step"), "starts-of"
    )
    lengths = starts.groupBy("conv_id").agg(F.count("*").alias("started"))
    known = working.write(
        convs.join(lengths, "conv_id", "left").select(
            "conv_id", "h", F.coalesce("started", F.lit(0)).alias("started")
        ),
        "known",
    )
    own = turns.join(broadcast_if_few(known), "conv_id").filter("place >= h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("started")).alias("place"), "step")
    return known.select("conv_id"), working.write(starts.union(own), "steps")


# -- chunks --------------------------------------------------------------------------


@dataclass
class _Level:
    """Sequences in chunks (conv_id, chunk, root, path), and those of the names of whole chunks."""

    chunks: DataFrame
    above: _Level | None
    most: int  # steps of a chunk

    def links(self) -> DataFrame:
        """(conv_id, chunk, root, before, path_before): chunks that go on from a whole one."""
        before = self.chunks.filter(F.octet_length("path") == self.most * _STEP).select(
            "conv_id",
            (F.col("chunk") + 1).alias("chunk"),
            F.col("root").alias("before"),
            F.col("path").alias("path_before"),
        )
        return self.chunks.drop("path").join(before, ["conv_id", "chunk"])


def _cut_in_chunks(steps: DataFrame, most: int) -> DataFrame:
    """(conv_id, chunk, path): at most so many consecutive steps of a conversation a row."""
    chunk = F.floor(F.col("place") / most).alias("chunk")
    held = F.sort_array(F.collect_list(F.struct("place", "step")))
    paths = steps.groupBy("conv_id", chunk).agg(held.alias("steps"))
    path = F.unhex(F.array_join(F.transform("steps", lambda s: F.hex(s["step"])), ""))
    return paths.select("conv_id", "chunk", path.alias("path"))


def _levels(
    steps: DataFrame, convs: DataFrame, working: Work, most: int, number: int = 0
) -> _Level:
    """Every conversation in chunks, each with the name that it starts from.

    A conversation whose steps fill its last chunk has an empty one after it, and one without
    steps an empty first one, so that the node that it ends at is in one of its chunks.
    """
    whole = F.octet_length("path") == most * _STEP
    chunks = working.write(_cut_in_chunks(steps, most), f"cut-{number}")
    after = chunks.filter(whole).select("conv_id", (F.col("chunk") + 1).alias("chunk"))
    first = convs.select("conv_id", F.lit(0).cast("long").alias("chunk"))
    empty = after.union(first).withColumn("path", F.lit(b""))
    every = chunks.union(empty).groupBy("conv_id", "chunk")
    every = every.agg(F.max_by("path", F.octet_length("path")).alias("path"))
    every = working.write(every, f"every-{number}")
    if every.filter(whole).isEmpty():
        return _Level(every.withColumn("root", F.lit(ROOT)), None, most)
    # The names of whole chunks are sequences themselves.
    named = F.concat(F.unhex(F.sha2("path", 256)), _eight_bytes(F.lit(0)))
    names = every.filter(whole).select("conv_id", F.col("chunk").alias("place"), named.alias("step"))
    above = _levels(names, convs, working, most, number + 1)
    roots = above.chunks.select("conv_id", "chunk", "root", "path").mapInArrow(
        _roots(most), "conv_id long, chunk long, root binary"
    )
    chunks = every.join(working.write(roots, f"roots-{number}"), ["conv_id", "chunk"])
    return _Level(working.write(chunks, f"rooted-{number}"), above, most)


def _roots(most: int):
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each chunk starts from, by the chunks of the names of chunks."""
        for batch in batches:
            for conv_id, chunk, root, path in zip(*(c.to_pylist() for c in batch.columns)):
                names = prefix_names(root, path, min(len(path) // _STEP + 1, most))
                places = range(chunk * most, chunk * most + len(names))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv_id] * len(names), pa.int64()),
                        pa.array(places, pa.int64()),
                        pa.array(names, pa.binary()),
                    ],
                    names=["conv_id", "chunk", "root"],
                )

    return _joined(give)


# -- cutting -------------------------------------------------------------------------


_ROW = """root binary, parent binary, depth long, chars long, path binary, first long, n long,
    height int"""


def _enter(most: int):
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks as rows of the least piece that holds all their nodes, with the parent of their root
        and the length of its last turn."""
        for batch in batches:
            parents, chars, heights = [], [], []
            for before, path in zip(*(batch.column(c).to_pylist() for c in ("before", "path_before"))):
                parents.append(None if path is None else prefix_name(before, path, most - 1))
                chars.append(0 if path is None else int.from_bytes(path[-8:], "big"))
            for path in batch.column("path"):
                n = len(path.as_py()) // _STEP
                heights.append(most if n == most else 1 << n.bit_length())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("root"),
                    pa.array(parents, pa.binary()),
                    pa.array([most * c for c in batch.column("chunk").to_pylist()], pa.int64()),
                    pa.array(chars, pa.int64()),
                    batch.column("path"),
                    batch.column("conv_id"),
                    pa.array([1] * batch.num_rows, pa.int64()),
                    pa.array(heights, pa.int32()),
                ],
                names=["root", "parent", "depth", "chars", "path", "first", "n", "height"],
            )

    return enter


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, conv_id): the node that each conversation ends at, from its last chunk."""
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        names = [prefix_name(root, path, len(path) // _STEP) for root, path in rows]
        columns = [pa.array(names, pa.binary()), batch.column(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["name", "conv_id"])


def _halves(height: int):
    half = height // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The upper half of each row, and the lower half where the row gets that far."""
        for batch in batches:
            out: list[tuple] = []
            rows = (batch.column(c).to_pylist() for c in range(batch.num_columns))
            for root, parent, depth, chars, path, first, n in zip(*rows):
                upper = path[: half * _STEP]
                out.append((root, parent, depth, chars, upper, first, n))
                if len(upper) == half * _STEP:
                    above = prefix_name(root, upper, half - 1)
                    last = int.from_bytes(upper[-8:], "big")
                    lower = (_name(root, upper), above, depth + half, last)
                    out.append((*lower, path[half * _STEP :], first, n))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, field.type) for x, field in zip(zip(*out), batch.schema)],
                    schema=batch.schema,
                )

    return cut


def _merge(pieces: DataFrame) -> DataFrame:
    keys = ["root", "parent", "depth", "chars", "path"]
    return pieces.groupBy(*keys).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def _cut_all(level: _Level, working: Work, number: int) -> list[tuple[int, DataFrame]]:
    """(height, rows of all pieces of that height), the greatest first, down to single nodes."""
    links = level.links().drop("root")
    entering = level.chunks.join(links, ["conv_id", "chunk"], "left")
    entering = entering.mapInArrow(_enter(level.most), _ROW)
    entering = working.write(entering, f"entering-{number}")
    height = entering.agg(F.max("height")).first()[0]
    rows, cuts = None, []
    while True:
        here = entering.filter(F.col("height") == height).drop("height")
        rows = _merge(here if rows is None else rows.unionByName(here))
        rows = working.write(rows, f"pieces-{number}-{height}")
        cuts.append((height, rows))
        if height == 1:
            return cuts
        rows = rows.mapInArrow(_halves(height), rows.schema)
        height //= 2


# -- grafting ------------------------------------------------------------------------


def _ancestors(start: int, end: int):
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A cut root's totals for the nodes above it that are so far down the path to it."""
        for batch in batches:
            rows = (batch.column(c).to_pylist() for c in range(5))
            for root, path, depth, leaves, saved in zip(*rows):
                names = prefix_names(root, path, end)[start:]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.binary()),
                        pa.array(range(depth + start, depth + end), pa.int64()),
                        pa.array([leaves] * len(names), pa.int64()),
                        pa.array([saved] * len(names), pa.int64()),
                    ],
                    names=["name", "depth", "leaves", "saved"],
                )

    return _joined(give)


_TOTALS = "name binary, depth long, leaves long, saved long"


def _sum_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("name", "depth").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def _graft_pieces(
    own: DataFrame, cuts: list[tuple[int, DataFrame]], working: Work, number: int
) -> DataFrame:
    """What is below every node within the pieces of the greatest height."""
    totals = own
    for height, rows in reversed(cuts[:-1]):
        half = height // 2
        path = F.expr(f"substring(path, 1, {half * _STEP})").alias("path")
        cut = rows.filter(F.octet_length("path") >= half * _STEP).select("root", path, "depth")
        cut = cut.distinct().withColumn("name", F.unhex(F.sha2(F.concat("root", "path"), 256)))
        below = _sum_totals(totals.filter(F.col("depth") % height == half)).drop("depth")
        given = cut.join(below, "name").select("root", "path", "depth", "leaves", "saved")
        given = _sum_totals(given.mapInArrow(_ancestors(0, half), _TOTALS))
        totals = totals.union(working.write(given, f"grafts-{number}-{height}"))
    return _sum_totals(totals)


def _graft_all(
    own: DataFrame,
    cuts: list[tuple[int, DataFrame]],
    level: _Level,
    working: Work,
    number: int = 0,
) -> DataFrame:
    """(name, depth, leaves, saved): totals of every node's subtree, from those of single nodes.

    Beyond the greatest height, the roots of chunks are a trie of their own, one level up; what it
    gives a root goes to the nodes of the chunk before it.
    """
    totals = _graft_pieces(own, cuts, working, number)
    if level.above is None:
        return totals
    totals = working.write(totals, f"within-{number}")
    is_root = F.col("depth") % level.most == 0
    roots = totals.filter(is_root).withColumn("depth", (F.col("depth") / level.most).cast("long"))
    cuts_above = _cut_all(level.above, working, number + 1)
    roots = _graft_all(roots, cuts_above, level.above, working, number + 1)
    roots = roots.withColumn("depth", F.col("depth") * level.most)
    roots = working.write(roots, f"above-{number}")
    links = level.links().select(
        F.col("root").alias("name"),
        F.col("before").alias("root"),
        F.col("path_before").alias("path"),
        ((F.col("chunk") - 1) * level.most).alias("start"),
    )
    given = links.distinct().join(roots.drop("depth"), "name")
    given = given.select("root", "path", F.col("start").alias("depth"), "leaves", "saved")
    given = given.mapInArrow(_ancestors(1, level.most), _TOTALS)
    return _sum_totals(totals.filter(~is_root).union(given)).union(roots)


# -- members that end at a node ------------------------------------------------------


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv_id) rows as rows of a name, its first id, and many ids joined."""
    for batch in batches:
        names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        cuts = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        runs = list(zip([0, *cuts], [*cuts, len(names)])) if names else []
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i, _ in runs], pa.binary()),
                pa.array([ids[i] for i, _ in runs], pa.int64()),
                pa.array([",".join(map(str, ids[i:j])) for i, j in runs], pa.string()),
            ],
            names=["name", "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a name from its sorted runs, which are never held together."""
    name, digest = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != name:
                if digest:
                    done.append((name, digest.hexdigest()))
                name, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _pairs(done)
    if digest:
        yield _pairs([(name, digest.hexdigest())])


def _pairs(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    names, digests = zip(*done) if done else ((), ())
    columns = [pa.array(names, pa.binary()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["name", "ends_sha256"])


def _ends(ending: DataFrame) -> DataFrame:
    """(name, ends_sha256): the ids of the conversations that end at a node, ascending."""
    order = ["name", "conv_id"]
    runs = (
        ending.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_id_runs, "name binary, first long, ids string")
    )
    placed = runs.repartition("name").sortWithinPartitions("name", "first")
    return placed.mapInArrow(_digests, "name binary, ends_sha256 string")


NODE = """conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,
    n_leaves long, saved_tokens long, ends_sha256 string"""


# -- the trie ------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, working: Work, most: int = CHUNK) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by turn (null first), then role, then the digest of role and text; a null role or text
    is empty; rows without conv_id are left out; repeated rows are turns of their own.  For the
    rebuilding see `rebuilt`.  Members of a node are the conversations that start with its turns; the root, at depth
    0, has all of them.  n_leaves counts the childless nodes at or below a node, saved_tokens sums
    (members - 1) * code points of the last text over the same nodes.  ends_sha256 is the SHA-256
    of the ids of members that end here, in ascending order, joined by commas.  An empty table
    gives no rows; other columns are not read.
    """
    convs, steps = rebuilt(ordered_turns(conversations, working), working)
    if convs.isEmpty():
        return working.spark.createDataFrame([], NODE)
    level = _levels(steps, convs, working, most)
    cuts = _cut_all(level, working, 0)
    nodes = cuts[-1][1].groupBy(F.col("root").alias("name"), "parent", "depth", "chars").agg(
        F.min("first").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.sum((F.octet_length("path") > 0).cast("long")).alias("n_children"),
    )
    nodes = working.write(nodes, "nodes")
    own = nodes.select(
        "name",
        "depth",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    totals = _graft_all(own, cuts, level, working).drop("depth")
    last = level.chunks.filter(F.octet_length("path") < most * _STEP)
    ending = last.select("root", "path", "conv_id").mapInArrow(
        _endings, "name binary, conv_id long"
    )
    ends = working.write(_ends(working.write(ending, "ending")), "ends")
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.sha2(F.lit(b""), 256)
    return (
        nodes.join(totals, "name")
        .join(ends, "name", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
