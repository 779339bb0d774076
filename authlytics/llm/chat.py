"""Conversations as training text with a loss mask, and back, in Spark expressions only.

Turn structs are collected per conversation and sorted; adjacent turns of one role are merged into a
block; blocks are written one after the other:

    ### role:
    text<turn/>text</turn>

Control strings inside texts get a backslash behind their first character, one more if there are
some already, so no text holds a control string, reading back takes one away, and other backslashes
stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, ROLE_END, JOIN, END = "### ", ":\n", "<turn/>", "</turn>\n"

# First character and rest of each control string that is kept out of texts.
_CONTROLS = (("#", "## "), ("<", "turn/>"), ("<", "/turn>"))
# Characters that a role may not show as they are.
_ROLE_CODES = (("%", "%25"), (":", "%3A"), ("<", "%3C"), ("#", "%23"), ("\n", "%0A"))
_BACKSLASHES = r"(\\*)"
CHUNK = 512  # elements of an array that a fold goes over at a time


def escape(text: Column) -> Column:
    for first, rest in _CONTROLS:
        text = F.regexp_replace(text, first + _BACKSLASHES + rest, rf"{first}\\$1{rest}")
    return text


def unescape(text: Column) -> Column:
    for first, rest in _CONTROLS:
        text = F.regexp_replace(text, rf"{first}\\" + _BACKSLASHES + rest, f"{first}$1{rest}")
    return text


def _encode_role(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _decode_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _merge(turns: Column) -> Column:
    """Sorted turns as blocks (role, texts) of adjacent turns of one role.

    A block begins where the role is another than before; it is the slice up to the next beginning.
    """
    n = F.size(turns)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def role(i: Column) -> Column:
        return F.get(turns, i)["role"]

    begins = F.filter(places, lambda i: (i == 0) | (role(i) != role(i - 1)))
    ends = F.concat(F.slice(begins, 2, F.size(begins)), F.array(n))
    ranges = F.arrays_zip(begins.alias("begin"), ends.alias("end"))
    return F.transform(
        F.when(n > 0, ranges),
        lambda r: F.struct(
            role(r["begin"]).alias("role"),
            F.transform(
                F.slice(turns, r["begin"] + 1, r["end"] - r["begin"]), lambda t: t["text"]
            ).alias("texts"),
        ),
    )


def _pieces(blocks: Column, trained: str) -> Column:
    """The output's pieces in order, each with whether the loss covers it."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_block(block: Column) -> Column:
        loss = block["role"] == trained
        texts = F.flatten(
            F.transform(
                block["texts"], lambda t: F.array(piece(F.lit(JOIN), F.lit(False)), piece(t, loss))
            )
        )
        head = piece(F.concat(F.lit(HEADER), block["role"], F.lit(ROLE_END)), F.lit(False))
        end = piece(F.lit(END), F.lit(False))
        # The first text follows the header, not a join.
        return F.concat(F.array(head), F.slice(texts, 2, F.size(texts)), F.array(end))

    return F.flatten(F.transform(blocks, of_block))


def _in_chunks(values: Column) -> Column:
    """The array cut into arrays of CHUNK, so that a fold never carries a long array along."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(CHUNK))
    return F.transform(starts, lambda at: F.slice(values, at, CHUNK))


def _running(lengths: Column) -> Column:
    """The sum of what is before each of the lengths."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))

    def add(state: Column, length: Column) -> Column:
        return F.struct(
            (state["at"] + length).alias("at"),
            F.concat(state["before"], F.array(state["at"])).alias("before"),
        )

    return F.aggregate(lengths, state, add)["before"]


def _loss_spans(pieces: Column, chunks: Column) -> Column:
    """(start, length) in characters of the pieces that the loss covers, given all lengths in
    chunks."""
    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, n: a + n))
    within = F.zip_with(
        chunks, _running(sums), lambda c, at: F.transform(_running(c), lambda before: before + at)
    )
    spans = F.zip_with(
        F.flatten(within),
        F.transform(
            pieces, lambda p: F.struct(p["loss"].alias("loss"), F.length(p["text"]).alias("length"))
        ),
        lambda start, p: F.struct(
            start.alias("start"), p["length"].alias("length"), p["loss"].alias("loss")
        ),
    )
    return F.transform(
        F.filter(spans, lambda s: s["loss"]),
        lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")),
    )


def format_chats(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans: a row per conversation.

    Turns are ordered by turn (nulls first), ties by role and text; repeated rows are turns of their
    own.  Null texts and roles are empty; rows without an id are one conversation.  loss_spans are
    (start, length) in characters, one per text of the trained role.  An empty table gives no rows.
    """
    turn = F.struct(
        F.col("turn"),
        _encode_role(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
    )
    collected = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id")
    sorted_turns = F.array_sort(F.collect_list("t"))
    blocks = collected.agg(sorted_turns.alias("turns")).select(
        "conv_id", _merge(F.col("turns")).alias("blocks")
    )
    pieces = blocks.select("conv_id", _pieces(F.col("blocks"), trained).alias("pieces"))
    # Columns of their own, so that no lambda computes them again for every element.
    sized = pieces.withColumn("lengths", F.transform("pieces", lambda p: F.length(p["text"])))
    chunked = sized.withColumn("chunks", _in_chunks(F.col("lengths")))
    return chunked.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        _loss_spans(F.col("pieces"), F.col("chunks")).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.split(formatted, END, -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, ROLE_END, 1)
        body = F.substring(block, F.length(role) + len(ROLE_END) + 1, F.length(block))
        name = _decode_role(F.substring(role, F.lit(len(HEADER) + 1), F.length(role)))
        return F.transform(
            F.split(body, JOIN, -1),
            lambda t: F.struct(name.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    The text is cut once for every CHUNK spans, and the spans out of these cuts, so that no span is
    counted off from the beginning of a long text.
    """

    def cut(chunk: Column) -> Column:
        first, last = F.get(chunk, F.lit(0)), F.element_at(chunk, -1)
        end = last["start"] + last["length"]
        text = F.substring(formatted, first["start"] + 1, end - first["start"])
        return F.struct(text.alias("text"), first["start"].alias("start"), chunk.alias("spans"))

    cuts = F.transform(_in_chunks(spans), cut)
    texts = F.transform(
        cuts,
        lambda c: F.transform(
            c["spans"],
            lambda s: unescape(F.substring(c["text"], s["start"] - c["start"] + 1, s["length"])),
        ),
    )
    return F.when(F.size(spans) > 0, F.array_join(F.flatten(texts), "")).otherwise("")
