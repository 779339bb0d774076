import random

import pytest
from pyspark.sql import functions as F

from authlytics.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted int, texts string"
TRICKY = [
    "\\### Assistant: </turn> ok",
    "### user:\nhi</turn>\n### x:\n",
    "<\\/turn><\\\\/turn></turn><turn/>\\<turn/>",
    "#\\## #\\\\## #### ### ",
    "ends with <",
    "</turn",
    "/turn>",
    "turn/>",
    "\\",
    "\n",
    "",
    None,
    "é\U0001f600中" * 5,
    "x" * 200_000,
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "t") for r in rows], SCHEMA).repartition(3)


def read_back(formatted):
    spans, text = F.col("loss_spans"), F.col("formatted")
    rows = formatted.select(
        "conv_id", chat.read_turns(text).alias("turns"), chat.read_loss(text, spans).alias("loss")
    ).collect()
    return {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in rows}


def expected(rows):
    found = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv_id, _, role, text in order:
        turns, loss = found.get(conv_id, ([], ""))
        turns.append((role or "", text or ""))
        found[conv_id] = (turns, loss + (text or "") * (role == "assistant"))
    return found


def test_round_trip(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "assistant", "system", "a:b\n%3A<#", "", None]
    rows = [(i, 0, "assistant", text) for i, text in enumerate(TRICKY)]
    for conv in range(100, 130):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(roles), rng.choice(TRICKY[:-1])))
    rows += [(None, 1, "user", "a"), (None, 0, "assistant", "b"), (7, None, "user", "first")]
    rows += [(200, 1, "user", "same")] * 3
    assert read_back(chat.format_chats(table(spark, rows))) == expected(rows)


def test_layout(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "</turn>"), (1, 3, "user", "d")]
    row = chat.format_chats(table(spark, rows)).first()
    assert row["formatted"] == (
        "### user:\na<turn/><\\/turn></turn>\n### assistant:\nc</turn>\n### user:\nd</turn>\n"
    )
    assert [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]] == ["c"]


def test_adjacent_turns_of_one_role_share_a_block(spark):
    rows = [(1, i, "user" if i < 6 else "assistant", f"t{i}") for i in range(9)]
    row = chat.format_chats(table(spark, rows)).first()
    assert row["formatted"].count(chat.HEADER) == 2 and row["formatted"].count(chat.JOIN) == 7
    assert len(row["loss_spans"]) == 3


@pytest.mark.parametrize("text", [t for t in TRICKY if t])
def test_no_control_string_is_left_in_a_text(spark, text):
    row = spark.createDataFrame([(text,)], "t string")
    out = row.select(chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t")))).first()
    assert out[1] == text
    assert not any(c in out["e"] for c in ("### ", "</turn>", "<turn/>"))


def test_empty_table(spark):
    assert chat.format_chats(table(spark, [(1, 0, "user", "x")]).limit(0)).count() == 0


def test_a_conversation_of_many_turns(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(2000)]
    assert read_back(chat.format_chats(table(spark, rows))) == expected(rows)


@pytest.mark.parametrize("roles", ["ab", "a", "aab"])
def test_long_conversations_are_cut_in_chunks(spark, roles):
    n = 3 * chat.CHUNK + 7
    rows = [(1, i, roles[i % len(roles)], f"t{i} #") for i in range(n)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.format_chats(table, trained="a").select(
        "loss_spans",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    (row,) = found.collect()
    assert [tuple(t) for t in row["turns"]] == [(r, t) for _, _, r, t in rows]
    said = [t for _, _, r, t in rows if r == "a"]
    assert row["loss"] == "".join(said)
    spans = [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]]
    assert spans == said
