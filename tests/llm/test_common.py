import numpy as np
import pytest
from pyspark.sql import functions as F

from authlytics.llm import common


def test_words():
    text = "Don't STOP–me É_é 3x\x7f".encode()
    assert [w.decode() for w in common.split_words(text)] == ["don", "t", "stop–me", "É", "é", "3x"]
    assert [w.decode() for w in common.split_blanks("A\tB\x0bÉ c d".encode())] == [
        "a",
        "b",
        "É",
        "c d",
    ]


def test_bitmap_has_every_key_and_few_others(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    keys = np.concatenate([keys, [0, 1, 32768, common.BITMAP_BITS, -1]])
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long")
    bits = common.bitmap(frame, F.col("k"))
    assert common.in_bitmap(bits, keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert common.in_bitmap(bits, others).sum() < 10
    assert not common.in_bitmap(common.bitmap(frame.limit(0), F.col("k")), keys).any()


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (9, 8), (10, 9), (12, 11), (11, 12)],
        [(i, i + 1) for i in range(60)],
        [(1, i) for i in range(2, 40)] + [(50, 51)],
        [(5, 5)],
    ],
)
def test_connected(spark, links):
    root = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["root"] for r in common.connected(frame, common.Work(spark), "c").collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: root[x] for x in nodes}


def test_row_keys_tell_rows_apart_and_leave_columns_alone(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 5), (None, None, 5), (None, "", 6)], "doc_id long, text string, key int"
    )
    gone = rows.filter("text = 'b'").select(common.row_key().alias("key"))
    left = common.without(rows, gone)
    assert left.columns == ["doc_id", "text", "key"]
    assert left.count() == 3
    gone = rows.filter("text IS NULL").select(common.row_key().alias("key"))
    assert common.without(rows, gone).count() == 2  # a null text is an empty one


def test_working_tables_are_dropped_by_name(spark):
    work = common.Work(spark)
    rows = work.write(spark.range(3), "kept")
    work.write(spark.range(3), "gone")
    work.drop("gone")
    assert rows.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(f"{work.folder}/gone").count()


def test_only_small_tables_are_broadcast(spark, monkeypatch):
    rows = common.Work(spark).write(spark.range(20), "rows")

    def hinted(frame):
        return "ResolvedHint" in frame._jdf.queryExecution().analyzed().toString()

    assert hinted(common.broadcast_if_few(rows))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 19)
    assert not hinted(common.broadcast_if_few(rows))


def test_the_session_keeps_its_own_batch_size(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    with common.arrow_rows(spark, 7):
        common.Work(spark)
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name, None) == before


def test_a_worker_keeps_one_cache():
    made = []
    for name in ("a", "a", "b", "a"):
        common.worker_cache(name, lambda: made.append(name))
    assert made == ["a", "b", "a"]


def test_bucketed_rows_need_no_shuffle(spark):
    rows = common.Work(spark).write_bucketed(spark.range(100).withColumn("v", F.col("id") % 7), "b", "v")
    plan = rows.groupBy("v").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows.groupBy("v").count().count() == 7
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("working_")]
