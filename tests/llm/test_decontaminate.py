import numpy as np
import pytest
from cases import ODD_TEXTS, documents, prose
from reference import contamination

from authlytics.llm import decontaminate
from authlytics.llm.common import Work

ITEMS = [
    (1, prose(1, 40)),
    (2, prose(2, 10)),
    (3, "Just four, short words"),
    (4, None),
    (5, "..."),
    (1, prose(3, 15)),
    (None, prose(4, 12)),
    (6, "the " * 30),
    (10, "aaa " * 11 + "bbb"),
]


def rows():
    found = [(100 + i, f"{prose(50 + i, 30)}. {prose(1 + i % 4, 40)[: 40 + 9 * i]}") for i in range(20)]
    found += [(200, "just FOUR short-words; four just"), (201, "the " * 500), (202, "aaa " * 40 + "bbb")]
    found += [(203, prose(7, 20_000)), (204, prose(2, 10)), (204, prose(2, 10)), (205, prose(2, 9))]
    # Words of one item across the border of two documents are no occurrence.
    words = prose(1, 40).split()
    return found + [(300, " ".join(words[:9])), (301, " ".join(words[9:18]))] + ODD_TEXTS


def items(spark, content=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in content], "item_id long, text string, term string")


@pytest.mark.parametrize("segment,block", [(1 << 21, 1 << 16), (50, 7)])
def test_hits(spark, monkeypatch, segment, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", segment)
    found = decontaminate.contamination(documents(spark, rows()), items(spark), Work(spark))
    result = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    assert sorted(result, key=repr) == contamination(rows(), ITEMS)


def test_segments_hold_whole_documents():
    built = decontaminate._Segment()
    for n, text in enumerate([b"a b a", b"", b"b c"]):
        built.add({"doc_id": n, "key": {"doc_id": n, "text": 0}}, text)
    head, postings = list(built.rows(7))
    assert [d["n_words"] for d in head.column("documents")[0].as_py()] == [3, 0, 2]
    lists = {
        term: np.cumsum(gaps).tolist()
        for term, gaps in zip(postings.column("term").to_pylist(), postings.column("gaps").to_pylist())
    }
    assert lists == {b"a": [0, 2], b"b": [1, 5], b"c": [6]}


def test_proximity(spark):
    phrase = "one two three four five six seven eight nine ten"
    near = "one two x three four five six y seven eight nine ten"
    far = "one two x x x x three four five six seven eight nine ten"
    docs = documents(spark, [(1, phrase), (2, near), (3, far), (4, "one two three"), (5, "four five")])
    work = Work(spark)
    index = decontaminate.build_index(docs, work)
    found = decontaminate.search(index, items(spark, [(1, phrase)]), work, slop=2)
    places = decontaminate.documents(index).join(found, ["segment", "place"])
    assert sorted((r["doc_id"], r["exact"]) for r in places.collect()) == [(1, False), (1, True), (2, False)]


def test_removing_contaminated_documents(spark):
    docs = documents(spark, rows())
    clean = decontaminate.decontaminate(docs, items(spark), Work(spark))
    assert clean.columns == docs.columns
    expected = [d for d, _, hit, _ in contamination(rows(), ITEMS) if not hit]
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_tables(spark):
    docs = documents(spark, ODD_TEXTS)
    none = items(spark).limit(0)
    assert decontaminate.contamination(docs.limit(0), items(spark), Work(spark)).count() == 0
    found = decontaminate.contamination(docs, none, Work(spark))
    assert found.filter("n_hit = 0").count() == len(ODD_TEXTS)


def test_windows_start_from_their_rarest_term(spark):
    rarity = spark.createDataFrame([(b"a", 9), (b"b", 2), (b"c", 2)], "term binary, n long")
    windows = [(b"1", 7, [b"a", b"c", b"b"]), (b"2", None, [b"a", b"a"]), (b"3", 8, [b"a", b"x"])]
    windows = spark.createDataFrame(windows, decontaminate._WINDOWS)
    found = decontaminate.ordered_windows(windows, rarity)
    rows = [(bytes(r["anchor"]), r["item_id"], r["terms"], r["offsets"]) for r in found.collect()]
    assert sorted(rows) == [(b"a", None, "a a", [0, 1]), (b"c", 7, "c b a", [1, 2, 0])]


def test_many_items_in_one_pass(spark, monkeypatch):
    """3,000 items, in many blocks: the lists are read once, and a segment sees own anchors only."""
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 1024)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 2000)
    content = [(i, prose(1000 + i, 12)) for i in range(3_000)]
    docs = [(i, f"{prose(i, 30)} {prose(1000 + 13 * i, 12)}") for i in range(200)]
    content += [(20_000 + i, content[5][1]) for i in range(50)] + [(None, docs[3][1])]
    work = Work(spark)
    read = []
    monkeypatch.setattr(
        work, "write", lambda rows, name: read.append((name, rows)) or Work.write(work, rows, name)
    )
    found = decontaminate.contamination(documents(spark, docs), items(spark, content), work)
    result = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    assert sorted(result, key=repr) == contamination(docs, content)
    assert [name for name, _ in read].count("matches") == 1
    plan = dict(read)["matches"]._jdf.queryExecution().executedPlan().toString()
    scans = [line.partition("ReadSchema")[2] for line in plan.splitlines() if "FileScan" in line]
    assert sum("gaps" in columns for columns in scans) == 1
