import hashlib

import pytest
from pyspark.sql import functions as F

from authlytics.llm import warc
from authlytics.llm.common import Work

PAGES = "page_id long, url string, html string, digest string, n long, record_type int"
LONG = "é<p>\r\n\r\nWARC/1.1\r\n" * 20_000
SAME = "s" * 100


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, 2) for i, u, h in rows], PAGES).repartition(3)


ROWS = [
    (1, "http://a/", "short"),
    (2, None, None),
    (3, "http://a/", ""),
    (4, "http://b/\r\nWARC-Type: evil", LONG),
    (5, "http://é/", LONG),
    (6, "http://c/", SAME),
    (7, "http://c/", SAME),
    (6, "http://c/", SAME),
    (8, "http://c/", SAME[1:]),
    (9, "http://c/", SAME[1:]),
    (None, "http://c/", SAME),
    (None, "http://d/", "x" * 40_000),
    (10, "http://e/", "0\r\n\r\n" * 50),
]


def expected(rows):
    found = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "").encode() == raw and i is not None]
        first = min(ids, default=None)
        again = len(raw) >= 100 and first is not None and page_id != first
        kind = "revisit" if again else "response"
        digest = hashlib.sha256(raw).hexdigest()
        found.append((page_id, len(raw), digest, kind, first if again else None, True))
    return sorted(found, key=repr)


def test_round_trip(spark):
    found = warc.round_trip(pages(spark, ROWS), Work(spark)).collect()
    assert sorted(map(tuple, found), key=repr) == expected(ROWS)


def test_payloads_come_back_whole(spark):
    work = Work(spark)
    path = f"{work.folder}/archives"
    warc.write_archives(pages(spark, ROWS), path, work)
    found = warc.read_archives(spark, path).filter("record_type = 'response'").collect()
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in found}
    assert texts[4] == LONG and texts[2] == "" and texts[10] == "0\r\n\r\n" * 50


def test_revisits_name_the_response_for_other_readers(spark):
    work, same = Work(spark), "z" * 200
    path = f"{work.folder}/archives"
    rows = [(3, "http://a/ first", same), (5, "http://b/", same), (6, None, same), (7, "http://c/", "z")]
    warc.write_archives(pages(spark, rows), path, work)
    files = spark.read.format("binaryFile").load(path).collect()
    records = [h for f in files for h, _ in warc.parse(bytes(f["content"]))]
    named = {
        int(h["x-page-id"]): (h.get("warc-refers-to-target-uri"), h.get("warc-refers-to-date"))
        for h in records
    }
    there = ("http://a/%20first", warc.DATE)
    assert named == {3: (None, None), 5: there, 6: there, 7: (None, None)}


def test_long_records_are_put_together_in_linear_time(spark):
    work = Work(spark)
    path = f"{work.folder}/archives"
    text = "0123456789abcdef" * (1 << 21)  # 32 MB in some 60 segments
    warc.write_archives(pages(spark, [(1, "http://a/", text)]), path, work)
    (page,) = warc.read_archives(spark, path).select("complete", F.octet_length("payload")).collect()
    assert tuple(page) == (True, len(text))


def test_many_pages_stay_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 100_000)
    rows = [(i, f"http://h{i}/", "y" * (i * 37 % 9000)) for i in range(300)]
    work = Work(spark)
    path = f"{work.folder}/archives"
    warc.write_archives(pages(spark, rows), path, work)
    sizes = spark.read.format("binaryFile").load(path).select("length").collect()
    assert len(sizes) > 3 and max(r["length"] for r in sizes) <= 100_000
    assert warc.read_archives(spark, path).count() == 300


@pytest.mark.parametrize("size", [0, 1, 4095, 4096, 4097, 50_000])
def test_chunked_framing(size):
    payload = bytes(i % 251 for i in range(size))
    assert warc.unchunked(warc.chunked(payload)) == payload


@pytest.mark.parametrize("body", [b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b"3\r\nabcXX0\r\n\r\n"])
def test_broken_chunks(body):
    assert warc.unchunked(body) is None


def segments(total):
    block = warc._HTTP + warc.chunked(b"z" * 40_000)
    cut = [block[i : i + 16384] for i in range(0, len(block), 16384)]
    digest = hashlib.sha256(b"z" * 40_000).hexdigest()
    rows = []
    for n, piece in enumerate(cut, 1):
        last = n == len(cut)
        rows.append(("o", n, total or len(block) if last else None, "response" if n == 1 else "continuation",
                     5 if n == 1 else None, None, digest if n == 1 else "", bytearray(piece)))
    return rows


@pytest.mark.parametrize("change", ["none", "missing", "length", "twice", "first"])
def test_segments(spark, change):
    rows = segments(7 if change == "length" else None)
    if change == "missing":
        del rows[1]
    if change == "twice":
        rows.append(rows[1])
    if change == "first":
        del rows[0]
    records = spark.createDataFrame(rows[::-1], warc._RECORD)
    page = warc.reassemble(records).mapInArrow(warc._decode, warc._PAGE).first()
    assert page["complete"] == (change == "none")
    assert (page["payload"] is None) == (change != "none")


def test_broken_archives_raise():
    whole = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], b"block") + warc.RECORD_END
    assert len(list(warc.parse(whole * 3))) == 3
    for broken in (whole[:-6], b"junk" + whole, whole + b"more"):
        with pytest.raises(ValueError):
            list(warc.parse(broken))


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, ROWS).limit(0), Work(spark)).count() == 0
