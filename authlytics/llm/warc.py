"""Pages written to WARC archives and read back, with segmented and chunked records.

Archives are written by Spark's text sink, whose line separator ends a record, and read as whole
files of bounded size.  A long record is cut into a first segment and continuation records, which
may land in other files.  Reading parses each file on its own; records of one segment are decoded
at once, and only segments are shuffled: grouped by the identifier of their origin, ordered by
segment number, and joined if numbers and total length agree.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlytics.llm.common import Work, utf8

RECORD_END = b"\r\n\r\n"
SEGMENT_BYTES = 16 << 10  # of a record's block, at most
CHUNK_BYTES = 4 << 10
FILE_BYTES = 16 << 20
REVISIT_BYTES = 100  # payloads from this size on are stored once
DATE = "2024-01-01T00:00:00Z"
_HEADER_ROOM = 4 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


# -- records -------------------------------------------------------------------------


def chunked(payload: bytes) -> bytes:
    pieces = []
    for i in range(0, len(payload), CHUNK_BYTES):
        piece = payload[i : i + CHUNK_BYTES]
        pieces.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join(pieces) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; none if its framing is broken."""
    pieces, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        piece = body[end + 2 : end + 2 + size]
        at = end + 2 + size + 2
        if len(piece) < size or body[at - 2 : at] != b"\r\n":
            return None
        if not size:
            return b"".join(pieces)
        pieces.append(piece)


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the line ends after it."""
    lines = [b"WARC/1.1"]
    for name, value in headers + [("Content-Length", len(block))]:
        if value is not None:
            raw = value if isinstance(value, bytes) else str(value).encode()
            lines.append(name.encode() + b": " + raw)
    return b"\r\n".join(lines) + RECORD_END + block


def page_records(
    page_id,
    url: bytes | None,
    payload: bytes,
    digest: str,
    refers_to,
    name: str,
    first_url: bytes | None = None,
) -> Iterator[bytes]:
    """The record of a page, and its continuations if it is long; `name` is the row's own.

    A revisit names the response by page, and for other readers by its URI and date.
    """
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + chunked(payload)
    own = _urn(name)

    def safe(uri: bytes | None) -> bytes | None:
        return uri and _UNSAFE.sub(lambda m: b"%%%02X" % m.group()[0], uri)

    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", own),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", safe(url)),
        ("WARC-Refers-To-Target-URI", safe(first_url) if revisit else None),
        ("WARC-Refers-To-Date", DATE if revisit else None),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
    ]
    segments = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    if len(segments) == 1:
        yield record(headers, block)
        return
    for number, segment in enumerate(segments, 1):
        if number > 1:
            headers = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", _urn(f"{name}/{number}")),
                ("WARC-Date", DATE),
                ("WARC-Segment-Origin-ID", own),
            ]
        total = len(block) if number == len(segments) else None
        extra = [("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total)]
        yield record(headers + extra, segment)


def _urn(name: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(name.encode()).digest())}>"


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; names are lower-cased.  Broken archives raise."""
    at = 0
    while at < len(archive):
        end = archive.find(RECORD_END, at)
        lines = archive[at:end].split(b"\r\n")
        if end < 0 or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        pairs = (line.partition(b":") for line in lines[1:])
        headers = {name.decode().lower(): value.strip().decode() for name, _, value in pairs}
        start = end + len(RECORD_END)
        at = start + int(headers["content-length"])
        if at + len(RECORD_END) > len(archive):
            raise ValueError("the last record is cut off")
        yield headers, archive[start:at]
        at += len(RECORD_END)


# -- writing -------------------------------------------------------------------------


def write_archives(pages: DataFrame, path: str, working: Work) -> None:
    """Write a record per page row (page_id, url, html) to archives in a folder.

    A null html is an empty payload.  Of equal payloads of at least REVISIT_BYTES the rows of the
    smallest page_id (nulls last) are responses, the others revisits that name that page; smaller
    payloads are all responses.  Repeated rows have records of their own.  Other columns are left.
    """
    payload = utf8("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("binary").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    firsts = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(
            F.min("page_id").alias("first_id"),
            F.min_by("url", "page_id").alias("first_url"),
            F.count("*").alias("n"),
        )
        .filter("n > 1 AND first_id IS NOT NULL")
        .select("digest", "first_id", "first_url")
    )
    firsts = working.write(firsts, "firsts")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    records = (
        rows.join(firsts, "digest", "left")
        .select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"), "first_url")
        .mapInArrow(_write_records, "record binary")
        .select(F.col("record").cast("string").alias("record"))
    )
    (
        records.write.option("lineSep", RECORD_END.decode())
        .option("maxRecordsPerFile", FILE_BYTES // (SEGMENT_BYTES + _HEADER_ROOM))
        .text(path)
    )


def _write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    partition, row = TaskContext.get().partitionId(), 0
    for batch in batches:
        records: list[bytes] = []
        for page in batch.to_pylist():
            name = f"{page['page_id']}/{page['digest']}/{partition}/{row}"
            records += page_records(
                page["page_id"],
                page["url"],
                page["payload"],
                page["digest"],
                page["refers_to"],
                name,
                page["first_url"],
            )
            row += 1
        yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])


# -- reading -------------------------------------------------------------------------

_RECORD = """origin string, segment int, total long, type string, page_id long, refers_to long,
    digest string, block binary"""
_PAGE = """page_id long, record_type string, refers_to long, digest string, payload binary,
    complete boolean"""


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def number(headers: dict[str, str], name: str) -> int | None:
        return int(headers[name]) if name in headers else None

    for batch in batches:
        for archive in batch.column(0):
            rows = []
            for headers, block in parse(archive.as_py()):
                rows.append(
                    {
                        "origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]),
                        "segment": number(headers, "warc-segment-number"),
                        "total": number(headers, "warc-segment-total-length"),
                        "type": headers["warc-type"],
                        "page_id": number(headers, "x-page-id"),
                        "refers_to": number(headers, "x-refers-to-page-id"),
                        "digest": headers.get("warc-payload-digest", "").partition(":")[2],
                        "block": block,
                    }
                )
            kinds = [
                ("origin", pa.string()),
                ("segment", pa.int32()),
                ("total", pa.int64()),
                ("type", pa.string()),
                ("page_id", pa.int64()),
                ("refers_to", pa.int64()),
                ("digest", pa.string()),
                ("block", pa.binary()),
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages from the blocks of their segments, null where these could not be put together."""
    for batch in batches:
        payloads, complete = [], []
        for blocks, kind, digest in zip(*(batch.column(c) for c in ("blocks", "type", "digest"))):
            block = None if not blocks.is_valid else b"".join(blocks.as_py())
            payload = None
            if block is not None and kind.as_py() != "revisit":
                head, _, body = block.partition(RECORD_END)
                framed = b"transfer-encoding: chunked" in head.lower()
                payload = unchunked(body) if framed else body
                whole = payload is not None
                complete.append(whole and hashlib.sha256(payload).hexdigest() == digest.as_py())
            else:
                complete.append(block is not None)
            payloads.append(payload)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("type"),
                batch.column("refers_to"),
                batch.column("digest"),
                pa.array(payloads, pa.binary()),
                pa.array(complete, pa.bool_()),
            ],
            names=["page_id", "record_type", "refers_to", "digest", "payload", "complete"],
        )


def reassemble(records: DataFrame) -> DataFrame:
    """Records by their blocks in order: one of those of one segment, else the segments of an
    origin, null where they don't fit together.  Nothing is joined before `_decode`, once."""
    kept = ["type", "page_id", "refers_to", "digest"]
    whole = records.filter("segment IS NULL").select(*kept, F.array("block").alias("blocks"))
    part = F.struct("segment", "total", *kept, "block")
    parts = records.filter("segment IS NOT NULL").groupBy("origin")
    parts = parts.agg(F.sort_array(F.collect_list(part)).alias("parts"))
    first, last = F.col("parts")[0], F.element_at("parts", -1)
    numbers = F.transform("parts", lambda p: p["segment"])
    sizes = F.transform("parts", lambda p: F.octet_length(p["block"]).cast("long"))
    size = F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n)
    agree = (numbers == F.sequence(F.lit(1), F.size("parts"))) & (size == last["total"])
    blocks = F.transform("parts", lambda p: p["block"])
    joined = parts.select(*(first[c].alias(c) for c in kept), F.when(agree, blocks).alias("blocks"))
    return whole.unionByName(joined)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, digest, payload, complete: a row per record of a page.

    digest is the recorded SHA-256 of the full payload.  A response is complete if its segments and
    chunks fit together and its payload has that digest; where they don't fit the payload is null.
    Revisits have no payload of their own.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return reassemble(files.mapInArrow(_read_records, _RECORD)).mapInArrow(_decode, _PAGE)


def round_trip(pages: DataFrame, working: Work) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, complete: a row per page,
    written and read back; a revisit's size is that of the response with its digest."""
    path = f"{working.folder}/archives"
    write_archives(pages, path, working)
    sized = read_archives(pages.sparkSession, path).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    rows = working.write(sized.drop("payload"), "records")
    sizes = working.write(
        rows.filter("record_type = 'response'")
        .join(rows.filter("record_type = 'revisit'").select("digest").distinct(), "digest")
        .groupBy("digest")
        .agg(F.max("payload_bytes").alias("first_bytes")),
        "sizes",
    )
    return rows.join(sizes, "digest", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "first_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "complete",
    )
