"""From legacy ARC archives to WARC archives.

Method: an ARC file is read record by record: its version block says which header line its records
have (version 1: five fields, version 2: ten), each header line declares the length of what follows.
Every record becomes a WARC record with a synthesised identifier (from its content, so a rerun gives the
same), an ISO date, a type by what it is (file description: ``warcinfo``, HTTP response:
``response``, others: ``resource``), and digests of block and payload. Of HTTP records with equal
payloads of at least ``REVISIT_BYTES``, the one with the smallest page id stays a response and
the others become revisits of it.

Archives are written by Spark's text sink, one row a file, with the end of a WARC record as the line
separator and gzip on top, so they go to any store that Spark reaches and obey its commit protocol.
A file holds about ``FILE_BYTES``; a single larger record gets a file of its own.

Defined cases: a null payload is an empty one; a null url becomes ``urn:page:<id>``, spaces in a url are
escaped; a null page id has no page header and counts as the smallest; repeated rows become
repeated records of one identifier, and are all responses or all revisits; a damaged header line is skipped
up to the next one that can be read; a record cut off by the end of its file is marked
as truncated; an empty table gives archives without page records and an empty result. Columns other than
``page_id, url, html`` are not used.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import read, stage

FILE_BYTES = 8 << 20
REVISIT_BYTES = 100
DATE = "20240101000000"
PAGE_HEADER = b"X-Page-Id"
#: Fields of a record's header line by the version its file declares.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        *("URL", "IP-address", "Archive-date", "Content-type", "Result-code"),
        *("Checksum", "Location", "Offset", "Filename", "Archive-length"),
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
_FILE = "name string, content binary"


def write_archives(files: DataFrame, path: str, end: bytes) -> None:
    """Write each row's ``content``, which lacks the final ``end``, as one compressed file."""
    files.select(F.col("content").cast("string")).write.option("lineSep", end.decode()).option(
        "compression", "gzip"
    ).option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def inflate(content: bytes) -> bytes:
    """All members of a gzip file, or the content as it is."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data
    return b"".join(out) + (b"" if out else content)


# ARC


def _arc_record(version: int, url: str, date: str, block: bytes, offset: int) -> bytes:
    start = f"{url} 0.0.0.0 {date} text/html"
    if version == 2:
        digest = hashlib.sha1(block).hexdigest()
        start += f" 200 {digest} - {offset} pages.arc"
    return f"{start} {len(block)}\n".encode() + block + b"\n"


def _arc_head(version: int, name: str) -> bytes:
    body = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {DATE} text/plain {len(body)}\n".encode() + body + b"\n"


def arc_of_pages(pages: DataFrame) -> DataFrame:
    """``name, content`` of ARC files of the pages; files take turns in both versions."""
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, count = [], 0, 0
        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "html"))
            for page, url, html in zip(*columns):
                page, url, payload = page.as_py(), url.as_py(), html.as_py().encode()
                if not parts:
                    version = 1 + count % 2
                    parts, count = [_arc_head(version, f"pages-{count}.arc")], count + 1
                    size = len(parts[0])
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += b"Content-Length: %d\r\n" % len(payload)
                if page is not None:
                    head += PAGE_HEADER + b": %d\r\n" % page
                target = f"urn:page:{page}" if not url else quote(url, safe=":/?#[]@!$&'()*+,;=%~")
                record = _arc_record(version, target, DATE, head + b"\r\n" + payload, size)
                parts.append(record)
                size += len(record)
                if size >= FILE_BYTES:
                    yield _file_row(f"pages-{count - 1}.arc", b"".join(parts)[:-1])
                    parts = []
        if parts:
            yield _file_row(f"pages-{count - 1}.arc", b"".join(parts)[:-1])

    return rows.mapInArrow(each, _FILE)


def _file_row(name: str, content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([content], pa.binary())], ["name", "content"]
    )


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    cut: bool


def _arc_line(line: bytes, version: int) -> list[str] | None:
    """The fields of a header line, or None if it is none of this version."""
    fields = ARC_FIELDS[version]
    parts = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
    if len(parts) != len(fields) or not parts[-1].isdigit() or not parts[2].isdigit():
        return None
    return parts


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of one ARC file, its version block first."""
    at, version = 0, 1
    while at < len(content):
        end = content.find(b"\n", at)
        end = len(content) if end < 0 else end
        line = content[at:end]
        head = line.startswith(b"filedesc://")
        fields = _arc_line(line, 1 if head else version)
        if fields is None:
            at = end + 1
            continue
        length, begin = int(fields[-1]), end + 1
        block = content[begin : begin + length]
        if head:
            declared = re.match(rb"([12]) ", block)
            version = int(declared[1]) if declared else 1
        yield ArcRecord(*fields[:4], block, len(block) < length)
        at = begin + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header part, with the empty line, and payload of an HTTP message."""
    at = block.find(END)
    return (block, b"") if at < 0 else (block[: at + 4], block[at + 4 :])


def http_header(head: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def iso_date(arc: str) -> str:
    """An ARC date of 4 to 14 digits as an ISO 8601 time."""
    d = arc + "00000101000000"[len(arc) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


_RECORD = (
    "record_id string, kind string, url string, ip string, date string, mime string, "
    "page_id long, head binary, payload binary, payload_digest string, payload_bytes long, "
    "truncated boolean"
)
_RECORD_TYPES = [
    pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
    pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.bool_(),
]


#: What to do with payloads on the way: leave them out, keep them, or keep them compressed.
NONE, RAW, PACKED = "none", "raw", "packed"


def _carried(payload: bytes, how: str) -> bytes | None:
    if how == PACKED:
        return zstandard.ZstdCompressor(level=1).compress(payload)
    return payload if how == RAW else None


def _warc_fields(record: ArcRecord, how: str = RAW) -> tuple:
    http = record.block.startswith(b"HTTP/")
    info = record.url.startswith("filedesc://")
    head, payload = split_http(record.block) if http else (b"", record.block)
    digest = hashlib.sha256(payload).hexdigest()
    page = http_header(head, PAGE_HEADER) if http else None
    seed = f"{record.url} {record.date} {record.ip} {hashlib.sha256(record.block).hexdigest()}"
    return (
        f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}",
        "warcinfo" if info else "response" if http else "resource",
        record.url,
        record.ip,
        iso_date(record.date),
        record.mime,
        int(page) if page else None,
        head,
        _carried(payload, how),
        digest,
        len(payload),
        record.cut,
    )


def read_arc(spark: SparkSession, path: str, payload: str = RAW) -> DataFrame:
    """The records of all ARC files of a folder, with the WARC fields they will have."""
    names = [f.split()[0] for f in _RECORD.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [_warc_fields(r, payload) for r in parse_arc(inflate(content.as_py()))]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), _RECORD_TYPES)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return archive_files(spark, path).mapInArrow(each, _RECORD)


# WARC


def warc_record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block


def _warc_of(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    kind = "revisit" if revisit else row["kind"]
    block = row["head"]
    if not revisit:
        block += zstandard.ZstdDecompressor().decompress(row["payload"])
    http = row["kind"] == "response"
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": row["date"],
        "WARC-Target-URI": None if kind == "warcinfo" else row["url"],
        "WARC-Filename": row["url"][11:] if kind == "warcinfo" else None,
        "WARC-IP-Address": None if kind == "warcinfo" else row["ip"],
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "WARC-Truncated": "length" if row["truncated"] else None,
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": f"<{row['refers_to']}>" if revisit else None,
        "WARC-Refers-To-Target-URI": row["refers_url"],
        "WARC-Refers-To-Date": row["refers_date"],
        "Content-Type": "application/http; msgtype=response" if http else row["mime"],
    }
    return warc_record(fields, block)


def warc_files(records: DataFrame) -> DataFrame:
    """``name, content`` of WARC files of converted records with packed payloads."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                parts.append(_warc_of(row))
                size += len(parts[-1])
                if size >= FILE_BYTES:
                    yield _file_row("pages.warc", END.join(parts))
                    parts, size = [], 0
        if parts:
            yield _file_row("pages.warc", END.join(parts))

    return records.mapInArrow(each, _FILE)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields, by lower-case name, and block of each record of one WARC file."""
    at = 0
    while at < len(content):
        end = content.find(END, at)
        if end < 0:
            return
        version, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(fields["content-length"])
        yield fields, content[end + 4 : end + 4 + length]
        at = end + 4 + length + len(END)


_READ = (
    "record_type string, record_id string, refers_id string, page_id long, url string, "
    "payload_digest string, payload_bytes long"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record; digest and size are of the full payload, of revisits as well.

    The digest of a stored payload is checked against its header.
    """
    names = [f.split()[0] for f in _READ.split(", ")]

    def fields_of(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields["warc-type"]
        http = block.startswith(b"HTTP/")
        head, payload = split_http(block) if http else (b"", block)
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        size = len(payload)
        if kind == "revisit":
            size = int(http_header(head, b"Content-Length") or 0)
        elif hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{fields['warc-record-id']}: the payload is not that of its digest")
        page = http_header(head, PAGE_HEADER) if http else None
        return (
            kind,
            fields["warc-record-id"].strip("<>"),
            fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            int(page) if page else None,
            fields.get("warc-target-uri"),
            digest,
            size,
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = [fields_of(*r) for r in parse_warc(inflate(content.as_py()))]
                if rows:
                    kinds = [pa.string()] * 3 + [pa.int64(), pa.string(), pa.string(), pa.int64()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return archive_files(spark, path).mapInArrow(each, _READ)


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Convert all ARC files of a folder to WARC files in another."""
    slim = read_arc(spark, arc_path, NONE).filter("kind = 'response'").select(
        "page_id", "payload_digest", "payload_bytes", "record_id", "url", "date"
    )
    large = slim.filter(F.col("payload_bytes") >= REVISIT_BYTES)
    first = large.groupBy("payload_digest").agg(
        F.min(F.struct("page_id", "record_id", "url", "date")).alias("first")
    )
    later = (
        large.select("payload_digest", "page_id", "record_id")
        .join(first, "payload_digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("first.page_id")))
        .select(
            "record_id",
            F.col("first.record_id").alias("refers_to"),
            F.col("first.url").alias("refers_url"),
            F.col("first.date").alias("refers_date"),
        )
        .distinct()
    )
    records = read_arc(spark, arc_path, PACKED).join(later, "record_id", "left")
    write_archives(warc_files(records), warc_path, END)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stage(spark)
    write_archives(arc_of_pages(read(spark, sf_dir, "pages")), store.path("arc"), b"\n")
    convert(spark, store.path("arc"), store.path("warc"))
    rows = read_warc(spark, store.path("warc"))
    pages = rows.filter("record_type IN ('response', 'revisit')")
    first = rows.filter("record_type = 'response'").selectExpr(
        "record_id AS refers_id", "page_id AS refers_to"
    ).distinct()
    return pages.join(first, "refers_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
