"""WARC archives: writing pages, and a reader that salvages what it can.

Each record is one gzip member. The bytes go through Spark's text writer, so any
file system that Spark knows holds the archives, and a lost executor's files are
written again. That writer ends each value with a separator: it is the zero byte
that a member of under 16 MiB ends with anyway (the top byte of its length);
after a larger one comes an empty member.

The reader takes members or plain records as they come. Where a check fails (gzip
checksum, header, length, digest) it looks for the next member or version line
that passes all checks, goes on from there, and logs the bytes between as a gap.
A round trip counts what it reads: pages that were written and not read are an error.
"""

from __future__ import annotations

import hashlib
import logging
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.llm.storage import new_folder, stored

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
BREAK = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SHARED_PAYLOAD_BYTES = 100
ARCHIVE_BYTES = 256 << 20
GZIP_LEVEL = 3
ROWS_PER_BATCH = 256
BYTES_AT_ONCE = 1 << 14
WRITTEN_AT = "2024-01-01T00:00:00Z"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, not compressed. Characters that would end a header line are percent-encoded."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", WRITTEN_AT),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
        fields.append(("WARC-Target-URI", safe))
    if refers_to is not None:
        fields.append(("WARC-Profile", SAME_PAYLOAD))
        fields.append(("WARC-Refers-To", _record_id(refers_to, digest)))
        fields.append(("X-Refers-To-Page-Id", str(refers_to)))
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + head + b"\r\n" + block + BREAK


def member_bytes(record: bytes) -> bytes:
    """A gzip member whose last byte is zero."""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    member = packer.compress(record) + packer.flush()
    if member[-1]:
        empty = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
        member += empty.flush()
    return member


def revisits(pages: DataFrame, least_bytes: int = SHARED_PAYLOAD_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which pages repeat which payload.

    Of pages with the same payload of at least `least_bytes`, the smallest page_id
    (and each row that repeats it) is the response; the others, null ids included,
    refer to it. If all their ids are null, all are responses.
    """
    full = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = stored(
        full.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first"),
        "first-payloads",
    )
    again = F.coalesce(F.col("page_id") > F.col("first"), F.lit(True))
    return full.join(firsts, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(F.col("first").isNotNull() & again, F.col("first")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = SHARED_PAYLOAD_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """pages (page_id, url, html) as archives in folder; a null html is an empty payload.

    Each task cuts its members into archives by their bytes: one is closed with the
    member that takes it to `archive_bytes`, so it is larger by one member at most.
    White space and control characters in a url are written percent-encoded.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = filled = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                rows = batch.slice(at, ROWS_PER_BATCH).to_pylist()
                packed = [
                    member_bytes(
                        record_bytes(
                            r["page_id"], r["url"], r["payload"].encode(), r["digest"], r["refers_to"]
                        )
                    )[:-1]
                    for r in rows
                ]
                into = []
                for member in packed:
                    into.append(archive)
                    filled += len(member) + 1
                    if filled >= archive_bytes:
                        archive, filled = archive + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(into, pa.int32()), pa.array(packed, pa.binary())], ["archive", "member"]
                )

    (
        revisits(pages, least_bytes)
        .mapInArrow(members, "archive int, member binary")
        .select("archive", F.col("member").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .partitionBy("archive")
        .text(folder)
    )


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


class Breaks:
    """The next end of a header after a place; bytes without one are searched once."""

    def __init__(self, data: bytes) -> None:
        self.data, self.since, self.found = data, 0, -1

    def after(self, at: int) -> int:
        if not self.since <= at <= self.found:
            found = self.data.find(BREAK, at)
            self.since, self.found = at, len(self.data) if found < 0 else found
        return self.found


def plain_record(data: bytes, at: int, breaks: Breaks | None = None) -> tuple[dict, int]:
    """The record at this place and where it ends; ValueError says which check failed."""
    if not VERSION_LINE.match(data, at):
        raise ValueError("version")
    end = (breaks or Breaks(data)).after(at)
    if end == len(data):
        raise ValueError("header")
    fields = _fields(data[at:end])
    if not re.fullmatch("[0-9]{1,18}", fields.get("content-length", "")):
        raise ValueError("header")
    start = end + len(BREAK)
    stop = start + int(fields["content-length"])
    if data[stop : stop + len(BREAK)] != BREAK:
        raise ValueError("length")
    block = data[start:stop]
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
        raise ValueError("digest")
    http, cut, payload = block.partition(BREAK)
    is_http = fields.get("content-type", "").startswith("application/http")
    record = {"fields": fields, "payload": payload if is_http and cut else block}
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and digest.startswith("sha256:"):
        record["digest"] = hashlib.sha256(record["payload"]).hexdigest()
        if record["digest"] != digest[7:]:
            raise ValueError("digest")
    return record, stop + len(BREAK)


def records_at(data: bytes, at: int, breaks: Breaks | None = None) -> tuple[list[dict], int]:
    """The records of the member at this place, or the plain record there, and where it ends."""
    if not data.startswith(MEMBER, at):
        record, end = plain_record(data, at, breaks)
        return [record], end
    # In steps: what follows a member is copied, so it must not be the whole rest.
    unpacker, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof and fed < len(data):
            parts.append(unpacker.decompress(data[fed : fed + BYTES_AT_ONCE]))
            fed = min(fed + BYTES_AT_ONCE, len(data))
    except zlib.error as bad:
        raise ValueError("gzip") from bad
    if not unpacker.eof:
        raise ValueError("gzip")
    inner, found, inside = b"".join(parts), [], 0
    while inside < len(inner):
        record, inside = plain_record(inner, inside)
        found.append(record)
    return found, fed - len(unpacker.unused_data)


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record) for each good record, (start, end, reason) for each gap, in order."""
    at, gap, reason = 0, None, ""
    # The next member and version line, looked for again only when passed.
    member = version = -1
    breaks = Breaks(data)
    while at < len(data):
        try:
            found, end = records_at(data, at, breaks)
        except ValueError as failed:
            if gap is None:
                gap, reason = at, str(failed)
            if member <= at:
                member = data.find(MEMBER, at + 1)
                member = len(data) if member < 0 else member
            if version <= at:
                line = VERSION_LINE.search(data, at + 1)
                version = line.start() if line else len(data)
            at = min(member, version)
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        for record in found:
            yield at, end, record
        at = end
    if gap is not None:
        yield gap, at, reason


READ_SCHEMA = pa.schema(
    [
        ("archive", pa.string()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("gap_reason", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
READ_COLUMNS = (
    "archive string, start long, end long, gap_reason string, record_type string, page_id long,"
    " url string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch("-?[0-9]{1,19}", text) else None


def _row(archive: str, start: int, end: int, found: dict | str, payloads: bool) -> dict:
    row = {"archive": archive, "start": start, "end": end}
    if isinstance(found, str):
        return row | {"gap_reason": found}
    fields, payload = found["fields"], found["payload"]
    kind = fields.get("warc-type")
    length = len(payload) if kind == "response" else _number(fields.get("x-payload-length"))
    return row | {
        "record_type": kind,
        "page_id": _number(fields.get("x-page-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": found.get("digest") or fields.get("warc-payload-digest", "").partition(":")[2],
        "refers_to": _number(fields.get("x-refers-to-page-id")),
        "payload": payload if payloads else None,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all archives in folder, and a row with gap_reason for each quarantined gap.

    An archive is read by one task, which holds its bytes and one batch of records;
    archives of common size (1 GB) fit, and those written here are cut smaller.
    """

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for start, end, found in salvage(content.as_py()):
                    rows.append(_row(path.as_py(), start, end, found, payloads))
                    if len(rows) == ROWS_PER_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return archives.select("path", "content").mapInArrow(opened, READ_COLUMNS)


class PagesLost(Exception):
    """Pages that were written and not read back."""


def read_back(spark: SparkSession, folder: str, written: int) -> DataFrame:
    """The records of the archives in folder, without payloads; PagesLost if not `written` are read.

    The gaps are logged: their number and bytes here, each as a row of the table
    whose folder the message names.
    """
    found = stored(read_archives(spark, folder, payloads=False), "archive-log")
    gap = F.col("gap_reason").isNotNull()
    seen = found.agg(
        F.count_if(~gap).alias("records"),
        F.count_if(gap).alias("gaps"),
        F.coalesce(F.sum(F.when(gap, F.col("end") - F.col("start"))), F.lit(0)).alias("bytes"),
    ).first()
    told = (
        f"{seen['records']} of {written} records read from {folder}; {seen['gaps']} gaps of"
        f" {seen['bytes']} bytes are listed in {found.stored_in}"
    )
    if seen["records"] != written:
        raise PagesLost(told)
    if seen["gaps"]:
        logging.getLogger(__name__).warning(told)
    return found.where(~gap)


def round_trip(pages: DataFrame) -> DataFrame:
    """pages written and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null ids come back as null, repeated rows as rows of their own; columns other
    than page_id, url and html are not archived, and urls are archived with white
    space and control characters percent-encoded. A page that is not read back is
    an error (PagesLost); what was skipped is logged.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "archives")
    write_archives(pages, folder)
    return read_back(spark, folder, pages.count()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
