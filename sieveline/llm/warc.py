"""WARC archives: a writer with revisit records and a salvage reader.

The writer is Spark's own text writer: a record ends with two line ends, which is the writer's
line separator. Files are committed like those of any other table, so lost tasks and executors
leave nothing half-written in sight, and any file system that Spark writes to will do.

The reader takes archives as they are found, plain or as gzip members, whole or damaged. When a
check fails - a member that does not inflate, a version line that is not there, a header
without a length, a block that does not end where it should - it searches for the next valid
member or version line, goes on there, and reports the bytes in between as a quarantined gap. It does
so inside of a member too, also in what inflates of a member that is damaged or cut off.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sieveline.llm.common import join_groups
from sieveline.sizing import broadcast_if_small, staged

VERSION = "WARC/1.1"
# Plain archives start a record with this line; both versions in use are read.
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
GZIP = b"\x1f\x8b\x08"
RECORD_END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
# Payloads from this size on are stored once.
REVISIT_BYTES = 1000
# Bytes of one archive, about. An archive is read as a whole by one task.
ARCHIVE_BYTES = 32 << 20
# Records are handed on in blocks of about this size.
EMIT_BYTES = 4 << 20
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def header_value(value: Column) -> Column:
    """A value that cannot end its header line: control characters and spaces percent-encoded."""
    out = F.coalesce(value.cast("string"), F.lit(""))
    for code in [37, *range(33), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def decided(pages: DataFrame, page_id: str, payload: str) -> DataFrame:
    """(payload_digest, payload_bytes, refers_to, members): the page that others with its payload revisit."""
    bytes_ = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    digests = pages.select(F.col(page_id).alias("id"), F.sha1(bytes_).alias("payload_digest"), F.octet_length(bytes_).alias("payload_bytes"))
    large = digests.filter(F.col("payload_bytes") >= REVISIT_BYTES)
    groups = large.groupBy("payload_digest", "payload_bytes").agg(F.max("id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    return groups.filter("__n > 1 and __keep is not null")


def records(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """(record, size): the text of each page's record, up to its closing line ends.

    Only payloads that occur more than once are looked up; the pages themselves are not shuffled
    while the list of those is small.
    """
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    copies = staged(decided(pages, page_id, payload), "warc-copies").drop("__n", "payload_bytes")
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), text.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload"), "payload_digest": F.sha1(F.col("payload").cast("binary"))})
    rows = rows.join(broadcast_if_small(copies), "payload_digest", "left")
    revisit = F.col("__keep").isNotNull() & ~F.col("__keep").eqNullSafe(F.col("id"))
    block = F.when(revisit, F.lit("HTTP/1.1 200 OK\r\n\r\n")).otherwise(F.concat(F.lit(HTTP_HEAD), "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    number = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", header_value(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("__keep").cast("string"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """One WARC record per row of ``pages`` in archives below ``path``.

    Of records with equal payloads of at least 1000 bytes, the one with the largest page id is a
    response and the others revisit it; so do all other records stay responses, those with a null
    id (which is no id to refer to) only if no other page has their payload. Rows that repeat the
    largest id are all responses. Null payloads are empty, a null or broken URL is percent-encoded
    into its header line. An empty table gives no archive. Other columns are not read.
    """
    size = pages.agg(F.sum(F.octet_length(F.col(payload).cast("string"))), F.count(F.lit(1))).first()
    per_file = max(1, int((size[1] or 1) * ARCHIVE_BYTES / max(size[0] or 1, 1)))
    records(pages, page_id, url, payload).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


@dataclass
class Record:
    offset: int
    version: str
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""

    @property
    def payload(self) -> bytes:
        """What follows the head of an HTTP message; the block itself if it is none."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block


@dataclass
class Gap:
    """Bytes ``offset`` to ``offset + length`` of an archive that hold no valid record, or none but the
    ones given before. A gap inside of a member has the member's offset, its length in inflated bytes, and the reason
    names its place in them."""

    offset: int
    length: int
    reason: str


class Damaged(ValueError):
    pass


def parse(data: bytes | memoryview, at: int, offset: int | None = None) -> tuple[Record, int]:
    """The record that starts at ``at`` and the place behind it; :class:`Damaged` if there is none."""
    data = memoryview(data)
    start = VERSION_LINE.match(data, at)
    if not start:
        raise Damaged("no version line")
    head_end = re.compile(rb"\r?\n\r?\n").search(data, start.end())
    if not head_end:
        raise Damaged("header does not end")
    record = Record(at if offset is None else offset, bytes(data[at : start.end()]).decode().strip())
    for line in bytes(data[start.end() : head_end.start()]).decode("utf-8", "replace").splitlines():
        if line[:1] in " \t" and record.headers:
            record.headers[list(record.headers)[-1]] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a name")
        record.headers[name.strip().lower()] = value.strip()
    length = record.headers.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no length")
    end = head_end.end() + int(length)
    if bytes(data[end : end + 4]) != RECORD_END:
        raise Damaged("block does not end where its length says")
    record.block = bytes(data[head_end.end() : end])
    check(record)
    return record, end + 4


def sha1_digest(value: str) -> bytes | None:
    """The bytes of a digest header: SHA-1 in hexadecimal or in base 32. None for any other."""
    kind, _, digest = value.partition(":")
    try:
        decoded = bytes.fromhex(digest) if len(digest) == 40 else base64.b32decode(digest.upper()) if len(digest) == 32 else b""
    except ValueError:
        return None
    return decoded if kind.lower() == "sha1" and len(decoded) == 20 else None


def check(record: Record) -> None:
    """SHA-1 digests must hold, in hexadecimal or in base 32; others are not looked at."""
    for name, data in (("warc-block-digest", lambda: record.block), ("warc-payload-digest", lambda: record.payload)):
        wanted = sha1_digest(record.headers.get(name, ""))
        if wanted and record.headers.get("warc-type") != "revisit" and hashlib.sha1(data()).digest() != wanted:
            raise Damaged(f"{name} differs")


def inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What inflates of the gzip member that starts at ``at``, the place behind what was read, and the
    reason why that is not the whole member; None if it is, and its checksum holds."""
    stream, out, read = zlib.decompressobj(wbits=31), [], at
    while not stream.eof and read < len(data):
        before, chunk = stream.copy(), data[read : read + (1 << 16)]
        try:
            out.append(stream.decompress(chunk))
        except zlib.error as e:
            # Byte by byte, nothing is lost that comes before the error.
            for k in range(len(chunk)):
                try:
                    out.append(before.decompress(chunk[k : k + 1]))
                except zlib.error:
                    break
            return b"".join(out), read + k, f"member does not inflate: {e}"
        read += len(chunk)
    return b"".join(out), read - len(stream.unused_data), None if stream.eof else "member is cut off"


def in_member(inner: bytes, at: int) -> Iterator[Record | Gap]:
    """The valid records of a member's inflated bytes in order, and the gaps between them."""
    place, lost_from, reason = 0, None, ""

    def gap() -> Gap:
        return Gap(at, place - lost_from, f"{reason} (inflated bytes from {lost_from} of the member)")

    while place < len(inner):
        try:
            record, end = parse(inner, place, at)
        except Damaged as e:
            if lost_from is None:
                lost_from, reason = place, str(e)
            start = VERSION_LINE.search(inner, place + 1)
            place = start.start() if start else len(inner)
            continue
        if lost_from is not None:
            yield gap()
            lost_from = None
        yield record
        place = end
    if lost_from is not None:
        yield gap()


def read_one(data: bytes, at: int) -> tuple[list[Record | Gap], int, str | None]:
    """The records of the member, or the plain record, at ``at``, the place behind what was read, and
    the reason if the member is not whole; :class:`Damaged` if there is no valid record."""
    if data[at : at + 3] != GZIP:
        record, end = parse(data, at)
        return [record], end, None
    inner, end, fault = inflated(data, at)
    found = list(in_member(inner, at))
    if not any(isinstance(f, Record) for f in found):
        raise Damaged(fault or (found[0].reason if found else "empty member"))
    # What follows the last record of a broken member is in the gap that the member leaves.
    while fault and isinstance(found[-1], Gap):
        found.pop()
    return found, end, fault


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All valid records of an archive in order, and the gaps between them."""
    at, lost_from, reason = 0, None, ""
    next_start = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
    # Records of the last broken member and how far it was read: stored blocks show them again.
    shown, reach = [], 0
    while at < len(data):
        try:
            found, end, fault = read_one(data, at)
            if at < reach and data[at : at + 3] != GZIP and (found[0].headers, found[0].block) in shown:
                raise Damaged("part of a broken member")
        except Damaged as e:
            if lost_from is None:
                lost_from, reason = at, str(e)
            start = next_start.search(data, at + 1)
            at = start.start() if start else len(data)
            continue
        if lost_from is not None:
            yield Gap(lost_from, at - lost_from, reason)
            lost_from = None
        yield from found
        if fault is None:
            at = end
            continue
        shown, reach = [(f.headers, f.block) for f in found if isinstance(f, Record)], end
        lost_from, reason = at, fault
        start = next_start.search(data, at + 1)
        at = start.start() if start else len(data)
    if lost_from is not None:
        yield Gap(lost_from, len(data) - lost_from, reason)


SCHEMA = (
    "archive string, offset long, gap_bytes long, gap_reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, and one per quarantined gap.

    A record has its type, id, URL, the record it refers to, its whole payload, and the payload's
    length and SHA-1; those of a revisit are what its headers say of the payload that it repeats.
    A gap has its offset, its bytes and the check that failed, and nothing else. An empty
    archive gives no row. Archives are read by one task each.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for pdf in batches:
            for path_, content in zip(pdf["path"], pdf["content"]):
                block, size = [], 0
                for r in salvage(content):
                    if isinstance(r, Gap):
                        block.append((path_, r.offset, r.length, r.reason, *[None] * 7))
                        continue
                    h, payload = r.headers, r.payload
                    if h.get("warc-type") == "revisit":
                        given = h.get("warc-payload-digest", "")
                        known = sha1_digest(given)
                        digest = known.hex() if known else given.partition(":")[2] or None
                        length = int(h["x-payload-length"]) if h.get("x-payload-length", "").isdigit() else None
                    else:
                        digest, length = hashlib.sha1(payload).hexdigest(), len(payload)
                    values = (h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"))
                    block.append((path_, r.offset, None, None, *values, digest, length, payload))
                    size += len(payload)
                    if size >= EMIT_BYTES:
                        yield pd.DataFrame(block, columns=names)
                        block, size = [], 0
                if block:
                    yield pd.DataFrame(block, columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, SCHEMA)
