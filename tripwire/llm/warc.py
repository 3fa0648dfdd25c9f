"""WARC archives: write pages as records, and a salvage reader that goes on behind damage.

Writing. A page is a ``response`` record (an HTTP response with the html in UTF-8 as its payload), or a ``revisit``
record without payload if an equal payload of ``REVISIT_BYTES`` or more belongs to a page with a smaller page_id. The first
page of each payload comes from one aggregation over digests; html is joined with the repeated digests only, which are
written first, so that Spark sees their size. Each record is a gzip member (or plain, ``compress=False``), and Spark's
text sink writes them, an empty member (or the record's closing line ends) between them: archives of ``ARCHIVE_RECORDS``
records at most, committed by Spark's own protocol, so a lost executor or a second attempt leaves no partial file.

Reading. An archive is read from its start, member by member or record by record. A record counts if its member's
checksum, its version line and header, its length, closing line ends and block digest are all right. After a failed check
the reader searches for the next gzip member or version line behind it that passes all of them, goes on from there, and
logs the bytes between as a quarantined gap. A damaged record therefore costs itself, whatever happened to its length. Any
other reader's archives are read too; a record without a block digest is checked by its length and line ends.

Defined results. Null html: an empty payload. Smaller payloads than ``REVISIT_BYTES`` and repeated rows of the smallest
page_id are all responses. A null page_id comes after all others; if every page of a payload has one, all are responses.
Null or odd urls: bytes up to space, and DEL, are percent-escaped, a null url has no target header. No pages: no
archives and no rows. An archive that is empty, or holds no valid record, gives one gap or none. Columns other than
page_id, url and html aren't read. Inside a gap, a whole valid record quoted by a damaged one is taken for a record. One
archive must fit in a task's memory, so give archives of other writers some bound too.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm._tables import stored

REVISIT_BYTES = 100
ARCHIVE_RECORDS = 2000
LEVEL = 6
# The format's version line, line ends, content types and the revisit profile.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
_GZIP = b"\x1f\x8b\x08"
_EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300") + bytes(8)  # no bytes, and their checksum and length
_FIRST_BYTES = 1 << 16
_HEADER_BYTES = 1 << 20
_START = re.compile(rb"WARC/\d+\.\d+\r?\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r?\n")
_ENTRY = "archive string, at long, size long, gap string, type string, record_id string, refers_to string, target string, digest string, payload_bytes long, payload binary"


# ---------------------------------------------------------------- writing

def _record(page: str, url: str | None, first: str | None, digest: str, payload: bytes, size: int, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = [
        f"WARC-Type: {'revisit' if first is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{page}:{digest}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {re.sub('[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}"] if url is not None else []),
        *([f"WARC-Refers-To: <urn:page:{first}:{digest}>", f"WARC-Profile: {PROFILE}"] if first is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Type: {HTTP_TYPE}",
        f"Content-Length: {len(block)}",
    ]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + END + block


def _records(date: str, compress: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for page, url, first, digest, payload, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = _record("" if page is None else str(page), url, None if first is None else str(first), digest, payload or b"", length, date)
                if compress:
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    one = packer.compress(one + END) + packer.flush()
                out.append(one)
                size += len(one)
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return run


def write_archives(pages: DataFrame, path: str, compress: bool = True, date: str = "1970-01-01T00:00:00Z", archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) to WARC files under ``path``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    copies = rows.where(F.length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = stored(copies.where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("copied"), "first"), "first_pages")
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    lines = (
        rows.join(firsts, F.col("digest") == F.col("copied"), "left")
        # A revisit has no body: only the length that its header names goes to Python.
        .select("page_id", "url", revisit.alias("first"), "digest", F.when(revisit.isNull(), F.col("payload")).alias("payload"), F.length("payload").alias("length"))
        .mapInArrow(_records(date, compress), "value binary")
        .select(F.col("value").cast("string").alias("value"))
    )
    end = _EMPTY_MEMBER if compress else END
    lines.write.option("lineSep", end.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", archive_records).text(path)


# ---------------------------------------------------------------- reading

class Damage(Exception):
    """A check that failed."""


@dataclass
class Record:
    head: dict[str, str]
    block: memoryview
    payload: memoryview = field(init=False)
    http: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        self.payload, self.http = self.block, {}
        if self.head.get("content-type", "").replace(" ", "").startswith("application/http"):
            end = bytes(self.block[:_HEADER_BYTES]).find(END)
            if end >= 0:
                self.http = _fields(bytes(self.block[:end]))
                self.payload = self.block[end + len(END) :]


def _fields(text: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is not one. A line that starts with a blank goes on the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _record_at(data: bytes | memoryview, at: int) -> tuple[Record, int]:
    """The record that begins at ``at`` and the place after it, or ``Damage``."""
    head = bytes(data[at : at + _HEADER_BYTES])
    if not _START.match(head):
        raise Damage("no version line")
    end = head.find(END)
    if end < 0:
        raise Damage("header without end")
    if any(b":" not in line and line[:1] not in (b" ", b"\t") for line in head[:end].split(b"\n")[1:]):
        raise Damage("header line without a name")
    fields = _fields(head[:end])
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damage("no content length")
    start = at + end + len(END)
    stop = start + int(length)
    if stop + len(END) > len(data):
        raise Damage("record goes beyond the end")
    if bytes(data[stop : stop + len(END)]) != END:
        raise Damage("no line ends after the block")
    block = memoryview(data)[start:stop]
    kind, _, digest = fields.get("warc-block-digest", "").partition(":")
    if kind == "sha256" and hashlib.sha256(block).hexdigest() != digest.lower():
        raise Damage("block digest differs")
    return Record(fields, block), stop + len(END)


def _member_at(data: bytes, at: int) -> tuple[list[Record], int]:
    """The records of the gzip member that begins at ``at`` (none: an empty member) and the place after it."""
    unpacker = zlib.decompressobj(31)
    try:
        out = [unpacker.decompress(memoryview(data)[at : at + _FIRST_BYTES])]
        if out[0] and not _START.match(out[0][:64]) and len(out[0]) >= 64:
            raise Damage("no version line in the member")
        place = at + _FIRST_BYTES
        while not unpacker.eof and place < len(data):
            out.append(unpacker.decompress(memoryview(data)[place : place + (1 << 20)]))
            place += 1 << 20
    except zlib.error as error:
        raise Damage("member checksum or code wrong") from error
    if not unpacker.eof:
        raise Damage("member goes beyond the end")
    text = b"".join(out)
    records, inner = [], 0
    while inner < len(text):
        record, inner = _record_at(text, inner)
        records.append(record)
    return records, min(place, len(data)) - len(unpacker.unused_data)


def _valid_at(data: bytes, at: int) -> tuple[list[Record], int]:
    if data[at : at + 3] == _GZIP:
        return _member_at(data, at)
    record, end = _record_at(data, at)
    return [record], end


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, list[Record]]]:
    """``(place, size, reason, records)`` of an archive, in order: what passes all checks has no reason, a gap has one."""
    at = 0
    while at < len(data):
        try:
            records, end = _valid_at(data, at)
        except Damage as damage:
            reason, gap = str(damage), at
            while True:
                found = _NEXT.search(data, at + 1)
                if found is None:
                    records, at, end = [], len(data), len(data)
                    break
                at = found.start()
                try:
                    records, end = _valid_at(data, at)
                    if records:  # an empty member alone is no proof
                        break
                except Damage:
                    continue
            yield gap, at - gap, reason, []
        if records:
            yield at, end - at, None, records
        at = end


def _entry(archive: str, at: int, size: int, reason: str | None, record: Record | None, payload: bool) -> dict:
    row = dict.fromkeys((c.split()[0] for c in _ENTRY.split(", ")))
    row |= {"archive": archive, "at": at, "size": size, "gap": reason}
    if record is not None:
        kind = record.head.get("warc-type")
        revisit = kind == "revisit"
        length = record.http.get("content-length", "") if revisit else ""
        stated = record.head.get("warc-payload-digest", "").partition(":")[2].lower() or None
        row |= {
            "type": kind,
            "record_id": record.head.get("warc-record-id"),
            "refers_to": record.head.get("warc-refers-to"),
            "target": record.head.get("warc-target-uri"),
            # of a revisit, as its header states them: the payload is another record's
            "digest": stated if revisit else hashlib.sha256(record.payload).hexdigest(),
            "payload_bytes": (int(length) if re.fullmatch("[0-9]{1,18}", length) else None) if revisit else len(record.payload),
            "payload": bytes(record.payload) if payload and not revisit else None,
        }
    return row


def _read(payload: bool):
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in _ENTRY.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for at, size, reason, records in salvage(data.as_py()):
                    for record in records or [None]:
                        rows.append(_entry(archive, at, size, reason, record, payload))
                        held += len(rows[-1]["payload"] or b"") + 200
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row for every valid record and every gap of the archives under ``path``: where it stands (archive, at, size: bytes as
    stored), why it is a gap (null for records), and a record's type, ids, target, digest, length and, if asked for, payload."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read(payload), _ENTRY)


def records(entries: DataFrame) -> DataFrame:
    return entries.where("gap IS NULL").drop("gap")


def gaps(entries: DataFrame) -> DataFrame:
    """The quarantine log: archive, first byte, number of bytes, and the check that failed."""
    return entries.where("gap IS NOT NULL").select("archive", "at", "size", F.col("gap").alias("reason"))


def salvage_archives(spark: SparkSession, path: str, log: str, payload: bool = True) -> DataFrame:
    """The valid records of the archives under ``path``, read once; the quarantined gaps are appended to the Parquet table ``log``."""
    entries = stored(read_archives(spark, path, payload), "archive_entries")
    gaps(entries).write.mode("append").parquet(log)
    return records(entries)


def resolve(found: DataFrame) -> DataFrame:
    """Records (with payload) whose revisits have the payload of the record they refer to; null if that one is lost."""
    whole = found.where("type = 'response'").groupBy(F.col("record_id").alias("of")).agg(F.first("payload").alias("original"))
    return (
        found.join(whole, found["refers_to"] == F.col("of"), "left")
        .withColumn("payload", F.coalesce("payload", "original"))
        .drop("of", "original")
    )


def _page_id(name: str):
    return F.expr(f"try_cast(nullif(regexp_extract({name}, '^<urn:page:(-?[0-9]*):[0-9a-f]+>$', 1), '') AS bigint)")


def page_records(found: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of the records of :func:`write_archives`."""
    return found.select(
        _page_id("record_id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        _page_id("refers_to").alias("refers_to"),
    )
