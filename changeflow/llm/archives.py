"""Legacy archive converter: ARC archives become WARC archives.

An ARC archive begins with a "filedesc" record that states its version. Every
record is a header line, as many bytes as the line declares, and a line end.

* version 1 lines: URL, IP address, date, content type, length
* version 2 lines: URL, IP address, date, content type, result code, checksum,
  location, offset, file name, length

The URL may hold spaces, so fields are taken from the right. The converter
synthesises what WARC wants and ARC lacks: record identifiers (named by archive
and offset, so a repeated run makes the same), ISO timestamps, record types and
payload digests. Of records with equal payloads one stays a response, the
others become revisits that name it.

Archives are rows (archive, content), as Spark's binaryFile reader gives them;
an archive is one row and must fit a task. Written archives are cut at a
bounded size, so a large crawl becomes many archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import col

ARC_FIELDS = {1: 5, 2: 10}
#: The lines of the "filedesc" record that name the fields.
ARC_LINES = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER, REFERS_HEADER = "X-Record-Key", "X-Refers-To-Key"
ARCHIVE_BYTES = 16 << 20
#: A member is unpacked from so many bytes at a time: what follows it among these is copied, never the rest of the archive.
READ_BYTES = 16 << 10
_CRLF = b"\r\n"

_RECORD = pa.schema(
    [
        ("key", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("content_type", pa.string()),
        ("record_id", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)
_RECORD_SQL = "key long, url string, ip string, date string, content_type string, record_id string, payload binary, payload_bytes long, payload_digest string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ARC ---------------------------------------------------------------------------------------


def arc_start(name: str, version: int, date: str = "19960101000000") -> bytes:
    body = b"%d 0 synthetic\n%s\n" % (version, ARC_LINES[version])
    extra = b" 200 - - 0 " + name.encode() if version == 2 else b""
    return b"filedesc://%s 0.0.0.0 %s text/plain%s %d\n%s\n" % (name.encode(), date.encode(), extra, len(body), body)


def arc_record(url: str, payload: bytes, key: int | None, version: int, name: str = "-", offset: int = 0, date: str = "19960101000000") -> bytes:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "-")
    named = b"" if key is None else f"{KEY_HEADER}: {key}\r\n".encode()
    block = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n%s" % (named, len(payload), payload)
    extra = b" 200 - - %d %s" % (offset, name.encode()) if version == 2 else b""
    return b"%s 0.0.0.0 %s text/html%s %d\n%s\n" % (url.encode(), date.encode(), extra, len(block), block)


def write_arc(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", version: int = 2, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """ARC archives (archive, content) of ``pages``: what the converter's input looks like. A null payload is empty."""
    rows = pages.select(col(key).cast("long"), col(url).cast("string"), F.coalesce(col(html), F.lit("")).cast("binary"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []
        size, name = 0, f"part-{part:05d}-{number:05d}.arc"
        for batch in batches:
            for k, u, h in zip(*(c for c in batch.columns)):
                if not held:
                    held.append(arc_start(name, version))
                    size = len(held[0])
                held.append(arc_record(u.as_py(), h.as_py(), k.as_py(), version, name, size))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield _archive(name, held)
                    number, held = number + 1, []
                    name = f"part-{part:05d}-{number:05d}.arc"
        if held:
            yield _archive(name, held)

    return rows.mapInArrow(archives, "archive string, content binary")


def _archive(name: str, held: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(held)], pa.binary())], names=["archive", "content"])


def parse_arc(name: str, content: bytes) -> Iterator[dict]:
    """The records of an archive. Raises ValueError where a line or a declared length doesn't fit."""
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].rstrip(b"\r")
        if fields is None:
            if not line.startswith(b"filedesc://"):
                raise ValueError(f"{name}: it doesn't begin with a filedesc record")
            length = int(line.rpartition(b" ")[2])
            version = int(content[end + 1 : end + 1 + length].split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: version {version} is unknown")
            fields, at = ARC_FIELDS[version], end + 1 + length
            continue
        parts = line.rsplit(b" ", fields - 1)
        if len(parts) < fields or not parts[-1].isdigit():
            raise ValueError(f"{name}, byte {at}: not a header line of {fields} fields")
        length = int(parts[-1])
        if end + 1 + length > len(content):
            raise ValueError(f"{name}, byte {at}: {length} bytes are declared, fewer follow")
        block = content[end + 1 : end + 1 + length]
        head, payload = b"", block
        if block.startswith(b"HTTP/"):
            gap = re.search(rb"\r?\n\r?\n", block)
            head, payload = (block[: gap.start()], block[gap.end() :]) if gap else (block, b"")
        key = re.search(rb"(?im)^%s: *(-?\d+)\r?$" % KEY_HEADER.encode(), head)
        text = [p.decode("utf-8", "replace") for p in parts]
        yield dict(
            key=int(key[1]) if key else None, url=text[0], ip=text[1], date=iso_date(text[2]), content_type=text[3],
            record_id=f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}').urn}>",
            payload=payload, payload_bytes=len(payload), payload_digest=payload_digest(payload),
        )
        at = end + 1 + length


def iso_date(stamp: str) -> str:
    """14 digits (or the first 8 to 13 of them, the rest as zero) as a WARC date; the epoch where they are none."""
    m = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(\d{0,6})", stamp)
    if not m:
        return "1970-01-01T00:00:00Z"
    time = m[4].ljust(6, "0")
    return f"{m[1]}-{m[2]}-{m[3]}T{time[:2]}:{time[2:4]}:{time[4:]}Z"


def read_arc(archives: DataFrame) -> DataFrame:
    """One row per ARC record: its fields, its payload, and the synthesised identifier and digest."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns):
                held, size = [], 0
                for r in parse_arc(name.as_py(), content.as_py()):
                    held.append(r)
                    size += r["payload_bytes"]
                    if size >= ARCHIVE_BYTES // 4 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema=_RECORD)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=_RECORD)

    return archives.select("archive", "content").mapInArrow(records, _RECORD_SQL)


# --- WARC --------------------------------------------------------------------------------------


def mark_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with record_type and refers_to.

    Of records with equal payloads of at least ``min_bytes``, that with the
    largest key is the response and the others revisit it. Null keys are the
    smallest; rows that repeat the largest key are responses too.
    """
    groups = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("key").alias("first_key"), F.max_by("record_id", "key").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisits = (F.col("payload_bytes") >= min_bytes) & F.col("first_key").isNotNull() & ~F.col("key").eqNullSafe(F.col("first_key"))
    return records.join(groups, "payload_digest", "left").select(
        *(records[c] for c in records.columns),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("first_key")).alias("refers_to"),
        F.when(revisits, F.col("first_id")).alias("refers_to_id"),
    )


def warc_record(r: dict) -> bytes:
    """A gzip member of its own. A revisit holds the response's headers, which state the payload's length, and no payload."""
    response = r["record_type"] == "response"
    block = b"HTTP/1.0 200 OK\r\nContent-Type: %s\r\nContent-Length: %d\r\n\r\n%s" % (
        r["content_type"].encode(), r["payload_bytes"], r["payload"] if response else b"",
    )
    head = [
        "WARC/1.0", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}",
        f"WARC-Target-URI: {r['url']}", f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}", "Content-Type: application/http; msgtype=response",
    ]
    if r["key"] is not None:
        head.append(f"{KEY_HEADER}: {r['key']}")
    if not response:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: {r['refers_to_id']}", f"{REFERS_HEADER}: {r['refers_to']}",
        ]
    head.append(f"Content-Length: {len(block)}")
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress("\r\n".join(head).encode() + _CRLF * 2 + block + _CRLF * 2) + press.flush()


def write_warc(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """WARC archives (archive, content) of marked records; write them as a table."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            names = batch.schema.names
            for values in zip(*batch.columns):
                held.append(warc_record({n: v.as_py() for n, v in zip(names, values)}))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield _archive(f"part-{part:05d}-{number:05d}.warc.gz", held)
                    number, held, size = number + 1, [], 0
        if held:
            yield _archive(f"part-{part:05d}-{number:05d}.warc.gz", held)

    return records.mapInArrow(archives, "archive string, content binary")


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, by gzip member and declared length."""
    view, at = memoryview(content), 0
    while at < len(content):
        member, data = zlib.decompressobj(31), []
        while at < len(content) and not member.eof:
            data.append(member.decompress(view[at : at + READ_BYTES]))
            at += READ_BYTES
        at = min(at, len(content)) - len(member.unused_data)
        head, _, body = b"".join([*data, member.flush()]).partition(_CRLF * 2)
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield headers, body[: int(headers["Content-Length"])]


def read_warc(archives: DataFrame) -> DataFrame:
    """key, url, payload, payload_bytes, payload_digest, record_type and refers_to of each record.

    A response's digest and length are computed anew from its payload and must
    be those declared; a revisit has a null payload and states them.
    """
    schema = pa.schema(
        [
            ("key", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for headers, block in parse_warc(content.as_py()):
                    held.append(_read_record(headers, block))
                    size += len(block)
                    if size >= ARCHIVE_BYTES // 4 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    return archives.select("content").mapInArrow(
        records, "key long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def _read_record(headers: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(_CRLF * 2)
    length = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", head)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    response = headers["WARC-Type"] == "response"
    if response and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: its payload isn't the declared one")
    number = lambda name: int(headers[name]) if name in headers else None
    return dict(
        key=number(KEY_HEADER), url=headers["WARC-Target-URI"], payload=payload if response else None, payload_bytes=length,
        payload_digest=digest, record_type=headers["WARC-Type"], refers_to=number(REFERS_HEADER),
    )
