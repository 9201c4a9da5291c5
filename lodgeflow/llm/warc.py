"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

The writer turns pages into WARC/1.1 records and lets Spark's text sink write
them, so archives are committed, retried and spread like any Spark output. With
"gzip" each record is a gzip member of its own, made before the sink, so that
damage to one leaves the next to go on from. Of
pages with equal payloads the one with the smallest id becomes a response; the
others become revisits that refer to it and keep the HTTP header, and with it the
length of the payload.

The reader takes plain archives, gzip members of one record each, and gzip files
of many records. A record whose length, end or digest fails its check is
quarantined: the reader searches for the next gzip member or version line that
starts a valid record, goes on from there, and logs the bytes between as a gap.

Defined cases: a null html is an empty payload; payloads of fewer than
``min_bytes`` are never revisits; rows that repeat the smallest id of their
payload are all responses; a page without an id refers to the smallest id there
is; control characters of a URL are percent-encoded; an empty table writes an
archive without records. A page is one record, built whole; pages far above the
usual size go to files of few records. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodgeflow.llm.common import per_row

#: Records and bytes of one archive file; a file is read as a whole by one task, which can take up to 2 GB.
RECORDS_PER_FILE, BYTES_PER_FILE = 1000, 1 << 30
DATE = "2024-01-01T00:00:00Z"

_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, without the newline that the text sink adds."""
    block = (_HTTP % len(payload)).encode() + (payload if refers_to is None else b"")
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {uri}"] if uri else []),
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member, without the zero byte that the text sink adds.

    A member ends with its size, so with a zero unless that is 16 MB or more; an
    empty member then follows.
    """
    data = gzip.compress(record(page_id, url, payload, refers_to) + b"\n", 6, mtime=0)
    if data[-1]:
        data += gzip.compress(b"", mtime=0)
    return data[:-1]


def write(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "none") -> None:
    """Write (page_id, url, html) as archive files below ``path``, which must not exist.

    A file holds at most RECORDS_PER_FILE records; pages of more than their share
    of BYTES_PER_FILE go to files of their own, with as few records as keep these
    below that size too. So no file outgrows what a task reads at once.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    pages = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    # Only payloads that occur again need a look-up; the sizes and digests alone are shuffled for it.
    again = (
        pages.where(F.length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha", "first_id")
    )
    revisits = pages.join(again, "sha", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(F.col("page_id").eqNullSafe(F.col("first_id")), None).otherwise(F.col("first_id")).alias("refers_to"),
    )
    members = compression == "gzip"
    built = per_row(member if members else record, "binary")("page_id", "url", "payload", "refers_to").cast("string")
    usual = BYTES_PER_FILE // RECORDS_PER_FILE
    # From the sizes alone: no page is written before it is known whether large ones need files of their own.
    (largest,) = pages.agg(F.max(F.length("payload"))).first()
    parts = [(F.length("payload") <= usual, RECORDS_PER_FILE)]
    if (largest or 0) > usual:
        parts.append((F.length("payload") > usual, max(1, BYTES_PER_FILE // largest)))
    for chosen, records in parts:
        # The bytes of members are final: the sink only adds the last one of each.
        writer = revisits.where(chosen).select(built.alias("record")).write.mode("append" if chosen is not parts[0][0] else "error")
        writer = writer.option("maxRecordsPerFile", records).option("compression", "none" if members else compression)
        writer.option("lineSep", "\0" if members else "\n").text(path)


def _plain(data: bytes, at: int) -> tuple[dict, int] | None:
    """The record that starts at ``at`` and its end, if it passes its checks."""
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0 or not _VERSION.match(data, at):
        return None
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,15}", size):
        return None
    start, end = head_end + 4, head_end + 4 + int(size)
    block = data[start:end]
    if data[end : end + 4] != b"\r\n\r\n":
        return None
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    length = len(payload)
    if kind == "response" and declared and declared != f"sha1:{digest(payload)}":
        return None
    if kind == "revisit":
        stated = re.search(rb"(?i)\ncontent-length:\s*([0-9]+)", http)
        length = int(stated[1]) if stated else None
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_bytes": length,
        "payload_digest": declared.removeprefix("sha1:") or digest(payload),
        "payload": payload if kind == "response" else None,
    }, end + 4


def _inflated(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What a gzip member holds as far as it can be read, and its end if it is whole."""
    engine, out = zlib.decompressobj(31), []
    try:
        for k in range(at, len(data), 1 << 16):
            out.append(engine.decompress(data[k : k + (1 << 16)]))
            if engine.eof:
                return b"".join(out), min(k + (1 << 16), len(data)) - len(engine.unused_data)
    except zlib.error:
        pass
    return b"".join(out), None


def salvaged(data: bytes) -> Iterator[tuple[str, int, int, dict]]:
    """("record" or "gap", offset, length, fields) of an archive, in order, covering every byte.

    Records inside a gzip member have the member's offset and length.
    """
    at = gap = 0
    while at < len(data):
        found, end = [], None
        if data.startswith(b"\x1f\x8b\x08", at):
            inner, end = _inflated(data, at)
            parts = [p for p in salvaged(inner)] if inner else []
            found = [fields for kind, _, _, fields in parts if kind == "record"]
            if end is None and found:  # records before the damage; the rest of the member is a gap
                end = min([m.start() for m in [_START.search(data, at + 1)] if m] + [len(data)])
                damaged = True
            else:
                damaged = any(kind == "gap" for kind, *_ in parts)
            if end is not None and (found or not inner):
                if gap < at:
                    yield "gap", gap, at - gap, {}
                for fields in found:
                    yield "record", at, end - at, fields
                if damaged:
                    yield "gap", at, end - at, {}
                at = gap = end
                continue
        elif (one := _plain(data, at)) is not None:
            if gap < at:
                yield "gap", gap, at - gap, {}
            yield "record", at, one[1] - at, one[0]
            at = gap = one[1]
            continue
        following = _START.search(data, at + 1)
        at = following.start() if following else len(data)
    if gap < len(data):
        yield "gap", gap, len(data) - gap, {}


_SCHEMA = (
    "archive string, kind string, offset bigint, length bigint, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each record and each quarantined gap of the archives below ``path``.

    ``payload`` is null unless asked for. Files are read whole, one at a time.
    """
    names = [part.split()[0] for part in _SCHEMA.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for archive, content in zip(batch["path"].to_pylist(), batch["content"]):
                held, size = [], 0
                for kind, offset, length, fields in salvaged(content.as_py()):
                    payload = fields.get("payload") if payloads else None
                    held.append({**dict.fromkeys(names), **fields, "archive": archive, "kind": kind,
                                 "offset": offset, "length": length, "payload": payload})
                    size += len(payload or b"")
                    if size > 4 << 20 or len(held) >= 1000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)


    schema = to_arrow_schema(StructType.fromDDL(_SCHEMA))
    return files.mapInArrow(rows, _SCHEMA)
