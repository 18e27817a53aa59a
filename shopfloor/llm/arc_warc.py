"""Converter from legacy ARC archives to WARC.

An ARC file begins with a version block, whose first line gives the version and with it the fields of
each record's header line: five in version 1, ten in version 2; the last is the length of what
follows. URLs may hold spaces, so fields are taken from the right. WARC needs what ARC lacks:
identifiers (made from page and payload, so reruns agree), timestamps (from the 14 digits), types
(warcinfo for the version block, response for HTTP messages, resource for the rest; revisit for a
payload that another record has) and digests.

Both kinds of archives have a gzip member per record. They are written by Spark's text writer, a row an
archive of about ARCHIVE_BYTES and a file a row, which adds a line end to each file, and read as binary
files; so any store that Spark reaches will do, and a task holds one archive at a time.

Cases: null html is empty; a null url becomes ``urn:page:`` with the id, white space in one is percent
encoded; a null page_id stays null and counts as smaller than any id (if equal payloads have no id at
all, each is a response); of repeated rows with the largest id all are responses; an empty table gives
none; extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.text import saved, shared_folder

ARCHIVE_BYTES = 8 << 20
REVISIT_BYTES = 1000
CAPTURED, ADDRESS = "20240101000000", "0.0.0.0"
#: Fields of a header line by version. Fixed values.
FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"],
}
FIELD_LINES = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class ArcRecord:
    fields: dict[str, str]
    content: bytes


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """Contents of the gzip members one by one; plain data as it is. White space may follow the last."""
    if not data.startswith(b"\x1f\x8b"):
        if data.strip():
            yield data
        return
    view, at = memoryview(data), 0
    while data[at:at + 2] == b"\x1f\x8b":
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(data):
                raise ValueError("a gzip member ends early")
            part = view[at:at + step]
            parts.append(z.decompress(part))
            at += len(part) - len(z.unused_data)
        yield b"".join(parts)
    if data[at:].strip():
        raise ValueError("no gzip member where one should begin")


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """All records of an archive, the version block first."""
    names = None
    for member in members(data):
        at = 0
        while at < len(member):
            if member[at:at + 1] in b"\r\n":
                at += 1
                continue
            end = member.index(b"\n", at)
            line = member[at:end].decode("utf-8", "replace").rstrip("\r")
            # the version block's own line always has the fields of version 1
            fields = FIELDS[1] if names is None else names
            values = line.rsplit(" ", len(fields) - 1)
            if len(values) < len(fields) or not values[-1].isdigit():
                raise ValueError(f"not a header line of this version: {line[:200]!r}")
            length = int(values[-1])
            content = member[end + 1:end + 1 + length]
            if len(content) < length:
                raise ValueError(f"{length} bytes declared, {len(content)} there: {line[:200]!r}")
            record = ArcRecord(dict(zip(fields, values, strict=True)), content)
            if names is None:
                version = re.match(rb"(\d+) ", content)
                if not version or int(version[1]) not in FIELDS:
                    raise ValueError(f"unknown version block: {content[:80]!r}")
                names = FIELDS[int(version[1])]
            yield record
            at = end + 1 + length


def arc_version_block(version: int, name: str) -> bytes:
    content = f"{version} 0 pages\n".encode() + FIELD_LINES[version] + b"\n"
    return f"filedesc://{name} {ADDRESS} {CAPTURED} text/plain {len(content)}\n".encode() + content + b"\n"


def arc_record(version: int, url: str, content: bytes, offset: int, name: str) -> bytes:
    url = re.sub(r"\s", lambda m: f"%{ord(m.group()):02X}", url)
    checksum = hashlib.md5(content).hexdigest()
    extra = f" 200 {checksum} - {offset} {name}" if version == 2 else ""
    return f"{url} {ADDRESS} {CAPTURED} text/html{extra} {len(content)}\n".encode() + content + b"\n"


def http_message(page_id: int | None, payload: bytes) -> bytes:
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{page}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def http_parts(message: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """The header block with its empty line, its fields by lower-case name, and the payload."""
    head, mark, payload = message.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return head + mark, fields, payload


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def timestamp(digits: str) -> str:
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", base32(hashlib.sha1(block).hexdigest())),
              ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive."""
    for member in members(data):
        at = 0
        while at < len(member):
            end = member.index(b"\r\n\r\n", at)
            lines = member[at:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
            block = member[end + 4:end + 4 + length]
            if len(block) < length:
                raise ValueError("a record ends early")
            yield fields, block
            at = end + 8 + length


def archives(items: Iterable, begin, make, limit: int = ARCHIVE_BYTES) -> Iterator[bytes]:
    """Archives of compressed records: ``begin(n)`` gives what comes first in the n-th,
    ``make(item, n, offset)`` the record of an item at that place."""
    n, parts, size = 0, [], 0
    for item in items:
        if not parts:
            parts = [gzip_member(begin(n))]
            size = len(parts[0])
        parts.append(gzip_member(make(item, n, size)))
        size += len(parts[-1])
        if size >= limit:
            yield b"".join(parts)
            n, parts = n + 1, []
    if parts:
        yield b"".join(parts)


def arc_archives(pages: Iterable[tuple], name: str, limit: int = ARCHIVE_BYTES) -> Iterator[bytes]:
    """ARC archives of (page id, url, html); versions 1 and 2 by turns."""
    def version(n: int) -> int:
        return 1 + (n + ord(name[0])) % 2

    def make(page: tuple, n: int, offset: int) -> bytes:
        page_id, url, html = page
        return arc_record(version(n), url or f"urn:page:{page_id}", http_message(page_id, html or b""), offset, name)

    return archives(pages, lambda n: arc_version_block(version(n), name), make, limit)


def _one_by_one(blobs: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    for blob in blobs:
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.large_binary())], ["archive"])


def write_archives(rows: DataFrame, path: str) -> None:
    rows.select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def archive_files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def pages_to_arc(pages: DataFrame, path: str) -> None:
    """Writes ARC archives of the pages."""
    def rows(batches):
        pages = (tuple(batch.column(i)[k].as_py() for i in range(3)) for batch in batches for k in range(batch.num_rows))
        return _one_by_one(arc_archives(pages, f"{uuid.uuid4().hex}.arc.gz"))

    pages = pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("binary"))
    write_archives(pages.mapInArrow(rows, "archive binary"), path)


def arc_contents(data: bytes) -> Iterator[ArcRecord]:
    """All records of an archive but the version block."""
    return (record for record in read_arc(data) if not record.fields["url"].startswith("filedesc:"))


def arc_parts(record: ArcRecord) -> tuple[int | None, bytes]:
    """Page id and payload of a record."""
    if not record.content.startswith(b"HTTP/"):
        return None, record.content
    _, http, payload = http_parts(record.content)
    page = http.get("x-page-id")
    return None if page is None else int(page), payload


def arc_records(files: DataFrame) -> DataFrame:
    """path, place (in the archive), page_id, payload_bytes and digest (of the payload) of all records."""
    names = ["path", "place", "page_id", "payload_bytes", "digest"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def rows(batches):
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                out: list[list] = [[] for _ in names]
                for place, record in enumerate(arc_contents(data.as_py())):
                    page, payload = arc_parts(record)
                    row = (path, place, page, len(payload), hashlib.sha1(payload).hexdigest())
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    return files.mapInArrow(rows, "path string, place int, page_id long, payload_bytes long, digest string")


def _convert(record: ArcRecord, response: int | None) -> bytes:
    """A WARC record; a revisit of the response with that page id, if there is one."""
    page_id, payload = arc_parts(record)
    digest, message = hashlib.sha1(payload).hexdigest(), record.content
    fields = [("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", timestamp(record.fields["date"])),
              ("WARC-Target-URI", record.fields["url"]), ("WARC-IP-Address", record.fields["ip"]),
              ("WARC-Payload-Digest", base32(digest))]
    if not message.startswith(b"HTTP/"):
        return warc_record("resource", [*fields, ("Content-Type", "application/octet-stream")], message)
    fields.append(("Content-Type", "application/http;msgtype=response"))
    if response is None:
        return warc_record("response", fields, message)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(response, digest))]
    return warc_record("revisit", fields, http_parts(message)[0])


def arc_to_warc(spark, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> None:
    """Converts all archives of a folder. Of equal payloads of ``least`` bytes or more, the record with
    the largest page id is a response and the others revisit it.

    Only digests meet by payload; which records of an archive are revisits comes to the archive by its
    path, so a common payload is in no task's way."""
    files = archive_files(spark, arc_path)
    records = saved(arc_records(files)).where(F.col("payload_bytes") >= least)
    responses = records.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    responses = saved(responses.where("n > 1 and response is not null").drop("n"))
    revisits = records.join(responses, "digest").where(~F.col("page_id").eqNullSafe(F.col("response")))
    revisits = saved(revisits.groupBy("path").agg(F.collect_list(F.struct("place", "response")).alias("revisits")))

    def rows(batches):
        info = b"software: arc converter\r\nformat: WARC File Format 1.1\r\n"
        name = uuid.uuid4()

        def begin(n: int) -> bytes:
            return warc_record("warcinfo", [
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(name, str(n))}>"), ("WARC-Date", timestamp(CAPTURED)),
                ("Content-Type", "application/warc-fields")], info)

        def converted():
            for batch in batches:
                for i in range(batch.num_rows):
                    found = batch.column("revisits")[i].as_py() or []
                    response = {r["place"]: r["response"] for r in found}
                    for place, record in enumerate(arc_contents(batch.column("content")[i].as_py())):
                        yield _convert(record, response.get(place))

        return _one_by_one(archives(converted(), begin, lambda record, n, offset: record))

    marked = files.join(revisits, "path", "left")
    write_archives(marked.select("content", "revisits").mapInArrow(rows, "archive binary"), warc_path)


def warc_records(files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, record_id and refers of all records but
    warcinfo. Digests of blocks and of payloads that are there are checked."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers"]

    def rows(batches):
        for batch in batches:
            for data in batch.column("content"):
                out = []
                for fields, block in read_warc(data.as_py()):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    _, http, payload = http_parts(block) if block.startswith(b"HTTP/") else (b"", {}, block)
                    size = int(http["content-length"]) if kind == "revisit" else len(payload)
                    if fields["WARC-Block-Digest"] != base32(hashlib.sha1(block).hexdigest()) or (
                            kind != "revisit" and hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"digest of {fields['WARC-Record-ID']} doesn't match")
                    page = http.get("x-page-id")
                    out.append((None if page is None else int(page), size, digest, kind,
                                fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64()] * 2 + [pa.string()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    return files.mapInArrow(rows, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "record_id string, refers string")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """pages -> ARC -> WARC -> page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/archives/{uuid.uuid4().hex}"
    pages_to_arc(pages, f"{folder}/arc")
    arc_to_warc(spark, f"{folder}/arc", f"{folder}/warc")
    records = saved(warc_records(archive_files(spark, f"{folder}/warc")))
    # the identifier has the digest in it, so only records with a page can be referred to
    referred = saved(records.where(f"record_type = 'response' and payload_bytes >= {REVISIT_BYTES}").select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to")).distinct())
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    others = records.where("refers is null").withColumn("refers_to", F.lit(None).cast("long"))
    return others.select(*columns).union(records.where("refers is not null").join(referred, "refers", "left").select(*columns))


SQL = """
WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS latest FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM m
"""
