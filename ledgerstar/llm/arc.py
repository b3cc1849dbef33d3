"""Convert legacy ARC archives to WARC: parse, decide revisits over all files, write, read.

An ARC file begins with a version block that names the fields of its header lines; version
1 lines have five fields, version 2 lines ten. A record is such a line and as many bytes as
it declares. `convert` reads every archive twice. The first reading gives one narrow row
per record with the digest of its payload; rows are counted per digest, and only payloads
held more than once are joined back, which adaptive execution splits where one payload is
very common. The second reading writes, archive by archive, a WARC file: a warcinfo record,
then `response` records (`resource` where the block is no HTTP message) and, for payloads
that another record holds, `revisit` records with the HTTP header only. No payload is
shuffled on its own; archives travel compressed, and no archive is larger than
`segment_bytes` and one record.

Synthesised fields: record ids are version-8 UUIDs that hold the row id and bits of the
digest; 14-digit dates become ISO timestamps; digests are base32 SHA-1 of block and payload.

Defined cases: a null html is an empty payload, a null url becomes `urn:x-none`; a null
page_id gives no id header: such a record revisits the largest id if there is one, else
all are responses; rows that share the largest page_id of a payload are all responses;
an empty table gives no archives and no rows; other columns are not read. Declared lengths
that do not fit the data raise an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.llm.common import fresh_path, in_batches, rows_of, stored

# Field names of ARC header lines by version, and WARC names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = "X-Page-Id"
ARCHIVE_DATE = "20240101000000"
SEGMENT_BYTES = 8 << 20

_SEGMENT = pa.schema([("segment", pa.binary())])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC

class ArcRecord(NamedTuple):
    fields: dict[str, str]
    block: bytes


def arc_header(version: int, url: str, mime: str, length: int, offset: int, name: str, block: bytes) -> bytes:
    start = [url, "0.0.0.0", ARCHIVE_DATE, mime]
    if version == 2:
        start += ["200", hashlib.md5(block).hexdigest(), "-", str(offset), name]
    return (" ".join([*start, str(length)]) + "\n").encode()


class ArcFile:
    """One archive in the making."""

    def __init__(self, version: int, number: int):
        self.version, self.name = version, f"part-{number}.arc"
        body = f"{version} 0 pages\n{ARC_FIELDS[version]}\n\n".encode()
        self.data = bytearray()
        self.add(f"filedesc://{self.name}", "text/plain", body)

    def add(self, url: str, mime: str, block: bytes) -> None:
        self.data += arc_header(self.version, url, mime, len(block), len(self.data), self.name, block)
        self.data += block + b"\n"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an archive, the version block left out."""
    names, at = None, 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("an ARC header line does not end")
        line = data[at:end].decode("utf-8", "replace").split(" ")
        begin = end + 1
        length = int(line[-1])
        if length < 0 or begin + length > len(data):
            raise ValueError("an ARC record declares more bytes than there are")
        block = bytes(data[begin : begin + length])
        at = begin + length
        while data[at : at + 1] == b"\n":
            at += 1
        if names is None:
            about, fields = block.decode().split("\n")[:2]
            names = fields.split(" ")
            if int(about.split(" ")[0]) not in ARC_FIELDS or len(line) != len(names):
                raise ValueError("an ARC file of unknown version")
            continue
        if len(line) != len(names):
            raise ValueError("an ARC header line does not have the fields of its version")
        yield ArcRecord(dict(zip(names, line)), block)


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes] | None:
    """Header fields (lower-case names), header bytes and payload of an HTTP message."""
    if not block.startswith(b"HTTP/"):
        return None
    cut = block.find(b"\r\n\r\n")
    if cut < 0:
        return None
    lines = block[:cut].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, block[: cut + 4], block[cut + 4 :]


def archive_pages(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write pages as ARC files of both versions, several per task, below `path`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments():
            files: dict[int, ArcFile] = {}
            made = 0
            for number, (page_id, url, html) in enumerate(rows_of(batches, "page_id", "url", "html")):
                version = number % 2 + 1
                payload = (html or "").encode()
                header = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                header += "" if page_id is None else f"{ID_HEADER}: {page_id}\r\n"
                header += f"Content-Length: {len(payload)}\r\n\r\n"
                if version not in files:
                    made += 1
                    files[version] = ArcFile(version, made)
                url = "urn:x-none" if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=%~-._") or "-"
                files[version].add(url, "text/html", header.encode() + payload)
                if len(files[version].data) >= segment_bytes:
                    yield (bytes(files.pop(version).data),)
            for file in files.values():
                yield (bytes(file.data),)

        yield from in_batches(segments(), _SEGMENT, size=1)

    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    _write(source.mapInArrow(work, "segment binary"), path, "\n")


def _write(segments: DataFrame, path: str, ending: str) -> None:
    """One compressed file per row; `ending` is what a file's last record ends with."""
    cut = F.expr(f"substring(segment, 1, octet_length(segment) - {len(ending)})")
    segments.select(cut.cast("string").alias("value")).write.mode("errorifexists").option(
        "lineSep", ending
    ).option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


# ---- WARC

def record_id(row_id: int | None, digest: str, seed: str = "") -> str:
    """A version-8 UUID with all 64 bits of the row id; without one, a name-based UUID."""
    if row_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{seed} {digest}')}>"
    bits = row_id & 0xFFFFFFFFFFFFFFFF
    tail = int.from_bytes(hashlib.sha1(digest.encode()).digest()[:8], "big") >> 6
    whole = (bits >> 16) << 80 | 8 << 76 | (bits >> 4 & 0xFFF) << 64 | 2 << 62 | (bits & 0xF) << 58 | tail
    return f"<urn:uuid:{uuid.UUID(int=whole)}>"


def row_id_of(record: str) -> int | None:
    """The row id in a record id; None for a name-based one."""
    whole = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if whole >> 76 & 0xF != 8:
        return None
    bits = (whole >> 80) << 16 | (whole >> 64 & 0xFFF) << 4 | whole >> 58 & 0xF
    return bits - (bits >> 63 << 64)


def iso_date(digits: str) -> str:
    """`YYYYMMDDhhmmss`, or a head of it, as a WARC date."""
    full = digits + "00000101000000"[len(digits):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        cut = data.find(b"\r\n\r\n", at)
        if cut < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("a WARC record does not begin where the last one ends")
        lines = data[at:cut].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        block = data[cut + 4 : cut + 4 + length]
        at = cut + 4 + length
        if len(block) != length or data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record declares a wrong length")
        at += 4
        yield fields, block


def _converted(record: ArcRecord, refers_to: int | None) -> bytes:
    """The WARC record of an ARC record; `refers_to` is the row id that holds its payload."""
    fields, block = record
    parts = http_parts(block)
    head, payload = ({}, block) if parts is None else (parts[0], parts[2])
    digest = sha1_base32(payload)
    own = head.get(ID_HEADER.lower())
    kind = "resource" if parts is None else "response" if refers_to is None else "revisit"
    if kind == "revisit":
        block = parts[1]
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(None if own is None else int(own), digest, fields["URL"])),
        ("WARC-Date", iso_date(fields["Archive-date"])), ("WARC-Target-URI", fields["URL"]),
        ("WARC-IP-Address", fields["IP-address"]), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
    ]
    if kind == "revisit":
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    mime = fields["Content-type"] if kind == "resource" else "application/http; msgtype=response"
    return warc_record([*lines, ("Content-Type", mime)], block)


_FOUND = pa.schema([
    ("archive", pa.string()), ("place", pa.int64()), ("row_id", pa.int64()),
    ("digest", pa.binary()), ("payload_bytes", pa.int64()),
])


def _payloads(archives: DataFrame) -> DataFrame:
    """One narrow row per HTTP record of the archives."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for path, content in rows_of(batches, "path", "content"):
                for place, record in enumerate(parse_arc(gzip.decompress(content))):
                    parts = http_parts(record.block)
                    if parts is not None:
                        own = parts[0].get(ID_HEADER.lower())
                        yield (
                            path, place, None if own is None else int(own),
                            hashlib.sha1(parts[2]).digest(), len(parts[2]),
                        )

        yield from in_batches(rows(), _FOUND)

    kind = "archive string, place long, row_id long, digest binary, payload_bytes long"
    return archives.mapInArrow(work, kind)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """Write a WARC file for every ARC file below `arc_path`."""
    archives = _files(spark, arc_path)
    found = stored(_payloads(archives), "arc-payloads")
    held = stored(
        found.filter(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.max("row_id").alias("holder"))
        .filter((F.col("n") > 1) & F.col("holder").isNotNull()).drop("n"),
        "arc-holders",
    )
    revisits = found.join(held, ["digest", "payload_bytes"]).filter(
        F.col("row_id").isNull() | (F.col("row_id") < F.col("holder"))
    )
    decided = revisits.groupBy("archive").agg(
        F.collect_list(F.struct("place", "holder")).alias("revisits")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments():
            for content, again in rows_of(batches, "content", "revisits"):
                holder = {r["place"]: r["holder"] for r in again or ()}
                about = b"software: arc conversion\r\nformat: WARC File Format 1.1\r\n"
                out = bytearray(warc_record([
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", record_id(None, sha1_base32(content), "warcinfo")),
                    ("WARC-Date", iso_date(ARCHIVE_DATE)), ("Content-Type", "application/warc-fields"),
                ], about))
                for place, record in enumerate(parse_arc(gzip.decompress(content))):
                    out += _converted(record, holder.get(place))
                yield (bytes(out),)

        yield from in_batches(segments(), _SEGMENT, size=1)

    joined = archives.join(decided, F.col("path") == F.col("archive"), "left")
    _write(joined.select("content", "revisits").mapInArrow(work, "segment binary"), warc_path, "\r\n\r\n")


_READ = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def read_records(spark: SparkSession, warc_path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all HTTP records."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (content,) in rows_of(batches, "content"):
                for fields, block in parse_warc(gzip.decompress(content)):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    if f"sha1:{sha1_base32(block)}" != fields["warc-block-digest"]:
                        raise ValueError("a WARC block does not fit its digest")
                    head, _, payload = http_parts(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response":
                        length, refers = len(payload), None
                        if sha1_base32(payload) != digest:
                            raise ValueError("a WARC payload does not fit its digest")
                    else:
                        length = int(head["content-length"])
                        refers = row_id_of(fields["warc-refers-to"])
                    yield row_id_of(fields["warc-record-id"]), length, digest, kind, refers

        yield from in_batches(rows(), _READ)

    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _files(spark, warc_path).select("content").mapInArrow(work, kind)


def pages_through_archives(pages: DataFrame, least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Pages to ARC files, these to WARC files, and the records read back from those."""
    spark = pages.sparkSession
    arc, warc = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    archive_pages(pages, arc, segment_bytes)
    convert(spark, arc, warc, least_bytes)
    return read_records(spark, warc)
