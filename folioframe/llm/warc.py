"""WARC: legacy ARC archives are converted to WARC, written with revisits, and read back.

ARC files come in two versions that differ in the fields of a record's header line; the version block at the
start declares which. A record is a header line, as many bytes as the line declares, and a newline:

* version 1: url, ip address, 14-digit date, content type, length;
* version 2: url, ip address, date, content type, result code, checksum, location, offset, file name, length.

The fields are read from the right, so a url with spaces is kept; a date with fewer digits is
completed; a block shorter than its declared length is marked truncated. For each record the converter makes up

* WARC-Record-ID: a name-based UUID of a key, so that converting again gives the same ids;
* WARC-Date: the date in ISO 8601; WARC-Target-URI and WARC-IP-Address as they are;
* WARC-Type: warcinfo for the version block, response for a block that starts with an HTTP status line, else resource;
* digests: SHA-1 in base32 of the block and, for a response, of the payload after the HTTP header.

Legacy files in storage are converted by convert_archives; what is no header there is reported and skipped up to the next header.

Archives are written by Spark's text writer: one value is one record as bytes, the line separator is the blank
line pair that ends a WARC record, and files are gzip streams. Any file system that Spark writes to will do.

Edge cases: a null payload is empty; a null or odd url is percent-encoded or empty; repeated rows are records of their
own, and equal ids with equal payloads are all responses; a null id is never a revisit, as nothing can tell its
record from others; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.shared import work_dir

END = b"\r\n\r\n"
#: A file has so many records at most, and fewer if they are long: about FILE_BYTES by their mean.
RECORDS_A_FILE, FILE_BYTES = 2_000, 256_000_000
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_V1 = re.compile(rb"^(?P<url>.*) (?P<ip>\S+) (?P<date>\d{4,14}) (?P<type>.*?) (?P<length>\d+)$")
_V2 = re.compile(
    rb"^(?P<url>.*) (?P<ip>\S+) (?P<date>\d{4,14}) (?P<type>.*?) (?P<code>\S+) (?P<checksum>\S+) (?P<location>\S+) (?P<offset>\d+) (?P<file>\S+) (?P<length>\d+)$"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    kind: str
    block: bytes
    version: int = 1
    truncated: bool = False
    extra: dict[str, str] = field(default_factory=dict)


def arc_bytes(records: Iterable[ArcRecord], version: int = 1, name: str = "legacy.arc") -> bytes:
    """An ARC file of the version; what the converter is tested and fed with."""
    fields = "URL IP-address Archive-date Content-type Archive-length"
    if version == 2:
        fields = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
    body = f"{version} 0 folioframe\n{fields}\n".encode()
    out = bytearray()

    def put(url: str, ip: str, date: str, kind: str, block: bytes, code: str = "-") -> None:
        middle = f"{code} - - {len(out)} {name} " if version == 2 else ""
        out.extend(f"{url} {ip} {date} {kind} {middle}{len(block)}\n".encode() + block + b"\n")

    put(f"filedesc://{name}", "0.0.0.0", "19960101000000", "text/plain", body)
    for r in records:
        put(r.url, r.ip, r.date, r.kind, r.block, r.extra.get("code", "200"))
    return bytes(out)


def _url_text(raw: bytes) -> str:
    """A url's bytes as text; those that are no UTF-8 are percent-encoded."""
    return re.sub(r"[\udc80-\udcff]", lambda m: f"%{ord(m[0]) - 0xDC00:02X}", raw.decode("utf-8", "surrogateescape"))


def parse_arc(source: bytes | BinaryIO, on_bad: Callable[[int, bytes, str], None] | None = None) -> Iterator[ArcRecord]:
    """The records of an ARC file, plain or gzip, the version block first.

    A line where a header should be that is none raises ValueError; with on_bad it is reported (its offset in the plain file, its first
    bytes, what is wrong) and lines are skipped until one is a header. A gzip stream that breaks off ends the file and is reported too.
    """
    stream = io.BytesIO(source) if isinstance(source, bytes) else source
    start = stream.read(2)
    stream.seek(0)
    if start == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    version, at, lost = 1, 0, False
    try:
        while line := stream.readline():
            begin, at = at, at + len(line)
            line = line.rstrip(b"\r\n")
            if not line:
                continue
            match = _V2.match(line) if version == 2 else _V1.match(line)
            if not match:
                # The version block's own line has version-1 fields in some version-2 files.
                match = _V1.match(line)
            if not match:
                if on_bad is None:
                    raise ValueError(f"no ARC header line: {line[:80]!r}")
                if not lost:
                    on_bad(begin, line[:200], "no header line")
                lost = True
                continue
            lost = False
            raw = match.groupdict()
            url = _url_text(raw.pop("url"))
            got = {k: v.decode("utf-8", "replace") for k, v in raw.items()}
            length = int(got.pop("length"))
            block = stream.read(length)
            at += len(block)
            if url.startswith("filedesc:"):
                version = 2 if block[:1] == b"2" else 1
            if on_bad is not None and len(block) < length:
                on_bad(begin, line[:200], "block shorter than declared")
            yield ArcRecord(url, got.pop("ip"), got.pop("date"), got.pop("type"), block, version, len(block) < length, got)
    except (EOFError, OSError, zlib.error) as e:
        if on_bad is None:
            raise
        on_bad(at, b"", f"stream breaks off: {e}"[:200])


def iso_date(digits: str) -> str:
    """ISO 8601 of a date of 4 to 14 digits; missing parts are the first of their kind."""
    d = digits + "00000101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, key)}>"


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block after the HTTP header, or all of it."""
        if self.headers.get("Content-Type", "").startswith("application/http"):
            return self.block.partition(END)[2]
        return self.block

    def without_end(self) -> bytes:
        """The record but for the blank lines that end it."""
        head = "".join(f"{k}: {v}\r\n" for k, v in self.headers.items())
        return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + self.block


def convert(record: ArcRecord, key: str | None = None) -> WarcRecord:
    """The WARC record of an ARC record. key: what the id is made of; by default url, date and digest."""
    block = record.block
    http = block.startswith(b"HTTP/") and END in block
    kind = "warcinfo" if record.url.startswith("filedesc:") else "response" if http else "resource"
    digest = sha1_base32(block)
    headers = {"WARC-Type": kind, "WARC-Record-ID": record_id(key or f"{record.url} {record.date} {digest}"), "WARC-Date": iso_date(record.date)}
    if kind == "warcinfo":
        headers["WARC-Filename"] = record.url.removeprefix("filedesc://")
    else:
        headers["WARC-Target-URI"] = record.url
        if record.ip != "0.0.0.0":
            headers["WARC-IP-Address"] = record.ip
    headers["Content-Type"] = "application/http; msgtype=response" if http else record.kind
    headers["WARC-Block-Digest"] = f"sha1:{digest}"
    if http:
        headers["WARC-Payload-Digest"] = f"sha1:{sha1_base32(block.partition(END)[2])}"
    if record.truncated:
        headers["WARC-Truncated"] = "length"
    headers["Content-Length"] = str(len(block))
    return WarcRecord(headers, block)


def revisit(record: WarcRecord, of_key: str) -> WarcRecord:
    """The record with its HTTP header alone, referring to the record of of_key for the payload."""
    head = record.block.partition(END)[0] + END if record.headers["Content-Type"].startswith("application/http") else b""
    headers = record.headers | {
        "WARC-Type": "revisit",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "WARC-Refers-To": record_id(of_key),
        "WARC-Block-Digest": f"sha1:{sha1_base32(head)}",
        "Content-Length": str(len(head)),
    }
    return WarcRecord(headers, head)


def parse_warc(stream: BinaryIO) -> Iterator[WarcRecord]:
    """The records of a WARC stream that is not compressed, one at a time."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        yield WarcRecord(headers, stream.read(int(headers["Content-Length"])))


def _url(text: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "")


def _convert_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, url, payload, original) to WARC records: through an ARC archive of a few rows, of either version."""
    for batch in batches:
        columns = [batch.column(i) for i in range(4)]
        for begin in range(0, batch.num_rows, 256):
            rows = list(zip(*(c.slice(begin, 256).to_pylist() for c in columns), strict=True))
            legacy = []
            for key, url, text, _ in rows:
                body = (text or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\nX-Key: {'' if key is None else key}\r\n\r\n"
                legacy.append(ArcRecord(_url(url), "0.0.0.0", "20240101", "text/html", head.encode() + body))
            archive = arc_bytes(legacy, 1 + begin // 256 % 2)
            out = []
            for (key, _, _, original), arc in zip(rows, (r for r in parse_arc(archive) if not r.url.startswith("filedesc:")), strict=True):
                made = convert(arc, None if key is None else f"key {key}")
                if original is not None:
                    made = revisit(made, f"key {original}")
                    made.headers["X-Refers-To-Key"] = str(original)
                out.append(made.without_end())
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])


def _write(records: DataFrame, path: str, records_a_file: int) -> None:
    """A column `record` of bytes as gzip files of WARC records."""
    value = records.select(F.col("record").cast("string").alias("value"))
    value.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_a_file).text(path)


def write_archives(rows: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, original_col: str, records_a_file: int = RECORDS_A_FILE) -> None:
    """A WARC record per row, in gzip files below path; original_col: the id that a revisit refers to, else null."""
    picked = rows.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload"), F.col(original_col).alias("original"))
    _write(picked.mapInArrow(_convert_rows, "record binary"), path, records_a_file)


def _convert_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, offset, record, line, problem) of ARC files: a row for each record converted and for each problem met."""
    names = ["file", "offset", "record", "line", "problem"]
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.string()]
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            out: list[tuple] = []
            for record in parse_arc(io.BytesIO(content.as_py()), lambda at, line, what: out.append((name, at, None, line, what))):  # noqa: B023
                out.append((name, None, convert(record).without_end(), None, None))
                if len(out) >= 500:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out.clear()
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str) -> DataFrame:
    """Convert the ARC files (plain or gzip, of either version) below arc_path to WARC archives below warc_path.

    Returns what could not be read: (file, offset, line, problem). A file is one task's work, as a legacy archive is of a few hundred MB by
    convention; a bad header costs the records up to the next good one and no more.
    """
    got = spark.read.format("binaryFile").load(arc_path).select("path", "content").mapInArrow(_convert_files, "file string, offset bigint, record binary, line binary, problem string")
    _write(got.where("record is not null"), warc_path, RECORDS_A_FILE)
    return got.where("problem is not null").select("file", "offset", "line", "problem")


class _Inflated(io.RawIOBase):
    """A gzip stream of any number of members, inflated as it is read."""

    def __init__(self, data: bytes):
        self.data, self.at, self.member, self.ready = memoryview(data), 0, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.ready and (self.at < len(self.data) or self.member.unconsumed_tail):
            if self.member.eof:
                self.at -= len(self.member.unused_data)
                self.member = zlib.decompressobj(31)
            piece = self.member.unconsumed_tail or self.data[self.at : self.at + 65536]
            if not self.member.unconsumed_tail:
                self.at += len(piece)
            self.ready = self.member.decompress(piece, 1 << 20)
        n = min(len(target), len(self.ready))
        target[:n] = self.ready[:n]
        self.ready = self.ready[n:]
        return n


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            names = ("key", "type", "target", "bytes", "digest", "refers_to", "record_id", "date")
            out: list[tuple] = []
            for r in parse_warc(io.BufferedReader(_Inflated(content.as_py()), 1 << 20)):
                if r.headers["WARC-Type"] == "warcinfo":
                    continue
                head = dict(x.partition(": ")[::2] for x in r.block.partition(END)[0].decode("utf-8", "replace").split("\r\n")[1:])
                kind = r.headers["WARC-Type"]
                if kind == "response":
                    size, digest = len(r.payload), sha1_base32(r.payload)
                else:
                    size, digest = int(head.get("Content-Length", 0)), r.headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                out.append((head.get("X-Key") or None, kind, r.headers.get("WARC-Target-URI"), size, digest, r.headers.get("X-Refers-To-Key"), r.headers["WARC-Record-ID"], r.headers["WARC-Date"]))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.record_batch([pa.array(c, pa.int64() if n == "bytes" else pa.string()) for n, c in zip(names, columns, strict=True)], list(names))


def read_archives(spark, path: str) -> DataFrame:
    """The records of the archives below path: key, type, target, bytes and digest of the full payload, refers_to, record_id, date.

    A response's size and digest are taken from the payload read, a revisit's from its headers.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read, "key string, type string, target string, bytes bigint, digest string, refers_to string, record_id string, date string")


def originals(rows: DataFrame, id_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """(id, digest, original) of each row whose payload an equal one with a lesser id has: digests alone are shuffled."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    slim = rows.where(F.col(id_col).isNotNull() & (F.octet_length(payload) >= least_bytes)).select(F.col(id_col).alias("id"), F.sha1(payload).alias("digest"))
    least = slim.groupBy("digest").agg(F.min("id").alias("original"), F.max("id").alias("last")).where("original <> last").select("digest", "original")
    return slim.join(least, "digest").where("id <> original").select("id", "digest", "original").distinct()


def archive_and_read(rows: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """Write rows as archives with revisits, then read the archives: (id, payload_bytes, payload_digest, record_type, refers_to, ...)."""
    spark = rows.sparkSession
    picked = rows.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).cast("string").alias("payload"))
    kind = picked.schema["id"].dataType
    found = originals(picked, "id", "payload", least_bytes).withColumnsRenamed({"id": "r_id", "digest": "r_digest"})
    payload = F.coalesce("payload", F.lit("")).cast("binary")
    # The digest is computed again for ids that have a revisit alone: equal ids may have different payloads.
    with_original = picked.join(found.hint("shuffle_hash"), (F.col("id") == F.col("r_id")) & (F.sha1(payload) == F.col("r_digest")), "left")
    path = work_dir(spark, "warc")
    size = picked.agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes")).first()
    records_a_file = max(1, min(RECORDS_A_FILE, int(FILE_BYTES * size["n"] / max(1, size["bytes"] or 0))))
    write_archives(with_original, path, "id", "url", "payload", "original", records_a_file)
    got = read_archives(spark, path)
    return got.select(
        F.col("key").cast(kind).alias(id_col),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
        F.col("target").alias("target_uri"),
        F.col("record_id").alias("warc_record_id"),
        F.col("date").alias("warc_date"),
    )
