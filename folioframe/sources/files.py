"""Readers of small text formats and of binary record files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.records import model


def read_map(spark: SparkSession, path: str, separator: str = "=") -> DataFrame:
    """(key, value) of lines `key=value;`: backslashes escape, text after # and blank lines go."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    pattern = rf"^((?:[^{separator}\\]|\\.)*){separator}((?:[^;\\]|\\.)*);?\s*$"
    part = lambda k: F.regexp_replace(F.trim(F.regexp_extract("value", pattern, k)), r"\\(.)", "$1")
    return lines.where(F.col("value").rlike(pattern)).select(part(1).alias("key"), part(2).alias("value"))


def read_beacon(spark: SparkSession, path: str) -> DataFrame:
    """(id, n, target) of a link list: `#TARGET:` gives the url template, lines are id or id|n."""
    lines = spark.read.text(path)
    target = lines.where("value like '#TARGET:%'").agg(F.first(F.trim(F.substr("value", F.lit(9)))).alias("t")).scalar()
    rows = lines.where("value not like '#%' and trim(value) <> ''")
    key = F.trim(F.split("value", r"\|").getItem(0))
    n = F.coalesce(F.try_to_number(F.get(F.split("value", r"\|"), F.lit(1)), F.lit("999999999")).cast("int"), F.lit(1))
    return rows.select(key.alias("id"), n.alias("n"), F.replace(F.coalesce(target, F.lit("")), F.lit("{ID}"), key).alias("target"))


def parse_binary(data: bytes) -> Iterator[tuple[str, str, list]]:
    """Records of a binary exchange file: a leader of 24 bytes, a directory of 12-byte entries, and the fields.

    Consecutive records with the same control number are parts of one record. Fields are sorted by tag.
    """
    held: tuple[str, str, list] | None = None
    at = 0
    while at + 24 <= len(data):
        length = int(data[at : at + 5])
        record = data[at : at + length]
        at += length
        leader, base = record[:24].decode("utf-8", "replace"), int(record[12:17])
        fields = []
        for k in range(24, base - 1, 12):
            tag, size, start = record[k : k + 3].decode(), int(record[k + 3 : k + 7]), int(record[k + 7 : k + 12])
            body = record[base + start : base + start + size].rstrip(b"\x1e").decode("utf-8", "replace")
            if tag < "010":
                fields.append({"tag": tag, "ind1": "", "ind2": "", "subfields": [{"code": "", "value": body}]})
            else:
                parts = body[2:].split("\x1f")[1:]
                fields.append({"tag": tag, "ind1": body[:1], "ind2": body[1:2], "subfields": [{"code": p[:1], "value": p[1:]} for p in parts]})
        key = next((f["subfields"][0]["value"] for f in fields if f["tag"] == "001"), "")
        if held and held[0] == key and key:
            held[2].extend(f for f in fields if f["tag"] != "001")
        else:
            if held:
                yield held[0], held[1], sorted(held[2], key=lambda f: f["tag"])
            held = (key, leader, fields)
    if held:
        yield held[0], held[1], sorted(held[2], key=lambda f: f["tag"])


def binary_record(leader: str, fields: list, limit: int = 99_999) -> bytes:
    """The bytes of a record; one over the limit is split into several that repeat its control number."""
    bodies = []
    for f in fields:
        if f["tag"] < "010":
            body = f["subfields"][0]["value"]
        else:
            body = f["ind1"] + f["ind2"] + "".join(f"\x1f{s['code']}{s['value']}" for s in f["subfields"])
        bodies.append((f["tag"], body.encode() + b"\x1e"))
    key = [b for b in bodies if b[0] == "001"][:1]
    parts, now, size = [], [], 26
    for tag, body in bodies:
        if now and size + 12 + len(body) > limit:
            parts.append(now)
            now = list(key)
            size = 26 + sum(12 + len(b) for _, b in now)
        now.append((tag, body))
        size += 12 + len(body)
    parts.append(now)
    out = b""
    for part in parts:
        directory, data = b"", b""
        for tag, body in part:
            directory += f"{tag}{len(body):04}{len(data):05}".encode()
            data += body
        base = 24 + len(directory) + 1
        head = f"{base + len(data) + 1:05}{leader[5:12]}{base:05}{leader[17:24]}".encode()
        out += head + directory + b"\x1e" + data + b"\x1d"
    return out


_RECORD_END = "\x1d"
_FIELDS = pa.list_(pa.struct([("tag", pa.string()), ("ind1", pa.string()), ("ind2", pa.string()), ("subfields", pa.list_(pa.struct([("code", pa.string()), ("value", pa.string())])))]))


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """Records (control_number, leader, fields) of binary files of any size: the reader splits them at the byte that ends a record.

    Consecutive parts of a record too long for one are joined where they are in one split; merge_parts joins those that a split divides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = b"".join(x + _RECORD_END.encode() for x in batch.column(0).to_pylist() if x and x.strip())
            got = list(parse_binary(data))
            yield pa.record_batch([pa.array([r[0] for r in got], pa.string()), pa.array([r[1] for r in got], pa.string()), pa.array([r[2] for r in got], _FIELDS)], ["control_number", "leader", "fields"])

    rows = spark.read.text(path, lineSep=_RECORD_END).select(F.col("value").cast("binary").alias("value"))
    return rows.mapInArrow(run, model.SCHEMA)


def merge_parts(records: DataFrame) -> DataFrame:
    """Rows of one control number as one record, with the fields of all in the order of their tags and the first leader."""
    whole = F.flatten(F.collect_list("fields"))
    return records.groupBy("control_number").agg(F.first("leader").alias("leader"), model.sorted_fields(whole).alias("fields"))


def write_binary(records: DataFrame, path: str, mode: str = "error", records_a_file: int = 0) -> None:
    """Records as binary files, written by all tasks; records over the limit are split in several parts. mode `append` adds files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [binary_record(leader, fields)[:-1] for leader, fields in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    rows = records.select("leader", "fields").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    rows.write.mode(mode).option("lineSep", _RECORD_END).option("maxRecordsPerFile", records_a_file).text(path)


def detect_format(name: str, head: bytes = b"") -> str:
    """`xml` or `binary`: by the file's name, else by its first bytes (markup, or five digits of a record's length)."""
    if name.lower().endswith((".xml", ".xml.gz")):
        return "xml"
    if name.lower().endswith((".mrc", ".marc", ".raw")):
        return "binary"
    start = head.lstrip(b"\xef\xbb\xbf \t\r\n")
    if start.startswith(b"<"):
        return "xml"
    if len(head) >= 5 and head[:5].isdigit():
        return "binary"
    raise ValueError(f"neither name nor contents of {name} tell a record format")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of files of either format; what is there is told by the first file's name and contents."""
    first = spark.read.format("binaryFile").load(path).select("path", F.substr("content", F.lit(1), F.lit(64)).alias("head")).orderBy("path").first()
    kind = detect_format(first["path"], bytes(first["head"])) if first else "binary"
    return read_xml(spark, path) if kind == "xml" else read_binary(spark, path)


def read_dsv(spark: SparkSession, path: str, separator: str = ",", quote: str = '"') -> DataFrame:
    """Rows of separated values with a header line; quotes are doubled inside quotes, and quoted values may hold line ends."""
    return spark.read.option("header", True).option("sep", separator).option("quote", quote).option("escape", quote).option("multiLine", True).csv(path)


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """Records of XML files with record, controlfield and datafield elements."""
    subfield = "struct<_code: string, _VALUE: string>"
    schema = f"leader string, controlfield array<struct<_tag: string, _VALUE: string>>, datafield array<struct<_tag: string, _ind1: string, _ind2: string, subfield: array<{subfield}>>>"
    rows = spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", "true").schema(schema).load(path)
    none = F.expr(f"cast(array() as array<{model.FIELD}>)")
    text = lambda c: F.coalesce(c, F.lit(""))
    control = F.transform("controlfield", lambda f: F.struct(f["_tag"].alias("tag"), F.lit("").alias("ind1"), F.lit("").alias("ind2"), F.array(F.struct(F.lit("").alias("code"), text(f["_VALUE"]).alias("value"))).alias("subfields")))
    data = F.transform(
        "datafield",
        lambda f: F.struct(
            f["_tag"].alias("tag"), text(f["_ind1"]).alias("ind1"), text(f["_ind2"]).alias("ind2"),
            F.transform(f["subfield"], lambda s: F.struct(s["_code"].alias("code"), text(s["_VALUE"]).alias("value"))).alias("subfields"),
        ),
    )
    fields = model.sorted_fields(F.concat(F.coalesce(control, none), F.coalesce(data, none)))
    out = rows.select("leader", fields.alias("fields"))
    return out.select(model.first_value(F.col("fields"), "001", "").alias("control_number"), "leader", "fields")
