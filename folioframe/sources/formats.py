"""Further sources and sinks: JSON by a field mapping, feeds, harvested XML, sections, archives, SQL scripts and column-wise JSON."""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.records import model


@dataclass(frozen=True)
class Mapping:
    """A field made from JSON: the value at `path`, if it matches `pattern` (whose first group it becomes, if it has one)."""

    tag: str
    code: str
    path: str
    pattern: str = ""


def from_json(rows: DataFrame, column: str, key: str, mappings: Sequence[Mapping], leader: str = "00000naa a2200000 u 4500") -> DataFrame:
    """Records from JSON texts. A path with [*] gives a field for each element; missing, null and empty values give none."""

    def found(m: Mapping) -> Column:
        raw = F.get_json_object(F.col(column), m.path)
        if "[*]" in m.path:
            # The engine answers one match as itself and several as an array.
            listed = F.coalesce(F.from_json(raw, "array<string>"), F.array(raw))
            got = F.filter(listed, lambda v: v.isNotNull())
        else:
            got = F.filter(F.array(raw), lambda v: v.isNotNull())
        got = F.transform(got, lambda v: F.regexp_replace(v, '^"(.*)"$', "$1"))
        if m.pattern:
            group = 1 if re.compile(m.pattern).groups else 0
            got = F.transform(F.filter(got, lambda v: v.rlike(m.pattern)), lambda v: F.regexp_extract(v, m.pattern, group))
        return F.transform(F.filter(got, lambda v: v != ""), lambda v: model.field(m.tag, {m.code: v}))

    own = F.array(model.field("001", {"": F.col(key)}, "", ""))
    fields = model.sorted_fields(F.concat(own, *map(found, mappings)))
    return rows.select(F.col(key).cast("string").alias("control_number"), F.lit(leader).alias("leader"), fields.alias("fields"))


_FEED = "item_id string, title string, link string, description string, pub_date string"


def read_feed(spark: SparkSession, path: str, feed: str = "") -> DataFrame:
    """(feed, item_id, title, link, description, pub_date) of RSS (0.9x, 1.0, 2.0) and Atom files; the id is the guid or id, else the link."""

    def rows(tag: str, schema: str, *columns: Column) -> DataFrame:
        xml = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").schema(schema).load(path)
        return xml.select(*columns)

    link = F.col("link").cast("string")
    item = rows(
        "item", "guid string, title string, link string, description string, pubDate string, date string",
        F.coalesce("guid", "link").alias("item_id"), F.col("title"), link.alias("link"), F.col("description"), F.coalesce("pubDate", "date").alias("pub_date"),
    )
    hrefs = F.transform(F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), lambda x: x["_href"])
    entry = rows(
        "entry", "id string, title string, link array<struct<_href: string, _rel: string>>, summary string, content string, updated string, published string",
        F.coalesce("id", F.get(hrefs, F.lit(0))).alias("item_id"), F.col("title"), F.get(hrefs, F.lit(0)).alias("link"), F.coalesce("summary", "content").alias("description"),
        F.coalesce("published", "updated").alias("pub_date"),
    )
    # The day's name says nothing more, and the formatter reads none.
    dated = item.unionByName(entry).withColumn("pub_date", F.regexp_replace("pub_date", r"^[A-Z][a-z]{2}, ", ""))
    stamp = F.coalesce(F.try_to_timestamp("pub_date", F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp("pub_date", F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp("pub_date"))
    return dated.select(F.lit(feed).alias("feed"), "item_id", "title", "link", "description", stamp.alias("pub_date")).where("item_id is not null")


def read_harvest(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, datestamp, deleted, sets) of landed harvesting responses; of several of an identifier the latest."""
    schema = "header struct<identifier: string, datestamp: string, setSpec: array<string>, _status: string>"
    rows = spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", "true").schema(schema).load(path)
    h = F.col("header")
    got = rows.where(h["identifier"].isNotNull()).select(h["identifier"].alias("identifier"), h["datestamp"].alias("datestamp"), F.coalesce(h["_status"] == "deleted", F.lit(False)).alias("deleted"), h["setSpec"].alias("sets"))
    return got.groupBy("identifier").agg(F.max_by(F.struct("datestamp", "deleted", "sets"), F.struct("datestamp", "deleted")).alias("r")).select("identifier", "r.*")


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """(section, name, value) of a small configuration file: `[section]`, `name = value`, quotes off, # and ; begin comments. Names before any section have ''.

    `@inherit "section"` takes over what an earlier section has so far; a name stated twice in a section counts as last stated.
    """
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one file of settings, read by the driver
    found: dict[str, dict[str, str]] = {}
    section = ""
    for line in map(str.strip, text.splitlines()):
        if m := re.match(r"^\[(.+)\]$", line):
            section = m[1].strip()
        elif m := re.match(r'^@inherit\s+"([^"]+)"$', line):
            if m[1] not in found or not section:
                raise ValueError(f"cannot inherit: {line}")
            found.setdefault(section, {}).update(found[m[1]])
        elif line and line[0] not in "#;" and (m := re.match(r'^([^=]+?)\s*=\s*(?:"((?:[^"\\]|\\.)*)"|([^#;]*?))\s*(?:[#;].*)?$', line)):
            found.setdefault(section, {})[m[1]] = re.sub(r"\\(.)", r"\1", m[2]) if m[2] is not None else m[3]
    out = [(s, n, v) for s, pairs in found.items() for n, v in pairs.items()]
    return spark.createDataFrame(out, "section string, name string, value string")


def split_statements(script: str) -> list[str]:
    """The statements of an SQL script: semicolons in quotes and comments do not divide; comments go."""
    token = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|#[^\n]*|/\*.*?\*/|;|.", re.S)
    out, now = [], ""
    for t in token.findall(script):
        if t == ";":
            out.append(now.strip())
            now = ""
        elif not t.startswith(("--", "/*")) and not (t[0] == "#" and len(t) > 1):
            now += t
    return [s for s in [*out, now.strip()] if s]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, kind, content) of tar, tar.gz and zip files. kind is read from the member's name (member_kind).

    An archive is one task's work and its members are streamed a batch each, so many archives read in parallel.
    """

    def members(data: bytes) -> Iterator[tuple[str, bytes]]:
        if zipfile.is_zipfile(io.BytesIO(data)):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                yield from ((n, z.read(n)) for n in z.namelist() if not n.endswith("/"))
        else:
            with tarfile.open(fileobj=io.BytesIO(data)) as t:
                yield from ((m.name, t.extractfile(m).read()) for m in t if m.isfile())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for member, data in members(content.as_py()):
                    yield pa.record_batch([pa.array([name]), pa.array([member]), pa.array([data], pa.binary())], ["archive", "member", "content"])

    got = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, member string, content binary")
    return got.select("archive", "member", member_kind(F.col("member")).alias("kind"), "content")


#: How members of record archives are named. The first letter of a raw member, or the end of a member's name, tells its records.
RAW_KINDS = {"a": "title", "b": "superior", "c": "authority"}
NAME_KINDS = {"aut.mrc": "authority", "tit.mrc": "title", "lok.mrc": "local"}


def member_kind(member: Column) -> Column:
    """What records a member holds by its name: title, superior, authority, local, or other."""
    letter = F.regexp_extract(member, "([abc])[0-9]{3}[.]raw", 1)
    kind = F.element_at(F.create_map(*(F.lit(x) for pair in RAW_KINDS.items() for x in pair)), letter)
    for end, name in NAME_KINDS.items():
        kind = F.when(F.endswith(member, F.lit(end)), F.lit(name)).otherwise(kind)
    return F.coalesce(kind, F.lit("other"))


def column_json(rows: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row `json`: an array of values for each column, in the given order. For reports that fit a row; larger tables are written as they are."""
    struct = F.struct(*(F.col(c) for c in [*order, *(c for c in columns if c not in order)]))
    sorted_rows = rows.agg(F.array_sort(F.collect_list(struct)).alias("r"))
    return sorted_rows.select(F.to_json(F.struct(*(F.col("r").getField(c).alias(c) for c in columns))).alias("json"))


def write_xml(records: DataFrame, path: str) -> None:
    """Records as XML files that read_xml reads."""
    control = F.transform(F.filter("fields", lambda f: f["tag"] < "010"), lambda f: F.struct(f["tag"].alias("_tag"), F.get(f["subfields"], F.lit(0))["value"].alias("_VALUE")))
    subfields = lambda f: F.transform(f["subfields"], lambda s: F.struct(s["code"].alias("_code"), s["value"].alias("_VALUE")))
    data = F.transform(F.filter("fields", lambda f: f["tag"] >= "010"), lambda f: F.struct(f["tag"].alias("_tag"), f["ind1"].alias("_ind1"), f["ind2"].alias("_ind2"), subfields(f).alias("subfield")))
    out = records.select("leader", control.alias("controlfield"), data.alias("datafield"))
    out.write.format("xml").option("rootTag", "collection").option("rowTag", "record").option("declaration", "version=\"1.0\" encoding=\"UTF-8\"").save(path)
