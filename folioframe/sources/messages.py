"""Mailboxes, publishers' product messages (ONIX) and page-wise transcriptions (TEI)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions.strings import unescape_html
from folioframe.functions.text import collapse_space

#: Codes of kinds of product numbers and titles, and the mark of a word that goes on in the next line.
DOI, ISBN_13, DISTINCTIVE = "06", "15", "01"
WORD_GOES_ON = "¬"


def read_mailbox(spark: SparkSession, path: str) -> DataFrame:
    """(sender, received, subject, from_, to, message_id, body) of mailbox files, read in splits at `From ` at the start of a line.

    Folded header lines are joined. A received time that cannot be read, and a header that is not there, are null; a file's start without a `From ` line is left out.
    `>From ` in a body is `From `. Bodies stay encoded as they are. Times are those of the session's zone.
    """
    rows = spark.read.option("lineSep", "\nFrom ").text(path)
    first = r"^(?:From )?(\S+) +(?:[A-Z][a-z]{2} )?([A-Z][a-z]{2} +\d{1,2} \d\d:\d\d:\d\d \d{4})[^\n]*(?:\n|\z)"
    plain = F.regexp_replace("value", "\r\n", "\n")
    # A blank line divides header and body; without headers the envelope's own line end is half of it.
    parts = rows.select(plain.alias("v")).where(F.col("v").rlike(first)).select(
        F.regexp_extract("v", first, 1).alias("sender"), F.regexp_replace(F.regexp_extract("v", first, 2), " +", " ").alias("at"), F.split(F.regexp_replace("v", first, "\n"), "\n\n", 2).alias("p")
    )
    head = F.regexp_replace(F.get("p", F.lit(0)), r"\n[ \t]+", " ")
    header = lambda name: F.nullif(F.regexp_extract(F.col("head"), rf"(?im)^{name}:[ \t]*(.*)$", 1), F.lit(""))
    return parts.withColumn("head", head).select(
        "sender", F.try_to_timestamp("at", F.lit("MMM d HH:mm:ss yyyy")).alias("received"), header("Subject").alias("subject"), header("From").alias("from_"), header("To").alias("to"),
        header("Message-ID").alias("message_id"), F.regexp_replace(F.coalesce(F.get("p", F.lit(1)), F.lit("")), r"(?m)^>From ", "From ").alias("body"),
    )


def read_onix(spark: SparkSession, path: str) -> DataFrame:
    """(reference, doi, isbn, title, subtitle, contributors, languages, publisher, dates) of each Product of ONIX 3 messages with reference tags."""
    schema = """RecordReference string, ProductIdentifier array<struct<ProductIDType: string, IDValue: string>>,
    DescriptiveDetail struct<TitleDetail: array<struct<TitleType: string, TitleElement: array<struct<TitleText: string, Subtitle: string>>>>, Contributor: array<struct<PersonName: string, PersonNameInverted: string, CorporateName: string>>,
      Language: array<struct<LanguageCode: string>>>,
    PublishingDetail struct<Publisher: array<struct<PublisherName: string>>, PublishingDate: array<struct<Date: string>>>"""
    rows = spark.read.format("xml").option("rowTag", "Product").option("ignoreNamespace", "true").schema(schema).load(path)
    number = lambda kind: F.get(F.filter("ProductIdentifier", lambda p: F.lpad(p["ProductIDType"], 2, "0") == kind), F.lit(0))["IDValue"]
    title = F.get(F.get(F.filter("DescriptiveDetail.TitleDetail", lambda t: F.lpad(t["TitleType"], 2, "0") == DISTINCTIVE), F.lit(0))["TitleElement"], F.lit(0))
    listed = lambda c, f: F.coalesce(F.array_compact(F.transform(c, f)), F.array().cast("array<string>"))
    return rows.where("RecordReference is not null").select(
        F.col("RecordReference").alias("reference"), number(DOI).alias("doi"), number(ISBN_13).alias("isbn"), title["TitleText"].alias("title"), title["Subtitle"].alias("subtitle"),
        listed("DescriptiveDetail.Contributor", lambda c: F.coalesce(c["PersonNameInverted"], c["PersonName"], c["CorporateName"])).alias("contributors"), listed("DescriptiveDetail.Language", lambda x: x["LanguageCode"]).alias("languages"),
        F.get("PublishingDetail.Publisher", F.lit(0))["PublisherName"].alias("publisher"), listed("PublishingDetail.PublishingDate", lambda d: d["Date"]).alias("dates"),
    )


def tei_text(c: Column) -> Column:
    """The text of the spans of a transcription, with blanks between; a word that goes on in the next span is one."""
    pieces = F.filter(F.regexp_extract_all(c, F.lit(r"<span\b[^>]*(?<!/)>([^<]+)"), 1), lambda p: p != "")
    return collapse_space(F.regexp_replace(F.array_join(F.transform(pieces, lambda p: unescape_html(p)), " "), rf"{WORD_GOES_ON}+( |\z)", ""))
