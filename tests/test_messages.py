"""Mailboxes, product messages and transcriptions on small files."""

import datetime

from pyspark.sql import functions as F

from folioframe.sources import messages


def test_mailbox(spark, tmp_path):
    one = "From a@x.de Sat Jan  3 01:05:34 2026\nSubject: Hello\n  folded\nFrom: A <a@x.de>\nTo: b\nMessage-ID: <1@x>\n\nbody\n\n>From me\n"
    two = "From MAILER-DAEMON Fri Dec 31 23:59:59 1999\r\nsubject: x\r\n\r\n"
    (tmp_path / "box").write_text(f"{one}\n{two}\nFrom b@y Mon Foo 99 00:00:00 2000\n\nno headers\n")
    got = messages.read_mailbox(spark, str(tmp_path / "box")).collect()
    assert [r["sender"] for r in got] == ["a@x.de", "MAILER-DAEMON", "b@y"]
    assert tuple(got[0])[1:] == (datetime.datetime(2026, 1, 3, 1, 5, 34), "Hello folded", "A <a@x.de>", "b", "<1@x>", "body\n\nFrom me\n")
    assert (got[1]["received"], got[1]["subject"], got[1]["to"], got[1]["body"].strip()) == (datetime.datetime(1999, 12, 31, 23, 59, 59), "x", None, "")
    assert (got[2]["received"], got[2]["subject"], got[2]["body"].strip()) == (None, None, "no headers")
    (tmp_path / "none").write_text("no mailbox at all\n")
    assert messages.read_mailbox(spark, str(tmp_path / "none")).count() == 0
    many = "\n".join(f"From u{k}@x Sat Jan  3 01:05:34 2026\nSubject: {k}\n\n{'y' * 500}" for k in range(200))
    (tmp_path / "many").write_text(many)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    try:
        back = messages.read_mailbox(spark, str(tmp_path / "many"))
        assert back.rdd.getNumPartitions() > 5 and sorted(int(r["subject"]) for r in back.collect()) == list(range(200))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_product_messages(spark, tmp_path):
    full = """<Product><RecordReference>r1</RecordReference><ProductIdentifier><ProductIDType>15</ProductIDType><IDValue>9781</IDValue></ProductIdentifier><ProductIdentifier><ProductIDType>06</ProductIDType><IDValue>10.1/x</IDValue></ProductIdentifier>
    <DescriptiveDetail><TitleDetail><TitleType>02</TitleType><TitleElement><TitleText>Other</TitleText></TitleElement></TitleDetail><TitleDetail><TitleType>01</TitleType><TitleElement><TitleText>T</TitleText><Subtitle>S</Subtitle></TitleElement></TitleDetail>
    <Contributor><PersonName>A B</PersonName><PersonNameInverted>B, A</PersonNameInverted></Contributor><Contributor><CorporateName>C</CorporateName></Contributor><Language><LanguageCode>ger</LanguageCode></Language></DescriptiveDetail>
    <PublishingDetail><Publisher><PublisherName>P</PublisherName></Publisher><PublishingDate><Date>20200101</Date></PublishingDate></PublishingDetail></Product>"""
    (tmp_path / "o.xml").write_text(f"<ONIXMessage>{full}<Product><RecordReference>r2</RecordReference></Product></ONIXMessage>")
    got = {r["reference"]: tuple(r)[1:] for r in messages.read_onix(spark, str(tmp_path / "o.xml")).collect()}
    assert got == {"r1": ("10.1/x", "9781", "T", "S", ["B, A", "C"], ["ger"], "P", ["20200101"]), "r2": (None, None, None, None, [], [], None, [])}


def test_transcriptions(spark):
    texts = ['<p><span a="1">Ein Wort&amp;</span><span/><span>zer¬</span> <span>teilt  ist</span><b>not</b></p>', "<span>end¬</span>", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(messages.tei_text(F.col("t"))).collect()] == ["Ein Wort& zerteilt ist", "end", "", None]
