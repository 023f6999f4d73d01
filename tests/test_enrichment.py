"""Enrichment, merging of forms, holdings, formats, incremental behaviour and reports on small fixtures."""

import io
import json
import os
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioframe.functions import holdings, stemming
from folioframe.operators import enrichment, merging, reports
from folioframe.records import model
from folioframe.records.query import QueryError, compile_query
from folioframe.sources import files, formats
from folioframe.streaming import incremental


def f(tag, *subfields, ind=("", "")):
    return (tag, ind[0], ind[1], list(subfields))


def records(spark, *rows):
    return spark.createDataFrame([(k, leader, fields) for k, leader, fields in rows], model.SCHEMA)


def plain(row):
    return [(x["tag"], [(s["code"], s["value"]) for s in x["subfields"]]) for x in row["fields"]]


L = "00000nas a2200000 u 4500"


def test_references_and_values(spark):
    df = records(spark, ("1", L, [f("100", ("a", "X"), ("0", "(DE-588)7")), f("700", ("0", "(DE-588)7"), ("0", "(DE-588)8")), f("856", ("u", "q7"))]), ("2", L, []))
    lookup = spark.createDataFrame([("7", "q7"), ("8", "q8"), ("8", "q9"), ("9", "z"), (None, "n")], "ref string, value string")
    got = enrichment.add_from_references(df, lookup, ("100", "700"), "0", r"^\(DE-588\)(.+)$", "856", "u")
    by = {r["control_number"]: plain(r) for r in got.collect()}
    assert [v for t, v in by["1"] if t == "856"] == [[("u", "q7")], [("u", "q8")], [("u", "q9")]]
    assert by["2"] == []
    used, dropped = enrichment.split_used(spark.createDataFrame([("a", "7"), ("b", "5"), ("c", None)], "k string, gnd string"), enrichment.references(df, ("100",), "0", r"\)(.+)$"), "gnd")
    assert sorted(r[0] for r in used.collect()) == ["a", "c"] and [r[0] for r in dropped.collect()] == ["b"]


def test_rewriting_references(spark):
    df = records(spark, ("1", L, [f("773", ("w", "(DE-627)5"), ("t", "5")), f("800", ("w", "(DE-627)5"))]), ("2", L, [f("773", ("w", "(DE-627)6"))]))
    mapping = spark.createDataFrame([("5", "9"), ("4", "1")], "ref string, new string")
    by = {r["control_number"]: plain(r) for r in enrichment.rewrite_references(df, mapping, ("773",), "w", "(DE-627)").collect()}
    assert by["1"] == [("773", [("w", "(DE-627)9"), ("t", "5")]), ("800", [("w", "(DE-627)5")])]
    assert by["2"] == [("773", [("w", "(DE-627)6")])]
    gone = enrichment.without_references(df, spark.createDataFrame([("5",)], "ref string"), ("773",), "w", r"^\(DE-627\)(.+)$")
    assert {r["control_number"]: plain(r) for r in gone.collect()}["1"][0] == ("773", [("t", "5")])


def test_authority_data(spark):
    df = records(spark, ("1", L, [f("100", ("a", "old"), ("4", "aut"), ("0", "(DE-627)3")), f("700", ("a", "kept"))]))
    authority = spark.createDataFrame([("3", "New, N.", None)], "ref string, name string, title string")
    got = enrichment.from_authority(df, authority, ("100", "700"), r"^\(DE-627\)(.+)$", {"a": "name", "c": "title"})
    assert plain(got.first()) == [("100", [("a", "New, N."), ("4", "aut"), ("0", "(DE-627)3")]), ("700", [("a", "kept")])]


def test_identifier_joins(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "gnd string")
    one = spark.createDataFrame([("a", 2, "u/a")], "id string, n int, target string")
    got = {r["gnd"]: r["links"] and [tuple(x) for x in r["links"]] for r in enrichment.link_lists(ids, {"y": one, "x": one}, "gnd").collect()}
    assert got == {"a": [("x", 2, "u/a"), ("y", 2, "u/a")], "b": None}
    items = spark.createDataFrame([(1, "10.1/A", ["h"], ["i1", "i2"]), (2, "10.1/b", None, ["i9", "i2"]), (3, None, [], None)], "k int, doi string, known array<string>, isbns array<string>")
    urls = spark.createDataFrame([("10.1/a", "h"), ("10.1/A", "g"), ("10.1/B", "z")], "doi string, url string")
    assert sorted(map(tuple, enrichment.missing_urls(items, urls, "k", "doi", "url", "known").collect())) == [(1, "g"), (2, "z")]
    lookup = spark.createDataFrame([("i2", "d2"), ("i9", "d9"), ("i9", "d8")], "isbn string, doi string")
    assert sorted(map(tuple, enrichment.two_hop(items, lookup, "k", "isbns", "isbn", "doi").collect())) == [(1, "d2"), (2, "d8")]


def test_local_data_flags_and_translations(spark):
    df = records(spark, ("1", L, [f("ZWI", ("b", "0"))]), ("2", L, []))
    local = spark.createDataFrame([("0", [f("LOK", ("a", "z"))]), ("1", [f("LOK", ("a", "o"))])], f"control_number string, fields array<{model.FIELD}>")
    by = {r["control_number"]: [t for t, _ in plain(r)] for r in enrichment.add_local(df, local).collect()}
    assert by == {"1": ["ZWI", "LOK", "LOK"], "2": []}
    rows = spark.createDataFrame([("s", [], True), ("c", ["s", "q"], False), ("d", ["q"], None), ("e", None, True)], "k string, up array<string>, own boolean")
    assert {r["k"]: r["held"] for r in enrichment.inherited_flag(rows, "k", "up", "own", "held").collect()} == {"s": True, "c": True, "d": False, "e": True}
    t = spark.createDataFrame([("p", "de", "w", "Wikidata"), ("p", "de", "i", "Own"), ("p", "en", "x", "?"), ("r", "de", "m", "MACS")], "ppn string, language string, text string, origin string")
    best = enrichment.best_translation(t, "ppn", "language", "text", "origin", ("Own", "MACS", "Wikidata"))
    assert sorted(map(tuple, best.collect())) == [("p", "de", "i", "Own"), ("p", "en", "x", "?"), ("r", "de", "m", "MACS")]
    assert list(map(tuple, enrichment.translation_gaps(t, "ppn", "language", ("de", "en")).collect())) == [("r", "en")]
    assert sorted(map(tuple, enrichment.translation_coverage(t, "ppn", "language").collect())) == [("de", 2, 0), ("en", 1, 1)]
    subs = spark.createDataFrame([("u", "B"), ("u", "j1"), ("v", "j9")], "user string, item string")
    bundles = spark.createDataFrame([("B", "j1"), ("B", "j2")], "b string, m string")
    assert sorted(map(tuple, enrichment.expand_bundles(subs, bundles, "item", "b", "m").collect())) == [("u", "j1", False), ("u", "j1", True), ("u", "j2", True), ("v", "j9", False)]
    parents = spark.createDataFrame([("s",), ("t",)], "k string")
    children = spark.createDataFrame([("s", "x"), ("s", "w"), ("s", "x")], "p string, tag string")
    assert {r["k"]: r["tags"] for r in enrichment.tags_from_children(parents, children, "k", "p", "tag", "tags").collect()} == {"s": ["w", "x"], "t": []}


def test_merge_of_forms(spark):
    online = [
        f("001", ("", "1")), f("005", ("", "2020")), f("007", ("", "cr")), f("008", ("", "850101n19902001")), f("022", ("a", "1234-5678")), f("100", ("a", "Zed")),
        f("245", ("a", "The Title")), f("260", ("a", "Bonn"), ("b", "P"), ("c", "1990-")), f("300", ("a", "online")), f("776", ("w", "(DE-627)2")), f("LOK", ("a", "x")),
    ]
    print_ = [
        f("001", ("", "2")), f("005", ("", "2019")), f("008", ("", "850101n19901999")), f("022", ("a", "8765-4321")), f("100", ("a", "Abe")), f("245", ("a", "Other title")),
        f("264", ("a", "Bonn"), ("b", "P"), ("c", "1985-")), f("300", ("a", "print")), f("650", ("a", "Topic")), f("776", ("w", "(DE-627)1")), f("LOK", ("a", "x")),
    ]
    df = records(spark, ("1", L, online), ("2", L, print_), ("7", L, [f("001", ("", "7")), f("245", ("a", "alone"))]))
    links = spark.createDataFrame([("1", "2"), ("2", "1"), ("7", "99")], "a string, b string")
    groups = merging.groups_of(df, links, "a", "b")
    assert sorted((r["control_number"], r["head"], r["others"]) for r in groups.collect()) == [("1", "2", ["1"]), ("2", "2", ["1"])]
    got = {r["control_number"]: plain(r) for r in merging.merge_forms(df, groups, 2024, unique=("300",)).collect()}
    assert set(got) == {"2", "7"}
    assert got["7"] == [("001", [("", "7")]), ("245", [("a", "alone")])]
    by = {}
    for tag, subfields in got["2"]:
        by.setdefault(tag, []).append(dict(subfields))
    assert [t for t, _ in got["2"]] == sorted(t for t, _ in got["2"])
    assert by["001"] == [{"": "2"}] and by["005"] == [{"": "2020"}] and by["008"] == [{"": "850101n19902001"}]
    assert by["245"] == [{"a": "The Title"}] and by["246"] == [{"a": "Other title", "g": "print title"}]
    assert by["100"] == [{"a": "Abe"}] and by["700"] == [{"a": "Zed"}] and by["650"] == [{"a": "Topic"}]
    assert by["264"] == [{"a": "Bonn", "b": "P", "c": "1985- (print); 1990- (electronic)"}]
    assert by["300"] == [{"a": "print (print); online (electronic)"}]
    assert [x["2"] for x in by["022"]] == ["print", "electronic"] and [x["9"] for x in by["022"]] == ["Other title", "The Title"]
    assert len(by["LOK"]) == 2 and "776" not in by and by["ZWI"][0]["b"] == "1"
    assert list(map(tuple, merging.renamed_keys(groups).collect())) == [("1", "2")]


def test_follow_up_of_merged_keys(spark):
    renamed = spark.createDataFrame([("1", "2")], "ref string, new string")
    subs = spark.createDataFrame([("u", "1", 5), ("u", "2", 9), ("v", "1", 3), ("w", "4", 1)], "user string, item string, seen int")
    assert sorted(map(tuple, merging.merge_subscriptions(subs, renamed, "user", "item", "seen").collect())) == [("u", "2", 5), ("v", "2", 3), ("w", "4", 1)]
    assert sorted(map(tuple, merging.swap_keys(subs, renamed, "item", ("user", "item")).collect())) == [("u", "2", 9), ("v", "2", 3), ("w", "4", 1)]
    assert list(map(tuple, merging.swap_report(subs, renamed, "item").collect())) == [("1", "2", 2)]
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, h string")
    new = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "q")], "k string, h string")
    assert sorted(r["k"] for r in merging.changed(new, old, "k", "h").collect()) == ["b", "c"]


@pytest.mark.parametrize(
    "statement, want",
    [
        ("1.1965 - 25.1989; 27.1991 -", [(1965, 1, None, 1989, 25, None), (1991, 27, None, 9999, None, None)]),
        ("1970", [(1970, None, None, 1970, None, None)]),
        ("12(1990),3 - 14(1992),1", [(1990, 12, 3, 1992, 14, 1)]),
        ("Vol. 2 (1971) - 1980 [N=3]", [(1971, 2, None, 1980, None, None)]),
        ("6/7.1990/91 - 70/71.1999/00", [(1990, 6, None, 2000, 71, None)]),
        ("1.1985(lückenhaft) - 7.1990; [1991]-1995/96", [(1985, 1, None, 1990, 7, None), (1991, None, None, 1996, None, None)]),
        ("1890/95-1896/1900; 1984/85", [(1890, None, None, 1900, None, None), (1984, None, None, 1985, None, None)]),
        ("1/8.1947/55-; 3.1970-1972/73", [(1947, 1, None, 9999, None, None), (1970, 3, None, 1973, None, None)]),
        ("12.1990,3-5; 1991,2-; 1990-95", [(1990, 12, 3, 1990, 12, 5), (1991, None, 2, 9999, None, None)]),
        ("5.1994/95,2; 1994/3", [(1994, 5, 2, 1995, 5, 2), (1994, None, 3, 1994, None, 3)]),
        ("rubbish", []),
        ("", []),
    ],
)
def test_holdings(spark, statement, want):
    got = spark.createDataFrame([(statement,)], "s string").select(holdings.spans(F.col("s"))).first()[0]
    assert list(map(tuple, got)) == want


def test_availability(spark):
    rows = spark.createDataFrame([("s", "12.1990,3 - 14.1992,1"), ("s", "2000 -"), ("n", None)], "k string, statement string")
    asked = [("s", 1990, 12, 2), ("s", 1990, 12, 3), ("s", 1991, None, None), ("s", 1992, 14, 2), ("s", 1992, 13, 9), ("s", 2020, 1, 1), ("s", 1999, 1, 1), ("n", 1990, 1, 1), ("x", 1990, 1, 1), ("s", None, 1, 1)]
    articles = spark.createDataFrame(asked, "parent string, year int, volume int, issue int")
    got = {tuple(r)[:4]: r["available"] for r in holdings.availability(articles, rows, "parent", "k", "statement").collect()}
    assert [got[a] for a in asked] == [False, True, True, False, True, True, False, False, False, False]


def test_stems_and_keywords(spark):
    df = spark.createDataFrame([("Churches", "en"), ("singing", "en"), (None, "en"), ("is", "en")], "w string, l string")
    assert [r[0] for r in df.select(stemming.stem(F.col("w"), "en")).collect()] == ["church", "sing", None, "is"]
    titles = spark.createDataFrame([(1, "On the early churches of Rome"), (2, "Early church"), (3, "church")], "k int, t string")
    words = spark.createDataFrame([("Early Church",), ("Churches",), ("Christianity",)], "w string")
    assert sorted(map(tuple, stemming.keywords_in_titles(titles, words, "k", "t", "w", "en", 6).collect())) == [(1, "Churches"), (1, "Early Church"), (2, "Churches"), (2, "Early Church"), (3, "Churches")]


def test_query_functions(spark):
    df = records(spark, ("1", L, [f("245", ("a", "x"))]), ("2", "00000nab a2200000 u 4500", [f("245", ("a", "y, z"))]))
    ask = lambda q: sorted(r[0] for r in df.where(compile_query(q)).select("control_number").collect())
    assert ask("IsSerial()") == ["1"] and ask("NOT IsSerial()") == ["2"] and ask("IsArticle() OR 245a == \"x\"") == ["1", "2"]
    assert ask('HasValue("245a", "y, z")') == ["2"]
    for bad in ("Nothing()", 'IsSerial("a")', 'HasValue("245a" "x")', "IsSerial("):
        with pytest.raises(QueryError):
            compile_query(bad)


def test_json_records(spark):
    text = json.dumps({"id": 5, "title": "T", "authors": [{"name": "A"}, {"name": "B"}], "ids": [{"v": "doi:10.1/x"}, {"v": "no"}], "one": [{"v": "z"}]})
    maps = [formats.Mapping("245", "a", "$.title"), formats.Mapping("700", "a", "$.authors[*].name"), formats.Mapping("024", "a", "$.ids[*].v", "^doi:(.+)$"), formats.Mapping("650", "a", "$.one[*].v"), formats.Mapping("500", "a", "$.none")]
    got = formats.from_json(spark.createDataFrame([("5", text), ("6", None)], "k string, j string"), "j", "k", maps).orderBy("control_number").collect()
    assert plain(got[0]) == [("001", [("", "5")]), ("024", [("a", "10.1/x")]), ("245", [("a", "T")]), ("650", [("a", "z")]), ("700", [("a", "A")]), ("700", [("a", "B")])]
    assert plain(got[1]) == [("001", [("", "6")])]


def test_feeds_and_harvest(spark, tmp_path):
    rss = '<rss version="2.0"><channel><title>C</title><item><guid>g1</guid><title>One</title><link>http://x/1</link><pubDate>Sat, 07 Sep 2002 00:00:01 GMT</pubDate></item><item><title>Two</title><link>http://x/2</link></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>e1</id><title>Three</title><link rel="self" href="http://s"/><link href="http://x/3"/><updated>2003-12-13T18:30:02Z</updated></entry></feed>'
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.xml").write_text(rss)
    (tmp_path / "f/b.xml").write_text(atom)
    got = {r["item_id"]: (r["title"], r["link"], r["pub_date"]) for r in formats.read_feed(spark, str(tmp_path / "f")).collect()}
    assert got == {"g1": ("One", "http://x/1", datetime(2002, 9, 7, 0, 0, 1)), "http://x/2": ("Two", "http://x/2", None), "e1": ("Three", "http://x/3", datetime(2003, 12, 13, 18, 30, 2))}
    (tmp_path / "o.xml").write_text('<OAI-PMH><ListRecords><record><header><identifier>i</identifier><datestamp>2020-01-01</datestamp><setSpec>s</setSpec></header></record><record><header status="deleted"><identifier>i</identifier><datestamp>2020-02-01</datestamp></header></record></ListRecords></OAI-PMH>')
    assert [tuple(r)[:3] for r in formats.read_harvest(spark, str(tmp_path / "o.xml")).collect()] == [("i", "2020-02-01", True)]


def test_sections_scripts_archives_and_xml(spark, tmp_path):
    (tmp_path / "c.conf").write_text('top = 1\n[A]\nname = "x \\"y\\" # z"  # note\n; gone\nn= 5 ; five\n')
    assert list(map(tuple, formats.read_sections(spark, str(tmp_path / "c.conf")).collect())) == [("", "top", "1"), ("A", "name", 'x "y" # z'), ("A", "n", "5")]
    (tmp_path / "i.conf").write_text('[A]\nx = 1\ny = 2\n[B]\n@inherit "A"\ny = 3\n')
    assert [tuple(r) for r in formats.read_sections(spark, str(tmp_path / "i.conf")).collect()] == [("A", "x", "1"), ("A", "y", "2"), ("B", "x", "1"), ("B", "y", "3")]
    (tmp_path / "j.conf").write_text('[B]\n@inherit "A"\n')
    with pytest.raises(ValueError):
        formats.read_sections(spark, str(tmp_path / "j.conf"))
    assert formats.split_statements("SELECT ';' ; -- a;b\nINSERT /* ; */ x;# c;\n\n;") == ["SELECT ';'", "INSERT  x"]
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        for name, data in (("x/aut.mrc", b"1"), ("tit.mrc", b""), ("readme", b"r"), ("x-lok.mrc", b"l"), ("b001.raw", b"s"), ("c001.raw", b"c"), ("a012.raw", b"t"), ("normal.txt", b"n")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    got = {r["member"]: (r["kind"], bytes(r["content"])) for r in formats.read_archives(spark, str(tmp_path / "a.tar.gz")).collect()}
    assert got == {"x/aut.mrc": ("authority", b"1"), "tit.mrc": ("title", b""), "readme": ("other", b"r"), "x-lok.mrc": ("local", b"l"), "b001.raw": ("superior", b"s"), "c001.raw": ("authority", b"c"), "a012.raw": ("title", b"t"), "normal.txt": ("other", b"n")}
    df = records(spark, ("1", L, [f("001", ("", "1")), f("245", ("a", "<T & x>"), ("b", "y"), ind=("1", "0"))]))
    formats.write_xml(df, str(tmp_path / "xml"))
    back = files.read_xml(spark, str(tmp_path / "xml")).first()
    assert back["control_number"] == "1" and plain(back) == [("001", [("", "1")]), ("245", [("a", "<T & x>"), ("b", "y")])]
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    assert json.loads(formats.column_json(rows, ["s", "n"], ["n"]).first()[0]) == {"s": ["a", "b"], "n": [1, 2]}


def test_notifications_and_saved_searches(spark):
    items = spark.createDataFrame([("s", "i1", 5, 2024), ("s", "i2", 6, 2024), ("s", "i3", 9, 2001), ("s", "i4", 7, 2023)], "serial string, id string, ts int, year int")
    subs = spark.createDataFrame([("u", "s", 5), ("v", "s", 0)], "user string, serial string, seen int")
    sent = spark.createDataFrame([("v", "i1")], "user string, id string")
    assert sorted(map(tuple, incremental.notifications(items, subs, sent, "id", "ts", "year", 2024).collect())) == [("u", "s", "i2"), ("u", "s", "i4"), ("v", "s", "i2"), ("v", "s", "i4")]
    now = spark.createDataFrame([("q", "1"), ("q", "2"), ("r", "1")], "q string, i string")
    old = spark.createDataFrame([("q", "1"), ("q", "0"), ("r", "1"), ("r", "9")], "q string, i string")
    assert list(map(tuple, incremental.new_results(now, old, "q", "i").collect())) == [("q", "2")]
    assert sorted(map(tuple, incremental.advanced_results(now, old, "q", "i").collect())) == [("q", "1"), ("q", "2"), ("r", "1"), ("r", "9")]


def test_deliveries(spark):
    tracker = spark.createDataFrame([(1, "h1", "ok"), (2, "h2", "error"), (3, "h1", "ok")], "id int, hash string, state string")
    urls = spark.createDataFrame([(1, "https://doi.org/10.1234/AB"), (2, "http://x.org/p/")], "record_id int, url string")
    items = spark.createDataFrame([("a", "h1", ["http://dx.doi.org/10.1234/ab"]), ("b", "h1", ["http://new"]), ("c", "h2", ["https://x.org/p"]), ("d", "h9", [])], "k string, h string, urls array<string>")
    got = {r["k"]: (r["by"], r["records"]) for r in incremental.delivered(items, urls, tracker, "k", "h", ("error",)).collect()}
    assert got == {"a": ("url", [1]), "b": ("hash", [1, 3])}
    rows = spark.createDataFrame([("z", datetime(2024, 1, 1)), ("y", datetime(2024, 3, 1))], "source string, ts timestamp")
    assert [r["source"] for r in incremental.tardy(rows, "source", "ts", "2024-03-02 00:00:00", 30).collect()] == ["z"]
    assert [r["source"] for r in incremental.recent(rows, "ts", "2024-03-01 12:00:00").collect()] == ["y"]
    ends = rows.select(incremental.expiry(F.col("source"), F.col("ts"), F.col("source") == "z").alias("e"), "ts").collect()
    assert 30 <= (ends[0]["e"] - ends[0]["ts"]).days <= 60 and ends[1]["e"] is None


def test_feed_stream(spark, tmp_path):
    schema = "item_id string, title string"
    for n, rows in enumerate(([("a", "x" * 2000), ("a", "y"), ("b", "q")], [("b", "new"), ("c", None)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        incremental.store_new_items(stream, str(tmp_path / "out"), str(tmp_path / "mark"), longest=10).awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == [("a", "xxxxxxx..."), ("b", "q"), ("c", None)]
    assert os.path.isdir(tmp_path / "mark")


def test_reports(spark):
    rows = spark.createDataFrame([(2, "http://A.org/x", "404"), (1, "http://a.org/y", "404"), (3, "http://b.org", None), (4, "u", "dummy")], "id int, url string, error string")
    assert list(map(tuple, reports.error_report(rows, "id", "url", "error", ("dummy",)).collect())) == [("a.org", "404", 2, 1, "http://a.org/y")]
    lines = spark.createDataFrame([("1 INFO: a",), ("2 INFO: a",), ("3 SEVERE: b",), ("none",)], "line string")
    assert [tuple(r)[:3] for r in reports.log_report(lines, "line").orderBy("rank").collect()] == [("SEVERE", "b", 1), ("INFO", "a", 2)]
    assert reports.count_buckets(rows, {"bad": F.col("error").isNotNull(), "all": F.lit(True)}).first().asDict() == {"bad": 3, "all": 4}
    a = spark.createDataFrame([(1, "x", 5), (2, "y", None)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", 6), (3, None, 1)], "k int, s string, n int")
    assert sorted(map(str, map(tuple, reports.column_changes(a, b, "k", ["s", "n"]).collect()))) == ["(1, 'n', '5', '6')", "(2, 's', 'y', None)", "(3, 'n', None, '1')"]
    assert reports.schema_changes(a, b.drop("s").withColumn("z", F.lit(1))) == [("s", "string", None), ("z", None, "int")]
    nodes = spark.createDataFrame([("p", "200"), ("q", "x")], "k string, c string")
    links = spark.createDataFrame([("p", "q")], "src string, dst string")
    got = reports.classify(nodes, {"rel": [F.col("c").startswith("2")], "law": [F.col("c") == "262"]}, "k", links)
    assert sorted(map(tuple, got.collect())) == [("p", "rel"), ("q", "rel")]
