"""Links of a record, local blocks, made records, registers, tags and fields by language on small fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from folioframe.operators import registers
from folioframe.records import linking, model

SCHEMA = f"control_number string, fields array<{model.FIELD}>"


def fields(spark, *rows):
    return spark.createDataFrame([(str(k), [(tag, " ", " ", list(subs)) for tag, *subs in row]) for k, row in enumerate(rows)], SCHEMA)


def flat(rows):
    return [[(f["tag"], *((s["code"], s["value"]) for s in f["subfields"])) for f in r] for r in rows]


def changed(spark, f, *rows):
    return flat(r[0] for r in fields(spark, *rows).orderBy("control_number").select(f(F.col("fields"))).collect())


def test_links_once_each(spark):
    doi = ("024", ("a", "10.1/x"), ("2", "doi"))
    added = ("856", ("u", "https://doi.org/10.1/x"), ("x", "doi"), ("3", "Volltext"))
    got = changed(
        spark, lambda f: linking.unique_links(f, linking.RESOLVERS | {"10900/": "https://repository.example/"}),
        [("856", ("u", "http://a.de/1")), ("856", ("u", "https://a.de/1")), ("856", ("u", "a.de/1")), ("856", ("u", "http://a.de/2 ")), ("856", ("z", "no link"))],
        [doi, ("856", ("u", "urn:nbn:1"), ("u", "second")), ("856", ("u", "10900/7")), ("856", ("u", "b.org")), ("856", ("u", "urn:nbn:1"))],
        [doi, ("LOK", ("0", "866  "), ("x", "not before 2030: 10.1/x"))],
        [doi, ("856", ("u", "https://doi.org/10.1/x"))],
        [],
    )
    assert got[0] == [("856", ("u", "http://a.de/1")), ("856", ("u", "http://a.de/2 ")), ("856", ("z", "no link"))]
    assert got[1] == [doi, ("856", ("u", "https://nbn-resolving.org/urn:nbn:1"), ("u", "second")), ("856", ("u", "https://repository.example/10900/7")), ("856", ("u", "http://b.org")), added]
    assert got[2] == [doi, ("LOK", ("0", "866  "), ("x", "not before 2030: 10.1/x"))]
    assert got[3] == [doi, ("856", ("u", "https://doi.org/10.1/x"))] and got[4] == []


def test_headings_of_other_scripts(spark):
    f880 = ("880", ("6", "750-01/Hans"), ("a", "字"), ("2", "own"), ("9", "Z:AB"), ("9", "L:x"))
    got = changed(spark, lambda f: linking.translated_headings(f, "own"), [f880, ("900", ("a", "z"))], [("880", ("6", "750-01/Hant"), ("a", "b"), ("2", "other"))], [("880", ("6", "100-01"), ("a", "b"), ("2", "own"))])
    assert got[0] == [f880, ("900", ("a", "z")), ("750", ("a", "字"), ("2", "own"), ("9", "L:hans"), ("9", "Z:AB"))]
    assert [len(r) for r in got[1:]] == [1, 1]


def test_local_blocks(spark):
    block = lambda owner, *codes: [("LOK", ("0", "000 xx")), ("LOK", ("0", "852  "), ("a", owner)), *(("LOK", ("0", "936ln"), ("a", c)) for c in codes)]
    rows = [block("us", "B", "A", "Q") + block("them", "C"), block("them", "A"), block("us"), []]
    got = changed(spark, lambda f: linking.with_notations(f, ["us"], ["A", "B", "C"]), *rows)
    assert [f for f in got[0] if f[0] == "652"] == [("652", ("a", "A:B"))] and [len(r) for r in got[1:]] == [3, 2, 0]
    df = fields(spark, *rows).orderBy("control_number")
    assert [r[0] for r in df.select(linking.held_by_alone(F.col("fields"), "us")).collect()] == [False, False, True, False]
    refs = fields(spark, [("650", ("0", "(DE-588)2"), ("0", "(DE-588)1")), ("100", ("0", "(DE-588)9")), ("LOK", ("0", "(DE-588)2")), ("689", ("0", "(DE-627)3"))])
    assert refs.select(linking.authority_references(F.col("fields"))).first()[0] == ["1", "2"] and refs.select(linking.authority_references(F.col("fields"), ["LOK"])).first()[0] == ["2"]


def test_records_of_archives_and_bundles(spark):
    link = lambda u, *kinds: ("BEA", ("0", "lr"), ("u", u), ("a", "Arch"), *(("v", k) for k in kinds))
    person = [("035", ("a", "(DE-588)77")), ("100", ("a", "Last, First"), ("b", "II."), ("c", "Prof."), ("d", "1800-1870"))]
    got = linking.archive_records(fields(spark, [*person, link("u1", "Teilnachlass", "Briefe"), link("u2")], [*person, link("u3")], [*person, ("BEA", ("0", "xx"))], [link("u")])).collect()
    assert [r["control_number"] for r in got] == ["LR77"]
    made = {f[0]: f[1:] for f in flat([got[0]["fields"]])[0] if f[0] != "856"}
    assert made["245"] == (("a", "Teilnachlass von First II. Last (Prof.), 1800-1870 (Teilnachlass, Briefe)"),)
    assert made["100"] == (("a", "Last, First II. (Prof.)"), ("0", "(DE-588)77"), ("0", "(DE-627)0"), ("d", "1800-1870"))
    assert [f[1][1] for f in flat([got[0]["fields"]])[0] if f[0] == "856"] == ["u1", "u2", "u3"]
    rows = fields(spark, [("245", ("a", "t"))], []).withColumn("leader", F.lit("x"))
    bundles = spark.createDataFrame([("z", "0"), ("b", "0"), ("b", "9")], "bundle string, member string")
    out = {r["control_number"]: flat([r["fields"]])[0] for r in linking.bundle_records(rows, bundles, spark.createDataFrame([("b", "All")], "bundle string, title string")).collect()}
    assert out == {"0": [("245", ("a", "t")), ("BSP", ("a", "b"), ("a", "z"))], "1": [], "b": [("001", ("", "b")), ("245", ("a", "All")), ("SPR", ("a", "1"))]}


def test_registers(spark):
    day = datetime.date
    old = spark.createDataFrame([(1, day(2024, 1, 1), "a", "x"), (2, day(2024, 5, 1), "b", None), (3, day(2024, 1, 1), "c", "y")], "id int, t date, name string, note string")
    new = spark.createDataFrame([(1, day(2024, 1, 4), "A", None), (2, day(2024, 1, 1), "B", "n"), (4, day(2024, 1, 1), "d", None)], "id int, t date, name string, note string")
    assert list(map(tuple, registers.register_changes(old, new, "id", "t", ["name", "note"]).collect())) == [(1, "name", "a", "A", 3)]
    merged = {r["id"]: (r["name"], r["note"]) for r in registers.register_merged(old, new, "id", "t", ["name", "note"]).collect()}
    assert merged == {1: ("A", "x"), 2: ("b", None), 3: ("c", "y"), 4: ("d", None)}
    articles = spark.createDataFrame([("k", "1", "2020", "7", "", "1"), ("l", "1", "2020", "7", "123456789", "2"), ("m", "9", "2020", "7", "1", "3")], "key string, parent string, year string, volume string, issue string, pages string")
    got = registers.journal_articles(articles, spark.createDataFrame([("1", 5)], "ppn string, journal int"), "parent", "ppn")
    assert sorted((r["key"], r["volume"], r["issue"], r["journal"]) for r in got.collect()) == [("k", "", "7", 5), ("l", "7", "12345678", 5)]


def test_tags_and_terms(spark):
    tags, resources = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, tag string"), spark.createDataFrame([(7, "r"), (8, "s"), (9, "t")], "id int, record_id string")
    uses = spark.createDataFrame([(1, 7), (2, 7), (2, 8), (2, 8)], "tag_id int, resource_id int")
    t, u, r = registers.clean_tags(tags, uses, resources, spark.createDataFrame([("r",), ("r",)], "record_id string"))
    assert [x["id"] for x in t.collect()] == [2] and u.count() == 2 and [x["id"] for x in r.collect()] == [8]
    assert dict(map(tuple, registers.tag_keywords(tags, uses, resources).collect())) == {"r": ["a", "b"], "s": ["b"]}
    rows = spark.createDataFrame([(1, ["Epoch"], ["x", "y, gnd/12345678"]), (2, ["Epoch"], ["p", "q"]), (3, ["one"], ["z"]), (4, ["123456789"], ["p", "q"])], "k int, a array<string>, b array<string>")
    assert list(map(tuple, registers.reference_terms(rows, F.col("a"), F.col("b"), "k").collect())) == [("Epoch", "x,y")]


@pytest.mark.parametrize("asked", [["Art", "Bible"], ["zz"], ["b", "a", "c", "d", "e"]])
def test_chains_are_aligned(spark, asked):
    def plain(chain):
        chain = list(chain)
        for i in range(min(len(asked), len(chain))):
            n = [next((k for k, (x, y) in enumerate(zip(asked[i], w, strict=False)) if x != y), min(len(asked[i]), len(w))) for w in chain]
            best = max(range(i, len(chain)), key=lambda k: (n[k], -k))
            best = best if n[best] else i
            chain[i], chain[best] = chain[best], chain[i]
        return chain

    chains = [["Bibel", "Bible", "Arts"], ["x"], [], ["ca", "ab", "bc", "b", "e"], ["Art", "Art", "art"]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chains)], "i int, c array<string>")
    assert [r[0] for r in df.orderBy("i").select(registers.aligned_chain(F.col("c"), asked)).collect()] == list(map(plain, chains))


def test_fields_by_language(spark):
    known = {"title_de", "topic_de"}
    asked = {
        'title:x AND (+topic:"a title:b" -other:y)': 'title_de:x AND (+topic_de:"a title:b" -other:y)', r"a\:title:b": r"a\:title_de:b", "subtitle:x title:[a TO b]": "subtitle:x title_de:[a TO b]", "": "", "title": "title",
    }
    assert {q: registers.localized_query(q, "de", known) for q in asked} == asked
    rows = spark.createDataFrame([("a", "b", None), ("a", None, "x")], "title string, title_de string, full string")
    assert [r["title"] for r in registers.localized_columns(rows, ["title", "full"], "de").collect()] == ["b", "a"]
    assert [r[0] for r in rows.select(registers.has_any_text(["full", "title_de"])).collect()] == [True, True] and rows.select(registers.has_any_text(["full"])).first()[0] is False
