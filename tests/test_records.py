import pytest
from pyspark.sql import functions as F

from folioframe.functions import ranges, strings
from folioframe.operators import graph, matching, validation
from folioframe.records import accessors, checks, edits, grep, model
from folioframe.records.query import QueryError

LEADER = "00000naa a2200000 u 4500"


def records(spark):
    rows = [
        ("1", LEADER, [
            ("001", "", "", [("", "1")]), ("100", " ", " ", [("a", "Doe, Jane")]), ("245", "1", "0", [("a", "Title /"), ("b", "rest"), ("n", "2")]),
            ("650", " ", "0", [("a", "One"), ("x", "sub"), ("a", "Two")]), ("650", " ", "7", [("a", "Three .")]), ("773", "1", "8", [("g", "year:1999"), ("g", "pages:1-9")]),
            ("LOK", " ", " ", [("0", "000  x")]), ("LOK", " ", " ", [("0", "852  "), ("a", "DE-21")]), ("LOK", " ", " ", [("0", "000  y")]), ("LOK", " ", " ", [("0", "001  z")]),
        ]),
        ("2", None, [("001", "", "", [("", "2")])]),
        ("3", LEADER, []),
        ("4", LEADER, None),
    ]
    return spark.createDataFrame(rows, model.SCHEMA)


def fields_of(df, key="1"):
    row = df.where(F.col("control_number") == key).first()
    return [(f["tag"], *((s["code"], s["value"]) for s in f["subfields"])) for f in row["fields"]]


@pytest.mark.parametrize(
    ("query", "want"),
    [
        ('"245a:100"', [("100", "Doe, Jane"), ("245a", "Title /")]),
        ('if 650a == "Two" extract 100a', [("100a", "Doe, Jane")]),
        ('if 650a === "Three" extract 650a', [("650a", "Three .")]),
        ('if 650a !== "Three" extract 650x, if 100 exists extract 245n', [("245n", "2"), ("650x", "sub")]),
        ('if 999 is_missing extract 100', [("100", "Doe, Jane")]),
        ('leader[7]="a" 100a', [("100a", "Doe, Jane")]),
        ('leader[5-7]="naa" 100a', [("100a", "Doe, Jane")]),
        ('leader[7]="m" 100a', []),
    ],
)
def test_projection(spark, query, want):
    got = grep.grep(records(spark), query).orderBy("place").collect()
    assert [(r["label"], r["value"]) for r in got if r["control_number"] == "1"] == want


def test_projection_errors(spark):
    for bad in ("", "if 245a", 'if 245a == "x" extract', 'if 245a === "x" extract 100a', "245a 100a", "24"):
        with pytest.raises(QueryError):
            grep.compile_projection(bad, F.lit(None), F.lit(None))


@pytest.mark.parametrize(
    ("ops", "tag", "want"),
    [
        ("remove-subfields 650a:Two", "650", [("650", ("x", "sub")), ("650", ("a", "Three ."))]),
        ("replace 245a '^(T)(.*) /$' '\\2-\\1$'", "245", [("245", ("a", "itle-T$"), ("b", "rest"), ("n", "2"))]),
        ("globally-substitute 650a '(e)' '<\\1>'", "650", [("650", ("a", "On<e>"), ("x", "sub"), ("a", "Two")), ("650", ("a", "Thr<e><e> ."))]),
        ("replace-subfield-if-regex 650a '/(.)e/\\1E/'", "650", [("650", ("a", "OnE"), ("x", "sub"), ("a", "Two")), ("650", ("a", "ThrEe ."))]),
        ("add-subfield 245c:by", "245", [("245", ("a", "Title /"), ("b", "rest"), ("c", "by"), ("n", "2"))]),
        ("add-subfield-if 245c:by 650a:Nine", "245", [("245", ("a", "Title /"), ("b", "rest"), ("n", "2"))]),
        ("replace-field 100a:X", "100", [("100", ("a", "X"))]),
        ("replace-code 650a=b", "650", [("650", ("b", "One"), ("x", "sub"), ("b", "Two")), ("650", ("b", "Three ."))]),
        ("filter-chars 100a ', '", "100", [("100", ("a", "DoeJane"))]),
        ("translate 100a ab cd\ndelete-fields 650 245", "100", [("100", ("a", "Doe, Jcne"))]),
        ("insert-field 650a:New", "650", [("650", ("a", "New")), ("650", ("a", "One"), ("x", "sub"), ("a", "Two")), ("650", ("a", "Three ."))]),
        ("replace 100a . ''", "100", []),
    ],
)
def test_op_lists(spark, ops, tag, want):
    got = edits.apply_ops(records(spark), ops)
    assert [f for f in fields_of(got) if f[0] == tag] == want
    assert got.count() == 4


def test_keep_and_drop_see_earlier_edits(spark):
    keys = lambda ops: sorted(r[0] for r in edits.apply_ops(records(spark), ops).collect())
    assert keys("keep 100a:Doe") == ["1"]
    assert keys("globally-substitute 100a Doe Roe\nkeep 100a:Doe") == []
    assert keys("keep-level a") == ["1", "3", "4"]
    assert keys("drop-level a") == ["2"]
    for bad in ("fly", "keep", "translate 100a abc d", "replace 100 a b", "replace-subfield-if-regex 100a x"):
        with pytest.raises(edits.OpError):
            edits.apply_ops(records(spark), bad)


def test_single_edits(spark):
    f = F.col("fields")
    edited = lambda c, tag: [x for x in fields_of(records(spark).withColumn("fields", c)) if x[0] == tag]
    assert edited(edits.put_subfield(f, "100", "a", F.lit("Z")), "100") == [("100", ("a", "Z"))]
    assert edited(edits.put_subfield(f, "100", "b", F.lit("Z")), "100") == [("100", ("a", "Doe, Jane"), ("b", "Z"))]
    assert edited(edits.move_subfield(f, "245", "b", "a"), "245") == [("245", ("a", "rest"), ("n", "2"))]
    assert edited(edits.delete_first_subfield(f, "650", "a"), "650") == [("650", ("x", "sub"), ("a", "Two"))]
    assert edited(edits.retag(f, "100", "700"), "700") == [("700", ("a", "Doe, Jane"))]
    assert len(fields_of(records(spark).withColumn("fields", edits.merge(f, f)))) == 10
    assert edited(edits.insert_at_end(f, model.field("100", {"a": F.lit("N")}), "100", unique=True), "100") == [("100", ("a", "Doe, Jane"))]
    assert [x[0] for x in fields_of(records(spark).withColumn("fields", checks.drop_unused_blocks(f, "DE-21")))].count("LOK") == 2


def test_accessors_and_checks(spark):
    f = F.col("fields")
    row = records(spark).select(
        accessors.complete_title(f).alias("t"), accessors.issue(f).alias("i"), accessors.authors(f).alias("a"), accessors.publication_year(F.col("leader"), f, 2024).alias("y"), checks.malformed(f).alias("m"),
        checks.is_valid(F.col("leader"), f).alias("v"), checks.repeated(f, ("245", "650")).alias("r"),
    ).first()
    assert (row["t"], tuple(row["i"]), row["a"], row["y"], row["m"], row["v"], row["r"]) == ("Title : rest 2", ("1999", "", "", "1-9"), ["Doe, Jane"], "1999", [], True, ["650"])


def test_year_of_serials(spark):
    year = lambda ind, value: ("363", *ind, [("i", value)])
    old = ("008", "", "", [("", "850101c19501959")])
    rows = [
        ("open", "00000nas a", [old, year("01", "1970")]), ("future", "00000nas a", [old, year("01", "2030")]), ("ended", "00000nas a", [old, year("01", "1970"), year("10", "1990")]),
        ("twice", "00000nas a", [year("10", "1990"), year("10", "1995"), ("363", "1", "0", [("a", "x")])]), ("book", "00000nam a", [old, year("10", "1990")]), ("none", "00000nas a", [old]),
        ("local", "00000nas a", [("ZWI", " ", " ", [("y", "2001")]), year("10", "1990")]),
    ]
    got = spark.createDataFrame(rows, model.SCHEMA).select("control_number", accessors.publication_year(F.col("leader"), F.col("fields"), 2024).alias("y"))
    assert dict(map(tuple, got.collect())) == {"open": "2024", "future": "2030", "ended": "1990", "twice": "1995", "book": "1959", "none": "1959", "local": "2001"}


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("", [("01000000", "01999999")]), ("22", [("01022000", "01022999")]), ("1,2", [("01001002", "01001002")]), ("1-3", [("01001000", "01003999")]), ("3-1", None),
        ("1,2-5,17", [("01001002", "01005017")]), ("17,3.6-8", [("01017003", "01017003"), ("01017006", "01017008")]), ("17,6.3", None), ("1, 2 b", [("01001002", "01001002")]), ("1234", None), (None, None),
    ],
)
def test_scripture(spark, said, want):
    got = spark.createDataFrame([(said,)], "t string").select(ranges.scripture(F.col("t"), F.lit("01"))).first()[0]
    assert (got and [tuple(r) for r in got]) == want


@pytest.mark.parametrize(
    ("said", "want"),
    [
        ("2000-1900", "100019000101_100020001231"), ("300 v. Chr. - 200 v. Chr.", "099997000101_099998001231"), ("v100-50", "099999000101_100000501231"), ("XX.XX.1992-XX.02.2000", "100019920101_100020000229"),
        ("2001-2-3", "100020010203_100020010203"), ("1950-", "100019500101_100020241231"), ("-1950", "000000000000_100019501231"), ("19XX-19XX", "100019000101_100019991231"), ("soon", None), (None, None),
    ],
)
def test_times(spark, said, want):
    assert spark.createDataFrame([(said,)], "t string").select(ranges.times(F.col("t"), 2024)).first()[0] == want


def test_scalars(spark):
    lit = F.lit
    want = {
        "MCMXCIV": strings.roman(lit("MCMXCIV")).cast("string"), "8M0kX": strings.base62(lit(123456789)), "0": strings.base62(lit(0)), "tolkien": strings.author_key(lit("J.R. Tolkien")),
        "hans muller": strings.author_key(lit("Müller, Hans P.")), "10.1000/abc.1": strings.doi(lit("https://doi.org/10.1000/ABC.1")), "1h 2m 3s 4ms": strings.milliseconds(lit(3723004)),
        "1,234,567": strings.grouped(lit(1234567)), "hello...": strings.truncate(lit("hello big world"), 12), "ab": strings.common_prefix(lit("abcd"), lit("abx")), "http://a.org/": strings.canonical_url(lit("HTTP://A.org:80#f")),
    }
    got = spark.range(1).select(*(c.alias(k) for k, c in want.items())).first().asDict()
    assert got == {k: "1994" if k == "MCMXCIV" else k for k in want}


def test_levels_and_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (4, 5), (5, 4), (5, 6), (0, 4)], "a int, b int")
    assert sorted(map(tuple, graph.levels(edges, "a", "b").collect())) == [(0, 0), (1, 0), (2, 1), (3, 2), (4, None), (5, None), (6, None)]
    assert sorted(r[0] for r in graph.cyclic(edges, "a", "b").collect()) == [4, 5]


def test_merge_of_linked_records(spark):
    rows = [("1", [("001", "", "", [("", "1")]), ("245", "", "", [("a", "T")])]), ("2", [("245", "", "", [("a", "T")]), ("100", "", "", [("a", "X")])]), ("9", [])]
    df = spark.createDataFrame(rows, f"control_number string, fields array<{model.FIELD}>")
    links = spark.createDataFrame([("1", "0"), ("0", "2")], "a string, b string")
    got = {r["control_number"]: (r["merged"], [f["tag"] for f in r["fields"]]) for r in matching.merge_linked(df, links, "control_number", "a", "b").collect()}
    assert got == {"2": (["1"], ["001", "100", "245"]), "9": ([], [])}


def test_synonym_chunks_and_merge_order(spark):
    names = spark.createDataFrame([("n", s) for s in ("aaaa", "bbbb", "cccc")], "n string, s string")
    got = matching.synonyms(spark.createDataFrame([("n",), ("m",)], "k string"), names, "k", "n", "s", 12).collect()
    assert {r["k"]: r["synonyms"] for r in got} == {"n": ["aaaa, bbbb", "cccc"], "m": None}
    files = spark.createDataFrame([("a", 1, "full"), ("b", 3, "delta"), ("c", 2, "full"), ("d", 3, "delete")], "name string, day int, kind string")
    ordered = validation.merge_order(files, "day", "kind", "full", {"full": 0, "delete": 1, "delta": 2}, "name")
    assert [r["name"] for r in ordered.orderBy("place").collect()] == ["c", "d", "b"]


def test_ngrams_against_brute_force(spark):
    from folioframe.functions import language

    said = "Ab, cde f"
    want = sorted(g for w in ("_ab_", "_cde_", "_f_") for n in range(1, 6) for k in range(len(w) - n + 1) if (g := w[k : k + n]) != "_")
    got = spark.createDataFrame([(said,), (None,), ("",)], "t string").select(language.ngrams(F.col("t"))).collect()
    assert sorted(got[0][0]) == want
    assert got[2][0] == []


def test_every_kth_counts_over_merged_partitions(spark):
    """Wide rows and their counts shuffle different numbers of bytes, so adaptive execution merges other partitions for each."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 9001, 1, 8).select(((F.col("id") * 7919) % 9001).alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("wide"))
        rows = rows.union(spark.createDataFrame([(None, "x")], "id bigint, wide string"))
        got = sorted(map(tuple, grep.every_kth(rows, ["id"], 3).select("id", F.length("wide")).collect()))
        assert got == [(n, 128) for n in range(2, 9001, 3)]  # the null is last
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
