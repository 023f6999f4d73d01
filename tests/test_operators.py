import os
from datetime import timezone

import pytest
from pyspark.sql import functions as F

from folioframe.functions import language, text
from folioframe.operators import graph, intervals, ranking, sets
from folioframe.plans import catalogue
from folioframe.records import model
from folioframe.records.query import QueryError, compile_query
from folioframe.sources import files
from folioframe.streaming import events


@pytest.mark.parametrize(("q", "r", "want"), [((0, 2), (2, 4), 0.2), ((0, 2), (1, 2), 2 / 3), ((0, 3), (1, 2), 0.5), ((0, 2), (5, 7), -0.25)])
def test_interval_scores(spark, q, r, want):
    got = spark.range(1).select(intervals.score(*map(F.lit, (*q, *r)))).first()[0]
    assert got == pytest.approx(want)


def test_overlap_join_is_complete_and_distinct(spark):
    left = [(i, i * 7 % 90, i * 7 % 90 + i % 40) for i in range(40)]
    right = [(i, i * 11 % 90, i * 11 % 90 + i % 25) for i in range(40)]
    got = intervals.overlap_join(
        spark.createDataFrame(left, "a int, lo int, hi int"), spark.createDataFrame(right, "b int, c int, d int"), ("lo", "hi"), ("c", "d")
    ).select("a", "b")
    want = sorted((a, b) for a, lo, hi in left for b, c, d in right if d >= lo and c <= hi)
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_overlap_query_has_every_order(spark):
    sf = "/root/testdata/sf0.001"
    day = lambda ts: int(ts.replace(tzinfo=timezone.utc).timestamp()) // 86400
    spans = {}
    for k, ts in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_shipdate").toPandas().itertuples(index=False):
        lo, hi = spans.get(k, (10**9, -1))
        spans[k] = min(lo, day(ts)), max(hi, day(ts))
    want = {}
    for q, ts in spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderdate").toPandas().itertuples(index=False):
        met = [k for k, (lo, hi) in spans.items() if hi >= day(ts) and lo <= day(ts) + 3]
        if met:
            want[q] = (len(met), min(met))
    got = {r["q"]: (r["n"], r["first_k"]) for r in catalogue.QUERIES["interval_overlap"](spark, sf).collect()}
    assert got == want
    assert any(q % 97 for q in got)


def test_graph_with_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 8), (7, 7)], "a int, b int")
    assert sorted(map(tuple, graph.canonical(edges, "a", "b").collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 8), (9, 8)]
    tags = spark.createDataFrame([(1, "x")], "node int, tag string")
    assert sorted(map(tuple, graph.propagate(tags, edges, "node", "tag", "a", "b").collect())) == [(1, "x"), (2, "x"), (3, "x")]


def test_graph_against_brute_force(spark):
    pairs = [(i, i * 37 % 211) for i in range(0, 400, 3)] + [(i, i + 1) for i in range(500, 540)]
    out, near = {}, {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def reach(start, steps):
        seen, todo = {start}, [start]
        while todo:
            new = steps.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        return seen

    edges = spark.createDataFrame(pairs, "a int, b int")
    assert sorted(map(tuple, graph.canonical(edges, "a", "b").collect())) == sorted((n, min(reach(n, near))) for n in near)
    seeds = [(a, a % 5) for a in range(0, 400, 12)] + [(505, 1)]
    tagged = spark.createDataFrame(seeds, "node int, tag int")
    want = sorted({(n, tag) for a, tag in seeds for n in reach(a, out)})
    assert sorted(map(tuple, graph.propagate(tagged, edges, "node", "tag", "a", "b").collect())) == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_closure_queries_reach_every_customer(spark):
    sf = "/root/testdata/sf0.01"
    keys = {r[0] for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey").distinct().collect()}
    assert max(keys) >= 1000 and any(k % 3 for k in keys)
    least = lambda k: least(k // 7) if k and k % 7 == 0 and k // 7 in keys else k
    got = dict(map(tuple, catalogue.QUERIES["connected_components"](spark, sf).collect()))
    assert got == {n: least(n) for k in keys for n in (k, 7 * k)}
    assert {r["node"] for r in catalogue.QUERIES["tag_propagation"](spark, sf).collect()} == set(got)


def test_compare_tells_null_from_empty(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, ""), (2, "x"), (4, "z")], "k int, v string")
    assert dict(map(tuple, sets.compare(a, b, "k", ["v"]).collect())) == {1: "changed", 2: "same", 3: "left", 4: "right"}


def test_chunks(spark):
    got = spark.createDataFrame([([5, 5, 90, 3, 100],)], "s array<int>").select(ranking.chunk_numbers(F.col("s"), 10)).first()[0]
    assert got == [0, 0, 1, 2, 3]


def test_identifiers(spark):
    rows = spark.createDataFrame([("0317-8471", True), ("0317-8472", False), ("2434-561X", True), ("", False), (None, False)], "s string, want boolean")
    assert all(r[0] == r[1] for r in rows.select(text.issn_valid(F.col("s")), "want").collect())


def record(spark):
    rows = [("1", "x" * 24, [("001", "", "", [("", "1")]), ("245", "1", "0", [("a", "Title"), ("b", "rest")]), ("650", " ", "0", [("a", "One")]), ("650", " ", "0", [("a", "Two")])])]
    return spark.createDataFrame(rows, model.SCHEMA)


@pytest.mark.parametrize(
    ("query", "want"),
    [
        ('650a == "One"', True), ('650a != "One"', False), ('NOT 650a == "Three"', True), ('650a == /^T/ AND NOT (245a == "x" OR 245b == "y")', True),
        ("999 EXISTS", False), ("245b EXISTS AND 245a == /itl/", True),
    ],
)
def test_query_language(spark, query, want):
    assert record(spark).select(compile_query(query)).first()[0] is want


def test_query_errors():
    for bad in ("", "245a ==", "245a = x", '(245a == "x"', '24 == "x"', '245a == "x" 1'):
        with pytest.raises(QueryError):
            compile_query(bad, F.lit(None))


def test_binary_round_trip_with_oversize_record(spark, tmp_path):
    fields = [{"tag": "001", "ind1": "", "ind2": "", "subfields": [{"code": "", "value": "k1"}]}]
    fields += [{"tag": "900", "ind1": " ", "ind2": " ", "subfields": [{"code": c, "value": "This is a test string."} for c in "abcd"]} for _ in range(3000)]
    data = files.binary_record("00000nam a2200000 u 4500", fields)
    assert data.count(b"\x1d") > 1
    (tmp_path / "x.mrc").write_bytes(data + files.binary_record("00000nam a2200000 u 4500", [fields[0] | {"subfields": [{"code": "", "value": "k2"}]}]))
    got = files.read_binary(spark, str(tmp_path)).select("control_number", F.size("fields")).collect()
    assert sorted(map(tuple, got)) == [("k1", 3001), ("k2", 1)]


def test_xml_maps_and_beacons(spark, tmp_path):
    (tmp_path / "r.xml").write_text('<c><record><leader>L</leader><controlfield tag="001">7</controlfield><datafield tag="245" ind1="1" ind2="0"><subfield code="a">T</subfield></datafield></record></c>')
    got = files.read_xml(spark, str(tmp_path / "r.xml")).select("control_number", model.first_value(F.col("fields"), "245", "a")).first()
    assert tuple(got) == ("7", "T")
    (tmp_path / "m.map").write_text("# note\na=b;\nc\\=d=e;\n\n")
    assert dict(map(tuple, files.read_map(spark, str(tmp_path / "m.map")).collect())) == {"a": "b", "c=d": "e"}
    (tmp_path / "b.txt").write_text("#FORMAT: X\n#TARGET: http://h/{ID}\n11|3\n12\n")
    assert sorted(map(tuple, files.read_beacon(spark, str(tmp_path / "b.txt")).collect())) == [("11", 3, "http://h/11"), ("12", 1, "http://h/12")]


def test_islands_number_rows_as_the_sql(spark):
    days = [0, 0, 10, 41, 41, 73, None, 0, 200, 200]  # ties, intervals that touch, that lie apart, and one without a day
    rows = [(1, d) for d in days] + [(2, None), (2, None), (None, 5), (None, 5)]
    df = spark.createDataFrame(rows, "k int, d int").select("k", F.col("d").alias("lo"), (F.col("d") + 30).alias("hi"))
    got = [tuple(r) for r in intervals.islands(df.repartition(4), ["k"], "lo", "hi").select("k", "lo", "hi", "n").collect()]
    want = [(1, 0, 71, 6), (1, 73, 103, 1), (1, 200, 230, 3), (2, None, None, 1), (2, None, None, 1), (None, 5, 35, 2)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_language_profiles(spark):
    rows = spark.createDataFrame([("en", "the house of the king and the man"), ("de", "der und die das ist nicht ein haus")], "lang string, text string")
    model_ = language.profiles(rows, "lang", "text")
    asked = spark.createDataFrame([(1, "the man and the house"), (2, "die und das ist ein")], "id int, text string")
    assert {r["id"]: r["lang"] for r in language.classify(asked, model_, "id", "text", "lang").collect()} == {1: "en", 2: "de"}


def test_language_candidates(spark):
    model_ = spark.createDataFrame([("en", "a", 1.0), ("de", "b", 1.0), ("fr", "_a", 0.5)], "lang string, ngram string, weight double")
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (3, "1 2")], "id int, text string")  # a, _a, a_, _a_
    got = lambda cutoff: sorted((r["id"], r["lang"], round(r["score"], 6)) for r in language.candidates(asked, model_, "id", "text", "lang", cutoff).collect())
    assert got(1.0) == [(1, "en", 0.5), (2, "de", 0.5)]
    assert got(0.5) == [(1, "en", 0.5), (1, "fr", 0.25), (2, "de", 0.5)]
    assert len(got(0.0)) == 6


def test_candidates_shuffle_no_ngrams_and_merge_equal_keys(spark):
    model_ = spark.createDataFrame([("en", "a", 1.0), ("de", "b", 1.0)], "lang string, ngram string, weight double")
    asked = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b b"), (None, "a")], "id int, text string").repartition(3)
    got = language.candidates(asked, model_, "id", "text", "lang")
    # Of "a b b": n-grams of b twice, so a norm of sqrt(4 * (1 + 4)) with _a, a_, _a_ beside a.
    assert sorted((r["id"], r["lang"], round(r["score"], 6)) for r in got.collect()) == [(1, "en", 0.5), (2, "de", round(2 / 20**0.5, 6))]
    one = language.candidates(asked.where("id = 1"), model_, "id", "text", "lang")
    assert "HashAggregate" not in one._jdf.queryExecution().executedPlan().toString()


def test_shortest_cycle(spark):
    def found(pairs):
        return [r["node"] for r in graph.shortest_cycle(spark.createDataFrame(pairs, "a int, b int"), "a", "b").orderBy("place").collect()]

    two = [(1, 2), (2, 3), (3, 4), (4, 1), (4, 5), (5, 6), (6, 9), (9, 8), (8, 6)]  # 5 lies between two cycles
    assert found(two) == [6, 9, 8]
    assert found([*two, (3, 1)]) == [1, 2, 3]
    assert found([*two, (7, 7)]) == [7]
    assert found([(1, 2), (2, 3), (1, 3)]) == []


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.sql("select id, timestamp'2024-01-01' + make_interval(0,0,0,0,0,id * 7) as ts, concat('k', id % 3) as k from range(60)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = events.windowed(stream, "ts", ["k"], "1 hour").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = sorted(map(tuple, events.windowed(rows, "ts", ["k"], "1 hour").collect()))
    assert sorted(map(tuple, spark.sql("select * from w").collect())) == want
