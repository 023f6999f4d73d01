"""Record files in splits, deletion lists, dumps and further accessors on small fixtures."""

import pytest
from pyspark.sql import functions as F

from folioframe.functions import ranges
from folioframe.operators import dumps, intervals
from folioframe.operators.ranking import chunk_lengths, chunk_numbers
from folioframe.records import further, model
from folioframe.sources import files

LEADER = "00000nam a2200000 u 4500"


def records(spark, *rows):
    schema = f"control_number string, leader string, fields array<{model.FIELD}>"
    f = lambda tag, *subs: (tag, " ", " ", list(subs)) if tag >= "010" else (tag, "", "", [("", subs[0])])
    return spark.createDataFrame([(k, LEADER, [f(*x) for x in fields]) for k, *fields in rows], schema)


def test_binary_files_split_append_and_oversize(spark, tmp_path):
    path = str(tmp_path / "out")
    long = [("500", ("a", f"{k} " + "é" * 4000)) for k in range(30)]
    files.write_binary(records(spark, ("1", ("001", "1"), ("245", ("a", "ü\n x"))), ("2", ("001", "2"), *long)), path)
    files.write_binary(records(spark, *((str(k), ("001", str(k)), ("245", ("a", "t"))) for k in range(3, 200))), path, "append", 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        back = files.read_binary(spark, path)
        assert back.rdd.getNumPartitions() > 10
        got = {r["control_number"]: r for r in files.merge_parts(back).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=int) == [str(k) for k in range(1, 200)]
    assert got["1"]["fields"][1]["subfields"][0]["value"] == "ü\n x"
    assert sorted(f["subfields"][0]["value"] for f in got["2"]["fields"] if f["tag"] == "500") == sorted(v for _, (_, v) in long)


def test_formats_are_told_by_name_or_contents():
    assert files.detect_format("a.XML") == files.detect_format("a", b"\xef\xbb\xbf <collection>") == "xml"
    assert files.detect_format("b.mrc") == files.detect_format("b", b"00714cam") == "binary"
    with pytest.raises(ValueError):
        files.detect_format("c", b"nothing")


def test_deletion_list_forms(spark):
    lines = ["20240101000A1234567890001", "20240101000B123456789", "202401010009123456789X0001", "20240101000E123456789X", "", "short", "20240101000Z1234567890001"]
    got = dumps.deletions(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(map(tuple, got.collect())) == [("123456789", False), ("123456789X", False), ("123456789X", True)]


def test_repair_and_dates(spark):
    texts = ["Ã¼ber", "über", "plain", "â\u0082¬ 5", "漢字", "Â§ und Ã\u009f", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(further.repaired(F.col("t"))).collect()]
    assert got == ["über", "über", "plain", "€ 5", "漢字", "§ und ß", None]
    df = records(spark, ("1", ("264", ("c", "1999-05")), ("264", ("c", "1999")), ("264", ("c", "1985")), ("264", ("b", "x"))), ("2", ("245", ("a", "t"))))
    assert [r[0] for r in df.orderBy("control_number").select(further.production_dates(F.col("fields"))).collect()] == [["1985", "1999-05"], []]


def test_part_levels_need_a_parent(spark):
    rows = spark.createDataFrame([("a", "00000naa", ["p"]), ("b", "00000naa", ["q"]), ("c", "00000naa", []), ("d", "00000nam", ["q"]), ("e", "00000naa", ["q", "p"])], "control_number string, leader string, parents array<string>")
    got = dict(dumps.fixed_levels(rows, F.col("parents"), spark.createDataFrame([("p",)], "control_number string")).select("control_number", F.substr("leader", F.lit(8), F.lit(1))).collect())
    assert got == {"a": "a", "b": "b", "c": "a", "d": "m", "e": "a"}


def test_chunks(spark):
    rows = [([],), ([5, 5, 90, 3, 100],), ([1] * 25,), ([200],), (None,)]
    got = spark.createDataFrame(rows, "s array<int>").select(chunk_lengths(F.col("s"), 10).alias("n"), chunk_numbers(F.col("s"), 10).alias("k")).collect()
    assert [r["n"] for r in got] == [[], [2, 1, 1, 1], [10, 10, 5], [1], None] and got[1]["k"] == [0, 0, 1, 2, 3]


def test_overlaps_of_very_unequal_intervals(spark):
    left = [(k, k * 37 % 5000, k * 37 % 5000 + (4900 if k % 10 == 0 else k % 3)) for k in range(120)] + [(500, 0, 100_000), (501, 7, 7)]
    right = [(k, k * 53 % 6000, k * 53 % 6000 + k % 17) for k in range(150)] + [(900, 0, 1 << 40)]
    got = intervals.overlap_join(spark.createDataFrame(left, "a int, lo long, hi long"), spark.createDataFrame(right, "b int, c long, d long"), ("lo", "hi"), ("c", "d")).select("a", "b").collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a, lo, hi in left for b, c, d in right if d >= lo and c <= hi)


TIMES = {
    "1900-1950": "100019000101_100019501231", "1950-1900": "100019000101_100019501231", "1900": "100019000101_100019001231", "v50": "099999500101_099999501231", "ca. 1800-ca. 1810": "100018000101_100018101231",
    "12.03.1950-1951": "100019500312_100019511231", "1950-XX.02.1952": "100019500101_100019520229", "19XX-19XX": "100019000101_100019991231", "XXXX-1900": "000000000000_100019001231", "1900-": "100019000101_100020301231",
    "100 v. Chr. - 50 v. Chr.": "099999000101_099999501231", "v100-50": "099999000101_100000501231", "100avant J.-C. - 20": "099999000101_100000201231", "1900-02-03": "100019000203_100019000203", "-5.6.1900": "000000000000_100019000605",
    "abc": None, "": None, "-": None, "v100-": None, "XXXX-XXXX": None,
}


def test_time_ranges(spark):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    assert dict(df.select("t", ranges.times(F.col("t"), 2030)).collect()) == TIMES
    assert df.limit(1).select(ranges.times(F.lit("1500-1600"), 2030, True)).first()[0] == "100015000101_100015991231"
