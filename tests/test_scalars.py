"""Conversions, and books, aliases and references to scripture, on small fixtures; where there is one, against Python's own function."""

import zlib

import pytest
from pyspark.sql import functions as F

from folioframe.functions import scalars, scripture


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("c"))).collect()]


def test_ends_tests_and_orders(spark):
    assert column(spark, [" a ", "[a]-", "", None], lambda c: scalars.trim_chars(c, " []-")) == ["a", "a", "", None]
    assert column(spark, ["--a--"], lambda c: scalars.trim_chars(c, "-", right=False)) == ["a--"]
    assert column(spark, ["7", "1234"], lambda c: scalars.padded(c, 3, "0")) == ["007", "1234"] and column(spark, ["7"], lambda c: scalars.padded(c, 3, "0", False)) == ["700"]
    assert column(spark, ["Über x", "a.b", "axb"], lambda c: scalars.starts_with_any(c, ["über", "a."], True)) == [True, True, False]
    assert column(spark, ["a.b", "axb\n"], lambda c: scalars.ends_with_any(c, [".b", "b"])) == [True, False]
    assert column(spark, ["ab", "abc", "x"], lambda c: scalars.is_proper_prefix(F.lit("ab"), c)) == [False, True, False]
    assert column(spark, ["ab;c,d", "none"], lambda c: scalars.find_any_of(c, ",;")) == [2, None] and column(spark, ["ab;c,d", ""], lambda c: scalars.find_any_of(c, ",;", True)) == [4, None]
    assert column(spark, ["The 'Art", "  der Baum", "Anna"], scalars.sort_key) == ["art", "baum", "anna"]


def test_lists_in_a_text(spark):
    lists = [["a", "b;c", "d\\e", ""], ["", ""], ["x\ny"], [";", "\\"]]
    df = spark.createDataFrame([(x,) for x in lists], "c array<string>")
    joined = df.withColumn("j", scalars.join_escaped(F.col("c"), ";"))
    assert [r[0] for r in joined.select(scalars.split_escaped(F.col("j"), ";")).collect()] == lists
    assert joined.first()["j"] == r"a;b\;c;d\\e;"
    assert column(spark, [" a | |b|", "", None], lambda c: scalars.split_trimmed(c, "|")) == [["a", "b"], [], None]
    assert column(spark, ["a|b|a||b"], lambda c: scalars.distinct_list(c, "|")) == ["a|b|"]


def test_excerpts(spark):
    assert column(spark, ["abcdefgh", "abc", "abcd"], lambda c: scalars.shortened(c, 4)) == ["a...", "abc", "abcd"]
    assert column(spark, ["aa bb cc dd", "longestword a b", "x\ny", ""], lambda c: scalars.wrapped(c, 5)) == ["aa bb\ncc dd", "longestword\na b", "x\ny", ""]
    pairs = [("xabcy", "zabcabq"), ("abc", ""), ("", "x"), ("ab", "cd"), ("banana", "ananas")]
    got = spark.createDataFrame(pairs, "a string, b string").select(scalars.longest_common_part(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["abc", "", "", "", "anana"]


def test_numbers_and_bytes(spark):
    assert column(spark, ["-ff", "10", "g", "", "+7", None], lambda c: scalars.number(c, 16)) == [-255, 16, None, None, 7, None]
    assert column(spark, [255, 0], lambda c: scalars.in_base(c, 16, 4), "long") == ["00ff", "0000"]
    assert column(spark, ["YES", "0", "maybe", None], scalars.truth) == [True, False, None, None]
    texts = ["", "Wikipedia", "Zürich 漢字", "a=b %41+c\t", "line\nnext ", "x" * 300]
    assert column(spark, texts, scalars.to_hex) == [t.encode().hex() for t in texts]
    assert column(spark, texts, lambda c: scalars.from_hex(scalars.to_hex(c))) == texts and column(spark, ["f", "zz", "ff"], scalars.from_hex) == [None] * 3
    assert column(spark, texts, scalars.adler32) == [zlib.adler32(t.encode()) for t in texts]
    assert column(spark, texts, lambda c: scalars.from_quoted_printable(scalars.quoted_printable(c))) == texts
    assert column(spark, ["é=", "end "], scalars.quoted_printable) == ["=C3=A9=3D", "end=20"] and column(spark, ["a=\nb=c3=A9"], scalars.from_quoted_printable) == ["abé"]
    assert column(spark, [r"a\n\"é😀\101\q\\", "plain", "", "end\\"], scalars.c_unescaped) == ['a\n"é😀Aq\\', "plain", "", "end\\"]
    assert column(spark, [b"\xe9", b"a"], lambda c: scalars.decoded(c, "latin-1"), "binary") == ["é", "a"]


def test_codes_and_times(spark):
    assert column(spark, ["DE", "zh-cn", "xx"], scalars.library_language) == ["deu", "hans", None] and column(spark, ["deu", "q"], scalars.two_letter_language) == ["de", None]
    times = ["2024-02-03T04:05:06Z", "2024-02-03T05:05:06+01:00", "2024-02-03 04:05:06", "Sat, 03 Feb 2024 04:05:06 GMT", "2024-02-03", "no"]
    assert column(spark, times, lambda c: scalars.time_of(c).cast("string")) == ["2024-02-03 04:05:06"] * 4 + ["2024-02-03 00:00:00", None]
    assert column(spark, ["03.02.2024", "x"], lambda c: scalars.reformatted(c, "dd.MM.yyyy", "yyyy-MM-dd")) == ["2024-02-03", None]
    assert column(spark, ["2024-07-01T10:00:00Z", "2024-01-01T10:00:00Z"], lambda c: scalars.local_time(c, "Europe/Berlin")) == ["2024-07-01 12:00:00", "2024-01-01 11:00:00"]
    assert column(spark, ["0:86400 5:6", "7"], scalars.dates_query) == ["[1970-01-01T00:00:00Z TO 1970-01-02T00:00:00Z] OR [1970-01-01T00:00:05Z TO 1970-01-01T00:00:06Z]", None]


CODES, SPELLINGS = {"1mose": "01", "4esra": "78", "markus": "41"}, {"1mos": "1mose", "1.mos": "1mose", "mk": "markus"}


def test_scripture_queries(spark):
    def found(c):
        return F.transform(scripture.references(c, CODES, SPELLINGS, {"sermon": "markus 5"}), lambda r: F.concat_ws("-", r["lower"], r["upper"]))

    asked = {
        "1. Mos 1,2b": ["01001002-01001002"], "Mk3 or 1mose": ["41003000-41003999", "01000000-01999999"], "Sermon": ["41005000-41005999"], "5 Esra": ["78001000-78002999"],
        "6Esra 1,2": ["78015002-78015002"], "Nobody 3": None, "Mk 3-1": None, "Mk": ["41000000-41999999"],
    }
    assert dict(zip(asked, column(spark, list(asked), found), strict=True)) == asked
    kept = lambda c: F.size(scripture.without_whole_books(scripture.references(c, CODES, SPELLINGS)))
    assert column(spark, ["Mk3 OR 1mose"], kept) == [1]


@pytest.mark.parametrize(
    "title, want",
    [
        ("Zu Mk 3,5-7 und 1 Mos. 4:", ["Mk 3,5-7", "1 Mos. 4"]),
        ("Vom 3. Mai 1990, Mk", []),
        ("Markus 1–3", ["Markus 1-3"]),
        ("Mk 3-1; Nobody 2", []),
        ("", []),
    ],
)
def test_scripture_in_titles(spark, title, want):
    codes = CODES | {"mai": "99"}
    assert column(spark, [title], lambda c: F.transform(scripture.mentions(c, codes, SPELLINGS), lambda m: m["text"])) == [want]


def test_suggestions_take_the_longest_passage(spark):
    rows = [(1, "The  good SAMARITAN today"), (2, "on mk 2:3"), (3, "nothing"), (4, None), (5, "Samaritan")]
    got = scripture.suggestions(spark.createDataFrame(rows, "k int, t string"), "k", "t", {"samaritan": "x", "good samaritan": "y"}, CODES, SPELLINGS)
    assert dict(map(tuple, got.collect())) == {1: "good samaritan", 2: "mk 2:3", 5: "samaritan"}
    assert scripture.suggestions(spark.createDataFrame(rows, "k int, t string"), "k", "t", {}, CODES).count() == 0
