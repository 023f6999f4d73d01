"""A projecting query language over records: what to extract, and from which records.

    query     = [leader[a-b]="text"] statement {"," statement}
    statement = "REF[:REF...]"
              | if REF (== | != | === | !==) "pattern" extract (REF | *)
              | if REF (exists | is_missing) extract (REF | *)

A REF is a tag with an optional subfield code, in quotes or bare. == holds if any occurrence matches and != if none does; === and
!== test the field that is extracted from, so both references must have one tag. A leader condition (positions from 0, both ends
included) selects records. Results are ordered by tag and code, equal ones as in the record.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.operators.graph import _folder
from folioframe.records import model
from folioframe.records.query import QueryError

_TOKEN = re.compile(r'\s*(?:(?P<text>"(?:[^"\\]|\\.)*")|(?P<op>===|!==|==|!=|=|,|\*|\[|\]|-)|(?P<word>[A-Za-z0-9_]+))')
_HIT = "struct<tag: string, code: string, value: string>"


def _tokens(query: str) -> list[tuple[str, str]]:
    out, at, query = [], 0, query.rstrip()
    while at < len(query):
        m = _TOKEN.match(query, at)
        if not m:
            raise QueryError(f"unexpected {query[at:at + 10]!r}")
        at = m.end()
        kind, value = next((k, v) for k, v in m.groupdict().items() if v is not None)
        out.append((kind, re.sub(r"\\([\"\\])", r"\1", value[1:-1]) if kind == "text" else value))
    return out


def _reference(text: str) -> tuple[str, str | None]:
    if len(text) not in (3, 4):
        raise QueryError(f"no reference: {text!r}")
    return text[:3], text[3:] or None


def _hits(fields: Column, code: str | None) -> Column:
    """(tag, code, value) of the subfields of fields; without a code, a field's values joined by spaces."""
    if code is None:
        whole = lambda f: F.array_join(F.transform(f["subfields"], lambda s: s["value"]), " ")
        return F.transform(fields, lambda f: F.struct(f["tag"].alias("tag"), F.lit("").alias("code"), whole(f).alias("value")))

    def of(f: Column) -> Column:
        chosen = F.filter(f["subfields"], lambda s: s["code"] == code)
        return F.transform(chosen, lambda s: F.struct(f["tag"].alias("tag"), s["code"].alias("code"), s["value"].alias("value")))

    return F.flatten(F.transform(fields, of))


def _test(f: Column, code: str | None, pattern: str) -> Column:
    return F.exists(f["subfields"], lambda s: (F.lit(True) if code is None else s["code"] == code) & s["value"].rlike(pattern))


class _Parser:
    def __init__(self, query: str, fields: Column, leader: Column):
        self.rest, self.fields, self.leader = _tokens(query)[::-1], fields, leader

    def take(self, *wanted: str) -> str:
        if not self.rest:
            raise QueryError("the query ends too early")
        _, value = self.rest.pop()
        if wanted and value not in wanted:
            raise QueryError(f"{' or '.join(wanted)} expected, not {value!r}")
        return value

    def peek(self) -> str | None:
        return self.rest[-1][1] if self.rest else None

    def parse(self) -> tuple[Column, Column]:
        condition = F.lit(True)
        if self.peek() == "leader":
            self.take()
            self.take("[")
            first = int(self.take())
            last = first
            if self.take("-", "]") == "-":
                last = int(self.take())
                self.take("]")
            self.take("=")
            condition = F.substring(self.leader, first + 1, last - first + 1) == self.take()
        hits = [self.statement()]
        while self.rest:
            self.take(",")
            hits.append(self.statement())
        return condition, F.concat(*hits)

    def chosen(self, tag: str | None) -> Column:
        return self.fields if tag is None else F.filter(self.fields, lambda f: f["tag"] == tag)

    def target(self) -> tuple[str | None, str | None]:
        return (None, None) if self.peek() == "*" and self.take() else _reference(self.take())

    def statement(self) -> Column:
        none = F.expr(f"cast(array() as array<{_HIT}>)")
        if self.peek() != "if":
            references = [_reference(r) for r in self.take().split(":")]
            return F.concat(*(_hits(self.chosen(tag), code) for tag, code in references))
        self.take("if")
        tag, code = _reference(self.take())
        op = self.take("==", "!=", "===", "!==", "exists", "is_missing")
        if op in ("exists", "is_missing"):
            found = model.has_tag(self.fields, tag) if code is None else model.matches(self.fields, tag, code, "")
            found = found if op == "exists" else ~found
            pattern = None
        else:
            pattern = self.take()
            found = model.matches(self.fields, tag, code, pattern)
            found = found if op == "==" else ~found
        self.take("extract")
        to, to_code = self.target()
        if op in ("===", "!=="):
            if to not in (None, tag):
                raise QueryError(f"{op} needs one tag, not {tag} and {to}")
            same = F.filter(self.fields, lambda f: (f["tag"] == tag) & (_test(f, code, pattern) if op == "===" else ~_test(f, code, pattern)))
            return _hits(same, to_code)
        return F.when(found, _hits(self.chosen(to), to_code)).otherwise(none)


def compile_projection(query: str, fields: Column | None = None, leader: Column | None = None) -> tuple[Column, Column]:
    """The record condition and the array of (tag, code, value) that a query extracts."""
    return _Parser(query, F.col("fields") if fields is None else fields, F.col("leader") if leader is None else leader).parse()


def grep(records: DataFrame, query: str, control_numbers: DataFrame | None = None, every: int = 1, limit: int | None = None, key: str = "control_number") -> DataFrame:
    """(key, place, label, value) of what the query extracts, one row a value.

    control_numbers restricts the records to those listed, every keeps each k-th record in the order of keys (a sample that needs one
    sort, numbered over ranges), and limit is the number of records examined.
    """
    condition, hits = compile_projection(query)
    rows = records
    if control_numbers is not None:
        rows = rows.join(control_numbers.select(key).distinct(), key, "left_semi")
    if every > 1:
        rows = every_kth(rows, [key], every)
    if limit is not None:
        rows = rows.limit(limit)
    place = F.transform(hits, lambda h, i: F.struct(h["tag"].alias("tag"), h["code"].alias("code"), i.alias("i"), h["value"].alias("value")))
    got = rows.where(condition).select(key, F.posexplode(F.array_sort(place)).alias("place", "h"))
    return got.select(key, "place", F.concat("h.tag", "h.code").alias("label"), F.col("h.value").alias("value"))


def every_kth(rows: DataFrame, order: list[str], k: int) -> DataFrame:
    """Rows number k, 2k, 3k ... in an order (nulls last), without a task that sees all rows.

    Rows are sorted over ranges, and each partition's numbers start behind the counts of those before it; the counts are one small row a partition.
    The sorted rows are written once and read for both: made twice, adaptive execution may merge the partitions of each in another way.
    """
    from pyspark.sql import Window

    path, by = _folder(rows.sparkSession), [F.asc_nulls_last(c) for c in order]
    parted = rows.repartitionByRange(*by).withColumn("__p", F.spark_partition_id())
    made = parted.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(*by)))
    made.write.parquet(path)
    numbered = rows.sparkSession.read.schema(made.schema).parquet(path)
    counts = numbered.groupBy("__p").agg(F.count("*").alias("__c"))
    offsets = counts.select("__p", (F.sum("__c").over(Window.orderBy("__p")) - F.col("__c")).alias("__o"))
    return numbered.join(F.broadcast(offsets), "__p").where((F.col("__n") + F.col("__o")) % k == 0).drop("__p", "__n", "__o", "__c")


def tag_grep(records: DataFrame, pattern: str, key: str = "control_number") -> DataFrame:
    """(key, tag, value) of the fields whose tag has a match of the pattern."""
    got = records.select(key, F.explode(F.filter("fields", lambda f: f["tag"].rlike(pattern))).alias("f"))
    return got.select(key, "f.tag", F.array_join(F.transform("f.subfields", lambda s: s["value"]), " ").alias("value"))


def in_ranges(fields: Column, tag: str, code: str, ranges: list[tuple[str, str]], mode: str = "any") -> Column:
    """Whether a value lies in any (or in all) of the closed ranges, compared as text."""
    if mode not in ("any", "all"):
        raise QueryError(f"no mode: {mode!r}")

    def inside(v: Column) -> Column:
        tests = [(v >= low) & (v <= high) for low, high in ranges]
        return reduce((lambda a, b: a | b) if mode == "any" else (lambda a, b: a & b), tests, F.lit(mode == "all"))

    return F.exists(model.values(fields, tag, code), inside)


def with_heading(records: DataFrame, headings: DataFrame, tag: str = "650", key: str = "control_number") -> DataFrame:
    """Records with a field whose first $a, in lower case and without blanks and periods at its end, is a heading."""
    form = lambda c: F.regexp_replace(F.lower(c), r"[ .]+$", "")
    firsts = F.transform(F.filter("fields", lambda f: f["tag"] == tag), lambda f: F.get(F.filter(f["subfields"], lambda s: s["code"] == "a"), F.lit(0))["value"])
    asked = records.select(key, F.explode(firsts).alias("__h")).select(key, form(F.col("__h")).alias("__h"))
    wanted = headings.select(form(F.col(headings.columns[0])).alias("__h")).distinct()
    return records.join(asked.join(wanted, "__h", "left_semi").select(key), key, "left_semi")
