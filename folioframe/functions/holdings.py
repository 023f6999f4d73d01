"""Holdings statements of serials, and whether an issue is held.

A statement lists spans divided by `;`, `,` followed by a space, or `&`. A span is a point, `point - point`, `point -` (still running) or `point,issue - issue`. A
point is a volume and year (`12.1990`, `12(1990)`, `Vol. 12 (1990)`) or a year, either with an issue behind a comma or slash (`12.1990,3`, `1990,3`). Volumes and
years may be double (`6/7.1990/91`, `1999/2000`): a span begins with the first and ends with the last of them. Notes in square brackets (but not numbers there), text in
parentheses and a tail after `=` count for nothing. A span without a year in its first point is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_YEAR = r"(\d{4})(?:/(\d{4}|\d{2})(?!\d))?"
_POINT = rf"(?:(?:vol\.|bd\.|jg\.|v\.)?(\d{{1,4}})(?:/(\d{{1,4}}))?(?:\.|\((?=\d{{4}}[)/]))\(?)?{_YEAR}\)?(?:[,/](?:no\.|nr\.|h\.)?(\d{{1,4}}))?"
_SPAN = rf"^{_POINT}(?:(-)(?:{_POINT}|(\d{{1,3}}))?)?$"
#: Groups of a span: those of the two points, and the issue that ends a span within a year.
_FIRST = {"volume": 1, "volume2": 2, "year": 3, "year2": 4, "issue": 5}
_DASH, _LAST_ISSUE = 6, 12
_SECOND = {k: v + _DASH for k, v in _FIRST.items()}


def _text(span: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(span, _SPAN, group), F.lit(""))


def _int(span: Column, group: int) -> Column:
    return F.try_to_number(_text(span, group), F.lit("9999")).cast("int")


def _end(span: Column, point: dict[str, int]) -> tuple[Column, Column, Column]:
    """Year, volume and issue that a point ends with; a second year of two digits is the next after the first that ends so."""
    year, other = _int(span, point["year"]), _text(span, point["year2"])
    short = year - year % 100 + _int(span, point["year2"])
    year = F.when(other.isNull(), year).when(F.length(other) == 4, _int(span, point["year2"])).otherwise(F.when(short < year, short + 100).otherwise(short))
    return year, F.coalesce(_int(span, point["volume2"]), _int(span, point["volume"])), _int(span, point["issue"])


def spans(statement: Column) -> Column:
    """The spans of a statement: array of (year, volume, issue, to_year, to_volume, to_issue); an open end is year 9999."""
    numbers = F.regexp_replace(F.lower(statement), r"\[([\d./-]+)\]", "$1")
    clean = F.regexp_replace(numbers, r"\[[^\]]*\]|\((?!\d{4}[)/])[^)]*\)|=.*$", "")
    parts = F.transform(F.split(clean, r"[;&]|,\s+(?=\D*\d{1,4}[./(]|\d{4})"), lambda p: F.regexp_replace(F.regexp_replace(p, r"[–—]", "-"), r"\s+|[.,]+$", ""))

    def span(p: Column) -> Column:
        dash, closed, within = (_text(p, g).isNotNull() for g in (_DASH, _SECOND["year"], _LAST_ISSUE))
        (year, volume, issue), (year2, volume2, issue2) = _end(p, _FIRST), _end(p, _SECOND)
        until = lambda one, two, inside: F.when(closed, two).when(within, inside).when(~dash, one)
        return F.struct(
            _int(p, _FIRST["year"]).alias("year"), _int(p, _FIRST["volume"]).alias("volume"), issue.alias("issue"),
            F.coalesce(until(year, year2, year), F.lit(9999)).alias("to_year"), until(volume, volume2, volume).alias("to_volume"), until(issue, issue2, _int(p, _LAST_ISSUE)).alias("to_issue"),
        )

    return F.transform(F.filter(parts, lambda p: p.rlike(_SPAN) & (_text(p, _LAST_ISSUE).isNull() | _text(p, _FIRST["issue"]).isNotNull())), span)


def holds(held: Column, year: Column, volume: Column, issue: Column) -> Column:
    """Whether a span has the issue. A null volume or issue, asked or held, fits any; they count within the first and last year alone."""

    def after(s: Column) -> Column:
        first = F.coalesce(s["volume"] <= volume, F.lit(True)) & (F.coalesce(s["volume"] < volume, F.lit(False)) | F.coalesce(s["issue"] <= issue, F.lit(True)))
        return (year > s["year"]) | ((year == s["year"]) & first)

    def before(s: Column) -> Column:
        last = F.coalesce(s["to_volume"] >= volume, F.lit(True)) & (F.coalesce(s["to_volume"] > volume, F.lit(False)) | F.coalesce(s["to_issue"] >= issue, F.lit(True)))
        return (year < s["to_year"]) | ((year == s["to_year"]) & last)

    return F.coalesce(F.exists(held, lambda s: after(s) & before(s)), F.lit(False))


def availability(articles: DataFrame, statements: DataFrame, parent: str, key: str, statement: str, name: str = "available") -> DataFrame:
    """articles (parent, year, volume, issue) with a boolean: does a statement of the parent hold their issue?"""
    held = statements.select(F.col(key).alias("__k"), spans(F.col(statement)).alias("__s")).groupBy("__k").agg(F.flatten(F.collect_list("__s")).alias("__s"))
    got = articles.join(held, articles[parent] == F.col("__k"), "left")
    return got.withColumn(name, holds(F.col("__s"), F.col("year"), F.col("volume"), F.col("issue"))).drop("__k", "__s")
