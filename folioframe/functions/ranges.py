"""Texts that name ranges (chapters and verses, canons, years and days) as ranges of numbers; native expressions.

Codes are as wide as the indexes that use them: 2 + 3 + 3 digits for book, chapter and verse, 4 + 2 + 2 for canons, 8 + 4 for days.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGES = "array<struct<lower: string, upper: string>>"
#: Years are stored with this added, so those before the common era, as differences from it, sort first.
YEAR_OFFSET = 10_000_000
#: How texts mark a year before the common era.
BEFORE = r"(?: ?v\. ?[Cc]hr\.|BC|avant J\.-C\.|a\.C\.|公元前)"


def _range(lower: Column, upper: Column) -> Column:
    return F.struct(lower.alias("lower"), upper.alias("upper"))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once a row however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c, n, "0")


def scripture(text: Column, book: Column) -> Column:
    """Ranges of a reference to chapters and verses of a book of two digits, null if it is none.

    Empty text is the whole book. `1`, `1-3`, `1,2`, `1,2-5`, `1,2-3,4` and `1-3,4` are one range; after a chapter, verses and ranges of
    verses divided by periods must rise. A colon is a comma, letters behind a verse do not count, blanks do not either.
    """
    return _let(F.regexp_replace(text, r"[ \t]", ""), lambda t: _scripture(t, book))


def _scripture(t: Column, book: Column) -> Column:
    one = r"^(\d{1,3})(?:[,:](\d{1,3})[a-z]*)?(?:-(?:(\d{1,3})[,:])?(\d{1,3})([a-z]*))?$"
    c1, v1, c2, last, letters = (F.regexp_extract(t, one, k) for k in range(1, 6))
    to_chapter = (v1 == "") & (c2 == "")
    lower = F.concat(book, _pad(c1, 3), _pad(v1, 3))
    upper_chapter = F.when(last == "", c1).when(to_chapter, last).when(c2 != "", c2).otherwise(c1)
    upper_verse = F.when(last == "", F.when(v1 == "", F.lit("999")).otherwise(_pad(v1, 3))).when(to_chapter, F.lit("999")).otherwise(_pad(last, 3))
    upper = F.concat(book, _pad(upper_chapter, 3), upper_verse)
    good = t.rlike(one) & F.when(last == "", F.lit(True)).otherwise(upper > lower) & ~(to_chapter & (letters != ""))
    listed = r"^(\d{1,3})[,:]((?:\d{1,3}[a-z]*(?:-\d{1,3}[a-z]*)?)(?:\.\d{1,3}[a-z]*(?:-\d{1,3}[a-z]*)?)+)$"
    chapter = F.concat(book, _pad(F.regexp_extract(t, listed, 1), 3))
    first = lambda p: _pad(F.regexp_extract(p, r"^(\d+)", 1), 3)
    final = lambda p: _pad(F.regexp_extract(p, r"(\d+)[a-z]*$", 1), 3)
    items = F.transform(F.split(F.regexp_extract(t, listed, 2), r"\."), lambda p: F.struct(_range(F.concat(chapter, first(p)), F.concat(chapter, final(p))).alias("r"), p.contains("-").alias("span")))
    rising = F.forall(items, lambda x: ~x["span"] | (x["r"]["lower"] < x["r"]["upper"])) & F.forall(
        F.zip_with(F.slice(items, 2, 9999), F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0))), lambda b, a: b["r"]["lower"] > a["r"]["upper"]), lambda x: x
    )
    whole = F.array(_range(F.concat(book, F.lit("000000")), F.concat(book, F.lit("999999"))))
    listing = F.when(rising, F.transform(items, lambda x: x["r"]))
    return F.when(t == "", whole).when(t.rlike(listed), listing).when(good, F.array(_range(lower, upper))).otherwise(F.lit(None)).cast(_RANGES)


def canons(text: Column) -> Column:
    """(lower, upper) of canons, paragraphs and items: `c`, `c-c`, `c,p`, `c,p-p`, `c,p,i` or `c,p,i-i`; null if none."""
    form = r"^(\d{1,4})(?:-(\d{1,4})|,(\d{1,2})(?:,(\d{1,2}))?(?:-(\d{1,2}))?)?$"
    c1, c2, p, i, last = (F.try_to_number(F.regexp_extract(text, form, k), F.lit("9999")).cast("int") for k in range(1, 6))
    base = c1 * 10_000
    lower = base + F.coalesce(p, F.lit(0)) * 100 + F.coalesce(i, F.lit(0))
    lower = F.when(p.isNotNull() & i.isNull() & last.isNull(), base + p * 100 + 99).otherwise(lower)
    upper = (
        F.when(p.isNull(), F.coalesce(c2, c1) * 10_000 + 9999)
        .when(i.isNull(), F.when(last.isNull(), base + p * 100 + 99).otherwise(base + last * 100))
        .otherwise(base + p * 100 + F.coalesce(last, i))
    )
    numbers = [F.coalesce(x, F.lit(1)) > 0 for x in (c1, c2, p, i, last)]
    return F.when(text.rlike(form) & reduce(lambda a, b: a & b, numbers), F.struct(lower.alias("lower"), upper.alias("upper")))


def _year(c: Column, sign: int = 1) -> Column:
    return F.lpad((F.lit(YEAR_OFFSET) + sign * c.cast("int")).cast("string"), 8, "0")


#: One side of a span: a mark for years before the common era, day and month, year, and another such mark. X is an unknown digit.
_SIDE = rf"(?:ca\. )?(v)?(?:([0-9X]{{1,2}})\.([0-9X]{{1,2}})\.)?([0-9X]{{1,4}})({BEFORE})?"
_SPAN = rf"^(?:{_SIDE})?( ?- ?)(?:{_SIDE})?$"
_ALONE = r"^(?:ca\. )?(v)?(?:(\d{1,2})\.(\d{1,2})\.)?(\d{1,4})$"
_ISO_DAY = r"^(?:ca\. )?(\d{1,4})-(\d{1,2})-(\d{1,2})$"


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.concat(_year(year), _pad(month, 2), _pad(day, 2))


def _bounds(year: Column, sign: int = 1) -> tuple[Column, Column]:
    """The first and the last day of a year."""
    return F.concat(_year(year, sign), F.lit("0101")), F.concat(_year(year, sign), F.lit("1231"))


def times(text: Column, current_year: int, centuries: bool = False) -> Column:
    """The range `lower_upper` of a span of years or days, null if the text names none; current_year ends an open span.

    A span has two sides about a dash, either of which may be missing or wholly unknown, which leaves it open. A side is a year or a day, and an
    unknown digit the least it can be on the left and the most on the right. `v` before a year, or one of BEFORE behind it, puts the year
    before the common era: behind the second year, or with `v` at both, that holds for both, else for the first alone, as it does for
    years about a dash with blanks. With centuries, spans between full hundreds end a year earlier.
    """
    return _let(text, lambda t: F.coalesce(_alone(t), F.when(t.rlike(_SPAN), _span(t, current_year, centuries))))


def _alone(t: Column) -> Column:
    """A single year or day."""
    mark, day, month, year = (F.regexp_extract(t, _ALONE, k) for k in range(1, 5))
    iso = [F.regexp_extract(t, _ISO_DAY, k) for k in (1, 2, 3)]
    whole = F.when(mark == "", F.concat_ws("_", *_bounds(year))).otherwise(F.concat_ws("_", *_bounds(year, -1)))
    one = F.when(day == "", whole).when(mark == "", F.concat_ws("_", _day(year, month, day), _day(year, month, day)))
    return F.when(t.rlike(_ISO_DAY), F.concat_ws("_", _day(*iso), _day(*iso))).when(t.rlike(_ALONE), one)


def _span(t: Column, current_year: int, centuries: bool) -> Column:
    v1, d1, m1, y1, e1, dash, v2, d2, m2, y2, e2 = (F.regexp_extract(t, _SPAN, k) for k in range(1, 12))
    open1, open2 = ((y == "") | ((y == "XXXX") & ((d == "") | ((d == "XX") & (m == "XX")))) for y, d, m in ((y1, d1, m1), (y2, d2, m2)))
    # The least a left side and the most a right side can be.
    first = {"y": F.translate(y1, "X", "0"), "m": F.when(m1 == "XX", F.lit("01")).otherwise(F.translate(m1, "X", "0")), "d": F.when(d1 == "XX", F.lit("01")).otherwise(F.translate(d1, "X", "0"))}
    last_y, last_m = F.translate(y2, "X", "9"), F.when(m2 == "XX", F.lit("12")).otherwise(F.translate(m2, "X", "9"))
    end = F.dayofmonth(F.last_day(F.try_to_date(F.concat_ws("-", F.lpad(last_y, 4, "0"), _pad(last_m, 2), F.lit("01")), "yyyy-MM-dd"))).cast("string")
    last = {"y": last_y, "m": last_m, "d": F.when(d2 == "XX", F.coalesce(end, F.lit("99"))).otherwise(F.translate(d2, "X", "9"))}
    by_day = (d1 != "") | (d2 != "")
    lower = F.when(d1 == "", _bounds(first["y"])[0]).otherwise(_day(first["y"], first["m"], first["d"]))
    upper = F.when(d2 == "", _bounds(last["y"])[1]).otherwise(_day(last["y"], last["m"], last["d"]))
    ordered = F.concat_ws("_", F.least(lower, upper), F.greatest(lower, upper))

    a, b = first["y"].cast("int"), last["y"].cast("int")
    low, high = F.least(a, b), F.greatest(a, b)
    if centuries:
        high = F.when((low % 100 == 0) & (high % 100 == 0), high - 1).otherwise(high)
    years = F.concat_ws("_", _bounds(low)[0], _bounds(high)[1])

    letters, marked = (v1 != "") | (v2 != ""), (e1 != "") | (e2 != "")
    early = F.when(~by_day & ~(letters & (marked | (v1 == ""))), F.concat_ws("_", _bounds(first["y"], -1)[0], F.when((v2 != "") | (e2 != ""), _bounds(last["y"], -1)[1]).otherwise(_bounds(last["y"])[1])))

    now = F.lit(current_year)
    since = F.concat_ws("_", F.concat(_year(F.least(a, now)), F.substr(lower, F.lit(9))), _bounds(F.greatest(a, now))[1])
    until = F.concat_ws("_", F.lit("0" * 12), upper)
    both, plain = ~open1 & ~open2, (dash == "-") & ~letters & ~marked
    return F.when(both & plain & by_day, ordered).when(both & plain, years).when(both, early).when(plain & ~open1, since).when(plain & ~open2, until)


def times_text(code: Column) -> Column:
    """A range of days as text: v marks years before the common era, first and last days of years are left out, an open start is empty."""

    def side(c: Column, plain: str) -> Column:
        year = F.try_to_number(F.substr(c, F.lit(1), F.length(c) - 4), F.lit("99999999")).cast("int")
        rest = F.right(c, F.lit(4))
        shown = F.when(year > YEAR_OFFSET, (year - YEAR_OFFSET).cast("string")).otherwise(F.concat(F.lit("v"), (YEAR_OFFSET - year).cast("string")))
        days = F.when(rest == plain, F.lit("")).otherwise(F.concat(F.lit("-"), F.left(rest, F.lit(2)), F.lit("-"), F.right(rest, F.lit(2))))
        return F.when((year == 0) & (rest == "0000"), F.lit("")).otherwise(F.concat(shown, days))

    return _let(code, lambda c: F.concat(side(F.substring_index(c, "_", 1), "0101"), F.lit(" - "), side(F.substring_index(c, "_", -1), "1231")))
