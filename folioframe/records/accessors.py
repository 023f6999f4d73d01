"""What a bibliographic record says: titles, years, people, identifiers, languages and issues, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.records import checks, model


def _cut(c: Column) -> Column:
    return F.regexp_replace(c, r"[ \t/]+$", "")


def _title(fields: Column, code: str) -> Column:
    first = F.get(F.filter(fields, lambda f: f["tag"] == "245"), F.lit(0))
    return _cut(F.coalesce(F.get(F.filter(first["subfields"], lambda s: s["code"] == code), F.lit(0))["value"], F.lit("")))


def main_title(fields: Column) -> Column:
    a = _title(fields, "a")
    return F.when(a != "", a).otherwise(_title(fields, "b"))


def complete_title(fields: Column) -> Column:
    """Title and rest of title, divided by a colon unless the rest is a parallel title, then part name and number."""
    a, b, p, n = (_title(fields, c) for c in "abpn")
    both = F.concat(a, F.when(b.startswith(" = "), F.lit("")).otherwise(F.lit(" : ")), b)
    base = F.when(a == "", b).when(b == "", a).otherwise(both)
    more = lambda c: F.when(c != "", F.concat(F.lit(" "), c)).otherwise(F.lit(""))
    return F.when(base == "", base).otherwise(F.concat(base, more(p), more(n)))


def summary(fields: Column) -> Column:
    return F.array_join(model.values(fields, "520", "a"), " ")


def values_matching(fields: Column, tag: str, code: str, pattern: str) -> Column:
    return F.filter(model.values(fields, tag, code), lambda v: v.rlike(pattern))


def numeric_values(fields: Column, tag: str, code: str, prefix: str) -> Column:
    """Values of a code that begin with `prefix:`, without it."""
    chosen = F.filter(model.values(fields, tag, code), lambda v: v.startswith(prefix + ":"))
    return F.transform(chosen, lambda v: F.substr(v, F.lit(len(prefix) + 2)))


def authors(fields: Column, tags: tuple[str, ...] = ("100", "109", "700")) -> Column:
    """Names of people, each once, in the order of the tags given."""
    return F.array_distinct(F.concat(*(model.values(fields, t, "a") for t in tags)))


def identifiers(fields: Column, tag: str, code: str = "a") -> Column:
    return F.array_distinct(F.filter(model.values(fields, tag, code), lambda v: v != ""))


def issns(fields: Column, tags: tuple[str, ...] = ("022", "029")) -> Column:
    return F.array_distinct(F.concat(*(identifiers(fields, t) for t in tags)))


def isbns(fields: Column) -> Column:
    return identifiers(fields, "020")


def dois(fields: Column) -> Column:
    """Values of 024 $a that $2 calls a DOI."""
    chosen = F.filter(fields, lambda f: (f["tag"] == "024") & F.exists(f["subfields"], lambda s: (s["code"] == "2") & (s["value"] == "doi")))
    return F.array_distinct(model.values(chosen, "024", "a"))


def decimal_classes(fields: Column) -> Column:
    return F.array_distinct(F.transform(F.concat(model.values(fields, "082", "a"), model.values(fields, "083", "a")), lambda v: F.translate(v, "/", "")))


def superior_keys(fields: Column, tags: tuple[str, ...] = ("800", "810", "830", "773", "776"), institution: str = "DE-627") -> Column:
    """Keys of superior works: $w values `(institution)key`."""
    links = F.concat(*(model.values(fields, t, "w") for t in tags))
    head = f"({institution})"
    return F.array_distinct(F.transform(F.filter(links, lambda v: v.startswith(head)), lambda v: F.substr(v, F.lit(len(head) + 1))))


def languages(fields: Column) -> Column:
    """The code of 008 and those of 041."""
    fixed = F.trim(F.substring(model.first_value(fields, "008", ""), 36, 3))
    return F.array_distinct(F.filter(F.concat(F.array(fixed), model.values(fields, "041", "abdefghjkmn")), lambda v: v != ""))


def issue(fields: Column) -> Column:
    """Year, volume, issue and pages of an article: `key:value` in $g of a 773 with indicators 1 and 8, else codes j, d, e and h of 936 u w."""
    with_ind = lambda tag, a, b: F.filter(fields, lambda f: (f["tag"] == tag) & (f["ind1"] == a) & (f["ind2"] == b))
    host, local = with_ind("773", "1", "8"), with_ind("936", "u", "w")
    pairs = model.values(F.slice(host, 1, 1), "773", "g")
    named = lambda key: F.coalesce(F.get(F.transform(F.filter(pairs, lambda v: v.startswith(key + ":")), lambda v: F.substr(v, F.lit(len(key) + 2))), F.lit(0)), F.lit(""))
    get = lambda key, code: F.when(F.size(host) > 0, named(key)).otherwise(model.first_value(local, "936", code))
    return F.struct(get("year", "j").alias("year"), get("volume", "d").alias("volume"), get("number", "e").alias("issue"), get("pages", "h").alias("pages"))


def publication_year(leader: Column, fields: Column, current_year: int, fallback: str = "") -> Column:
    """The most recent year of publication.

    The first that is there of: local $y, a serial's end year (363 1 0 $i) or else the later of its start year (363 0 1 $i) and the
    present year, the last such field counting, the year of a reproduction, the issue's year of a component, 190 $j, and the second and the
    first date of 008. An open end (9999) counts as the year given as the present one, so the result does not hang on a clock.
    """
    year = lambda c: F.regexp_extract(c, r"(\d{4})", 1)
    some = lambda c: F.when(c != "", c)
    fixed = model.first_value(fields, "008", "")
    dates = [F.when(F.substring(fixed, k, 4).rlike(r"^\d{4}$"), F.substring(fixed, k, 4)) for k in (12, 8)]
    span = lambda a, b: F.filter(F.transform(F.filter(fields, lambda f: (f["tag"] == "363") & (f["ind1"] == a) & (f["ind2"] == b)), lambda f: model.first_value(F.array(f), "363", "i")), lambda v: v != "")
    last = lambda a, b: F.try_element_at(span(a, b), F.lit(-1))
    found = F.coalesce(
        some(year(model.first_value(fields, "ZWI", "y"))),
        F.when(checks.is_serial(leader), F.coalesce(last("1", "0"), F.greatest(last("0", "1"), F.when(last("0", "1").isNotNull(), F.lit(str(current_year)))))),
        some(year(model.first_value(fields, "534", "c"))),
        F.when(checks.is_component(leader), some(year(issue(fields)["year"]))),
        some(year(model.first_value(fields, "190", "j"))),
        *dates,
        F.lit(fallback),
    )
    return F.when(found == "9999", F.lit(str(current_year))).otherwise(found)
