"""Further facts of a record: production dates, authority numbers, links between forms, and predicates on access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.records import model

#: Tags whose $w links a record with its other forms, and the prefix of the union catalogue's keys.
CROSS_LINK_TAGS = ("770", "772", "775", "776", "777", "780", "785", "787")
UNION_PREFIX = "(DE-627)"


def _first(f: Column, code: str) -> Column:
    return F.coalesce(F.get(F.transform(F.filter(f["subfields"], lambda s: s["code"] == code), lambda s: s["value"]), F.lit(0)), F.lit(""))


def _fields(fields: Column, tag: str) -> Column:
    return F.filter(fields, lambda f: f["tag"] == tag)


def _found(values: Column) -> Column:
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def production_dates(fields: Column) -> Column:
    """First $c of each 264; of dates that begin with one year the last in order stands for it."""
    dates = F.array_sort(F.filter(F.transform(_fields(fields, "264"), lambda f: _first(f, "c")), lambda d: d != ""))
    later = F.zip_with(dates, F.slice(dates, 2, 100_000), lambda d, after: F.when(after.isNull() | (F.left(after, F.lit(4)) > F.left(d, F.lit(4))), d))
    return F.filter(later, lambda d: d.isNotNull())


def authority_number(fields: Column) -> Column:
    """The number behind (DE-588) in the first 035 $a that has one."""
    return F.substr(_found(F.filter(F.transform(_fields(fields, "035"), lambda f: _first(f, "a")), lambda v: v.startswith("(DE-588)"))), F.lit(9))


def wikidata_id(fields: Column) -> Column:
    """$a of the first 024 whose $2 names wikidata."""
    return _found(F.transform(F.filter(_fields(fields, "024"), lambda f: _first(f, "2").contains("wikidata")), lambda f: _first(f, "a")))


def wikipedia_link(fields: Column) -> Column:
    """$u of the first 670 whose $a names Wikipedia."""
    return _found(F.transform(F.filter(_fields(fields, "670"), lambda f: _first(f, "a").contains("Wikipedia")), lambda f: _first(f, "u")))


def cross_links(fields: Column, tags: tuple[str, ...] = CROSS_LINK_TAGS, form: str | None = None) -> Column:
    """Keys of linked records, sorted, each once; form: only links whose $i or $n begins so (`Online`, `Druck`)."""
    links = F.filter(fields, lambda f: f["tag"].isin(*tags))
    if form:
        links = F.filter(links, lambda f: _first(f, "i").startswith(form) | _first(f, "n").startswith(form))
    keys = F.transform(links, lambda f: F.get(F.filter(F.transform(f["subfields"], lambda s: F.when((s["code"] == "w") & s["value"].startswith(UNION_PREFIX), F.substr(s["value"], F.lit(len(UNION_PREFIX) + 1)))), lambda v: v.isNotNull()), F.lit(0)))
    return F.array_sort(F.array_distinct(F.filter(keys, lambda v: v.isNotNull())))


def is_open_access(fields: Column, with_found: bool = True) -> Column:
    """An 856 $z `LF`, or `kostenfrei...` for the full text, or (with_found) $x `unpaywall`; or a 655 $a `open access`."""

    def link(f: Column) -> Column:
        part = F.lower(_first(f, "3"))
        free = F.exists(f["subfields"], lambda s: (s["code"] == "z") & ((s["value"] == "LF") | (F.lower(s["value"]).startswith("kostenfrei") & part.isin("", "volltext"))))
        return (free | F.exists(f["subfields"], lambda s: (s["code"] == "x") & (F.lower(s["value"]) == "unpaywall"))) if with_found else free

    return F.exists(_fields(fields, "856"), link) | F.exists(_fields(fields, "655"), lambda f: F.lower(_first(f, "a")) == "open access")


def is_acquisition(fields: Column) -> Column:
    """A local 852 whose $m is e."""
    return F.exists(_fields(fields, "LOK"), lambda f: _first(f, "0").startswith("852") & (_first(f, "m") == "e"))


def field_hash(f: Column) -> Column:
    return F.sha1(as_text(f).cast("binary"))


def as_text(f: Column) -> Column:
    """A field as one line: tag, indicators, and `$code value` without blanks between."""
    return F.concat(f["tag"], F.lit(" "), f["ind1"], f["ind2"], F.array_join(F.transform(f["subfields"], lambda s: F.concat(F.lit("$"), s["code"], s["value"])), ""))


def unknown_tags(fields: Column, known: tuple[str, ...]) -> Column:
    """Tags, each once and sorted, that are neither local (a non-digit or a 9) nor known."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(fields, lambda f: ~f["tag"].isin(*known) & ~f["tag"].rlike("[^0-8]")), lambda f: f["tag"])))


def normalised(fields: Column, tag: str, codes: str, canonical: dict[str, str]) -> Column:
    """Values that are a variant, compared in lower case with blanks collapsed, become the canonical form."""
    forms = F.create_map(*(F.lit(x) for pair in canonical.items() for x in pair))
    return model.edit_values(fields, tag, codes, lambda v: F.coalesce(F.element_at(forms, F.lower(F.trim(F.regexp_replace(v, r"\s+", " ")))), v))


def repaired(text: Column) -> Column:
    """UTF-8 read as ISO 8859-1 and written as UTF-8 again, undone where that gives valid text; other text stays."""
    back = F.encode(text, "ISO-8859-1")
    doubled = text.rlike("[Â-ô][\u0080-¿]") & ~text.rlike("[^\u0000-ÿ]") & F.is_valid_utf8(back.cast("string"))
    return F.when(doubled, F.decode(back, "UTF-8")).otherwise(text)
