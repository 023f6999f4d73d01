"""Records of repeated fields: one row with nested arrays, its accessors, predicates and edits.

A missing field or subfield reads as empty text. All functions are Column expressions over the array of fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SUBFIELD = "struct<code: string, value: string>"
FIELD = f"struct<tag: string, ind1: string, ind2: string, subfields: array<{SUBFIELD}>>"
SCHEMA = f"control_number string, leader string, fields array<{FIELD}>"


def field(tag: str, subfields: dict[str, Column], ind1: str = " ", ind2: str = " ") -> Column:
    """A field of given subfields; those whose value is null are left out."""
    pairs = F.array(*(F.struct(F.lit(c).alias("code"), v.cast("string").alias("value")) for c, v in subfields.items()))
    return F.struct(F.lit(tag).alias("tag"), F.lit(ind1).alias("ind1"), F.lit(ind2).alias("ind2"), F.filter(pairs, lambda s: s["value"].isNotNull()).alias("subfields"))


def sorted_fields(fields: Column) -> Column:
    """Fields in the order of their tags, equal tags in their present order."""
    place = F.transform(fields, lambda f, i: F.struct(f["tag"].alias("tag"), i.alias("i"), f.alias("f")))
    return F.transform(F.array_sort(place, lambda a, b: F.when(a["tag"] < b["tag"], -1).when(a["tag"] > b["tag"], 1).otherwise(a["i"] - b["i"])), lambda p: p["f"])


def values(fields: Column, tag: str, codes: str) -> Column:
    """All values of the subfields whose code is in codes, in record order."""
    picked = F.transform(F.filter(fields, lambda f: f["tag"] == tag), lambda f: F.transform(F.filter(f["subfields"], lambda s: F.lit(codes).contains(s["code"]) if codes else s["code"] == ""), lambda s: s["value"]))
    return F.flatten(picked)


def first_value(fields: Column, tag: str, code: str) -> Column:
    return F.coalesce(F.get(values(fields, tag, code), F.lit(0)), F.lit(""))


def has_tag(fields: Column, tag: str) -> Column:
    return F.exists(fields, lambda f: f["tag"] == tag)


def matches(fields: Column, tag: str, code: str | None, pattern: str) -> Column:
    """Whether a subfield of the field (any code if None) has a match of the pattern."""

    def test(f: Column) -> Column:
        return (f["tag"] == tag) & F.exists(f["subfields"], lambda s: (F.lit(True) if code is None else s["code"] == code) & s["value"].rlike(pattern))

    return F.exists(fields, test)


def remove_fields(fields: Column, tag: str, code: str | None, pattern: str) -> Column:
    """Fields but for those with a matching subfield."""
    return F.filter(fields, lambda f: ~((f["tag"] == tag) & F.exists(f["subfields"], lambda s: (F.lit(True) if code is None else s["code"] == code) & s["value"].rlike(pattern))))


def edit_values(fields: Column, tag: str, codes: str, change) -> Column:
    """change(value) for the subfields named; fields left without a value go."""

    def edited(f: Column) -> Column:
        subfields = F.transform(f["subfields"], lambda s: F.struct(s["code"].alias("code"), F.when(F.lit(codes).contains(s["code"]), change(s["value"])).otherwise(s["value"]).alias("value")))
        kept = F.filter(subfields, lambda s: s["value"] != "")
        return F.when(f["tag"] == tag, F.struct(f["tag"].alias("tag"), f["ind1"].alias("ind1"), f["ind2"].alias("ind2"), kept.alias("subfields"))).otherwise(f)

    return F.filter(F.transform(fields, edited), lambda f: F.size(f["subfields"]) > 0)


def insert_field(fields: Column, new: Column, tag: str) -> Column:
    """The field put before others of its tag."""
    return F.concat(F.filter(fields, lambda f: f["tag"] < tag), F.array(new), F.filter(fields, lambda f: f["tag"] >= tag))


def checksum(fields: Column, without: Sequence[str] = ()) -> Column:
    """SHA-1 over the sorted fields but for some tags: the order of fields does not count."""
    lines = F.transform(
        F.filter(fields, lambda f: ~f["tag"].isin(*without)) if without else fields,
        lambda f: F.concat(f["tag"], f["ind1"], f["ind2"], F.array_join(F.transform(f["subfields"], lambda s: F.concat(F.lit("$"), s["code"], s["value"])), "")),
    )
    return F.sha1(F.array_join(F.array_sort(lines), "\n").cast("binary"))
