"""Rules that records must obey, structural checks and kinds of records, all as Column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.records import model


@dataclass(frozen=True)
class Rule:
    """Values of a subfield must match a pattern: all of a field, or its first one alone."""

    first_only: bool
    ind1: str
    ind2: str
    tag: str
    code: str
    pattern: str


def parse_rules(text: str) -> list[Rule]:
    """Lines `subfield_match ii TTTc pattern` or `first_subfield_match ...`: # is any indicator, a backslash keeps a blank, # starts a comment line."""
    out = []
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        words = [w.replace("\\ ", " ") for w in re.findall(r"(?:\\.|[^\s\\])+", line)]
        if len(words) != 4 or words[0] not in ("subfield_match", "first_subfield_match") or len(words[1]) != 2 or len(words[2]) != 4:
            raise ValueError(f"no rule: {line!r}")
        out.append(Rule(words[0] == "first_subfield_match", *words[1], words[2][:3], words[2][3], words[3]))
    return out


def violations(records: DataFrame, rules: list[Rule], key: str = "control_number") -> DataFrame:
    """(key, rule, value): each value that breaks a rule, with the rule's number from 0."""
    kind = "array<struct<rule: int, value: string>>"

    def breaches(k: int, r: Rule) -> Column:
        def broken(f: Column) -> Column:
            values = F.transform(F.filter(f["subfields"], lambda s: s["code"] == r.code), lambda s: s["value"])
            values = F.slice(values, 1, 1) if r.first_only else values
            return F.transform(F.filter(values, lambda v: ~v.rlike(r.pattern)), lambda v: F.struct(F.lit(k).alias("rule"), v.alias("value")))

        def concerned(f: Column) -> Column:
            out = f["tag"] == r.tag
            for name, want in (("ind1", r.ind1), ("ind2", r.ind2)):
                out = out if want == "#" else out & (f[name] == want)
            return out

        return F.flatten(F.transform(F.filter("fields", concerned), broken))

    found = [F.expr(f"cast(array() as {kind})"), *(breaches(k, r) for k, r in enumerate(rules))]
    return records.select(key, F.explode(F.concat(*found)).alias("v")).select(key, "v.rule", "v.value")


def in_order(fields: Column) -> Column:
    """Whether tags never fall."""
    tags = F.transform(fields, lambda f: f["tag"])
    return tags == F.array_sort(tags)


def repeated(fields: Column, tags: tuple[str, ...]) -> Column:
    """Those of the non-repeatable tags that occur more than once."""
    return F.filter(F.array(*map(F.lit, tags)), lambda t: F.size(F.filter(fields, lambda f: f["tag"] == t)) > 1)


def malformed(fields: Column) -> Column:
    """Tags of data fields without a subfield, or with an empty code or value."""
    bad = F.filter(fields, lambda f: (f["tag"] >= "010") & ((F.size(f["subfields"]) == 0) | F.exists(f["subfields"], lambda s: (s["code"] == "") | (s["value"] == ""))))
    return F.transform(bad, lambda f: f["tag"])


def is_valid(leader: Column, fields: Column) -> Column:
    """A whole leader, a key, at least one other field and no malformed one."""
    return F.coalesce((F.length(leader) == 24) & (model.first_value(fields, "001", "") != "") & (F.size(fields) > 1) & (F.size(malformed(fields)) == 0), F.lit(False))


def repeated_keys(records: DataFrame, key: str = "control_number") -> DataFrame:
    return records.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def level(leader: Column) -> Column:
    return F.substring(leader, 8, 1)


def is_monograph(leader: Column) -> Column:
    return level(leader) == "m"


def is_serial(leader: Column) -> Column:
    return level(leader) == "s"


def is_component(leader: Column) -> Column:
    return level(leader).isin("a", "b")


def is_reproduction(fields: Column) -> Column:
    return model.has_tag(fields, "534")


def is_electronic(leader: Column, fields: Column) -> Column:
    """Text or computer files whose 007 begins with c, or so marked in 935 $c or 245 $h."""
    by_form = F.substring(leader, 7, 1).isin("a", "m") & F.exists(model.values(fields, "007", ""), lambda v: v.startswith("c"))
    by_title = F.exists(model.values(fields, "245", "h"), lambda v: v.rlike(r"(?i)\[(Elektronische Ressource|electronic resource)\]"))
    return by_form | F.array_contains(model.values(fields, "935", "c"), "sodr") | by_title


def block_starts(fields: Column, tag: str = "LOK") -> Column:
    """The number of the local block of each field, from 0; -1 for other fields. A block begins with subfield 0 of `000`."""
    first = lambda f: (f["tag"] == tag) & F.exists(f["subfields"], lambda s: (s["code"] == "0") & s["value"].startswith("000"))
    return F.transform(fields, lambda f, i: F.when(f["tag"] == tag, F.size(F.filter(F.slice(fields, 1, i + 1), first)) - 1).otherwise(F.lit(-1)))


def drop_unused_blocks(fields: Column, used: str, tag: str = "LOK") -> Column:
    """Local blocks without a field whose 852 values match go; records without local data stay as they are."""
    numbered = F.zip_with(fields, block_starts(fields, tag), lambda f, b: F.struct(f.alias("f"), b.alias("b")))
    owner = lambda f: F.exists(f["subfields"], lambda s: (s["code"] == "0") & s["value"].startswith("852")) & F.exists(f["subfields"], lambda s: s["value"].rlike(used))
    kept = F.transform(F.filter(numbered, lambda p: (p["b"] >= 0) & owner(p["f"])), lambda p: p["b"])
    return F.transform(F.filter(numbered, lambda p: (p["b"] == -1) | F.array_contains(kept, p["b"])), lambda p: p["f"])
