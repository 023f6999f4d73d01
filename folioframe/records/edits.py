"""Edits of a record's fields and the op-lists made of them.

Every edit is a Column expression over the array of fields, so a whole op-list is one projection without a shuffle.
A specification is a tag of three characters and, where it says so, subfield codes. Fields left without a value go.
"""

from __future__ import annotations

import re
import shlex
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.records import model


class OpError(ValueError):
    pass


def _with(f: Column, subfields: Column, tag: Column | None = None) -> Column:
    return F.struct((f["tag"] if tag is None else tag).alias("tag"), f["ind1"].alias("ind1"), f["ind2"].alias("ind2"), subfields.alias("subfields"))


def _subfield(code: str | Column, value: Column) -> Column:
    return F.struct((F.lit(code) if isinstance(code, str) else code).alias("code"), value.alias("value"))


def _on(fields: Column, tag: str, change: Callable[[Column], Column]) -> Column:
    """change(field) gives the subfields of the fields with the tag; the empty ones go."""
    edited = F.transform(fields, lambda f: F.when(f["tag"] == tag, _with(f, change(f))).otherwise(f))
    return F.filter(edited, lambda f: F.size(f["subfields"]) > 0)


def _has(f: Column, code: str | None, pattern: str) -> Column:
    return F.exists(f["subfields"], lambda s: (F.lit(True) if code is None else s["code"] == code) & s["value"].rlike(pattern))


def java_template(template: str) -> str:
    r"""The template with \1 for the first group, as the regular expressions of the JVM write it."""
    return re.sub(r"\\(\d)", r"$\1", template.replace("$", r"\$"))


def filled(value: Column, pattern: str, template: str) -> Column:
    r"""The template with \N replaced by group N of the first match."""
    parts = re.split(r"\\(\d)", template)
    return F.concat(*(F.regexp_extract(value, pattern, int(p)) if k % 2 else F.lit(p) for k, p in enumerate(parts)))


def remove_subfields(fields: Column, tag: str, code: str, pattern: str) -> Column:
    """In a field with a matching subfield, all subfields of that code go."""
    return _on(fields, tag, lambda f: F.when(_has(f, code, pattern), F.filter(f["subfields"], lambda s: s["code"] != code)).otherwise(f["subfields"]))


def filter_chars(fields: Column, tag: str, codes: str, chars: str) -> Column:
    return model.edit_values(fields, tag, codes, lambda v: F.translate(v, chars, ""))


def translate(fields: Column, tag: str, codes: str, old: str, new: str) -> Column:
    """Characters for characters; [:upper:] and [:lower:] change the case."""
    if (old, new) == ("[:upper:]", "[:lower:]"):
        return model.edit_values(fields, tag, codes, F.lower)
    if (old, new) == ("[:lower:]", "[:upper:]"):
        return model.edit_values(fields, tag, codes, F.upper)
    if len(old) != len(new):
        raise OpError(f"sets of different sizes: {old!r}, {new!r}")
    return model.edit_values(fields, tag, codes, lambda v: F.translate(v, old, new))


def replace_values(fields: Column, tag: str, codes: str, pattern: str, template: str) -> Column:
    """The whole value becomes the filled template where the pattern matches."""
    return model.edit_values(fields, tag, codes, lambda v: F.when(v.rlike(pattern), filled(v, pattern, template)).otherwise(v))


def substitute(fields: Column, tag: str, codes: str, pattern: str, template: str) -> Column:
    """Every match within a value is replaced."""
    return model.edit_values(fields, tag, codes, lambda v: F.regexp_replace(v, pattern, java_template(template)))


def replace_strings(fields: Column, tag: str, codes: str, strings: Mapping[str, str]) -> Column:
    """Values equal to a key become its value."""
    if not strings:
        return fields
    pairs = F.create_map(*(F.lit(x) for pair in strings.items() for x in pair))
    return model.edit_values(fields, tag, codes, lambda v: F.coalesce(F.try_element_at(pairs, v), v))


def insert_at_end(fields: Column, new: Column, tag: str, unique: bool = False) -> Column:
    """The field put behind others of its tag; with unique, a record that has the tag is left as it is."""
    out = F.concat(F.filter(fields, lambda f: f["tag"] <= tag), F.array(new), F.filter(fields, lambda f: f["tag"] > tag))
    return F.when(model.has_tag(fields, tag), fields).otherwise(out) if unique else out


def add_subfield(fields: Column, tag: str, code: str, value: Column, pattern: str | None = None, of: str | None = None) -> Column:
    """A subfield before those of the same or a later code, in every field of the tag (where one of code `of` matches)."""

    def added(f: Column) -> Column:
        old = f["subfields"]
        out = F.concat(F.filter(old, lambda s: s["code"] < code), F.array(_subfield(code, value)), F.filter(old, lambda s: s["code"] >= code))
        return out if pattern is None else F.when(_has(f, of, pattern), out).otherwise(old)

    return _on(fields, tag, added)


def replace_first(fields: Column, tag: str, code: str, change: Callable[[Column], Column]) -> Column:
    """change(value) for the first subfield of the code in each field of the tag."""

    def edited(f: Column) -> Column:
        first = F.array_position(F.transform(f["subfields"], lambda s: s["code"]), F.lit(code))
        return F.transform(f["subfields"], lambda s, i: F.when(i + 1 == first, _subfield(s["code"], change(s["value"]))).otherwise(s))

    return _on(fields, tag, edited)


def replace_first_if(fields: Column, tag: str, code: str, pattern: str, template: str, everywhere: bool = False) -> Column:
    """In the first subfield of the code, the first match (or every one) is replaced."""
    if everywhere:
        return replace_first(fields, tag, code, lambda v: F.regexp_replace(v, pattern, java_template(template)))

    def once(v: Column) -> Column:
        at = F.regexp_instr(v, F.lit(pattern))
        found = F.regexp_substr(v, F.lit(pattern))
        new = F.concat(F.substr(v, F.lit(1), at - 1), filled(v, pattern, template), F.substr(v, at + F.length(found)))
        return F.when(v.rlike(pattern), new).otherwise(v)

    return replace_first(fields, tag, code, once)


def replace_field(fields: Column, tag: str, subfields: Mapping[str, str], condition: Column | None = None) -> Column:
    """The subfields of every field of the tag become the ones given."""
    new = F.array(*(_subfield(c, F.lit(v)) for c, v in subfields.items()))
    return _on(fields, tag, lambda f: new if condition is None else F.when(condition, new).otherwise(f["subfields"]))


def replace_code(fields: Column, tag: str, old: str, new: str) -> Column:
    return _on(fields, tag, lambda f: F.transform(f["subfields"], lambda s: F.when(s["code"] == old, _subfield(new, s["value"])).otherwise(s)))


def move_subfield(fields: Column, tag: str, old: str, new: str) -> Column:
    """Subfields of code new go, those of code old take it."""

    def moved(f: Column) -> Column:
        kept = F.filter(f["subfields"], lambda s: s["code"] != new)
        out = F.transform(kept, lambda s: F.when(s["code"] == old, _subfield(new, s["value"])).otherwise(s))
        return F.when(F.exists(f["subfields"], lambda s: s["code"] == old), out).otherwise(f["subfields"])

    return _on(fields, tag, moved)


def put_subfield(fields: Column, tag: str, code: str, value: Column) -> Column:
    """The first subfield of the code gets the value; a field without one gets it added."""
    first = F.lit(0)

    def put(f: Column) -> Column:
        replaced = F.get(replace_first(F.array(f), tag, code, lambda v: value), first)["subfields"]
        added = F.get(add_subfield(F.array(f), tag, code, value), first)["subfields"]
        return F.when(F.exists(f["subfields"], lambda s: s["code"] == code), replaced).otherwise(added)

    return _on(fields, tag, put)


def delete_subfields(fields: Column, tag: str, codes: str) -> Column:
    return _on(fields, tag, lambda f: F.filter(f["subfields"], lambda s: ~F.lit(codes).contains(s["code"])))


def keep_subfields(fields: Column, tag: str, codes: str) -> Column:
    return _on(fields, tag, lambda f: F.filter(f["subfields"], lambda s: F.lit(codes).contains(s["code"])))


def delete_first_subfield(fields: Column, tag: str, code: str) -> Column:
    def cut(f: Column) -> Column:
        first = F.array_position(F.transform(f["subfields"], lambda s: s["code"]), F.lit(code))
        return F.filter(f["subfields"], lambda s, i: i + 1 != first)

    return _on(fields, tag, cut)


def delete_fields(fields: Column, *tags: str) -> Column:
    return F.filter(fields, lambda f: ~f["tag"].isin(*tags))


def retag(fields: Column, old: str, new: str) -> Column:
    """Fields of a tag under another one, in the order of tags."""
    return model.sorted_fields(F.transform(fields, lambda f: F.when(f["tag"] == old, _with(f, f["subfields"], F.lit(new))).otherwise(f)))


def sanitize(fields: Column) -> Column:
    """Values trimmed, empty subfields and fields out."""
    trimmed = F.transform(fields, lambda f: _with(f, F.filter(F.transform(f["subfields"], lambda s: _subfield(s["code"], F.trim(s["value"]))), lambda s: s["value"] != "")))
    return F.filter(trimmed, lambda f: F.size(f["subfields"]) > 0)


def merge(fields: Column, others: Column) -> Column:
    """The fields and those of another record that it lacks, in the order of tags."""
    return model.sorted_fields(F.array_distinct(F.concat(fields, F.coalesce(others, F.expr(f"cast(array() as array<{model.FIELD}>)")))))


def _spec(text: str) -> tuple[str, str]:
    if len(text) < 4:
        raise OpError(f"a tag and codes are needed: {text!r}")
    return text[:3], text[3:]


def _pattern(text: str) -> tuple[str, str | None, str]:
    reference, colon, pattern = text.partition(":")
    if not colon or len(reference) not in (3, 4):
        raise OpError(f"no pattern: {text!r}")
    return reference[:3], reference[3:] or None, pattern


def _slashed(text: str) -> tuple[str, str, bool]:
    m = re.fullmatch(r"/((?:[^/\\]|\\.)*)/((?:[^/\\]|\\.)*)/(g?)", text)
    if not m:
        raise OpError(f"no /pattern/template/: {text!r}")
    return m[1].replace(r"\/", "/"), m[2].replace(r"\/", "/"), bool(m[3])


def _condition(text: str) -> Callable[[Column], Column]:
    """TTTc:pattern, as a predicate on the fields."""
    tag, code, pattern = _pattern(text)
    return lambda fields: model.matches(fields, tag, code, pattern)


def _field(text: str) -> tuple[str, dict[str, str]]:
    """TTTc:value."""
    reference, colon, value = text.partition(":")
    if not colon or len(reference) != 4:
        raise OpError(f"no TTTc:value: {text!r}")
    return reference[:3], {reference[3]: value}


def _insert(fields: Column, text: str, *condition: str) -> Column:
    tag, subfields = _field(text)
    out = model.insert_field(fields, model.field(tag, {c: F.lit(v) for c, v in subfields.items()}), tag)
    return F.when(_condition(condition[0])(fields), out).otherwise(fields) if condition else out


def _add(fields: Column, text: str, *condition: str) -> Column:
    tag, subfields = _field(text)
    ((code, value),) = subfields.items()
    out = add_subfield(fields, tag, code, F.lit(value))
    return F.when(_condition(condition[0])(fields), out).otherwise(fields) if condition else out


def _replace(fields: Column, text: str, *condition: str) -> Column:
    tag, subfields = _field(text)
    return replace_field(fields, tag, subfields, _condition(condition[0])(fields) if condition else None)


def _remove_all(fields: Column, *patterns: str) -> Column:
    for p in patterns:
        fields = model.remove_fields(fields, *_pattern(p))
    return fields


def _remove_subfields(fields: Column, *patterns: str) -> Column:
    for tag, code, pattern in map(_pattern, patterns):
        if code is None:
            raise OpError(f"a subfield code is needed: {tag!r}")
        fields = remove_subfields(fields, tag, code, pattern)
    return fields


def _specs(edit: Callable[..., Column]) -> Callable[..., Column]:
    """An edit for each of the specifications that colons divide."""

    def op(fields: Column, specs: str, *args) -> Column:
        for spec in specs.split(":"):
            fields = edit(fields, *_spec(spec), *args)
        return fields

    return op


def _first_if(fields: Column, spec: str, slashed: str) -> Column:
    return replace_first_if(fields, *_spec(spec), *_slashed(slashed))


def _code(fields: Column, text: str) -> Column:
    m = re.fullmatch(r"(\w{3})(\w)=(\w)", text)
    if not m:
        raise OpError(f"no TTTo=n: {text!r}")
    return replace_code(fields, *m.groups())


#: Edits of an op-list by name, with the least and the largest number of arguments.
EDITS: dict[str, tuple[Callable[..., Column], int, int]] = {
    "remove-fields": (_remove_all, 1, 99),
    "remove-subfields": (_remove_subfields, 1, 99),
    "filter-chars": (_specs(filter_chars), 2, 2),
    "translate": (_specs(translate), 3, 3),
    "replace": (_specs(replace_values), 3, 3),
    "globally-substitute": (_specs(substitute), 3, 3),
    "insert-field": (_insert, 1, 1),
    "insert-field-if": (_insert, 2, 2),
    "add-subfield": (_add, 1, 1),
    "add-subfield-if": (_add, 2, 2),
    "replace-field": (_replace, 1, 1),
    "replace-field-if": (_replace, 2, 2),
    "replace-subfield-if-regex": (_first_if, 2, 2),
    "replace-code": (_code, 1, 1),
    "delete-fields": (delete_fields, 1, 99),
    "sanitize": (sanitize, 0, 0),
}
#: Predicates of an op-list: whether a record stays, given its patterns. Later operations see earlier edits.
FILTERS = ("keep", "drop")


def apply_ops(records: DataFrame, ops: str, limit: int | None = None) -> DataFrame:
    """Runs an op-list, one operation a line with arguments quoted as in a shell; # starts a comment line.

    keep and drop take TTT[c]:pattern arguments, of which any may match, and decide on the fields as edited up to there;
    keep-level and drop-level take characters for the bibliographic level, the eighth character of the leader.
    """
    out = records
    for line in ops.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        name, *args = shlex.split(line)
        name = name.removeprefix("--")
        if name in FILTERS:
            if not args:
                raise OpError(f"{name} needs a pattern")
            found = F.lit(False)
            for a in args:
                found = found | _condition(a)(F.col("fields"))
            out = out.where(found if name == "keep" else ~found)
        elif name in ("keep-level", "drop-level") and len(args) == 1:
            found = F.coalesce(F.substring("leader", 8, 1).isin(*args[0]), F.lit(False))
            out = out.where(found if name == "keep-level" else ~found)
        elif name in EDITS:
            edit, least, most = EDITS[name]
            if not least <= len(args) <= most:
                raise OpError(f"{name}: wrong number of arguments")
            out = out.withColumn("fields", edit(F.col("fields"), *args))
        else:
            raise OpError(f"no operation: {line!r}")
    return out if limit is None else out.limit(limit)
