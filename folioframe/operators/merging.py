"""Merging the print and the online record of one work, and following up the change of keys.

The fields of all members of a group become rows with a slot that says which of them are one field of the result; each slot is folded on its own and the
slots are put together again. Groups are a work's few forms, slots a group's few equal fields: both small however large the collection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.strings import title_key
from folioframe.operators.graph import canonical
from folioframe.records import accessors, checks, model

#: Fields that link records, and where main entries go that a record can have only once.
LINKS = ("775", "776", "780", "785")
ADDED_ENTRY = {"100": "700", "110": "710", "111": "711"}
_FORM = r" \((electronic|print|electronic/print)\)$"


def groups_of(records: DataFrame, links: DataFrame, src: str, dst: str, key: str = "control_number") -> DataFrame:
    """(key, head, others): for each record in a group of two or more that are there, the group's largest key and its other keys, sorted.

    A link to a missing record joins its neighbours.
    """
    met = records.select(key).join(canonical(links, src, dst), F.col(key) == F.col("node")).select(key, "canonical")
    w = Window.partitionBy("canonical")
    got = met.withColumn("head", F.max(key).over(w)).withColumn("__all", F.array_sort(F.collect_set(key).over(w)))
    return got.where(F.size("__all") > 1).select(key, "head", F.array_remove("__all", F.col("head")).alias("others"))


def _joined(items: Column) -> Column:
    """One text of (value, form) items: equal ones as they are; else each value once, with the forms that have it in parentheses."""
    raw = F.array_distinct(F.transform(items, lambda x: x["value"]))
    base = lambda x: F.regexp_replace(x["value"], _FORM, "")
    forms = lambda x: F.when(x["value"].rlike(_FORM), F.split(F.regexp_extract(x["value"], _FORM, 1), "/")).otherwise(F.array(x["form"]))

    def text(b: Column) -> Column:
        have = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(items, lambda x: base(x) == b), forms))))
        return F.concat(b, F.lit(" ("), F.array_join(have, "/"), F.lit(")"))

    return F.when(F.size(raw) <= 1, F.get(raw, F.lit(0))).otherwise(F.array_join(F.transform(F.array_distinct(F.transform(items, base)), text), "; "))


def _combined(same: Column, codes: Sequence[str] | None) -> Column:
    """The subfields of the first of `same`, with the values of the codes (all codes of any member, if None) joined over its members."""
    listed = F.flatten(F.transform(same, lambda m: F.transform(m["subfields"], lambda s: F.struct(s["code"].alias("code"), s["value"].alias("value"), m["form"].alias("form")))))
    every = F.array_distinct(F.transform(listed, lambda s: s["code"]))

    def one(code: Column) -> Column:
        return F.struct(code.alias("code"), _joined(F.filter(listed, lambda s: s["code"] == code)).alias("value"))

    if codes is None:
        return F.transform(every, one)
    first = F.get(same, F.lit(0))["subfields"]
    present = F.filter(every, lambda c: c.isin(*codes))
    return F.concat(F.filter(first, lambda s: ~s["code"].isin(*codes)), F.transform(present, one))


def merge_forms(records: DataFrame, groups: DataFrame, current_year: int, unique: Sequence[str] = ()) -> DataFrame:
    """One record for each group of groups_of, under its head's key; other records as they are.

    Control fields are the head's, but for the latest 005 and the 008 with the larger second date. The title is that of the latest 005; other titles become
    246 with the form in $g. 260 counts as 264; places and publishers that agree are one field with the dates of both. A second main entry becomes an added one. Every
    ISSN tells its form ($2), dates ($3) and title ($9). Local fields are all kept. Tags of `unique` are merged value by value. Of other fields
    equal ones (by their normalised text) are kept once, in the order head, then ascending keys. Links between records go, but for 775. ZWI has the other keys in $b and
    the latest year in $y. Fields are sorted by tag.
    """
    key, first = "control_number", F.lit(0)
    linked = records.join(groups, key)
    f = F.col("fields")
    year = F.try_to_number(F.regexp_extract(accessors.publication_year(F.col("leader"), f, current_year), r"^(\d{4})", 1), F.lit("9999")).cast("int")
    member = linked.select(
        "head", "others", F.struct((F.col(key) != F.col("head")).alias("r"), F.col(key).alias("k")).alias("rank"), "leader", "fields", year.alias("year"),
        F.when(checks.is_electronic(F.col("leader"), f), "electronic").otherwise("print").alias("form"), accessors.main_title(f).alias("title"),
        F.array_join(model.values(F.filter(f, lambda x: x["tag"].isin("260", "264")), "264", "c"), ",").alias("dates"), model.first_value(f, "005", "").alias("changed"),
    )
    newest = Window.partitionBy("head").orderBy(F.desc("changed"), "rank")
    ranked = member.withColumn("place", F.row_number().over(newest))
    rows = ranked.select("head", "rank", "form", "title", "dates", "place", F.posexplode("fields").alias("pos", "f"))
    rows = rows.select("*", F.when(F.col("f.tag") == "260", "264").otherwise(F.col("f.tag")).alias("tag"))
    kept = rows.where(~((F.col("tag") == "001") & F.col("rank.r")) & ~(F.col("tag").isin(*LINKS) & (F.col("tag") != "775")) & (F.col("tag") != "ZWI"))

    text = lambda codes=None: title_key(F.array_join(F.transform(F.filter(F.col("f.subfields"), lambda s: s["code"].isin(*codes) if codes else F.lit(True)), lambda s: F.concat(s["code"], s["value"])), " "))
    tag = F.col("tag")
    # The order in which a member counts as the first of its slot.
    order = F.when(tag == "245", F.struct(F.lit("").alias("a"), F.col("place").alias("b"))).otherwise(
        F.struct(F.when(tag.isin("005", "008"), F.lit("~")).otherwise("").alias("a"), F.lit(0).alias("b"))
    )
    best = F.when(tag == "005", F.get("f.subfields", first)["value"]).when(tag == "008", F.substring(F.get("f.subfields", first)["value"], 12, 4)).otherwise("")
    main = Window.partitionBy("head", "tag").orderBy(F.col("order.b"), "rank", "pos")
    moved = kept.withColumn("order", order).withColumn("best", best).withColumn("nth", F.row_number().over(main))
    added = F.lit(None).cast("string")
    for old, new in ADDED_ENTRY.items():
        added = F.when((tag == old) & (F.col("nth") > 1), F.lit(new)).otherwise(added)
    out_tag = F.when((tag == "245") & (F.col("nth") > 1), "246").otherwise(F.coalesce(added, tag))
    subfield = lambda code, value: F.struct(F.lit(code).alias("code"), value.cast("string").alias("value"))
    pick = lambda codes: F.filter(F.col("f.subfields"), lambda s: s["code"].isin(*codes))
    others = lambda codes: F.filter(F.col("f.subfields"), lambda s: ~s["code"].isin(*codes))
    issn = F.concat(others(["2", "3", "9"]), F.filter(F.array(subfield("2", F.col("form")), subfield("3", F.col("dates")), subfield("9", F.col("title"))), lambda s: s["value"] != ""))
    varying = (tag == "245") & (F.col("nth") > 1)
    subfields = F.when(tag == "022", issn).when(varying, F.concat(pick(list("abhnp68")), F.array(subfield("g", F.concat("form", F.lit(" title")))))).otherwise(F.col("f.subfields"))
    slot = (
        F.when(tag == "LOK", F.concat_ws("|", "rank.k", "pos"))
        .when((tag < "010") | tag.isin(*unique), "")
        .when(tag == "264", text(("a", "b")))
        .when(tag.isin("245", "246"), title_key(F.array_join(F.transform(pick(["a"]), lambda s: s["value"]), " ")))
        .when(tag.isin(*ADDED_ENTRY) & (F.col("nth") == 1), "")
        .otherwise(F.concat_ws("|", "f.ind1", "f.ind2", text()))
    )
    # A varying title with the main one's words is the main one.
    group = F.when(out_tag.isin("245", "246"), "24").when(tag.isin(*ADDED_ENTRY) & added.isNull(), tag).otherwise(out_tag)
    one = F.struct(
        F.col("order.b").alias("b"), "rank", "pos", "form", "best", out_tag.alias("tag"), F.when(varying, "2").otherwise(F.col("f.ind1")).alias("ind1"),
        F.when(varying, "3").otherwise(F.col("f.ind2")).alias("ind2"), subfields.alias("subfields"),
    )
    slots = moved.select("head", group.alias("g"), slot.alias("slot"), one.alias("x")).groupBy("head", "g", "slot").agg(
        F.array_sort(F.collect_list("x")).alias("same"), F.max_by("x", F.struct("x.best", ~F.col("x.rank.r"))).alias("latest")
    )
    lead = F.get("same", first)
    merged = (
        F.when(F.col("g").isin("005", "008"), F.col("latest.subfields"))
        .when(F.col("g") < "010", lead["subfields"])
        .when(F.col("g") == "264", _combined(F.col("same"), ("c",)))
        .when(F.col("g").isin(*unique) if unique else F.lit(False), _combined(F.col("same"), None))
        .otherwise(lead["subfields"])
    )
    field = F.struct(lead["tag"].alias("tag"), lead["ind1"].alias("ind1"), lead["ind2"].alias("ind2"), merged.alias("subfields"))
    place = F.struct(lead["tag"].alias("tag"), lead["rank"].alias("rank"), lead["pos"].alias("pos"), field.alias("f"))
    folded = slots.select("head", place.alias("p")).groupBy("head").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["f"]).alias("fields"))
    heads = member.groupBy("head").agg(F.min_by("leader", "rank").alias("leader"), F.first("others").alias("others"), F.max("year").alias("year"))
    note = F.struct(
        F.lit("ZWI").alias("tag"), F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"),
        F.filter(F.concat(F.transform("others", lambda k: subfield("b", k)), F.array(subfield("y", F.col("year")))), lambda s: s["value"].isNotNull()).alias("subfields"),
    )
    whole = folded.join(heads, "head").select(F.col("head").alias(key), "leader", F.concat("fields", F.array(note)).alias("fields"))
    return records.join(groups.select(key), key, "left_anti").select(key, "leader", "fields").unionByName(whole)


def renamed_keys(groups: DataFrame, key: str = "control_number") -> DataFrame:
    """(ref, new) of the keys that a merge takes away, for rewrite_references and swap_keys."""
    return groups.where(F.col(key) != F.col("head")).select(F.col(key).alias("ref"), F.col("head").alias("new"))


def merge_subscriptions(subscriptions: DataFrame, renamed: DataFrame, user: str, item: str, seen: str) -> DataFrame:
    """Subscriptions under the new keys; of several of a user to one item the least time seen stays."""
    got = subscriptions.join(renamed, subscriptions[item] == F.col("ref"), "left")
    return got.select(user, F.coalesce("new", item).alias(item), seen).groupBy(user, item).agg(F.min(seen).alias(seen))


def swap_keys(rows: DataFrame, renamed: DataFrame, column: str, unique: Sequence[str] = ()) -> DataFrame:
    """rows with the new keys; where columns of `unique` then agree, the row that had the key all along stays, then the least one."""
    got = rows.join(renamed, rows[column] == F.col("ref"), "left").withColumn("__old", F.col("new").isNull())
    got = got.withColumn(column, F.coalesce("new", column))
    if unique:
        rest = [c for c in rows.columns if c not in unique]
        best = F.min_by(F.struct(*rest) if rest else F.struct(F.lit(0)), F.struct(~F.col("__old"), *rest))
        return got.groupBy(*unique).agg(best.alias("__r")).select(*(F.col(c) if c in unique else F.col(f"__r.{c}").alias(c) for c in rows.columns))
    return got.select(*rows.columns)


def swap_report(rows: DataFrame, renamed: DataFrame, column: str) -> DataFrame:
    """(ref, new, n): how many rows a swap of keys would change."""
    return rows.groupBy(F.col(column).alias("ref")).agg(F.count("*").alias("n")).join(renamed, "ref").select("ref", "new", "n")


def changed(rows: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """rows that are new or whose digest differs from the stored one."""
    old = stored.select(F.col(key).alias("__k"), F.col(digest).alias("__h"))
    return rows.join(old, rows[key] == F.col("__k"), "left").where(F.col("__h").isNull() | (F.col("__h") != F.col(digest))).select(*rows.columns)
