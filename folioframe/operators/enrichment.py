"""Enrichment of records and rows from other tables: references, authority data, identifiers, local data and translations.

Records keep their fields in one array. What they refer to is exploded to distinct (record, reference) rows, joined, and brought back as one
small map or array a record, so the arrays themselves are shuffled once, and a reference that many records share is a key of the large side alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.records import model

KEY = "control_number"


def references(records: DataFrame, tags: Sequence[str], code: str, pattern: str = "^(.+)$", key: str = KEY) -> DataFrame:
    """(key, ref): distinct first groups of the pattern in a subfield of the fields; values without a match are left out."""
    chosen = F.filter("fields", lambda f: f["tag"].isin(*tags))
    found = F.flatten(F.transform(chosen, lambda f: F.transform(F.filter(f["subfields"], lambda s: s["code"] == code), lambda s: F.regexp_extract(s["value"], pattern, 1))))
    return records.select(key, F.explode(F.array_distinct(found)).alias("ref")).where("ref <> ''")


def attach(rows: DataFrame, lookup: DataFrame, column: str, key: str, value: str | Column, name: str) -> DataFrame:
    """rows with `name`: the sorted distinct values that lookup has for their column, null where it has none."""
    value = F.col(value) if isinstance(value, str) else value
    listed = lookup.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_set(value)).alias(name))
    return rows.join(listed, rows[column] == F.col("__k"), "left").drop("__k")


def add_values(records: DataFrame, values: DataFrame, tag: str, code: str, key: str = KEY) -> DataFrame:
    """records with a field `tag` for each distinct (key, value), sorted by value; values that a field of this tag and code has are not added."""
    listed = values.select(key, "value").where("value is not null and value <> ''").groupBy(key).agg(F.array_sort(F.collect_set("value")).alias("__v"))
    none = F.expr("cast(array() as array<string>)")
    new = F.array_except(F.coalesce("__v", none), model.values(F.col("fields"), tag, code))
    made = F.transform(new, lambda v: model.field(tag, {code: v}))
    joined = records.join(listed, key, "left")
    return joined.withColumn("fields", F.when(F.size(made) > 0, model.sorted_fields(F.concat("fields", made))).otherwise(F.col("fields"))).select(*records.columns)


def add_from_references(records: DataFrame, lookup: DataFrame, tags: Sequence[str], code: str, pattern: str, new_tag: str, new_code: str, key: str = KEY) -> DataFrame:
    """Fields from what the records refer to: lookup is (ref, value), as external ids of persons, classes of linked topics, or ranges of linked works."""
    return add_values(records, references(records, tags, code, pattern, key).join(lookup.select("ref", "value"), "ref"), new_tag, new_code, key)


def _with_map(records: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """records with the map __m of their (key, ref, new) rows; of several for a ref the least one counts."""
    one = found.groupBy(key, "ref").agg(F.min("new").alias("new"))
    maps = one.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ref", "new"))).alias("__m"))
    return records.join(maps, key, "left")


def rewrite_references(records: DataFrame, mapping: DataFrame, tags: Sequence[str], code: str, prefix: str = "", key: str = KEY) -> DataFrame:
    """Subfield values prefix + ref become prefix + new for (ref, new) of mapping: links to records that were merged or renamed."""
    escaped = "".join("\\" + c if not c.isalnum() else c for c in prefix)
    found = references(records, tags, code, f"^{escaped}(.+)$", key).join(mapping.select("ref", "new"), "ref")

    def value(s: Column) -> Column:
        new = F.element_at(F.col("__m"), F.substr(s["value"], F.lit(len(prefix) + 1)))
        changed = F.when((s["code"] == code) & s["value"].startswith(prefix) & new.isNotNull(), F.concat(F.lit(prefix), new)).otherwise(s["value"])
        return F.struct(s["code"].alias("code"), changed.alias("value"))

    edited = F.transform("fields", lambda f: F.when(f["tag"].isin(*tags), f.withField("subfields", F.transform(f["subfields"], value))).otherwise(f))
    return _with_map(records, found, key).withColumn("fields", F.when(F.col("__m").isNull(), F.col("fields")).otherwise(edited)).select(*records.columns)


def from_authority(records: DataFrame, authority: DataFrame, tags: Sequence[str], pattern: str, codes: Mapping[str, str], key: str = KEY) -> DataFrame:
    """Fields whose $0 matches the pattern take the subfields of the authority row (ref, and a column for each code of codes).

    A null column leaves the subfield out; subfields with other codes stay, after the new ones. Fields without an authority row are unchanged.
    """
    pairs = F.filter(F.array(*(F.struct(F.lit(c).alias("code"), F.col(col).cast("string").alias("value")) for c, col in codes.items())), lambda s: s["value"].isNotNull())
    found = references(records, tags, "0", pattern, key).join(authority.select("ref", pairs.alias("new")), "ref")

    def rewritten(f: Column) -> Column:
        refs = F.transform(F.filter(f["subfields"], lambda s: s["code"] == "0"), lambda s: F.element_at(F.col("__m"), F.regexp_extract(s["value"], pattern, 1)))
        new = F.get(F.filter(refs, lambda r: r.isNotNull()), F.lit(0))
        rest = F.filter(f["subfields"], lambda s: ~s["code"].isin(*codes))
        return F.when(f["tag"].isin(*tags) & new.isNotNull(), f.withField("subfields", F.concat(new, rest))).otherwise(f)

    edited = F.transform("fields", rewritten)
    return _with_map(records, found, key).withColumn("fields", F.when(F.col("__m").isNull(), F.col("fields")).otherwise(edited)).select(*records.columns)


def link_lists(ids: DataFrame, lists: Mapping[str, DataFrame], column: str) -> DataFrame:
    """ids with `links`: (list, n, target) of each link list (id, n, target) that names them, sorted by the list's name."""
    every = None
    for name, rows in sorted(lists.items()):
        part = rows.select("id", F.struct(F.lit(name).alias("list"), "n", "target").alias("link"))
        every = part if every is None else every.unionByName(part)
    if every is None:
        raise ValueError("no link lists")
    return attach(ids, every, column, "id", "link", "links")


def missing_urls(items: DataFrame, urls: DataFrame, key: str, doi: str, url: str, known: str) -> DataFrame:
    """(key, url): the url that `urls` has for an item's DOI, where the item's array `known` has it not. DOIs compare without case."""
    mine = items.select(key, F.lower(doi).alias("__d"), F.col(known).alias("__known"))
    theirs = urls.select(F.lower(doi).alias("__d"), F.col(url).alias("url")).where("url is not null").distinct()
    has = F.coalesce(F.array_contains("__known", F.col("url")), F.lit(False))
    return mine.join(theirs, "__d").where(~has).select(key, "url").distinct()


def two_hop(items: DataFrame, lookup: DataFrame, key: str, hops: str, via: str, value: str) -> DataFrame:
    """(key, value): lookup's value for the first entry of the item's array `hops` that it knows, the least of several."""
    steps = items.select(key, F.posexplode(hops).alias("__i", "__h"))
    known = lookup.groupBy(F.col(via).alias("__h")).agg(F.min(value).alias(value))
    return steps.join(known, "__h").groupBy(key).agg(F.min_by(value, "__i").alias(value))


def add_local(records: DataFrame, local: DataFrame, tag: str = "ZWI", code: str = "b", key: str = KEY) -> DataFrame:
    """Local fields (key, fields) appended to the record of their key, and to the record that names their key in `tag` as one merged into it."""
    own = records.select(key, F.col(key).alias("ref")).union(references(records, (tag,), code, key=key).select(key, "ref")).distinct()
    theirs = local.select(F.col(key).alias("ref"), F.col("fields").alias("__l"))
    listed = own.join(theirs, "ref").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ref", "__l"))).alias("__a"))
    extra = F.flatten(F.transform("__a", lambda x: x["__l"]))
    return records.join(listed, key, "left").withColumn("fields", F.when(F.col("__a").isNull(), F.col("fields")).otherwise(F.concat("fields", extra))).select(*records.columns)


def tags_from_children(parents: DataFrame, children: DataFrame, key: str, parent: str, tag: str, name: str) -> DataFrame:
    """parents with `name`: the sorted tags of their children, an empty array for none."""
    got = attach(parents, children, key, parent, tag, name)
    return got.withColumn(name, F.coalesce(name, F.expr("cast(array() as array<string>)")))


def inherited_flag(rows: DataFrame, key: str, parents: str, flag: str, name: str) -> DataFrame:
    """rows with `name`: their own flag, or that of any of the array `parents`."""
    held = rows.where(F.col(flag)).select(F.col(key).alias("__p")).distinct()
    by = rows.select(F.col(key).alias("__k"), F.explode(parents).alias("__p")).join(held, "__p").select("__k").distinct()
    return rows.join(by, rows[key] == F.col("__k"), "left").withColumn(name, F.coalesce(flag, F.lit(False)) | F.col("__k").isNotNull()).drop("__k")


def prefer(rows: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """rows with those replaced whose key the reference set has (of several the least); keys that only it has are not added."""
    rest = [c for c in rows.columns if c != key]
    one = reference.groupBy(key).agg(F.min(F.struct(*rest)).alias("__r"))
    pick = (F.when(F.col("__r").isNull(), F.col(c)).otherwise(F.col(f"__r.{c}")).alias(c) for c in rest)
    return rows.join(one, key, "left").select(key, *pick)


def split_used(authorities: DataFrame, refs: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): authorities whose number is referred to or null, and the others."""
    used = refs.select(F.col("ref").alias(column)).distinct()
    numbered = authorities.where(F.col(column).isNotNull())
    kept = authorities.where(F.col(column).isNull()).unionByName(numbered.join(used, column, "left_semi").select(*authorities.columns))
    return kept, numbered.join(used, column, "left_anti").select(*authorities.columns)


def without_references(records: DataFrame, deleted: DataFrame, tags: Sequence[str], code: str, pattern: str, key: str = KEY) -> DataFrame:
    """Records without the subfields whose reference is in deleted (ref)."""
    found = references(records, tags, code, pattern, key).join(deleted.select("ref", F.lit(True).alias("new")), "ref")
    gone = lambda s: (s["code"] == code) & F.element_at(F.col("__m"), F.regexp_extract(s["value"], pattern, 1)).isNotNull()
    edited = F.transform("fields", lambda f: F.when(f["tag"].isin(*tags), f.withField("subfields", F.filter(f["subfields"], lambda s: ~gone(s)))).otherwise(f))
    return _with_map(records, found, key).withColumn("fields", F.when(F.col("__m").isNull(), F.col("fields")).otherwise(edited)).select(*records.columns)


def keyword_matches(keywords: DataFrame, authorities: DataFrame, keyword: str, heading: str, ref: str) -> DataFrame:
    """(keyword, n, ref): each distinct keyword without regard to case, how often it occurs, and the least reference whose heading it is, or null."""
    k = F.lower(F.trim(keyword))
    counts = keywords.select(k.alias("keyword")).where("keyword <> ''").groupBy("keyword").agg(F.count("*").alias("n"))
    known = authorities.groupBy(F.lower(F.trim(heading)).alias("keyword")).agg(F.min(ref).alias("ref"))
    return counts.join(known, "keyword", "left")


def best_translation(rows: DataFrame, key: str, language: str, text: str, origin: str, origins: Sequence[str]) -> DataFrame:
    """One translation a key and language: that of the first origin in `origins`, others last, ties by text."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, origins)), F.col(origin)), F.lit(0))
    rank = F.when(rank == 0, F.lit(len(origins) + 1)).otherwise(rank)
    best = F.min_by(F.struct(text, origin), F.struct(rank, F.col(text), F.col(origin)))
    return rows.where(F.col(text).isNotNull()).groupBy(key, language).agg(best.alias("__b")).select(key, language, f"__b.{text}", f"__b.{origin}")


def translation_gaps(rows: DataFrame, key: str, language: str, languages: Sequence[str]) -> DataFrame:
    """(key, language): languages without a translation of the key."""
    have = rows.groupBy(key).agg(F.collect_set(language).alias("__l"))
    return have.select(key, F.explode(F.array_except(F.array(*map(F.lit, languages)), F.col("__l"))).alias(language))


def translation_coverage(rows: DataFrame, key: str, language: str) -> DataFrame:
    """(language, translated, missing) over all keys."""
    total = rows.agg(F.count_distinct(key).alias("__t"))
    counts = rows.where(F.col(language).isNotNull()).groupBy(language).agg(F.count_distinct(key).alias("translated"))
    return counts.join(F.broadcast(total)).select(language, "translated", (F.col("__t") - F.col("translated")).alias("missing"))


def expand_bundles(subscriptions: DataFrame, bundles: DataFrame, item: str, bundle: str, member: str) -> DataFrame:
    """subscriptions with bundles replaced by their members, once for each; `bundled` tells them from single items."""
    parts = bundles.select(F.col(bundle).alias("__b"), F.col(member).alias("__m")).distinct()
    got = subscriptions.join(parts, subscriptions[item] == F.col("__b"), "left")
    rest = [c for c in subscriptions.columns if c != item]
    return got.select(*rest, F.coalesce("__m", item).alias(item), F.col("__b").isNotNull().alias("bundled")).distinct()
