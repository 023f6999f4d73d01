"""Whole collections: strict comparison, shuffling, splitting, lists of deletions, regrouping and level fixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Indicators of a deletion list and the widths of its lines (with and without a library number).
FULL, LOCAL = "ABCDE", "3459"
WIDTHS = {25: 9, 21: 9, 26: 10, 22: 10}
KEY_AT = 13


def deletions(lines: DataFrame, column: str = "value") -> DataFrame:
    """(key, local) of a fixed-width deletion list: the key's length follows from the line's; the letter before it says whether the whole record or
    local data alone goes. Blank lines and lines of other widths or letters are left out."""
    line = F.trim(F.col(column))
    length = F.element_at(F.create_map(*(F.lit(x) for pair in WIDTHS.items() for x in pair)), F.length(line))
    sign = F.substr(line, F.lit(KEY_AT - 1), F.lit(1))
    got = lines.where(length.isNotNull() & sign.isin(*FULL, *LOCAL)).select(F.trim(F.substr(line, F.lit(KEY_AT), length)).alias("key"), sign.isin(*LOCAL).alias("local"))
    return got.distinct()


def delete(records: DataFrame, listed: DataFrame, key: str = "control_number", tag: str = "LOK") -> DataFrame:
    """Records without those listed whole; those listed for their local data lose the fields of `tag`."""
    kept = records.join(listed.where("not local").select(F.col("key").alias(key)), key, "left_anti")
    local = listed.where("local").select(F.col("key").alias(key), F.lit(True).alias("__local"))
    fields = F.when(F.col("__local"), F.filter("fields", lambda f: f["tag"] != tag)).otherwise(F.col("fields"))
    return kept.join(local, key, "left").withColumn("fields", fields).select(*records.columns)


def strict_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that are not in both as often, with `n_left` and `n_right`; none if the collections are equal but for order."""
    both = left.withColumn("__s", F.lit(1)).unionByName(right.withColumn("__s", F.lit(0)))
    counts = both.groupBy(*left.columns).agg(F.sum("__s").alias("n_left"), F.sum(1 - F.col("__s")).alias("n_right"))
    return counts.where("n_left <> n_right")


def shuffled(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Rows in an order that depends on seed and key alone, so a second run gives the same."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key)


def part_of(key: Column, parts: int) -> Column:
    """The number of the part, of so many, that a row is dealt to by its key."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def regrouped(members: DataFrame) -> DataFrame:
    """Archive members (kind, ...) with the two groups of a complete dump: titles with superior titles, and authorities; others go."""
    group = F.when(F.col("kind").isin("title", "superior"), "titles").when(F.col("kind") == "authority", "authorities")
    return members.withColumn("dump", group).where("dump is not null")


def fixed_levels(records: DataFrame, parents: Column, monographs: DataFrame, key: str = "control_number") -> DataFrame:
    """Parts of books (level a) that have parents of which none is a monograph become parts of serials (level b). monographs: their keys."""
    books = monographs.select(F.col(key).alias("__p")).distinct()
    parts = records.where(F.substr("leader", F.lit(8), F.lit(1)) == "a").select(key, F.explode(parents).alias("__p"))
    found = parts.join(books.withColumn("__book", F.lit(True)), "__p", "left").groupBy(key).agg(F.max(F.coalesce("__book", F.lit(False))).alias("__book"))
    leader = F.when(~F.col("__book"), F.overlay("leader", F.lit("b"), 8)).otherwise(F.col("leader"))
    return records.join(found, key, "left").withColumn("leader", leader).select(*records.columns)


def sort_years(records: DataFrame, years: DataFrame, key: str = "control_number", year: str = "year") -> DataFrame:
    """records with the year that `years` lists for their key, where it does."""
    return records.join(years.groupBy(key).agg(F.max(year).alias(year)), key, "left")


def subset_by_parent(records: DataFrame, journals: DataFrame, pattern: str, column: str, journal_key: str, parent: str) -> DataFrame:
    """Records whose parent is a journal with a value of `column` that matches the pattern."""
    chosen = journals.where(F.col(column).rlike(pattern)).select(F.col(journal_key).alias(parent)).distinct()
    return records.join(chosen, parent, "left_semi")


def collections(articles: DataFrame, parents: DataFrame, key: str, parent: str, title: str, pattern: str) -> DataFrame:
    """articles with `collection`: whether any article names them as parent, or their title matches the pattern."""
    named = parents.select(F.col(parent).alias("__p")).distinct()
    return articles.join(named, articles[key] == F.col("__p"), "left").withColumn("collection", F.col("__p").isNotNull() | F.coalesce(F.col(title).rlike(pattern), F.lit(False))).drop("__p")


def translated_headings(records: DataFrame, translations: DataFrame, key: str = "control_number", tag: str = "750") -> DataFrame:
    """Translations (key, language, text) as fields `tag` $a text $9 language; a field of the same language is replaced."""
    from folioframe.records import model

    new = F.transform("__t", lambda t: model.field(tag, {"a": t["text"], "9": t["language"]}))
    per = translations.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("language", "text"))).alias("__t"))
    says = lambda f: F.exists("__t", lambda t: F.exists(f["subfields"], lambda s: (s["code"] == "9") & (s["value"] == t["language"])))
    kept = F.filter("fields", lambda f: (f["tag"] != tag) | ~says(f))
    edited = model.sorted_fields(F.concat(kept, new))
    return records.join(per, key, "left").withColumn("fields", F.when(F.col("__t").isNull(), F.col("fields")).otherwise(edited)).select(*records.columns)
