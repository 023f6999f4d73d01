"""Journal registers, user tags, collections and fields by language: joins and counts over several tables."""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.ranges import _let


def register_changes(old: DataFrame, new: DataFrame, key: str, updated: str, columns: Sequence[str]) -> DataFrame:
    """(key, attribute, before, after, days): attributes in which a newer entry differs; a null after is no change, days lie between the updates.

    Entries that only one side has give nothing, and neither do those older than the stored one.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("attribute"), F.coalesce(F.col(f"a.{c}").cast("string"), F.lit("")).alias("before"), F.col(f"b.{c}").cast("string").alias("after")) for c in columns))
    days = F.datediff(F.col(f"b.{updated}"), F.col(f"a.{updated}"))
    both = old.alias("a").join(new.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}")).where(days >= 0)
    changed = both.select(F.col(f"a.{key}").alias(key), days.alias("days"), F.explode(F.filter(cells, lambda x: x["after"].isNotNull() & (x["after"] != x["before"]))).alias("x"))
    return changed.select(key, "x.*", "days")


def register_merged(old: DataFrame, new: DataFrame, key: str, updated: str, columns: Sequence[str]) -> DataFrame:
    """Entries of both, with the newer one's values where it has any; new entries are added."""
    a, b = F.col(f"a.{updated}"), F.col(f"b.{updated}")
    newer = b.isNotNull() & (a.isNull() | (b >= a))
    pick = lambda c: F.when(newer, F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))).otherwise(F.col(f"a.{c}"))
    both = old.alias("a").join(new.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    return both.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), pick(updated).alias(updated), *(pick(c).alias(c) for c in columns))


def journal_articles(articles: DataFrame, journals: DataFrame, parent: str, journal_key: str, longest: int = 8) -> DataFrame:
    """Articles (key, parent, year, volume, issue, pages) of registered journals. Without an issue the volume is the issue; an issue is cut at so many characters."""
    got = articles.join(journals, articles[parent] == journals[journal_key])
    none = F.coalesce(F.col("issue"), F.lit("")) == ""
    return got.withColumn("__v", F.when(none, "").otherwise(F.coalesce("volume", F.lit("")))).withColumn("issue", F.left(F.when(none, F.coalesce("volume", F.lit(""))).otherwise(F.col("issue")), F.lit(longest))).withColumn("volume", F.col("__v")).drop("__v")


def clean_tags(tags: DataFrame, uses: DataFrame, resources: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tags, uses, resources) without uses (tag_id, resource_id) of resources (id, record_id) whose record is gone (record_id), then without tags and resources of no use."""
    dead = resources.join(gone.select("record_id").distinct(), "record_id", "left_semi").select(F.col("id").alias("resource_id"))
    used = uses.join(dead, "resource_id", "left_anti")
    return tags.join(used.select(F.col("tag_id").alias("id")).distinct(), "id", "left_semi"), used, resources.join(used.select(F.col("resource_id").alias("id")).distinct(), "id", "left_semi")


def tag_keywords(tags: DataFrame, uses: DataFrame, resources: DataFrame) -> DataFrame:
    """(record_id, keywords): the sorted distinct tags that users gave to a record."""
    given = uses.join(tags.select(F.col("id").alias("tag_id"), "tag"), "tag_id").join(resources.select(F.col("id").alias("resource_id"), "record_id"), "resource_id")
    return given.groupBy("record_id").agg(F.array_sort(F.collect_set("tag")).alias("keywords"))


def collection_sizes(collections: DataFrame, articles: DataFrame, key: str, parent: str, name: str = "n_articles") -> DataFrame:
    """collections with the number of articles whose parent they are, 0 for none. Articles are counted by parent before the join."""
    n = articles.where(F.col(parent).isNotNull()).groupBy(F.col(parent).alias(key)).agg(F.count("*").alias(name))
    return collections.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def reference_terms(records: DataFrame, primary: Column, synonyms: Column, key: str, number: str = r"(?:gnd/)?[0-9X]{8,}") -> DataFrame:
    """(term, synonyms): comma-joined parts of the primary values, and of the synonyms where at least two are left; parts that hold a number are none.

    Of records with one term the least key's synonyms count.
    """
    parts = lambda c: F.filter(F.flatten(F.transform(c, lambda v: F.transform(F.split(v, ","), lambda p: F.trim(p)))), lambda p: (p != "") & ~p.rlike(number))
    got = records.select(F.col(key).alias("__k"), F.array_join(parts(primary), ",").alias("term"), parts(synonyms).alias("s")).where((F.col("term") != "") & (F.size("s") > 1))
    return got.groupBy("term").agg(F.min_by(F.array_join("s", ","), "__k").alias("synonyms"))


def aligned_chain(chain: Column, asked: Sequence[str]) -> Column:
    """The chain with, place by place, the keyword that shares the longest prefix with the one asked there moved to it from this place or behind, in exchange.

    Case counts; the first of equally good ones is taken, and where none shares a letter the place is left as it is.
    """
    for i, word in enumerate(asked):
        chain = _placed(chain, i, word)
    return chain


def _placed(chain: Column, i: int, word: str) -> Column:
    return _let(chain, lambda c: F.when(F.size(c) > i, _let(_best_place(c, i, word), lambda p: _exchanged(c, F.lit(i), p))).otherwise(c))


def _best_place(chain: Column, i: int, word: str) -> Column:
    lengths = F.transform(chain, lambda w, k: F.when(k >= i, _shared(w, word)).otherwise(-1))
    return _let(lengths, lambda n: F.when(F.array_max(n) > 0, F.array_position(n, F.array_max(n)).cast("int") - 1).otherwise(i))


def _exchanged(chain: Column, i: Column, p: Column) -> Column:
    return F.transform(chain, lambda w, k: F.when(k == i, F.get(chain, p)).when(k == p, F.get(chain, i)).otherwise(w))


def _shared(w: Column, word: str) -> Column:
    """The length of the common prefix with a fixed word."""
    n = F.lit(0)
    for k in range(1, len(word) + 1):
        n = F.when(w.startswith(word[:k]), k).otherwise(n)
    return n


# Fields by language.


def localized_query(query: str, language: str, known: Collection[str]) -> str:
    """A query with `field:` as `field_language:` wherever known has such a field; what is in quotation marks, or escaped, is no field."""

    def renamed(m: re.Match[str]) -> str:
        name = m["name"]
        return m[0] if name is None or f"{name}_{language}" not in known else f"{name}_{language}{m['colon']}"

    return re.sub(r'"(?:[^"\\]|\\.)*"|\\.|(?<![\w.\\])(?P<name>[A-Za-z_][\w.-]*)(?P<colon>:)', renamed, query)


def localized_columns(rows: DataFrame, columns: Sequence[str], language: str) -> DataFrame:
    """rows whose columns hold the language's text (`column_language`) where there is one; columns of other languages stay."""
    return rows.withColumns({c: F.coalesce(F.col(f"{c}_{language}"), F.col(c)) for c in columns if f"{c}_{language}" in rows.columns})


def has_any_text(columns: Sequence[str]) -> Column:
    """Whether one of the columns holds text, as a document with a full text from any source."""
    return F.coalesce(F.length(F.concat_ws("", *columns)), F.lit(0)) > 0
