"""Books, aliases and references to scripture in queries and titles; native expressions over tables of names that the caller gives.

Names are compared in lower case without blanks: `1 Mos`, `1. mos` with the alias `1.mos`. A table of names is bounded by the number of books and
their spellings, a few thousand short words, so it is a literal map in the plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions import ranges

#: Names of a book's first and last chapters that count as books of their own, and where they lie in it.
_SHIFTED = r"^([56])(?:esra|ezra|ezr|esr|esd)[a-z]*(.*)$"
#: Names of months, which a number follows without being a reference.
_MONTHS = (
    "janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre|jan\\w*|feb\\w*|mär\\w*|apr\\w*|jun\\w*|jul\\w*|aug\\w*|sep\\w*|okt\\w*|nov\\w*|dez\\w*"
)
#: Chapters and verses as they stand in running text.
_PLACE = r" ?(\d{1,3}(?:[,:] ?\d{1,3}[a-f]?)?(?: ?- ?\d{1,3}(?:[,:] ?\d{1,3}[a-f]?)?|(?:\.\d{1,3}[a-f]?(?:-\d{1,3}[a-f]?)?)+)?)(?![\p{L}\p{N}])"


def _looked_up(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), c) if table else F.lit(None).cast("string")


def reference_parts(c: Column) -> Column:
    """(book, place) of one reference: the book keeps a leading numeral, the place is the tail that begins with a digit, or empty."""
    form = r"^(\d?\.?[^\d]*?)(\d.*)?$"
    flat = F.regexp_replace(F.lower(c), r"\s+", "")
    return F.struct(F.regexp_extract(flat, form, 1).alias("book"), F.regexp_extract(flat, form, 2).alias("place"))


def split_references(c: Column) -> Column:
    """The references of a query, which are divided by OR in any case."""
    return F.transform(F.split(c, r"(?i) OR "), reference_parts)


def aliased(c: Column, aliases: dict[str, str]) -> Column:
    """The canonical form of a reference that is an alias; the fifth and sixth of a book's parts are its chapters 1-2 and from 15 on; others stay."""
    flat = F.replace(F.lower(c), F.lit(" "), F.lit(""))
    part, place = F.regexp_extract(flat, _SHIFTED, 1), F.regexp_extract(flat, _SHIFTED, 2)
    chapter = F.regexp_extract(place, r"^(\d+)", 1)
    later = F.when(place == "", "15-16").otherwise(F.concat((F.try_to_number(chapter, F.lit("999")).cast("int") + 14).cast("string"), F.regexp_replace(place, r"^\d+", "")))
    shifted = F.concat(F.lit("4esra"), F.when(part == "5", F.when(place == "", "1-2").otherwise(place)).otherwise(later))
    return F.when(flat.rlike(_SHIFTED), F.coalesce(shifted, c)).otherwise(F.coalesce(_looked_up(flat, aliases), c))


def book_code(book: Column, codes: dict[str, str], spellings: dict[str, str] | None = None) -> Column:
    """The two digits of a book by its canonical name or a spelling of it; null if unknown."""
    return _looked_up(F.coalesce(_looked_up(book, spellings or {}), book), codes)


def references(c: Column, codes: dict[str, str], spellings: dict[str, str] | None = None, aliases: dict[str, str] | None = None) -> Column:
    """All ranges of a query of references; null if a book is unknown or a place cannot be read."""
    each = F.transform(F.split(c, r"(?i) OR "), lambda r: reference_parts(aliased(r, aliases or {})))
    found = F.transform(each, lambda p: ranges.scripture(p["place"], book_code(p["book"], codes, spellings)))
    return F.when(F.forall(found, lambda r: r.isNotNull() & F.forall(r, lambda x: x["lower"].isNotNull())), F.flatten(found))


def is_whole_book(r: Column) -> Column:
    """Whether a range covers all chapters of a book."""
    return r["lower"].endswith("000000") & r["upper"].endswith("999999")


def without_whole_books(found: Column) -> Column:
    return F.filter(found, lambda r: ~is_whole_book(r))


def _mention(names: set[str]) -> str:
    """A pattern of one of the names, with or without a period and a blank behind a numeral, and a place."""
    written = (re.sub(r"^(\d)(.)", r"\1\\.? ?\2", re.escape(n)) for n in sorted(names, key=lambda n: (-len(n), n)))
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])((?:{'|'.join(written)})\.?){_PLACE}"


def mentions(title: Column, codes: dict[str, str], spellings: dict[str, str] | None = None) -> Column:
    """References found in a title: array of (text, ranges) of known books whose place can be read; a month with a number is none."""
    known = codes | {k: codes[v] for k, v in (spellings or {}).items() if v in codes}
    known = {re.sub("[ .]", "", k): v for k, v in known.items() if re.search(r"[^\W\d_]", k)}
    if not known:
        return F.array().cast("array<struct<text: string, ranges: array<struct<lower: string, upper: string>>>>")
    form = _mention(set(known))

    def read(t: Column) -> Column:
        book = F.regexp_replace(F.lower(F.regexp_extract(t, form, 1)), r"[ .]", "")
        place = F.regexp_replace(F.lower(F.regexp_extract(t, form, 2)), " ", "")
        code = F.when(~book.rlike(rf"^(?:{_MONTHS})$"), book_code(book, known))
        return F.struct(t.alias("text"), F.when(code.isNotNull(), ranges.scripture(place, code)).alias("ranges"))

    texts = F.regexp_extract_all(F.regexp_replace(title, r"[‐‑‒–—―]", "-"), F.lit(form), 0)
    return F.filter(F.transform(texts, read), lambda m: m["ranges"].isNotNull())


def suggestions(titles: DataFrame, key: str, title: str, passages: dict[str, str], codes: dict[str, str], spellings: dict[str, str] | None = None) -> DataFrame:
    """(key, reference) for titles that name a passage or a reference: the longest named passage contained (ties: the first in order), else the first mention.

    A passage counts wherever its name stands in the lower-cased title with blanks collapsed. Their names are a list in the plan, as bounded as that of books.
    """
    names = sorted(passages, key=lambda p: (-len(p), p))
    flat = F.trim(F.regexp_replace(F.lower(F.col(title)), r"\s+", " "))
    passage = F.get(F.filter(F.array(*map(F.lit, names)).cast("array<string>"), lambda p: F.contains(flat, p)), F.lit(0))
    found = titles.withColumn("__r", F.coalesce(passage, F.get(mentions(flat, codes, spellings), F.lit(0))["text"]))
    return found.where("__r is not null").select(key, F.col("__r").alias("reference"))
