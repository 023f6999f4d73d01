"""The long tail of scalar functions on text, numbers, identifiers, dates, URLs and HTML, as native Column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Joined letters, dashes and quotation marks with their plain forms.
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ĳ": "IJ", "ĳ": "ij", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
DASHES = "‐‑‒–—―⁃−﹘﹣－"
QUOTES = "«‹»›„‚“‟‘‛”’❛❜❟❝❞〝〞〟＂"
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@cache
def _marks() -> tuple[str, str]:
    """Latin letters with diacritical marks and the same without, by canonical decomposition."""
    found = []
    for n in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        plain = unicodedata.normalize("NFD", chr(n))
        if len(plain) > 1 and plain[0].isascii():
            found.append((chr(n), plain[0]))
    return "".join(a for a, _ in found), "".join(b for _, b in found)


# Characters.


def without_marks(c: Column) -> Column:
    """Diacritical marks off, whether composed or combining."""
    return F.regexp_replace(F.translate(c, *_marks()), r"\p{Mn}", "")


def expand_ligatures(c: Column) -> Column:
    return reduce(lambda out, pair: F.replace(out, F.lit(pair[0]), F.lit(pair[1])), LIGATURES.items(), c)


def plain_dashes(c: Column) -> Column:
    return F.translate(c, DASHES, "-" * len(DASHES))


def plain_quotes(c: Column) -> Column:
    return F.translate(c, QUOTES, '"' * len(QUOTES))


def only_chars(c: Column, chars: str) -> Column:
    """What is left when all characters but these go."""
    return F.regexp_replace(c, "[^" + re.sub(r"([\]\[\\^&~-])", r"\\\1", chars) + "]", "")


def collapse(c: Column, char: str) -> Column:
    """Runs of a character become one."""
    q = r"\Q" + char + r"\E"
    return F.regexp_replace(c, f"(?:{q})+", re.sub(r"([\\$])", r"\\\1", char))


def char_count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def initial_caps(c: Column) -> Column:
    """First letters of words in upper case, the others as they are."""
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")


def is_initial_caps(c: Column) -> Column:
    return c.rlike(r"^\p{Lu}")


def is_unsigned(c: Column) -> Column:
    return c.rlike(r"^\d+$")


def is_decimal(c: Column) -> Column:
    return c.rlike(r"^\d+(\.\d*)?$|^\.\d+$")


# Words and parts.


def chop_words(c: Column, least: int = 1) -> Column:
    """Words of letters, digits, hyphens and apostrophes; a number keeps its period, hyphens and apostrophes at the ends of words go."""
    found = F.regexp_extract_all(c, F.lit(r"(\d+\.(?!\d)|[\p{L}\p{N}'\-]+)"), 1)
    cut = F.transform(found, lambda w: F.regexp_replace(w, r"^[-']+|[-']+$", ""))
    return F.filter(cut, lambda w: F.length(w) >= least)


def has_phrase(words: Column, phrase: Column) -> Column:
    """Whether the words of the phrase follow each other in words."""
    n = F.size(phrase)
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1)))
    return (n <= F.size(words)) & F.exists(starts, lambda k: F.slice(words, k, n) == phrase)


def common_prefix(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    same = F.filter(F.sequence(F.lit(0), n), lambda k: F.substr(a, F.lit(1), k) == F.substr(b, F.lit(1), k))
    return F.substr(a, F.lit(1), F.array_max(same))


def common_suffix(a: Column, b: Column) -> Column:
    return F.reverse(common_prefix(F.reverse(a), F.reverse(b)))


def glob(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """A shell pattern over the whole text: * ? [set] [!set], a backslash takes a character as it is."""
    out, at = "", 0
    while at < len(pattern):
        ch = pattern[at]
        end = pattern.find("]", at + 2) if ch == "[" else -1
        if ch == "\\" and at + 1 < len(pattern):
            at += 1
            out += re.escape(pattern[at])
        elif end > 0:
            body = pattern[at + 1 : end]
            out += "[" + ("^" + body[1:] if body[0] in "!^" else body).replace("\\", "\\\\").replace("[", "\\[") + "]"
            at = end
        else:
            out += {"*": ".*", "?": "."}.get(ch, re.escape(ch))
        at += 1
    return c.rlike(("(?is)" if ignore_case else "(?s)") + "^" + out + r"\z")


def truncate(c: Column, n: int, mark: str = "...") -> Column:
    """At most n characters, at the end of a word where there is one, with a mark for what is cut."""
    head = F.substring(c, 1, n - len(mark))
    word = F.regexp_replace(head, r"\s+\S*$", "")
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.when(word != "", word).otherwise(head), F.lit(mark)))


def csv_field(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def c_escape(c: Column) -> Column:
    """Backslashes, quotes and control characters written as in a C literal."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, name in (('"', '"'), ("\n", "n"), ("\r", "r"), ("\t", "t"), ("\b", "b"), ("\f", "f")):
        out = F.replace(out, F.lit(char), F.lit("\\" + name))
    return out


# Numbers.


def roman(c: Column) -> Column:
    """The number of a Roman numeral, null if it is none: a sign before a larger one counts as negative."""
    value = F.create_map(*(F.lit(x) for pair in ROMAN.items() for x in pair))
    signs = F.filter(F.split(F.upper(c), ""), lambda s: s != "")
    values = F.transform(signs, lambda s: F.try_element_at(value, s))
    total = F.aggregate(
        F.zip_with(values, F.concat(F.slice(values, 2, 99), F.array(F.lit(0))), lambda a, b: F.when(a < b, -a).otherwise(a)), F.lit(0), lambda s, x: s + x
    )
    return F.when(F.upper(c).rlike(r"^(?=.)M*(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"), total)


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th ... 11th, 12th, 13th ..."""
    last, teens = n % 10, n % 100
    ending = F.when((teens >= 11) & (teens <= 13), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), ending)


def grouped(n: Column, separator: str = ",") -> Column:
    """An integer with its digits in threes."""
    return F.regexp_replace(n.cast("string"), r"(?<=\d)(?=(\d{3})+$)", separator)


def base62(n: Column) -> Column:
    """Digits, capitals and small letters as digits of a number of 0 or more."""
    digit = lambda x: F.substr(F.lit(BASE62), F.pmod(x, F.lit(62)).cast("int") + 1, F.lit(1))
    start = F.struct(n.cast("bigint").alias("n"), F.lit("").alias("s"))

    def step(a: Column, _: Column) -> Column:
        done = (a["n"] == 0) & (a["s"] != "")
        left = F.call_function("div", a["n"], F.lit(62)).cast("bigint")
        return F.struct(left.alias("n"), F.when(done, a["s"]).otherwise(F.concat(digit(a["n"]), a["s"])).alias("s"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(10)), start, step, lambda a: a["s"])


def milliseconds(n: Column) -> Column:
    """A time of n milliseconds in days, hours, minutes, seconds and milliseconds; parts of 0 are left out."""
    parts = [(86_400_000, None, "d"), (3_600_000, 24, "h"), (60_000, 60, "m"), (1_000, 60, "s"), (1, 1_000, "ms")]
    shown = []
    for size, wrap, unit in parts:
        x = F.floor(n / size)
        x = x if wrap is None else x % wrap
        shown.append(F.when(x > 0, F.concat(x.cast("string"), F.lit(unit))))
    return F.when(n == 0, "0ms").otherwise(F.concat_ws(" ", *shown))


# Identifiers.


def doi(c: Column) -> Column:
    """The DOI of a text that is one, with or without resolver or `doi:`, in lower case; else null."""
    form = r"^(?:https?://[^/]+/|doi:)?(10\.\d{4,}(?:\.\d+)*/(?:(?![\"&'<>])\S)+)$"
    return F.when(c.rlike(form), F.lower(F.regexp_extract(c, form, 1)))


def find_doi(c: Column) -> Column:
    """The first DOI within a text, or empty text."""
    return F.regexp_extract(c, r"(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)", 1)


def issn(c: Column) -> Column:
    """An ISSN with its hyphen, null for a text of another length."""
    return F.when(F.length(c) == 9, c).when(F.length(c) == 8, F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 4)))


def isbn(c: Column) -> Column:
    """An ISBN without hyphens, null unless 10 or 13 characters are left."""
    plain = F.replace(c, F.lit("-"), F.lit(""))
    return F.when(F.length(plain).isin(10, 13), plain)


def title_key(c: Column) -> Column:
    """Titles that differ in punctuation, blanks, marks, ligatures or case have one key."""
    flat = F.trim(F.regexp_replace(c, r"[\p{P}\p{Z}\s]+", " "))
    return F.lower(without_marks(expand_ligatures(flat)))


def author_key(c: Column) -> Column:
    """First and last part of a name in lower case: `Last, First` is turned round, initials with periods go."""
    parts = F.split(F.trim(c), ",", 2)
    turned = F.when(F.size(parts) == 2, F.concat_ws(" ", F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))).otherwise(c)
    plain = F.regexp_replace(F.regexp_replace(turned, r"(?<![^\s.])[^\s.]\.", " "), r"(?<=\S)\.(?=\S)", ". ")
    words = F.filter(F.split(F.lower(without_marks(expand_ligatures(plain))), r"\s+"), lambda w: w != "")
    return F.when(F.size(words) == 0, F.lit("")).when(F.size(words) == 1, F.get(words, F.lit(0))).otherwise(F.concat_ws(" ", F.get(words, F.lit(0)), F.element_at(words, -1)))


# Dates.


def julian_day(d: Column) -> Column:
    """The number of a day since noon of 1 January 4713 BC."""
    return F.datediff(d, F.lit("1970-01-01").cast("date")) + 2_440_588


def from_julian_day(n: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), (n - 2_440_588).cast("int"))


def is_leap_year(y: Column) -> Column:
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def days_in_month(y: Column, m: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))


def zulu(ts: Column) -> Column:
    """A time in UTC as 2024-01-31T12:00:00Z, for a session in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def rfc1123(ts: Column) -> Column:
    return F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


# URLs and HTML.


def major_site(url: Column) -> Column:
    """The last two parts of the host."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r":\d+$|^[^@]*@", "")
    return F.substring_index(host, ".", -2)


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, default port, fragment and empty path's slash made alike."""
    form = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^#]*)"
    head = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, form, 1)), r"^(http://.*):80$", "$1"), r"^(https://.*):443$", "$1")
    rest = F.regexp_extract(url, form, 2)
    return F.when(url.rlike(form), F.concat(head, F.when(rest == "", "/").otherwise(rest))).otherwise(url)


def url_encode(c: Column) -> Column:
    """Percent-encoding with %20 for a blank."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def strip_tags(html: Column) -> Column:
    """Tags become blanks, which are collapsed; a < opens a tag before a letter or / alone, and quoted > do not close it."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"</?[A-Za-z][^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>", " "), r"\s+", " "))


def escape_html(c: Column) -> Column:
    out = c
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def unescape_html(c: Column) -> Column:
    out = c
    for char, name in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;"), (" ", "&nbsp;"), ("&", "&amp;")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return out
