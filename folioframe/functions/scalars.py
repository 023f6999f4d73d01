"""Conversions of text, numbers, encodings and times that the other function modules leave out; native Column expressions.

Null gives null. What cannot be read (a number with a foreign digit, an unknown truth value or code, a time in no format) gives null too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words for truth values, articles that do not count in an order, and forms of one date.
TRUE, FALSE = ("true", "yes", "on", "1"), ("false", "no", "off", "0")
ARTICLES = ("the", "a", "an", "le", "les", "la", "der", "die", "das", "el")
TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd MMM yyyy HH:mm:ss 'GMT'")
#: Two-letter language codes with those that German libraries use.
LANGUAGE_CODES = {
    "af": "afr", "an": "arg", "ar": "ara", "bg": "bul", "br": "bre", "ca": "cat", "cs": "cze", "cy": "cym", "da": "dan", "de": "deu", "el": "gre", "en": "eng", "es": "spa", "et": "est", "eu": "eus", "fi": "fin",
    "fr": "fra", "ga": "gaa", "gl": "glg", "he": "heb", "ht": "hat", "hr": "hrv", "hu": "hun", "id": "ind", "is": "ice", "it": "ita", "la": "lat", "lv": "lav", "lt": "lit", "ms": "msa", "mt": "mlt", "nl": "nld",
    "no": "nor", "oc": "oci", "pl": "pol", "pt": "por", "ro": "rum", "ru": "rus", "sk": "slo", "sl": "slv", "so": "som", "sq": "sqi", "sr": "srp", "sv": "swe", "sw": "swa", "tl": "tgl", "tr": "tur", "uk": "ukr",
    "vi": "vie", "zh": "hant", "zh-cn": "hans",
}


def _class(chars: str) -> str:
    return "[" + re.sub(r"([\]\[\\^&~-])", r"\\\1", chars) + "]"


def _looked_up(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), c)


# Ends, tests and orders.


def trim_chars(c: Column, chars: str = " \t\n\v\f\r", left: bool = True, right: bool = True) -> Column:
    """Characters of a set off one end or both."""
    parts = [f"^{_class(chars)}+"] * left + [rf"{_class(chars)}+\z"] * right
    return F.regexp_replace(c, "|".join(parts), "") if parts else c


def padded(c: Column, n: int, char: str = " ", leading: bool = True) -> Column:
    """At least n characters; longer text stays whole."""
    return F.when(F.length(c) >= n, c).otherwise((F.lpad if leading else F.rpad)(c, n, char))


def starts_with_any(c: Column, prefixes: Sequence[str], ignore_case: bool = False) -> Column:
    return c.rlike(("(?iu)" if ignore_case else "") + "^(?:" + "|".join(rf"\Q{p}\E" for p in prefixes) + ")")


def ends_with_any(c: Column, suffixes: Sequence[str], ignore_case: bool = False) -> Column:
    return c.rlike(("(?iu)" if ignore_case else "") + "(?:" + "|".join(rf"\Q{s}\E" for s in suffixes) + r")\z")


def is_proper_prefix(a: Column, b: Column) -> Column:
    """Whether b begins with a and is longer."""
    return b.startswith(a) & (F.length(a) < F.length(b))


def find_any_of(c: Column, chars: str, last: bool = False) -> Column:
    """The place, from 0, of the first or last character that is one of a set; null if there is none."""
    form = rf"(?s)^(.*){_class(chars)}" if last else rf"(?s)^([^{_class(chars)[1:-1]}]*){_class(chars)}"
    return F.when(c.rlike(form), F.length(F.regexp_extract(c, form, 1)))


def sort_key(c: Column) -> Column:
    """Text as it counts in an order: lower case, without a leading article and what is neither letter nor digit before the first that is."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), rf"^ *(?:{'|'.join(ARTICLES)}) ", ""), r"^[^\p{L}\p{N}]+", "")


# Lists in one text.


def escaped(c: Column, chars: str, mark: str = "\\") -> Column:
    """Characters of a set, and the mark itself, behind a mark."""
    return F.regexp_replace(c, f"({_class(chars + mark)})", re.sub(r"([\\$])", r"\\\1", mark) + "$1")


def split_escaped(c: Column, separator: str, mark: str = "\\") -> Column:
    """Parts between separators that have no mark before them; marks are taken off."""
    q = re.escape(mark)
    cut = F.regexp_replace(c, rf"(?s)\G((?:[^{_class(separator + mark)[1:-1]}]|{q}.)*+){re.escape(separator)}", "$1\0")
    return F.transform(F.split(cut, "\0"), lambda p: F.regexp_replace(p, rf"(?s){q}(.)", "$1"))


def join_escaped(parts: Column, separator: str, mark: str = "\\") -> Column:
    return F.array_join(F.transform(parts, lambda p: escaped(p, separator, mark)), separator)


def split_trimmed(c: Column, separator: str) -> Column:
    """Parts without white space about them, empty ones left out."""
    return F.filter(F.transform(F.split(c, rf"\Q{separator}\E"), lambda p: trim_chars(p)), lambda p: p != "")


def distinct_list(c: Column, separator: str) -> Column:
    """A list in a text, each part at its first place alone."""
    return F.array_join(F.array_distinct(F.split(c, rf"\Q{separator}\E")), separator)


# Excerpts.


def shortened(c: Column, n: int) -> Column:
    """At most n characters, the last three of them periods if some are cut; up to three characters stay."""
    return F.when(F.length(c) <= max(n, 3), c).otherwise(F.concat(F.substring(c, 1, max(n - 3, 0)), F.lit("...")))


def wrapped(c: Column, width: int) -> Column:
    """Lines of at most width characters, broken at blanks; a longer word has a line of its own."""
    return F.regexp_replace(F.regexp_replace(c, rf"(\S{{{width},}}|.{{1,{width}}})(?:[ \t]+|(?=\n)|\z)", "$1\n"), r"\n+\z|(?<=\n)\n", "")


def longest_common_part(a: Column, b: Column) -> Column:
    """The longest text found in both; of equally long ones the first in a. One pass over a: the best can grow by one character a place."""

    def step(best: Column, end: Column) -> Column:
        longer = F.substr(a, end - F.length(best), F.length(best) + 1)
        return F.when((end > F.length(best)) & F.contains(b, longer), longer).otherwise(best)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), F.lit(""), step)


# Numbers and bytes.


def number(c: Column, base: int = 10) -> Column:
    """A whole number written in a base of 2 to 36, with a sign or none."""
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"[:base]
    sign = F.when(c.startswith("-"), -1).otherwise(1)
    value = F.conv(F.regexp_replace(c, "^[+-]", ""), base, 10)
    return F.when(c.rlike(rf"^(?i)[+-]?[{digits}]+\z"), sign * F.try_to_number(value, F.lit("9" * 20)).cast("decimal(20,0)")).cast("bigint")


def in_base(n: Column, base: int, width: int = 0, fill: str = "0") -> Column:
    """A number of 0 or more in a base, in lower case, filled up on the left."""
    return padded(F.lower(F.conv(n.cast("string"), 10, base)), width, fill)


def truth(c: Column) -> Column:
    return F.when(F.lower(c).isin(*TRUE), True).when(F.lower(c).isin(*FALSE), False)


def to_hex(c: Column) -> Column:
    """Bytes of the UTF-8 form as hexadecimal digits, in lower case."""
    return F.lower(F.hex(F.encode(c, "UTF-8")))


def from_hex(c: Column) -> Column:
    """Text of hexadecimal digits of its UTF-8 form, null if they are none or the bytes are no text."""
    raw = F.when(c.rlike(r"^(?:[0-9A-Fa-f]{2})*\z"), F.unhex(c))
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string"))


def adler32(c: Column) -> Column:
    """The Adler-32 checksum of the UTF-8 form."""
    digits = F.hex(F.encode(c, "UTF-8"))
    places = F.filter(F.sequence(F.lit(1), F.length(digits) + 1, F.lit(2)), lambda k: k < F.length(digits))
    codes = F.transform(places, lambda k: F.conv(F.substr(digits, k, F.lit(2)), 16, 10).cast("bigint"))
    start = F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))

    def step(s: Column, x: Column) -> Column:
        a = (s["a"] + x) % 65521
        return F.struct(a.alias("a"), ((s["b"] + a) % 65521).alias("b"))

    return F.aggregate(codes, start, step, lambda s: s["b"] * 65536 + s["a"])


def quoted_printable(c: Column) -> Column:
    """Bytes that are not printable ASCII, and =, as =XX; so is a blank or tab at the end. Lines are not broken."""
    one = lambda ch: F.when(ch.rlike(r"^[\t -<>-~]\z"), ch).otherwise(F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "=$1"))
    whole = F.array_join(F.transform(F.split(c, ""), one), "")
    return F.regexp_replace(F.regexp_replace(whole, r" \z", "=20"), r"\t\z", "=09")


def from_quoted_printable(c: Column) -> Column:
    """The text again; a = at the end of a line joins it with the next. Null if the bytes are no text."""
    escapes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"=\r?\n", ""), "([%+])", "=$1"), "=%", "%25")
    ready = F.regexp_replace(F.replace(escapes, F.lit("=+"), F.lit("%2B")), "=([0-9A-Fa-f]{2})", "%$1")
    return F.try_url_decode(ready)


def c_unescaped(c: Column) -> Column:
    r"""Backslash forms as in a C literal taken off: \n and the like, \uNNNN (also two for one character), octal \NNN; others stand for the character itself."""
    token = r"(?s)(\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\[0-7]{1,3}|\\.|[^\\]+|\\\z)"
    names = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "a": "\a"}

    def plain(t: Column) -> Column:
        rest = F.substr(t, F.lit(2))
        wide = F.decode(F.unhex(F.regexp_replace(t, r"\\u", "")), "UTF-16BE")
        octal = F.char(F.conv(rest, 8, 10).cast("int"))
        return F.when(~t.startswith("\\") | (t == "\\"), t).when(t.rlike(r"^\\u[0-9A-Fa-f]{4}"), wide).when(t.rlike(r"^\\[0-7]"), octal).otherwise(F.coalesce(_looked_up(rest, names), rest))

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(token), 1), plain), "")


def decoded(raw: Column, charset: str) -> Column:
    """Bytes in a named character set as text; names differ in case, hyphens and underscores at will."""
    known = {"utf8": "UTF-8", "usascii": "US-ASCII", "ascii": "US-ASCII", "iso88591": "ISO-8859-1", "latin1": "ISO-8859-1", "utf16": "UTF-16", "utf16le": "UTF-16LE", "utf16be": "UTF-16BE", "utf32": "UTF-32"}
    return F.decode(raw, known[re.sub("[-_ ]", "", charset.lower())])


# Codes of languages.


def library_language(c: Column) -> Column:
    """The three- or four-letter code of a two-letter one."""
    return _looked_up(F.lower(c), LANGUAGE_CODES)


def two_letter_language(c: Column) -> Column:
    return _looked_up(F.lower(c), {v: k for k, v in LANGUAGE_CODES.items()})


# Times.


def time_of(c: Column, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """The time a text names, by the first format that fits; a weekday before it does not count."""
    plain = F.regexp_replace(F.regexp_replace(c, r"^[A-Z][a-z]{2}, ", ""), r"(?<=T\d\d:\d\d:\d\d)Z\z", "+00:00")
    return F.coalesce(*(F.try_to_timestamp(plain, F.lit(f)) for f in formats))


def reformatted(c: Column, old: str, new: str) -> Column:
    return F.date_format(F.try_to_timestamp(c, F.lit(old)), new)


def local_time(zulu: Column, zone: str) -> Column:
    """A time in UTC, `yyyy-MM-ddTHH:mm:ssZ`, as local `yyyy-MM-dd HH:mm:ss`."""
    return F.date_format(F.from_utc_timestamp(F.try_to_timestamp(zulu, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), zone), "yyyy-MM-dd HH:mm:ss")


def dates_query(c: Column) -> Column:
    """Ranges `from:to` of seconds since 1970, divided by blanks, as `[time TO time]` joined by OR; null if one is none. For a session in UTC."""
    show = lambda r, k: F.date_format(F.timestamp_seconds(F.get(F.split(r, ":"), F.lit(k)).cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shown = F.transform(F.split(c, " +"), lambda r: F.concat(F.lit("["), show(r, 0), F.lit(" TO "), show(r, 1), F.lit("]")))
    return F.when(c.rlike(r"^\d{1,10}:\d{1,10}(?: +\d{1,10}:\d{1,10})*$"), F.array_join(shown, " OR "))
