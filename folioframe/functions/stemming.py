"""A light suffix stemmer as a Column expression, and the removal of stop words.

Longest suffix first, and only where a stem of at least `least` letters is left; it is coarser than a full rule-based stemmer, and meant to make
inflected forms of a word meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUFFIXES = {
    "en": ("ations", "ation", "ings", "ness", "ing", "ies", "edly", "ed", "es", "ly", "s"),
    "de": ("ungen", "heiten", "keiten", "ung", "heit", "keit", "ern", "em", "en", "er", "es", "e", "s"),
    "fr": ("ements", "ement", "ations", "ation", "euses", "euse", "ives", "ive", "aux", "es", "e", "s"),
    "es": ("aciones", "mente", "ación", "idades", "idad", "ando", "iendo", "os", "as", "es", "a", "o", "e"),
}


def stem(word: Column, language: str, least: int = 3) -> Column:
    """The word in lower case without its longest suffix of the language; null stays null, an unknown language leaves the word."""
    w = F.lower(word)
    endings = SUFFIXES.get(language, ())
    return F.regexp_replace(w, rf"^(.{{{least},}}?)(?:{'|'.join(endings)})$", "$1") if endings else w


def without_stop_words(words: Column, stop: Sequence[str]) -> Column:
    """Words but for the stop words, in order and with repeats."""
    return F.filter(words, lambda w: ~F.lower(w).isin(*[s.lower() for s in stop])) if stop else words


def keywords_in_titles(titles: DataFrame, keywords: DataFrame, key: str, title: str, keyword: str, language: str, least_single: int = 7) -> DataFrame:
    """(key, keyword): keywords whose stems stand side by side in the title. Single words need least_single letters, words of a phrase three."""
    from folioframe.operators.validation import contained_phrases

    stems = lambda c: F.transform(F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), 1), lambda w: F.length(w) >= 3), lambda w: stem(w, language))
    texts = titles.select(key, stems(F.col(title)).alias("__w"))
    phrases = keywords.select(F.col(keyword).alias("keyword"), stems(F.col(keyword)).alias("phrase")).where(
        (F.size("phrase") > 1) | ((F.size("phrase") == 1) & (F.length(F.get("phrase", F.lit(0))) >= least_single))
    )
    # Only stems are compared: one row a distinct phrase, its keywords come back by a join on it.
    met = contained_phrases(texts, phrases.select("phrase").distinct(), key, "__w", "phrase")
    return met.join(phrases, "phrase").select(key, "keyword").distinct()
