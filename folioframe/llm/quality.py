"""Quality rules: counts with fixed limits, and distribution divergence from language references.

A language reference holds two histograms over all documents of a language: of CLASSES character classes, and of
the COMMON most common words (A-Z lower-cased) with all others as one. A document is compared with every reference by
the Jensen-Shannon distance (square root of the divergence in bits) of both; the reference with the least
sum is taken, and the document fails if a distance is over its limit. Guards: the
character histogram counts from LEAST_CHARS characters, the word histogram from LEAST_WORDS words, and from each distance
that which a sample of the document's size has by chance is taken first (a quarter of it for words, most
of which fall into one bin).

The limits are learnt from all guarded documents themselves: the median of their distances and SPREAD times the median deviation from it
(1.4826 of which are a standard deviation), at least LEAST_LIMIT, so they follow the corpus and not a setting, as long as most of it is sound.

Words are counted exactly over all documents, summed in each task before they are shuffled, so references do not depend on
batches or partitions; only each language's COMMON most frequent reach the driver, about 1 KB a language.

Base counts are exact: word_chars, n_symbols, lines repeated, words in repeated three-word windows.

Edge cases: null or wordless text has zero counts and fails the base limits; documents without
a language teach nothing; without references nothing diverges; words equally common are taken by their hash; repeated rows are judged each; empty tables give no rows;
other columns are ignored; long texts are read whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioframe.llm import kernels
from folioframe.llm.kernels import U64

#: Character classes: lower, upper, letters without case, marks, digits and numbers, space, punctuation, symbols, all else.
CLASSES = 9
COMMON = 40
#: Limits are the median and so many standard deviations (told by the median deviation), at least LEAST_LIMIT.
SPREAD, LEAST_LIMIT = 4.0, 0.05
LEAST_CHARS, LEAST_WORDS = 200, 50
MIN_WORDS, MAX_REPEAT = 50, 50
#: Bins of the distances from which limits are learnt.
BINS = 2000
_BY_CATEGORY = {"Ll": 0, "Lu": 1, "Lt": 1, "M": 3, "N": 4, "Z": 5, "P": 6, "S": 7, "L": 2}
#: Class of each code point, made at first use in each process.
_CLASSES: list[np.ndarray] = []
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _classes() -> np.ndarray:
    if not _CLASSES:
        kinds = (unicodedata.category(chr(c)) for c in range(0x110000))
        table = np.array([_BY_CATEGORY.get(k, _BY_CATEGORY.get(k[0], 8)) for k in kinds], np.uint8)
        table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5
        _CLASSES.append(table)
    return _CLASSES[0]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte at which each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.int32)
    wide = np.flatnonzero(code >= 0xC0)
    if len(wide):
        begin, first = at[wide], code[wide]
        tail = lambda k: (data[np.minimum(begin + k, len(data) - 1)] & 0x3F).astype(np.int32)
        two, three, four = (first & 0x1F) << 6 | tail(1), (first & 0x0F) << 12 | tail(1) << 6 | tail(2), (first & 0x07) << 18 | tail(1) << 12 | tail(2) << 6 | tail(3)
        code[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, np.minimum(four, 0x10FFFF)))
    return code, at


def char_histogram(words: kernels.Words) -> np.ndarray:
    """Characters of each class, texts x CLASSES; words must not be lower-cased."""
    n = len(words.counts)
    code, at = code_points(words.data)
    doc = np.repeat(np.arange(n), np.diff(np.searchsorted(at, words.offsets)))
    return np.bincount(doc * CLASSES + _classes()[code], minlength=CLASSES * n).reshape(n, CLASSES)


def _by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, whether an equal (doc, key) stands before it, and whether any other equals it."""
    order = np.lexsort((np.arange(len(keys)), keys, doc))
    k, d = keys[order], doc[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    earlier, any_other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order] = same[:-1]
    any_other[order] = same[:-1] | same[1:]
    return earlier, any_other


def _word_chars(words: kernels.Words) -> np.ndarray:
    return _by_text(((words.data & 0xC0) != 0x80) & ~kernels._IS_SPACE[words.data], words.offsets)


def base_counts(words: kernels.Words) -> dict[str, np.ndarray]:
    n = len(words.counts)
    out = {"n_words": words.counts, "word_chars": _word_chars(words), "n_symbols": _by_text(_SYMBOL[words.data], words.offsets)}
    # Lines: cut at each newline and at the ends of texts; those with a word count.
    newline = np.flatnonzero(words.data == 10)
    doc_of_newline = np.searchsorted(words.offsets, newline, side="right") - 1
    starts = np.concatenate([words.offsets[:-1], newline + 1])
    line_doc = np.concatenate([np.arange(n), doc_of_newline])
    order = np.lexsort((starts, line_doc))
    starts, line_doc = starts[order], line_doc[order]
    ends = np.append(starts[1:], 0) - 1
    last = np.append(line_doc[1:] != line_doc[:-1], True) if len(line_doc) else np.zeros(0, bool)
    ends[last] = words.offsets[1:][line_doc[last]]
    wordy = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, line_doc = starts[wordy], ends[wordy], line_doc[wordy]
    earlier, _ = _seen_before(kernels.span_hashes(words.data, starts, ends), line_doc)
    out["n_dup_lines"] = np.bincount(line_doc[earlier], minlength=n)
    # Words that a three-word window covers which is in the text twice or more.
    h = words.hashes()
    windows = kernels.grams(h, 3)
    inside = words.doc[2:] == words.doc[:-2] if len(h) > 2 else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    _, again = _seen_before(windows[at], words.doc[at])
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[at[again] + k] = True
    out["n_repeat_words"] = np.bincount(words.doc[covered], minlength=n)
    return out


class References:
    """languages; chars: languages x CLASSES shares; commons: sorted word hashes of each; shares: theirs and the rest's; limits: of both distances."""

    def __init__(self, languages: list[str], chars: np.ndarray, commons: list[np.ndarray], shares: list[np.ndarray], limits: tuple[float, float] = (1.0, 1.0)):
        self.languages, self.chars, self.commons, self.shares, self.limits = languages, chars, commons, shares, limits


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of each row of p (shares) and q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: np.where(a > 0, a * np.log2(a / m), 0).sum(axis=1)
        return np.sqrt(np.maximum((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0))


def distances(words: kernels.Words, lower: kernels.Words, refs: References) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character and word distance of each text to its nearest reference, and that reference's number (-1: none)."""
    n = len(words.counts)
    if not refs.languages:
        return np.zeros(n), np.zeros(n), np.full(n, -1)
    hist = char_histogram(words)
    share = hist / np.maximum(hist.sum(axis=1, keepdims=True), 1)
    h = lower.hashes()
    best = np.full(n, np.inf)
    char_d, word_d, which = np.zeros(n), np.zeros(n), np.zeros(n, int)
    for k in range(len(refs.languages)):
        commons = refs.commons[k]
        place = np.searchsorted(commons, h)
        place[place == len(commons)] = 0
        slot = np.where(commons[place] == h, place, len(commons)) if len(commons) else np.zeros(len(h), int)
        width = len(commons) + 1
        counts = np.bincount(words.doc * width + slot, minlength=n * width).reshape(n, width)
        c = js_distance(share, refs.chars[k])
        w = js_distance(counts / np.maximum(words.counts, 1)[:, None], refs.shares[k])
        better = c + w < best
        best = np.where(better, c + w, best)
        char_d, word_d, which = np.where(better, c, char_d), np.where(better, w, word_d), np.where(better, k, which)
    return char_d, word_d, which


def by_chance(bins: int, n: np.ndarray) -> np.ndarray:
    """About the distance of a sample of n from its own distribution, over so many bins."""
    return np.sqrt((bins - 1) / (8 * np.log(2) * np.maximum(n, 1)))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, key, n): kind 0 character class, 1 word, 2 all words."""
    for batch in batches:
        for at, texts in kernels.chunks(batch.column(1)):
            langs = np.array(batch.column(0).slice(at, len(texts)).to_pylist(), object)
            words = kernels.Words(texts, lower=True)
            hist, h = char_histogram(kernels.Words(texts)), words.hashes()
            for lang in sorted(set(langs)):
                mine = langs == lang
                key, n = np.unique(h[mine[words.doc]], return_counts=True)
                kinds = np.concatenate([np.zeros(CLASSES, np.int32), np.ones(len(key), np.int32), [2]]).astype(np.int32)
                keys = np.concatenate([np.arange(CLASSES), key.view(np.int64), [0]])
                counts = np.concatenate([hist[mine].sum(axis=0), n, [n.sum()]]).astype(np.int64)
                yield pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), len(kinds)), pa.array(kinds), pa.array(keys), pa.array(counts)], ["lang", "kind", "key", "n"])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """References of all languages of docs, from all documents."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_learn, "lang string, kind int, key bigint, n bigint").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    top = counts.select("*", F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")).alias("r"))
    got = top.where(F.col("r") <= COMMON).toArrow().to_pylist()
    languages = sorted({r["lang"] for r in got})
    by_language: dict[str, list] = {}
    for r in got:
        by_language.setdefault(r["lang"], []).append(r)
    chars, commons, shares = np.zeros((len(languages), CLASSES)), [], []
    for k, lang in enumerate(languages):
        mine = by_language[lang]
        for r in mine:
            if r["kind"] == 0:
                chars[k, r["key"]] = r["n"]
        chars[k] /= max(1, chars[k].sum())
        total = max(1, sum(r["n"] for r in mine if r["kind"] == 2))
        words = sorted((np.int64(r["key"]).view(np.uint64), r["n"]) for r in mine if r["kind"] == 1)
        commons.append(np.array([w for w, _ in words], U64))
        share = np.array([n / total for _, n in words])
        shares.append(np.append(share, max(0.0, 1 - share.sum())))
    refs = References(languages, chars, commons, shares)
    if languages:
        held = docs.sparkSession.sparkContext.broadcast(refs)
        bins = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_bins(held), "kind int, bin int, n bigint").groupBy("kind", "bin").agg(F.sum("n").alias("n")).toArrow()
        refs.limits = tuple(limit_of(bins.filter(pc.equal(bins["kind"], k))) for k in (0, 1))
    return refs


def excess(counts_chars: np.ndarray, n_words: np.ndarray, char_d: np.ndarray, word_d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both distances less what chance makes; NaN where the guards say that a text is too short."""
    c = np.where(counts_chars >= LEAST_CHARS, char_d - by_chance(CLASSES, counts_chars), np.nan)
    return c, np.where(n_words >= LEAST_WORDS, word_d - by_chance(COMMON + 1, n_words) / 4, np.nan)


def _bins(refs_of):
    """(kind, bin, n) of the excess distances of each text, kind 0 characters, 1 words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 * BINS + 1), np.int64)
        for batch in batches:
            for _, texts in kernels.chunks(batch.column(0)):
                words, lower = kernels.Words(texts), kernels.Words(texts, lower=True)
                char_d, word_d, _ = distances(words, lower, refs_of.value)
                chars = _word_chars(words)
                for k, d in enumerate(excess(chars, words.counts, char_d, word_d)):
                    at = np.round(d[~np.isnan(d)] * BINS).astype(np.int64) + BINS
                    total[k] += np.bincount(np.clip(at, 0, 2 * BINS), minlength=2 * BINS + 1)
        kind, at = np.nonzero(total)
        yield pa.record_batch([pa.array(kind.astype(np.int32)), pa.array((at - BINS).astype(np.int32)), pa.array(total[kind, at])], ["kind", "bin", "n"])

    return run


def _median(values: np.ndarray, n: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    total = np.cumsum(n[order])
    return float(values[order][np.searchsorted(total, (total[-1] + 1) // 2)])


def limit_of(bins: pa.Table) -> float:
    """The limit for distances given by their bins."""
    if not len(bins):
        return 1.0
    values, n = bins["bin"].to_numpy() / BINS, bins["n"].to_numpy()
    middle = _median(values, n)
    return max(LEAST_LIMIT, middle + SPREAD * 1.4826 * _median(np.abs(values - middle), n))


def _judge(refs_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = refs_of.value
        for batch in batches:
            for at, texts in kernels.chunks(batch.column(1)):
                words = kernels.Words(texts)
                counts = base_counts(words)
                char_d, word_d, which = distances(words, kernels.Words(texts, lower=True), refs)
                n = counts["n_words"]
                failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT * n)
                over_c, over_w = excess(counts["word_chars"], n, char_d, word_d)
                odd = (over_c > refs.limits[0]) | (over_w > refs.limits[1])  # NaN is over nothing
                names = [refs.languages[k] if k >= 0 else None for k in which.tolist()]
                columns = [pa.array(np.asarray(counts[c], np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                columns += [pa.array(failed), pa.array(~failed & ~odd), pa.array(names, pa.string()), pa.array(char_d), pa.array(word_d)]
                yield pa.record_batch(
                    [batch.column(0).slice(at, len(texts)), *columns],
                    ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reference", "char_distance", "word_distance"],
                )

    return run


def judge(docs: DataFrame, refs: References, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, kept, the nearest reference and the distances of each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(refs)
    kind = (
        f"id {rows.schema['id'].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, reference string, char_distance double, word_distance double"
    )
    return rows.mapInArrow(_judge(held), kind).withColumnRenamed("id", id_col)
