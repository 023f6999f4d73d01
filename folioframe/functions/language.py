"""N-gram profiles: the most frequent character n-grams of each category, and the nearest profile of a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words whose n-grams a task counts at a time, and n-grams of distinct words of texts: whole texts, so a long one may have more.
CHUNK_WORDS, CHUNK_GRAMS = 200_000, 1_000_000
LONGEST = 5


def _of_length(words: Column, n: int) -> Column:
    """The n-grams of each word; a word's own lambda takes one argument, as a second one would be bound to its index."""
    starts = lambda w: F.when(F.length(w) >= n, F.sequence(F.lit(1), F.length(w) - n + 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.flatten(F.transform(words, lambda w: F.transform(starts(w), lambda i: F.substr(w, i, F.lit(n)))))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1)


def ngrams(text: Column, longest: int = LONGEST) -> Column:
    """All n-grams of one to `longest` characters of the lower-cased words, each word between underscores; a lone underscore is none."""
    return _of_words(_words(text), longest)


def _of_words(words: Column, longest: int = LONGEST) -> Column:
    padded = F.transform(words, lambda w: F.concat(F.lit("_"), w, F.lit("_")))
    return F.filter(F.concat(*(_of_length(padded, n) for n in range(1, longest + 1))), lambda g: g != "_")


def ngram_counts(rows: DataFrame, category: str, text: str, most: int = 400) -> DataFrame:
    """(category, ngram, n, place): the `most` frequent n-grams of each category, ties in the n-grams' order. Words are counted first."""
    words = rows.select(category, F.explode(_words(F.col(text))).alias("__w")).groupBy(category, "__w").agg(F.count("*").alias("__n"))
    counts = words.select(category, "__n", F.explode(_of_words(F.array("__w"))).alias("ngram")).groupBy(category, "ngram").agg(F.sum("__n").alias("n"))
    order = Window.partitionBy(category).orderBy(F.desc("n"), "ngram")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def profiles(rows: DataFrame, category: str, text: str, most: int = 400) -> DataFrame:
    """(category, ngram, weight): the `most` frequent n-grams of each category, weights scaled to length 1."""
    top = ngram_counts(rows, category, text, most)
    norm = F.sqrt(F.sum(F.col("n").cast("double") * F.col("n")).over(Window.partitionBy(category)))
    return top.select(category, "ngram", (F.col("n") / norm).alias("weight"))


def classify(rows: DataFrame, model: DataFrame, key: str, text: str, category: str) -> DataFrame:
    """(key, category, score): the profile with the largest cosine; n-grams are counted per text before they meet the profiles,
    whose size is bounded by categories times `most`."""
    counts = rows.select(key, F.explode(ngrams(F.col(text))).alias("ngram")).groupBy(key, "ngram").agg(F.count("*").alias("n"))
    scored = counts.join(model, "ngram").groupBy(key, category).agg(F.sum(F.col("n") * F.col("weight")).alias("dot"))
    norms = counts.groupBy(key).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    best = scored.groupBy(key).agg(F.max_by(F.struct(category, "dot"), F.struct("dot", category)).alias("b"))
    return best.join(norms, key).select(key, F.col(f"b.{category}").alias(category), (F.col("b.dot") / F.col("norm")).alias("score"))


def _word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(number of n-gram, first n-gram of each word, n-grams by number) of all n-grams of the words, in the words' order."""
    padded = [f"_{w}_" for w in words]
    code = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    word, left = np.repeat(np.arange(len(size)), size), np.repeat(np.cumsum(size), size) - np.arange(len(code))
    whole, numbers, owners, names, made = "".join(padded), [], [], [], 0
    before = np.zeros(len(code), np.int64)
    for n in range(1, LONGEST + 1):
        at = np.flatnonzero(left >= n)
        key = (before[at] << 21) | code[at + n - 1]
        _, first, rank = np.unique(key, return_index=True, return_inverse=True)
        before[at] = rank
        kept = np.ones(len(at), bool) if n > 1 else code[at] != ord("_")
        numbers.append(rank[kept] + made)
        owners.append(word[at[kept]])
        names += [whole[i : i + n] for i in at[first].tolist()]
        made += len(first)
    number, owner = np.concatenate(numbers), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return number[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]), names


def _spans(first: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of the rows `of`, one row behind the other, and how many each has."""
    n = np.diff(first)[of]
    return np.repeat(first[of] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def _cosines(words: pa.Array, first: np.ndarray, postings: dict[str, list[tuple[int, float]]], categories: int) -> tuple[np.ndarray, np.ndarray]:
    """(dot with each category, norm) of texts, given their words one behind the other and the place of each text's first."""
    coded = words.dictionary_encode()
    number, start, gram_names = _word_grams(coded.dictionary.to_pylist())
    v = len(coded.dictionary)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key, n = np.unique(text * v + coded.indices.to_numpy(), return_counts=True)
    text, word = key // v, key % v
    owner = np.repeat(np.arange(v), np.diff(start))
    dots = np.zeros((len(first) - 1, categories))
    weights = np.zeros((categories, len(gram_names)))
    for k, g in enumerate(gram_names):
        for c, w in postings.get(g, ()):
            weights[c, k] += w
    for c in np.flatnonzero(weights.any(axis=1)).tolist():
        of_word = np.bincount(owner, weights[c][number], minlength=v)
        dots[:, c] = np.bincount(text, n * of_word[word], minlength=len(first) - 1)
    squares = np.zeros(len(first) - 1)
    edge = np.searchsorted(text, np.arange(len(first)))
    grams = np.concatenate([[0], np.cumsum(np.diff(start)[word])])[edge]
    a = 0
    while a < len(first) - 1:
        b = max(a + 1, int(np.searchsorted(grams, grams[a] + CHUNK_GRAMS, side="right")) - 1)
        some = slice(edge[a], edge[b])
        at, size = _spans(start, word[some])
        # n-gram and count in one number, as sorting that is faster than sorting places; both fit, as texts and n-grams of a chunk are few.
        bits = int(n[some].max(initial=1)).bit_length()
        packed = np.sort(((np.repeat(text[some] - a, size) * len(gram_names) + number[at]) << bits) | np.repeat(n[some], size))
        key, count = packed >> bits, packed & ((1 << bits) - 1)
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.add.reduceat(count, new).astype(float) if len(key) else np.zeros(0)
        squares[a:b] = np.bincount(key[new] // len(gram_names), count * count, minlength=b - a)
        a = b
    return dots, np.sqrt(squares)


def _scored(model: list[tuple[str, str, float]], names: list, cutoff: float):
    place = {c: i for i, c in enumerate(names)}
    postings: dict[str, list[tuple[int, float]]] = {}
    for c, g, w in model:
        postings.setdefault(g, []).append((place[c], w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            words, ends = lists.flatten(), np.concatenate([[0], np.cumsum(size)])
            a = 0
            while a < len(size):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK_WORDS, side="right")) - 1)
                if ends[b] > ends[a]:
                    dots, norm = _cosines(words.slice(ends[a], ends[b] - ends[a]), ends[a : b + 1] - ends[a], postings, len(names))
                    cosine = dots / np.where(norm > 0, norm, 1)[:, None]
                    high = cosine.max(axis=1)[:, None]
                    row, c = np.nonzero(((cosine == high) | (cosine >= cutoff * high)) & (norm > 0)[:, None])
                    yield pa.record_batch([batch.column(0).take(pa.array(a + row)), pa.array(c.astype(np.int32)), pa.array(cosine[row, c])], ["key", "place", "score"])
                a = b

    return run


def candidates(rows: DataFrame, model: DataFrame, key: str, text: str, category: str, cutoff: float = 1.0) -> DataFrame:
    """(key, category, score): the profile with the largest cosine and all whose cosine is at least `cutoff` times that.

    A profile that shares no n-gram with the text scores 0; a text without n-grams has no rows, nor has one without a key. Texts are scored where
    they are read: a text's n-grams are counted from its distinct words, in chunks of whole texts, and nothing of them is shuffled.
    """
    spark = rows.sparkSession
    weights = [tuple(r) for r in model.select(category, "ngram", "weight").collect()]
    names = sorted({w[0] for w in weights})
    kind = rows.schema[key].dataType.simpleString()
    if not names:
        return rows.select(key, F.lit(None).cast(model.schema[category].dataType).alias(category), F.lit(0.0).alias("score")).limit(0)
    # Texts of one key count as one: those few are put together first, the others never leave their task.
    several = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col(key).isNotNull() & (F.col("__n") > 1)).select(key)
    words = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), _words(F.col(text)).alias("words"))
    if not several.isEmpty():
        same = words["key"] == several[key]
        merged = words.join(several, same, "left_semi").groupBy("key").agg(F.flatten(F.collect_list("words")).alias("words"))
        words = words.join(several, same, "left_anti").union(merged)
    got = words.mapInArrow(_scored(weights, names, cutoff), f"key {kind}, place int, score double")
    places = spark.createDataFrame(list(enumerate(names)), f"place int, name {model.schema[category].dataType.simpleString()}")
    return got.join(F.broadcast(places), "place").select(F.col("key").alias(key), F.col("name").alias(category), "score")
