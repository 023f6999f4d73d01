"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and each run of characters that are not letters becomes one gap; its features
are the n-grams of one to three of the resulting symbols, hashed to BUCKETS. The matrix of
log-probabilities (languages x BUCKETS) is broadcast: 256 KB a language, in blocks of up to BLOCK_LANGUAGES, so 64 MB at a time. A
batch is scored by gathering matrix columns and summing them by text. With more languages than a block holds there is a pass for each
block, which carries the best language, its score and the sum of all so far; between passes the rows are written as a table.

Training takes about PER_LANGUAGE documents of each language, by a hash of the id: a bound that
does not grow with the corpus. Scoring reads every text whole.

Edge cases: null, empty or letterless text gives `und` and score 0, as does a model without
training rows; ties go to the language that sorts first; repeated rows are predicted each; empty
tables give no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm import kernels
from folioframe.llm.shared import give_back, saved, work_dir
from folioframe.llm.kernels import U64

BUCKETS = 1 << 16
ORDERS = 3
PER_LANGUAGE = 4_000
BLOCK_LANGUAGES = 256
BROADCAST_LANGUAGES = 100_000
ALPHA = 0.1
UNKNOWN = "und"
#: Code points that are letters, made at first use in each process.
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of the texts, offsets of each text's, and whether each has a letter."""
    data, offsets = kernels.raw(texts)
    body = data.tobytes()
    parts = [body[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    code = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
    is_letter = _letters()[code]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of a run of other characters stands for the run
    code = np.where(is_letter, code, 0)[keep]
    count = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(is_letter)])
    return code, count[first], letters[first[1:]] > letters[first[:-1]]


def buckets(code: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the bucket of the n-gram that ends at each symbol; gaps stand before a text's first, whatever text comes before it."""
    wide = np.concatenate([np.zeros(ORDERS, np.uint32), code]).astype(U64)
    n = len(code)
    with np.errstate(over="ignore"):
        h = np.zeros(n, U64)
        for k in range(ORDERS):
            back = wide[ORDERS - k : ORDERS - k + n].copy()
            for j in range(k):
                at = first[:-1] + j
                back[at[at < first[1:]]] = 0
            h = h * kernels.BASE + back + U64(k + 1)
            yield (((h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9)) >> U64(48)).astype(np.int32)


class Model:
    """Languages in order; log-probabilities of buckets for each, and of the languages."""

    def __init__(self, languages: list[str], log_prob: np.ndarray, prior: np.ndarray):
        self.languages, self.log_prob, self.prior = languages, log_prob, prior

    def totals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods (languages x texts), and whether each text has a letter."""
        code, first, known = symbols(texts)
        total = np.repeat(self.prior[:, None], len(texts), axis=1)
        for bucket in buckets(code, first):
            for k in range(len(self.languages)):
                total[k] += kernels.sums(self.log_prob[k][bucket], first)
        return total, known

    def predict(self, texts: pa.Array, before: pa.StructArray | None = None) -> pa.StructArray:
        """(lang, best, mass) of each text: the likeliest language so far, its log-likelihood, and the sum of all as a multiple of it."""
        n = len(texts)
        if self.languages:
            total, known = self.totals(texts)
            at = np.argmax(total, axis=0)
            best = total[at, np.arange(n)]
            mass = np.exp(total - best).sum(axis=0)
            names = np.array([*self.languages, UNKNOWN], object)[np.where(known, at, len(self.languages))]
        else:
            best, mass, names = np.zeros(n), np.full(n, np.inf), np.full(n, UNKNOWN, object)
        if before is not None:
            old, old_mass = (before.field(c).to_numpy(zero_copy_only=False) for c in ("best", "mass"))
            names = np.where(best > old, names, np.array(before.field("lang").to_pylist(), object))
            top = np.maximum(best, old)
            best, mass = top, mass * np.exp(best - top) + old_mass * np.exp(old - top)
        return pa.StructArray.from_arrays([pa.array(names.tolist(), pa.string()), pa.array(best), pa.array(mass)], fields=list(_STATE))


_STATE = pa.struct([("lang", pa.string()), ("best", pa.float64()), ("mass", pa.float64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}


    def out() -> Iterator[pa.RecordBatch]:
        for x, got in counts.items():
            at = np.flatnonzero(got)
            yield pa.record_batch([pa.array([x] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(got[at])], ["lang", "bucket", "n"])
        counts.clear()

    for batch in batches:
        for at, texts in kernels.chunks(batch.column(1)):
            if len(counts) > BLOCK_LANGUAGES:
                yield from out()
            langs = batch.column(0).slice(at, len(texts)).to_pylist()
            code, first, _ = symbols(texts)
            name = {x: i for i, x in enumerate(sorted(set(langs)))}
            lang = np.repeat([name[x] for x in langs], np.diff(first))
            for bucket in buckets(code, first):
                key, n = np.unique(lang * BUCKETS + bucket, return_counts=True)
                edge = np.searchsorted(key, np.arange(len(name) + 1) * BUCKETS)
                for x, i in name.items():
                    if x not in counts:
                        counts[x] = np.zeros(BUCKETS, np.int64)
                    counts[x][key[edge[i] : edge[i + 1]] - i * BUCKETS] += n[edge[i] : edge[i + 1]]
    yield from out()
    give_back()


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, block_languages: int = BLOCK_LANGUAGES
) -> list[Model]:
    """Fit on rows of docs with a language and a text: all of them up to about per_language a language. A model for each block of languages, one at least."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    size = {r["lang"]: r["size"] for r in sizes.collect()}  # a name and a number for each language
    if not size:
        return [Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))]
    languages, every = sorted(size), sum(size.values())
    place = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 20))
    shares = docs.sparkSession.createDataFrame([(x, min(1.0, per_language / n) * (1 << 20)) for x, n in size.items()], "lang string, share double")
    # A name and a number a language: broadcast up to BROADCAST_LANGUAGES of them. Only rows that the largest share would take are asked.
    shares = F.broadcast(shares) if len(size) <= BROADCAST_LANGUAGES else shares
    chosen = rows.where(place < min(1.0, per_language / min(size.values())) * (1 << 20)).join(shares, "lang").where(place < F.col("share"))
    counted = chosen.select("lang", "text").mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    blocks = [languages[k : k + block_languages] for k in range(0, len(languages), block_languages)]
    if len(blocks) > 1:
        counted = saved(counted, work_dir(docs.sparkSession, "languages"))
    models = []
    for block in blocks:
        mine = counted.where(F.col("lang").between(block[0], block[-1])).toArrow()
        matrix = np.full((len(block), BUCKETS), ALPHA)
        row = {x: i for i, x in enumerate(block)}
        np.add.at(matrix, ([row[x] for x in mine["lang"].to_pylist()], mine["bucket"].to_numpy()), mine["n"].to_numpy())
        log_prob = np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)
        models.append(Model(block, log_prob, np.log(np.array([size[x] for x in block]) / every)))
    return models


def predict(docs: DataFrame, models: list[Model], text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the likeliest language of each row and its probability (0 if the language is unknown)."""
    spark, state = docs.sparkSession, "__language_state"
    path = work_dir(spark, "language") if len(models) > 1 else ""
    for k, model in enumerate(models):
        docs = docs.withColumn(state, _pass(spark, model, k > 0)(text_col, *([state] if k else [])))
        if k + 1 < len(models):
            docs = saved(docs, f"{path}/{k}")
    s = F.col(state)
    probability = F.when(s["lang"] == UNKNOWN, 0.0).otherwise(1 / s["mass"])
    return docs.withColumns({lang: s["lang"], score: probability}).drop(state)


def _pass(spark, model: Model, chained: bool):
    held = spark.sparkContext.broadcast(model)

    def run(texts: pa.Array, before: pa.Array | None) -> pa.Array:
        out = [held.value.predict(part, None if before is None else before.slice(at, len(part))) for at, part in kernels.chunks(texts)]
        return pa.concat_arrays(out) if out else pa.array([], _STATE)

    if chained:

        @F.arrow_udf("struct<lang: string, best: double, mass: double>")
        def later(texts: pa.Array, before: pa.Array) -> pa.Array:
            return run(texts, before)

        return later

    @F.arrow_udf("struct<lang: string, best: double, mass: double>")
    def first(texts: pa.Array) -> pa.Array:
        return run(texts, None)

    return first


def held_out(id_col: Column, modulus: int) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % modulus == 0
