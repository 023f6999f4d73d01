"""Toxicity: cumulative-link ordinal regression over sparse word features.

P(grade <= k) = sigmoid(theta_k - w.x): one weight vector shared by ordered thresholds theta. A text's
features are its words (runs of letters, ASCII lower-cased) hashed to BUCKETS, each with the square root
of its share of the text's words, so x has length 1 and w.x follows how dense the text's words are.
Near copies among the training rows count once: else all words of a toxic text copied often would look toxic.

Labels that say only toxic or not are graded first: words much more frequent among toxic
labels than among others are indicators, and toxic rows are cut into mild, moderate and severe by
the terciles of their share of indicator words. Graded labels are taken as they are; one below 0 counts as 0.

A text is toxic if P(grade >= 1) reaches a cut calibrated on the training rows; its grade is 0 otherwise, and else 1 or the highest grade
that is likelier than not to be reached, so that grade and verdict agree.

Training takes at most about MAX_CLEAN and MAX_TOXIC labelled rows and MAX_BYTES of their texts, by a hash of the id, so that the features that
reach the driver are bounded too (a single text longer than that is still taken whole). The model (BUCKETS
floats, 1 MB) is broadcast. Every text is scored whole.

Edge cases: null or wordless text has no features, so it gets the grade of the thresholds alone, and is
never called toxic; without training rows of both kinds every text has grade 0; repeated labels of one id
count once, by the worst; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm import kernels

BUCKETS = 1 << 18
MAX_CLEAN, MAX_TOXIC, MAX_BYTES = 6_000, 4_000, 200_000_000
#: Words in fewer training rows than this are left out of the model.
LEAST_ROWS = 5
#: The model keeps words whose log odds between toxic and other rows lie so many standard errors, and so far, from 0: the weights are sparse.
LEAST_Z, LEAST_ODDS = 3.0, 1.5
GRADES = ("none", "mild", "moderate", "severe")


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of each distinct bucket of each text, and words per text."""
    words = kernels.Words(texts, lower=True, gaps=kernels.NO_LETTER)
    bucket = (words.hashes() >> np.uint64(46)).astype(np.int64)
    key = words.doc * BUCKETS + bucket
    key.sort()
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    key = key[edge[:-1]]
    return key // BUCKETS, key % BUCKETS, np.diff(edge), words.counts


class Model:
    """weights: over BUCKETS; thresholds: ascending, one fewer than grades; least: P(grade >= 1) from which a text is toxic."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, least: float = 0.5):
        self.weights, self.thresholds, self.least = weights.astype(np.float32), thresholds, least
        self.used = self.weights != 0

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= k) for k = 1.. (texts x thresholds), and words of each text."""
        words = kernels.Words(texts, lower=True, gaps=kernels.NO_LETTER)
        bucket = (words.hashes() >> np.uint64(46)).astype(np.int64)
        at = self.used[bucket]
        key = words.doc[at] * BUCKETS + bucket[at]
        key.sort()
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
        key, count = key[edge[:-1]], np.diff(edge)
        row = key // BUCKETS
        s = np.bincount(row, self.weights[key % BUCKETS] * np.sqrt(count / words.counts[row]), minlength=len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - s[:, None], -50, 50))), words.counts


def thinned(row: np.ndarray, bucket: np.ndarray, rows: int) -> np.ndarray:
    """Which rows to keep: the first of those that share their three least rare buckets (by a hash)."""
    support = np.bincount(bucket, minlength=BUCKETS)
    rare = support[bucket] <= max(2, rows // 50)
    r, h = row[rare], kernels.mix(bucket[rare].astype(np.uint64))
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    first = np.searchsorted(r, np.arange(rows + 1))
    keep, seen = np.ones(rows, bool), set()
    for i in range(rows):
        if first[i + 1] - first[i] >= 3:
            key = h[first[i] : first[i] + 3].tobytes()
            keep[i] = key not in seen
            seen.add(key)
    return keep


def grade_labels(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades 0..3 from toxic 0 or 1."""
    ill = np.bincount(bucket[toxic[row] > 0], minlength=BUCKETS)
    well = np.bincount(bucket[toxic[row] == 0], minlength=BUCKETS)
    odds = (ill / max(1, toxic.sum())) / ((well + 0.5) / max(1, (toxic == 0).sum()))
    marks = (ill >= 3) & (odds > 8)
    density = np.bincount(row, count * marks[bucket], minlength=len(words)) / np.maximum(words, 1)
    low, high = np.quantile(density[toxic > 0], [1 / 3, 2 / 3])
    return np.where(toxic > 0, 1 + (density > low) + (density > high), 0)


def fit(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, words: np.ndarray, grade: np.ndarray, steps: int = 400, l2: float = 2e-6) -> Model:
    """Full-batch Adam on the penalised likelihood; deterministic."""
    k = int(grade.max())
    ill = np.bincount(bucket[grade[row] > 0], minlength=BUCKETS) + 0.5
    well = np.bincount(bucket[grade[row] == 0], minlength=BUCKETS) + 0.5
    n_ill, n_well = (grade > 0).sum() + 1, (grade == 0).sum() + 1
    odds = np.log(ill / n_ill) - np.log(well / n_well)
    kept = ((ill + well >= LEAST_ROWS + 1) & (np.abs(odds) >= np.maximum(LEAST_ODDS, LEAST_Z * np.sqrt(1 / ill + 1 / well))))[bucket]
    row, bucket, count = row[kept], bucket[kept], count[kept]
    columns, col = np.unique(bucket, return_inverse=True)
    x = np.sqrt(count / words[row])
    share = np.array([(grade >= j).mean() for j in range(1, k + 1)]).clip(1e-6, 1 - 1e-6)
    theta = np.log((1 - share) / share)
    theta = np.maximum.accumulate(theta + 1e-3 * np.arange(k))
    at = np.concatenate([theta[:1], np.log(np.diff(theta) + 1e-3)])  # thresholds by their gaps, which stay positive
    p = np.concatenate([np.zeros(len(columns)), at])
    m, v, n = np.zeros_like(p), np.zeros_like(p), len(grade)
    weight = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    for t in range(1, steps + 1):
        w, gap = p[: len(columns)], np.exp(p[len(columns) + 1 :])
        theta = np.concatenate([[p[len(columns)]], p[len(columns)] + np.cumsum(gap)])
        s = np.bincount(row, w[col] * x, minlength=n)
        cut = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = cut[grade + 1] - s, cut[grade] - s
        fu, fl = 1 / (1 + np.exp(-np.clip(upper, -40, 40))), 1 / (1 + np.exp(-np.clip(lower, -40, 40)))
        fu[np.isposinf(upper)], fl[np.isneginf(lower)] = 1, 0
        inside = np.maximum(fu - fl, 1e-9)
        du, dl = fu * (1 - fu) / inside * weight, fl * (1 - fl) / inside * weight
        gs = du - dl  # of the negative log likelihood by s
        g_theta = np.array([-du[grade == j].sum() + dl[grade == j + 1].sum() for j in range(k)])
        grad = np.concatenate([np.bincount(col, gs[row] * x, minlength=len(columns)) + l2 * w, [g_theta.sum()], [g_theta[j:].sum() * gap[j - 1] for j in range(1, k)]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p - (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
    weights = np.zeros(BUCKETS)
    weights[columns] = p[: len(columns)]
    gap = np.exp(p[len(columns) + 1 :])
    return Model(weights, np.concatenate([[p[len(columns)]], p[len(columns)] + np.cumsum(gap)]))


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in kernels.chunks(batch.column(1)):
            row, bucket, count, words = features(texts)
            edge = np.searchsorted(row, np.arange(len(texts) + 1))
            spans = list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))
            bucket, count = bucket.astype(np.int32), count.astype(np.int32)
            yield pa.record_batch(
                [
                    batch.column(0).slice(at, len(texts)),
                    batch.column(2).slice(at, len(texts)),
                    pa.array(words.astype(np.int64)),
                    pa.array([bucket[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([count[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                ["toxic", "id", "words", "buckets", "counts"],
            )


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_clean: int = MAX_CLEAN, max_toxic: int = MAX_TOXIC, max_bytes: int = MAX_BYTES) -> Model | None:
    """A model from labels (id, grade): 0 and 1 are graded by indicator words, other grades kept. None without both kinds."""
    rated = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.greatest(F.max(label_col).cast("int"), F.lit(0)).alias("toxic"))
    size = rated.agg(F.count_if(F.col("toxic") > 0).alias("ill"), F.count_if(F.col("toxic") == 0).alias("well")).first()
    if not size["ill"] or not size["well"]:
        return None
    share = F.when(F.col("toxic") > 0, min(1.0, max_toxic / size["ill"])).otherwise(min(1.0, max_clean / size["well"]))
    chosen = rated.where(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 20)) < share * (1 << 20))
    # Ids and lengths alone: how much of them fits max_bytes.
    held = docs.select(F.col(id_col).alias("id"), F.octet_length(text_col).alias("bytes")).join(F.broadcast(chosen), "id").agg(F.sum("bytes")).first()[0] or 0
    if held > max_bytes:
        chosen = chosen.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 20)) < int(max_bytes / held * (1 << 20)))
    # About max_clean + max_toxic rows of 12 bytes: small enough to broadcast whatever the size of labels.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    got = rows.select("toxic", "text", F.col("id").cast("string").alias("id")).mapInArrow(_collect, "toxic int, id string, words bigint, buckets binary, counts binary").toArrow()
    got = got.filter(pc.greater(got["words"], 0)).sort_by("id")  # the fit sums in one order, whatever the tasks' order
    toxic, words = got["toxic"].to_numpy(), got["words"].to_numpy()
    if not len(toxic) or not (toxic > 0).any() or not (toxic == 0).any():
        return None
    parts = [np.frombuffer(x, np.int32) for x in got["buckets"].to_pylist()]
    row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    bucket = np.concatenate(parts).astype(np.int64)
    count = np.concatenate([np.frombuffer(x, np.int32) for x in got["counts"].to_pylist()])
    keep = thinned(row, bucket, len(words))
    number = np.cumsum(keep) - 1
    row, bucket, count = number[row[keep[row]]], bucket[keep[row]], count[keep[row]]
    toxic, words = toxic[keep], words[keep]
    grade = grade_labels(row, bucket, count, words, toxic) if toxic.max() == 1 else toxic
    model = fit(row, bucket, count, words, grade)
    s = np.bincount(row, model.weights[bucket] * np.sqrt(count / words[row]), minlength=len(words))
    p = 1 / (1 + np.exp(np.clip(model.thresholds[0] - s, -50, 50)))
    # A clean text lost counts as much as five toxic ones kept.
    cuts = np.linspace(0.25, 0.6, 36)
    cost = [5 * (p[grade == 0] >= c).mean() + (p[grade > 0] < c).mean() for c in cuts]
    model.least = float(cuts[np.flatnonzero(np.array(cost) <= min(cost) + 1e-12)].mean())
    return model


def scorer(docs: DataFrame, model: Model | None):
    """A function from a text column to struct<grade int, expected double, p_toxic double, toxic boolean>."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("grade", pa.int32()), ("expected", pa.float64()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())])

    @F.arrow_udf("struct<grade: int, expected: double, p_toxic: double, toxic: boolean>")
    def score(texts: pa.Array) -> pa.Array:
        model, out = held.value, []
        for _, part in kernels.chunks(texts):
            if model is None:
                above, words = np.zeros((len(part), 1)), np.zeros(len(part))
            else:
                above, words = model.score(part)
            toxic = (above[:, 0] >= (model.least if model else 2)) & (words > 0)
            grade = np.where(toxic, np.maximum((above >= 0.5).sum(axis=1), 1), 0)
            columns = [grade.astype(np.int32), above.sum(axis=1), above[:, 0].copy(), toxic]
            out.append(pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(kind)))
        return pa.concat_arrays(out) if out else pa.array([], kind)

    return score
