"""N-gram Jaccard join: documents whose word shingles are similar, and the groups they form.

A document's set holds its distinct five-word shingles (A-Z lower-cased; fewer words: the whole
sequence as one; no words: empty). Two documents link when 100 * |A & B| >= 80 * |A | B|.

1. One pass hashes each text's set to a class; equal sets are one class from here on, so copies
   cost nothing more. The same pass counts frequent shingles by lossy counting.
2. A second pass emits PartEnum signatures (partenum.py) of each class, packed by signature range; ranges are as many as bound their
   size. Classes that share a signature within a task are linked to the least of them there, and that one alone goes on, so a very common
   signature is one entry of each task.
3. Classes that share a signature form candidate edges, their components candidate groups.
4. The sets of those classes alone are gathered by group, in blocks of bounded size that meet pair
   by pair, and every link is decided by exact set sizes. Inside a block pair a class is compared with
   all others by an inverted index, until what is left untested lies in one component.

Result rows are linear in documents: no pairs are emitted. Edge cases: null or blank text has an
empty set, links with nothing and is its own component; repeated rows and repeated ids are rows
of their own; an empty table gives no rows; other columns are ignored. Long texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm import kernels, partenum
from folioframe.llm.graph import components
from folioframe.llm.kernels import U64
from folioframe.llm.shared import bloom_has, bloom_of, give_back, saved, spread_keys, work_dir

WIDTH = 5
#: A shingle is frequent if it is in so many classes of FLUSH shingles; the most frequent MOST_COMMON are broadcast (1.6 MB).
LOCAL_COMMON, MOST_COMMON = 4, 200_000
FLUSH = 300_000
#: Shingles and classes of a block; two blocks meet in one task.
BLOCK_SHINGLES, BLOCK_CLASSES = 1_000_000, 2_000
#: Groups of so many classes at least may be broadcast.
HOT_MEMBERS = 256
#: Groups of several blocks that are broadcast at most (12 MB); more are joined.
MOST_LARGE = 1_000_000
#: Shingles of the texts whose signatures make up a range (about 0.6 signatures each, of 16 bytes).
RANGE_SHINGLES = 4_000_000
#: Signatures of a range that are sorted at a time (36 MB with what that takes).
PIECE = 500_000


def _batches(batches: Iterator[pa.RecordBatch], flush: int = FLUSH) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, shingles, offsets, classes) of about `flush` shingles at a time; whole texts always."""
    held: list[tuple] = []
    n = 0

    def take():
        ids = pa.concat_arrays([x[0] for x in held])
        value = np.concatenate([x[1] for x in held])
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in held]))])
        return ids, value, first, np.concatenate([x[3] for x in held])

    for batch in batches:
        for at, texts in kernels.chunks(batch.column(1)):
            value, first = kernels.shingles(kernels.Words(texts, lower=True), WIDTH)
            held.append((batch.column(0).slice(at, len(texts)), value, first, kernels.set_classes(value, first)))
            n += len(value)
            if n >= flush:
                yield take()
                held, n = [], 0
    if held:
        yield take()
    held.clear()
    give_back()


def _once(value: np.ndarray, first: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sets of the first row of each class; empty sets go."""
    _, at = np.unique(classes, return_index=True)
    at = at[np.diff(first)[at] > 0]
    n = np.diff(first)[at]
    start = np.concatenate([[0], np.cumsum(n)])
    index = np.repeat(first[at] - start[:-1], n) + np.arange(start[-1])
    return value[index], start, classes[at]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, n, class, null) of documents and (null, count, null, shingle) of frequent shingles."""
    for ids, value, first, classes in _batches(batches):
        yield pa.record_batch(
            [ids, pa.array(np.diff(first)), pa.array(classes), pa.nulls(len(ids), pa.int64())], ["id", "n", "class", "shingle"]
        )
        value, _, _ = _once(value, first, classes)
        value.sort()
        edge = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1], [True]])) if len(value) else np.zeros(1, int)
        count = np.diff(edge)
        often = count >= LOCAL_COMMON
        k = int(often.sum())
        if k:
            yield pa.record_batch(
                [pa.nulls(k, ids.type), pa.array(count[often]), pa.nulls(k, pa.int64()), pa.array(value[edge[:-1][often]].view(np.int64))],
                ["id", "n", "class", "shingle"],
            )


def _stars(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct signatures in order, the least class of each, and distinct edges (rows a, b) from each other class there to it."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
    least = np.repeat(cls[start], np.diff(np.append(start, len(sig))))
    at = np.flatnonzero(cls != least)
    edges = np.unique(np.stack([cls[at], least[at]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
    return sig[start], cls[start], edges


def _signature_blobs(common_of, parts: int, keys: np.ndarray):
    """(key of a range, blob): signatures of the range with a class of each, and edges found already, dealt over the same ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = partenum.Common(common_of.value.view(U64))
        for _, value, first, classes in _batches(batches):
            value, first, classes = _once(value, first, classes)
            sig, of = partenum.signatures(value, first, common)
            sig, cls, edges = _stars(sig, classes[of])
            bound = np.array([-(-(p << 64) // parts) for p in range(parts)], U64)
            cut = np.append(np.searchsorted(sig, bound), len(sig))
            range_of = np.searchsorted(bound, edges[:, 0].view(U64), side="right") - 1
            edges = edges[np.argsort(range_of, kind="stable")]
            cut_edges = np.searchsorted(np.sort(range_of), np.arange(parts + 1))
            full = np.flatnonzero((np.diff(cut) > 0) | (np.diff(cut_edges) > 0))
            blobs = [
                np.int64(cut[p + 1] - cut[p]).tobytes() + sig[cut[p] : cut[p + 1]].tobytes() + cls[cut[p] : cut[p + 1]].tobytes() + edges[cut_edges[p] : cut_edges[p + 1]].tobytes()
                for p in full
            ]
            yield pa.record_batch([pa.array(keys[full]), pa.array(blobs, pa.binary())], ["part", "blob"])

    return run


def _bucket_edges(table: pa.Table) -> pa.Table:
    """Edges from each class of a signature to the least one there, for one range of signatures.

    Blobs are read in place, and as each has its signatures in order, the range is sorted piece by piece.
    """
    give_back()
    sigs, of, found = [], [], []
    for blob in (x.as_buffer() for chunk in table["blob"].chunks for x in chunk):
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        sigs.append(np.frombuffer(blob, U64, n, 8))
        of.append(np.frombuffer(blob, np.int64, n, 8 + 8 * n))
        found.append(np.frombuffer(blob, np.int64, -1, 8 + 16 * n).reshape(-1, 2))
    full = [s for s in sigs if len(s)]
    low, end = (min(int(s[0]) for s in full), max(int(s[-1]) for s in full) + 1) if full else (0, 1)
    pieces = -(-sum(map(len, full)) // PIECE)
    inner = np.array([low + (end - low) * k // pieces for k in range(1, pieces)], U64)
    cuts = [[0, *np.searchsorted(s, inner).tolist(), len(s)] for s in sigs]
    for k in range(pieces):
        sig, cls = (np.concatenate([x[c[k] : c[k + 1]] for x, c in zip(xs, cuts, strict=True)]) for xs in (sigs, of))
        found.append(_stars(sig, cls)[2])
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _sets(bloom_ref):
    """(class, set) of each class that the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = bloom_ref.value
        for _, value, first, classes in _batches(batches):
            value, first, classes = _once(value, first, classes)
            at = np.flatnonzero(bloom_has(bloom, classes))
            sets = [value[first[i] : first[i + 1]].tobytes() for i in at]
            yield pa.record_batch([pa.array(classes[at]), pa.array(sets, pa.binary())], ["class", "set"])

    return run


def link_sets(sets: list[np.ndarray]) -> np.ndarray:
    """A component number for each of some sets of distinct uint64, under the link rule.

    Every pair is decided: sets are compared with all others, one set at a time, until those not yet
    compared all lie in one component.
    """
    n = len(sets)
    label = np.arange(n)
    size = np.array([len(s) for s in sets])
    if n < 2 or not size.sum():
        return label
    first = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(n), size)
    _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    postings, edge = owner[order], np.concatenate([[0], np.cumsum(np.bincount(inverse))])
    waiting = np.ones(n, bool)
    while True:
        left = np.bincount(label[waiting], minlength=n)
        some = np.flatnonzero(left)
        if len(some) < 2:
            return label
        x = int(np.flatnonzero(waiting & (label == some[np.argmin(left[some])]))[0])
        waiting[x] = False
        mine = inverse[first[x] : first[x + 1]]
        span = edge[mine + 1] - edge[mine]
        index = np.repeat(edge[mine] - np.concatenate([[0], np.cumsum(span)[:-1]]), span) + np.arange(span.sum())
        both = np.bincount(postings[index], minlength=n)
        linked = np.flatnonzero((both > 0) & (100 * both >= 80 * (size + size[x] - both)))
        others = np.unique(label[linked])
        if len(others) > 1 or (len(others) and others[0] != label[x]):
            others = np.append(others, label[x])
            label[np.isin(label, others)] = others.min()


def _verify(key: tuple, table: pa.Table) -> pa.Table:
    classes = table["class"].to_numpy()
    label = link_sets([np.frombuffer(x, U64) for x in table["set"].to_pylist()])
    least: dict[int, int] = {}
    for c, g in zip(classes.tolist(), label.tolist(), strict=True):
        least[g] = min(c, least.get(g, c))
    to = np.array([least[g] for g in label.tolist()], np.int64)
    at = classes != to
    one = key[1].as_py() == 0 and key[2].as_py() == 0
    return pa.table({"a": classes[at], "b": to[at], "final": pa.array([one] * int(at.sum()), pa.bool_())})


def _hot(roots: DataFrame) -> DataFrame:
    """Roots with more than a ten-thousandth of all members, and HOT_MEMBERS at least: ten thousand rows at most, which are broadcast, so that none is one task's key."""
    hot = max(HOT_MEMBERS, (roots.agg(F.sum("members")).first()[0] or 0) // 10_000)
    return F.broadcast(roots.where(F.col("members") > hot))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class_id, component_id) of each row of docs.

    class_id is shared by rows with equal sets; component_id is the least id that links reach.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "near-dup")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    both = saved(rows.mapInArrow(_describe, f"id {id_type}, n bigint, class bigint, shingle bigint"), f"{path}/described")
    described = both.where("class is not null").select("id", "n", "class")
    common = (
        both.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toArrow()
    )
    common_of = spark.sparkContext.broadcast(common["shingle"].to_numpy())

    shingles = described.agg(F.sum("n")).first()[0] or 0
    parts = max(8, -(-shingles // RANGE_SHINGLES))
    keys = np.array(spread_keys(spark, parts), np.int32)
    blobs = rows.mapInArrow(_signature_blobs(common_of, parts, keys), "part int, blob binary")
    edges = blobs.repartition(parts, "part").groupBy("part").applyInArrow(_bucket_edges, "a bigint, b bigint")
    groups = saved(components(edges, f"{path}/candidates"), f"{path}/groups")

    classes = described.where("n > 0").groupBy("class").agg(F.min("id").alias("least_id"), F.max("n").alias("n"))
    sized = groups.join(classes.select(F.col("class").alias("node"), "n"), "node")
    blocks = F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_CLASSES)).cast("int")
    # Groups of one block are most: only the others are looked up. There is one for each BLOCK_CLASSES classes or BLOCK_SHINGLES shingles at most.
    large = saved(sized.groupBy("root").agg(blocks.alias("blocks")).where("blocks > 1"), f"{path}/large")
    large = F.broadcast(large) if large.count() <= MOST_LARGE else large
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    tasks = (
        groups.join(large, "root", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .select("root", "node", "blocks", mine.alias("m"), other.alias("o"))
        .where("blocks = 1 or m <> o")
        # Where there are several blocks, pairs are numbered from (1, 2): (0, 0) says that a group has one.
        .select(
            "root",
            F.col("node").alias("class"),
            F.when(F.col("blocks") == 1, 0).otherwise(F.least("m", "o") + 1).alias("i"),
            F.when(F.col("blocks") == 1, 0).otherwise(F.greatest("m", "o") + 1).alias("j"),
        )
    )
    bloom_ref = spark.sparkContext.broadcast(bloom_of(groups, "node"))
    sets = rows.mapInArrow(_sets(bloom_ref), "class bigint, set binary").dropDuplicates(["class"])
    links = saved(
        tasks.join(sets, "class").groupBy("root", "i", "j").applyInArrow(_verify, "a bigint, b bigint, final boolean"),
        f"{path}/links",
    )
    done = links.where("final").select(F.col("a").alias("node"), F.col("b").alias("root"))
    done = done.union(done.select(F.col("root").alias("node"), "root").distinct())
    open_links = links.where("not final").select("a", "b")
    if not open_links.isEmpty():
        done = done.union(components(open_links, f"{path}/blocks"))
    done = saved(done, f"{path}/done")
    reached = done.join(classes.select(F.col("class").alias("node"), "least_id"), "node")
    least = saved(reached.groupBy("root").agg(F.min("least_id").alias("component"), F.count("*").alias("members")), f"{path}/least")
    hot = _hot(least)
    met = done.join(hot.select("root", "component"), "root", "left")
    linked = met.where("component is not null").union(met.where("component is null").drop("component").join(least.select("root", "component"), "root").select(met.columns))
    linked = linked.select(F.col("node").alias("class"), "component")
    # A table of its own: the join below then deals both sides for itself alone, and a class with very many copies can be split.
    by_class = saved(
        classes.join(linked, "class", "left").select("class", F.coalesce("component", "least_id").alias("component")), f"{path}/by-class"
    )
    # Rows with an empty set are not looked up, so that they do not meet as one key.
    found = described.where("n > 0").join(by_class, "class").select("id", "n", "class", "component")
    alone = described.where("n = 0").select("id", "n", "class", F.col("id").alias("component"))
    return found.union(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("class").alias("class_id"), F.col("component").alias("component_id")
    )
