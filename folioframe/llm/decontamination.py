"""Benchmark decontamination: short test items found inside long documents.

The item's containment in a document is the share of its distinct five-word shingles that the whole document
has; THRESHOLD or more is a hit. MinHash estimates Jaccard similarity, which is near 0 between a short
item and a long text, so both sides are partitioned by size:

* items by their number of shingles, in classes of 8 * 2**c + 1 to 16 * 2**c;
* each document into windows of a class's largest size, at every half window, so that the piece of a document
  that holds an item is about as large as the item. The minima of small blocks are computed once and
  merged into those of larger windows.

An item and a window are candidates if any of PERMUTATIONS minima agree: with Jaccard j that fails with
(1 - j) ** PERMUTATIONS. Some window has j >= 0.5 with an item that stands whole (6e-8), and j >= 0.36 with four fifths
of one that stand together (2e-5). Items of 8 shingles or fewer form a class of their own whose windows are single
shingles: all their shingles are indexed, and none is missed. Candidates are verified by
exact containment in the document's whole shingle set, where they are found: there is no shuffle.

Items are broadcast in blocks of about BLOCK_ITEMS items and BLOCK_BYTES of text at most, one pass over the documents for each block; an
item longer than that is a block's only one. Rows of items whose id is null are searched and reported with it.

Edge cases: null or blank texts and items match nothing; an item with fewer than five words is one
shingle, and matches only a document that is the same sequence; repeated rows and ids are rows of their own;
empty tables give no rows; other columns are ignored. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm import kernels
from folioframe.llm.kernels import U64

WIDTH = 5
THRESHOLD = 0.8
PERMUTATIONS = 24
#: Shingles of the smallest block; classes are 1, 2, 4 ... blocks.
BLOCK = 8
CLASSES = 12
BLOCK_ITEMS, BLOCK_BYTES = 100_000, 32_000_000
_MULTIPLIERS = kernels.mix(np.arange(101, 101 + PERMUTATIONS, dtype=U64)) | U64(1)


def _within(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places first[i]:first[i + 1] of each i of at, one after another."""
    n = np.diff(first)[at]
    return np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Items:
    """The minima of some items, by class and permutation, and their shingle sets."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        value, first = kernels.shingles(kernels.Words(texts, lower=True), WIDTH)
        size = np.diff(first)
        self.ids, self.value, self.first, self.size = ids, value, first, size
        tiny = np.flatnonzero((size > 0) & (size <= BLOCK))
        owner = np.repeat(tiny, size[tiny])
        mine = value[_within(first, tiny)]
        order = np.argsort(mine, kind="stable")
        self.tiny, self.tiny_owner = mine[order], owner[order]
        self.tiny_maybe = np.zeros(1 << 16, bool)
        self.tiny_maybe[self.tiny >> U64(8) & U64(0xFFFF)] = True
        full = np.flatnonzero(size > BLOCK)
        cls = np.minimum(np.maximum(np.ceil(np.log2(np.maximum(size, 1) / (2 * BLOCK) + 1e-9)), 0).astype(int), CLASSES - 1)
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for c in sorted(set(cls[full].tolist())):
            mine = full[cls[full] == c]
            held, begin = value[_within(first, mine)], np.cumsum(size[mine]) - size[mine]
            tables = []
            for a in _MULTIPLIERS:
                with np.errstate(over="ignore"):
                    least = np.minimum.reduceat(held * a, begin)
                order = np.argsort(least, kind="stable")
                maybe = np.zeros(1 << 16, bool)
                maybe[least >> U64(8) & U64(0xFFFF)] = True
                tables.append((least[order], mine[order], maybe))
            self.tables[c] = tables

    def candidates(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(document, item) pairs, as document * items + item; grams: of the documents in their order."""
        n_docs = len(first) - 1
        blocks = -(-np.diff(first) // BLOCK)
        start = np.concatenate([[0], np.cumsum(blocks)])
        doc = np.repeat(np.arange(n_docs), blocks)
        at = first[doc] + (np.arange(start[-1]) - start[doc]) * BLOCK
        found = []
        if len(self.tiny):
            hit = np.flatnonzero(self.tiny_maybe[grams >> U64(8) & U64(0xFFFF)])
            low, high = np.searchsorted(self.tiny, grams[hit]), np.searchsorted(self.tiny, grams[hit], "right")
            where = np.searchsorted(first, hit, side="right") - 1
            for d, x, y in zip(where[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
                found.append(d * len(self.size) + self.tiny_owner[x:y])
        if not len(at) or not self.tables:
            return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        last = np.concatenate([doc[1:] != doc[:-1], [True]])
        for p, a in enumerate(_MULTIPLIERS):
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat(grams * a, at)
            owner, ends = doc, last
            for c in range(max(self.tables) + 1):
                if c in self.tables:
                    # A window is two neighbouring blocks of this class's half size.
                    window = least.copy()
                    window[:-1] = np.where(ends[:-1], least[:-1], np.minimum(least[:-1], least[1:]))
                    minima, items, maybe = self.tables[c][p]
                    hit = np.flatnonzero(maybe[window >> U64(8) & U64(0xFFFF)])
                    low, high = np.searchsorted(minima, window[hit]), np.searchsorted(minima, window[hit], "right")
                    for h, x, y in zip(hit[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
                        found.append(owner[h] * len(self.size) + items[x:y])
                if c < max(self.tables):
                    # Blocks of twice the size: pairs from each document's first block on.
                    begin = np.searchsorted(owner, np.arange(n_docs + 1))
                    even = np.flatnonzero((np.arange(len(owner)) - begin[owner]) % 2 == 0)
                    pair = least[even]
                    has = ~ends[even]
                    pair[has] = np.minimum(pair[has], least[even[has] + 1])
                    least, owner = pair, owner[even]
                    ends = np.concatenate([owner[1:] != owner[:-1], [True]])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _document_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts in their order, repeats and all, and offsets."""
    words = kernels.Words(texts, lower=True)
    h = words.hashes()
    grams = kernels.grams(h, WIDTH)
    whole = words.counts >= WIDTH
    per = np.where(whole, words.counts - WIDTH + 1, (words.counts > 0).astype(int))
    first = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros(first[-1], U64)
    n = np.where(whole, per, 0)
    begin = np.concatenate([[0], np.cumsum(n)])
    to = np.repeat(first[:-1] - begin[:-1], n) + np.arange(begin[-1])
    out[to] = grams[np.repeat(words.first[:-1] - begin[:-1], n) + np.arange(begin[-1])]
    for d in np.flatnonzero((words.counts > 0) & ~whole):
        w = h[words.first[d] : words.first[d + 1]]
        out[first[d]] = kernels.grams(w, len(w))[0] ^ U64(len(w))
    return out, first


def _hits(items: Items, texts: pa.Array, threshold: float) -> tuple[list[int], list[int], list[int]]:
    """Rows of texts, items that they contain, and shingles matched."""
    docs, found, matched = [], [], []
    if items.size.any():
        n = len(items.size)
        grams, first = _document_grams(texts)
        pairs = items.candidates(grams, first)
        for d, i in zip((pairs // n).tolist(), (pairs % n).tolist(), strict=True):
            mine = items.value[items.first[i] : items.first[i + 1]]
            both = int(np.isin(mine, grams[first[d] : first[d + 1]]).sum())
            if both >= threshold * len(mine) - 1e-9:
                docs.append(d)
                found.append(i)
                matched.append(both)
    return docs, found, matched


def _search(items_of, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = items_of.value
        for batch in batches:
            for at, texts in kernels.chunks(batch.column(1)):
                docs, found, matched = _hits(items, texts, threshold)
                if not docs:
                    continue
                docs = [at + d for d in docs]
                size = items.size[found] if found else np.zeros(0, np.int64)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(docs, pa.int64())),
                        items.ids.take(pa.array(found, pa.int64())),
                        pa.array(size, pa.int64()),
                        pa.array(matched, pa.int64()),
                        pa.array(np.array(matched, float) / np.maximum(size, 1)),
                    ],
                    ["doc", "item", "n_shingles", "n_matched", "containment"],
                )

    return run


def _blocks(items: DataFrame, item_id_col: str, item_text_col: str, block_items: int, block_bytes: int) -> Iterator[Items]:
    tests = items.select(F.col(item_id_col).alias("id"), F.col(item_text_col).cast("string").alias("text"))
    size = tests.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-(size["bytes"] or 0) // block_bytes))
    for k in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).toArrow()
        yield Items(part["id"].combine_chunks(), part["text"].combine_chunks().cast(pa.large_string()))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc id, item id, n_shingles of the item, n_matched, containment) of each hit."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type, item_type = rows.schema["id"].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    kind = f"doc {id_type}, item {item_type}, n_shingles bigint, n_matched bigint, containment double"
    out = None
    for block in _blocks(items, item_id_col, item_text_col, block_items, block_bytes):
        hits = rows.mapInArrow(_search(spark.sparkContext.broadcast(block), threshold), kind)
        out = hits if out is None else out.union(hits)
    return out.withColumnsRenamed({"doc": id_col, "item": item_id_col})


def without_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of docs that contain no item. Each row is decided by its own text where it is read, so nothing is joined or shuffled."""
    for block in _blocks(items, item_id_col, item_text_col, block_items, block_bytes):
        docs = docs.where(~_contains(docs.sparkSession.sparkContext.broadcast(block), threshold)(F.col(text_col).cast("string")))
    return docs


def _contains(items_of, threshold: float):
    @F.arrow_udf("boolean")
    def contains(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), bool)
        for at, part in kernels.chunks(texts):
            out[[at + d for d in _hits(items_of.value, part, threshold)[0]]] = True
        return pa.array(out)

    return contains
