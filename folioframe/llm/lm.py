"""LM scoring: a trigram model in an Elias-Fano trie of memory-mapped levels.

The model is learnt from all training documents; no n-gram is left out. Words are A-Z lower-cased, END closes each text.

* Unigrams: p(w) = (c + 0.1) / (N + 0.1 (V + 1)), c exact for every word.
* Bigrams and trigrams: p(w|h) = (c(hw) - D(c(hw))) / C(h) + lambda(h) p(w|h'), where h' is h without its first word, C(h) the count
  of h before any word, and D the discount of an n-gram seen once, twice or more often (DISCOUNTS). lambda(h) is the mass that the
  discounts free, so each context's probabilities sum to one; a context never seen has lambda 1.

Trie. A word's id is its place in the order of hashes; an n-gram's place is its rank among all of its length:

* level 1: word hashes as an Elias-Fano sequence and cumulative counts as another;
* level 2: parent id * V + child id, with log10 probabilities and each parent's log10 lambda;
* level 3: parent bigram's place * R + the child's place among the successors of the parent's last word (context-relative, R
  their most), likewise. Logarithms are quantised to 16 bits (steps of 1/4096).

Levels are cut into shards of about SHARD_TOKENS training tokens whatever the size of the corpus: level 1 by hash, the others by ranges of
keys whose bounds follow the counts of the level below. A parent with more tokens than a shard holds has its successors cut into several
shards; what a context needs of its other shards (its count and how many successors it has) is added up for those contexts alone.
Counts are summed in each task by flushes of FLUSH tokens before they are shuffled, as differences of sorted keys. Each shard is made by one task and written as files in
the shared folder; workers map the files, so the model costs them page cache and not memory, and the driver sees only sizes and
bounds. Where the shared folder isn't a local path, a worker copies a file to an unlinked temporary one and maps that.

Edge cases: null or blank text is END alone; without training rows N and V are 0 and every token has probability one, the
only one there is; repeated rows teach and are scored each; empty tables give no rows; other columns are ignored; long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm import kernels
from folioframe.llm.elias_fano import EliasFano
from folioframe.llm.files import map_arrays, write_arrays
from folioframe.llm.kernels import U64
from folioframe.llm.shared import remove, spread_keys, work_dir

END_HASH = U64(0x9D39247E33776D41)
ALPHA = 0.1
#: What is taken off the count of a bigram and of a trigram seen once, twice, and more often.
DISCOUNTS = {2: (0.8, 1.0, 1.2), 3: (0.95, 1.0, 1.2)}
STEP = 4096.0
#: Tokens that a task counts before it emits, training tokens of a shard, and tokens scored at a time.
FLUSH, SHARD_TOKENS, SCORED = 1_600_000, 3_000_000, 500_000

# The trie.


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)


def _quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log10 * STEP), 0, 65535).astype(np.uint16)


def _each(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs and the places where it does."""
    if not len(shard):
        return
    order = np.arange(len(shard)) if (shard[1:] >= shard[:-1]).all() else np.argsort(shard.astype(np.uint16) if shard.max() < 1 << 16 else shard, kind="stable")
    ordered = shard[order]
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        yield int(ordered[a]), order[a:b]


class Level:
    """Keys of n-grams of one length in shards: bounds[s] <= keys of shard s < bounds[s + 1], width: what a parent's number is multiplied by."""

    def __init__(self, number: int, width: int, bounds: np.ndarray, top: int):
        self.number, self.width, self.top = number, width, top
        self.bounds = np.unique(np.concatenate([np.zeros(1, U64), bounds.astype(U64)]))
        self.sizes = np.zeros(len(self.bounds), np.int64)
        self.widest = 1

    @property
    def shards(self) -> int:
        return len(self.bounds)

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, keys, side="right") - 1

    def end(self, s: int) -> int:
        return int(self.bounds[s + 1]) if s + 1 < self.shards else self.top

    def low_parent(self, s: int) -> int:
        return int(self.bounds[s]) // self.width

    def parents(self, s: int) -> int:
        """How many parents' keys may lie in shard s."""
        return (max(self.end(s), 1) - 1) // self.width - self.low_parent(s) + 1


class Trie:
    """All shards of a model; levels that are not made yet are absent. words, tokens: V and N."""

    def __init__(self, path: str, shards: int, shard_tokens: int, flush: int):
        self.path, self.shards, self.shard_tokens, self.flush = path, shards, shard_tokens, flush
        self.sizes, self.tokens = np.zeros(shards, np.int64), 0
        self.levels: dict[int, Level] = {}
        self.maps: dict[tuple[str, int], list] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"maps": {}}

    @property
    def words(self) -> int:
        return int(self.sizes.sum())

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)

    def part(self, name: str, shard: int) -> list:
        """Sequences and arrays of one file."""
        if (name, shard) not in self.maps:
            self.maps[name, shard] = [EliasFano.from_arrays(g) if len(g) == 4 else g[0] for g in map_arrays(f"{self.path}/{name}/{shard}")]
        return self.maps[name, shard]

    def put(self, name: str, shard: int, groups: list[list[np.ndarray]]) -> None:
        write_arrays(f"{self.path}/{name}/{shard}", groups)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of word hashes."""
        ids, counts, first = np.full(len(h), -1), np.zeros(len(h), np.int64), self.first
        for s, at in _each(shard_of(h, self.shards)):
            if self.sizes[s]:
                hashes, cumulative = self.part("words", s)
                low = -(-(s << 32) // self.shards) << 32
                place, equal = hashes.successor(h[at] - U64(low))
                at, place = at[equal], place[equal]
                ids[at] = first[s] + place
                counts[at] = (cumulative.access(place + 1) - cumulative.access(place)).astype(np.int64)
        return ids, counts

    def counts(self, ids: np.ndarray) -> np.ndarray:
        out, first = np.zeros(len(ids), np.int64), self.first
        for s, at in _each(np.searchsorted(first, ids, side="right") - 1):
            place = ids[at] - first[s]
            cumulative = self.part("words", s)[1]
            out[at] = (cumulative.access(place + 1) - cumulative.access(place)).astype(np.int64)
        return out

    def log_unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ALPHA) / (self.tokens + ALPHA * (self.words + 1)))

    def find(self, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first n-gram of level k whose key is not less, and whether it is equal."""
        level = self.levels[k]
        place, found, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool), level.first
        for s, at in _each(level.shard_of(keys)):
            place[at] = first[s]
            if level.sizes[s]:
                got, equal = self.part(f"keys{k}", s)[0].successor(keys[at] - level.bounds[s])
                place[at] += got
                found[at] = equal
        return place, found

    def log_p(self, k: int, place: np.ndarray) -> np.ndarray:
        """log10 p of the n-grams of level k at these places."""
        out, first = np.zeros(len(place)), self.levels[k].first
        for s, at in _each(np.searchsorted(first, place, side="right") - 1):
            out[at] = self.part(f"probs{k}", s)[0][place[at] - first[s]] / -STEP
        return out

    def log_lambda(self, k: int, parents: np.ndarray) -> np.ndarray:
        """log10 of the mass that the successors of these parents, by n-grams of level k, leave."""
        level, out = self.levels[k], np.zeros(len(parents))
        for s, at in _each(level.shard_of(parents.astype(U64) * U64(level.width))):
            out[at] = self.part(f"probs{k}", s)[1][parents[at] - level.low_parent(s)] / -STEP
        return out

    def starts(self, words: np.ndarray) -> np.ndarray:
        """The place of the first bigram of each word."""
        return self.find(2, words.astype(U64) * U64(self.words))[0]

    def bigram_keys(self, begin: int, end: int) -> np.ndarray:
        """The keys of the bigrams at a range of places."""
        level, first, out = self.levels[2], self.levels[2].first, [np.zeros(0, U64)]
        for s in range(level.shards):
            a, b = max(begin, int(first[s])), min(end, int(first[s + 1]))
            if a < b:
                keys = self.part("keys2", s)[0]
                got = keys.access(np.arange(a - first[s], b - first[s])) if b - a < keys.n // 8 else keys.decoded()[a - first[s] : b - first[s]]
                out.append(got + level.bounds[s])
        return np.concatenate(out)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts with END after each, and len+1 offsets."""
    words = kernels.Words(texts, lower=True)
    n = len(words.counts)
    first = words.first + np.arange(n + 1)
    out = np.full(first[-1], END_HASH, U64)
    out[np.arange(len(words.doc)) + words.doc] = words.hashes()
    return out, first


def _flushed(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[tuple[list[tuple[pa.RecordBatch, int, int]], np.ndarray, np.ndarray]]:
    """About `limit` tokens at a time: the rows they are of (batch, first row, rows), hashes, offsets. Whole texts always."""
    held, hashes, counts, n = [], [], [], 0

    def take():
        return held, np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))])

    for batch in batches:
        for at, texts in kernels.chunks(batch.column(column)):
            h, first = token_hashes(texts)
            held.append((batch, at, len(texts)))
            hashes.append(h)
            counts.append(np.diff(first))
            n += len(h)
            if n >= limit:
                yield take()
                held, hashes, counts, n = [], [], [], 0
    if held:
        yield take()


def packed(key: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted distinct keys and their counts: differences in as many bytes as the largest needs, counts in one with exceptions behind."""
    gap = np.diff(key, prepend=key[:1])
    width = max(1, (int(gap.max()).bit_length() + 7) // 8)
    much = np.flatnonzero(count >= 255)
    head = np.array([len(key), width, int(key[0]), len(much)], U64)
    small = np.minimum(count, 255).astype(np.uint8)
    return head.tobytes() + gap.view(np.uint8).reshape(-1, 8)[:, :width].tobytes() + small.tobytes() + much.astype(np.int64).tobytes() + count[much].astype(np.int64).tobytes()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, low, much = (int(x) for x in np.frombuffer(blob, U64, 4))
    gap = np.zeros((n, 8), np.uint8)
    gap[:, :width] = np.frombuffer(blob, np.uint8, n * width, 32).reshape(n, width)
    key = np.cumsum(gap.reshape(-1).view(U64), dtype=U64) + U64(low)
    at = 32 + n * width
    count = np.frombuffer(blob, np.uint8, n, at).astype(np.int64)
    if much:
        where = np.frombuffer(blob[at + n :], np.int64, 2 * much)
        count[where[:much]] = where[much:]
    return key, count


def _blobs(key: np.ndarray, shard_of_key) -> pa.RecordBatch:
    """Counts of the keys, as a blob for each shard; shards must rise with keys."""
    key = np.sort(key)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    key, count = key[edge[:-1]], np.diff(edge)
    spans = list(_each(shard_of_key(key)))
    blobs = [packed(key[at[0] : at[-1] + 1], count[at[0] : at[-1] + 1]) for _, at in spans]
    return pa.record_batch([pa.array([s for s, _ in spans], pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    got = [unpacked(b) for b in table["blob"].to_pylist()]
    key, count = np.concatenate([k for k, _ in got]), np.concatenate([c for _, c in got])
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[start], np.add.reduceat(count, start)


def _tiles(count: np.ndarray, limit: int) -> tuple[list[int], list[int], list[int]]:
    """Places at which a shard of the next level begins, and those of parents with more than a shard's tokens, with the pieces they need."""
    tile = (np.cumsum(count) - count) // limit
    cuts = np.flatnonzero(tile[1:] != tile[:-1]) + 1
    heavy = np.flatnonzero(count > limit)
    return cuts.tolist(), heavy.tolist(), (-(-count[heavy] // limit)).tolist()


_MADE = "shard int, n bigint, total bigint, widest bigint, cuts array<bigint>, heavy array<bigint>, pieces array<bigint>, edges array<array<bigint>>"


def _made(shard: int, n: int, total: int, widest: int, tiles: tuple, edges: list[list[int]]) -> pa.Table:
    numbers = pa.list_(pa.int64())
    columns = [pa.array([shard], pa.int32()), *(pa.array([x], pa.int64()) for x in (n, total, widest)), *(pa.array([x], numbers) for x in tiles), pa.array([edges], pa.list_(numbers))]
    return pa.table(columns, ["shard", "n", "total", "widest", "cuts", "heavy", "pieces", "edges"])


def _count_words(trie: Trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, _ in _flushed(batches, 0, trie.flush):
            yield _blobs(h, lambda k: shard_of(k, trie.shards))

    return run


def _make_words(trie: Trie):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        s = table["shard"][0].as_py()
        h, count = _summed(table)
        low = -(-(s << 32) // trie.shards) << 32
        high = min(-(-((s + 1) << 32) // trie.shards) << 32, 1 << 64)
        total = np.concatenate([[0], np.cumsum(count)])
        trie.put("words", s, [EliasFano.of(h - U64(low), high - low).arrays(), EliasFano.of(total, int(total[-1]) + 1).arrays()])
        return _made(s, len(h), int(total[-1]), 0, _tiles(count, trie.shard_tokens), [])

    return run


def _ids_of(trie: Trie, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word, inverse = np.unique(h, return_inverse=True)
    ids, counts = trie.look_up(word)
    return ids[inverse], counts[inverse]


def _with_before(first: np.ndarray, n: int, width: int) -> np.ndarray:
    """Places of tokens that have width - 1 tokens of their text before them."""
    ok = np.ones(n, bool)
    for k in range(width - 1):
        at = first[:-1] + k
        ok[at[at < first[1:]]] = False
    return np.flatnonzero(ok)


def _bigram_places(trie: Trie, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token, of the bigram that ends there: its place (-1: none), the token's rank among the successors, log10 p if the level has any."""
    n = len(ids)
    place, rank = np.full(n, -1), np.full(n, -1)
    at = _with_before(first, n, 2)
    at = at[(ids[at] >= 0) & (ids[at - 1] >= 0)]
    key, inverse = np.unique(ids[at - 1].astype(U64) * U64(trie.words) + ids[at].astype(U64), return_inverse=True)
    got, equal = trie.find(2, key)
    parent, of = np.unique(key // U64(trie.words), return_inverse=True)
    order = np.where(equal, got - trie.starts(parent)[of], -1)
    got = np.where(equal, got, -1)
    place[at], rank[at] = got[inverse], order[inverse]
    return place, rank, key


def _count_bigrams(trie_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of.value
        for _, h, first in _flushed(batches, 0, trie.flush):
            ids, _ = _ids_of(trie, h)
            at = _with_before(first, len(h), 2)
            yield _blobs(ids[at - 1].astype(U64) * U64(trie.words) + ids[at].astype(U64), trie.levels[2].shard_of)

    return run


def _count_trigrams(trie_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of.value
        for _, h, first in _flushed(batches, 0, trie.flush):
            ids, _ = _ids_of(trie, h)
            place, rank, _ = _bigram_places(trie, ids, first)
            at = _with_before(first, len(h), 3)
            yield _blobs(place[at - 1].astype(U64) * U64(trie.levels[3].width) + rank[at].astype(U64), trie.levels[3].shard_of)

    return run


def _context_sums(level: Level, s: int, key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key its parent's number within shard s, and (count, successors seen once, twice, more often) of each parent there."""
    parent = (key // U64(level.width)).astype(np.int64) - level.low_parent(s)
    n = level.parents(s)
    sums = [np.bincount(parent, count, minlength=n)] + [np.bincount(parent[np.minimum(count, 3) == c], minlength=n) for c in (1, 2, 3)]
    return parent, np.stack(sums, 1).astype(np.int64)


def _make_keys(trie_of, k: int):
    """The sorted keys of a shard and, for the next step alone, their counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        trie, s = trie_of.value, table["shard"][0].as_py()
        level = trie.levels[k]
        keys, count = _summed(table)
        trie.put(f"keys{k}", s, [EliasFano.of(keys - level.bounds[s], max(1, level.end(s) - int(level.bounds[s]))).arrays()])
        much = np.flatnonzero(count >= 255)
        trie.put(f"counts{k}", s, [[np.minimum(count, 255).astype(np.uint8)], [much], [count[much]]])
        parent, sums = _context_sums(level, s, keys, count)
        ends = sorted({int(parent[0]), int(parent[-1])})
        degree = sums[:, 1:].sum(axis=1)
        edges = [[p + level.low_parent(s), *sums[p].tolist()] for p in ends]
        return _made(s, len(keys), int(count.sum()), int(degree.max()), _tiles(count, trie.shard_tokens), edges)

    return run


def _shared_in(level: Level, s: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in shard s and sums of the contexts of `shared` (rows of parent and sums, by parent) that may have keys there."""
    low = level.low_parent(s)
    a, b = np.searchsorted(shared[:, 0], [low, low + level.parents(s)])
    return shared[a:b, 0] - low, shared[a:b, 1:]


def _make_probabilities(trie_of, k: int, shared: np.ndarray):
    """Quantised probabilities and lambdas of the shards given; shared: sums of the contexts that lie in several shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of.value
        level, off = trie.levels[k], np.array(DISCOUNTS[k])
        for batch in batches:
            for s in batch.column(0).to_pylist():
                if not level.sizes[s]:
                    # A shard without keys still says that its contexts have lambda 1.
                    left = np.zeros(level.parents(s), np.uint16)
                    at, sums = _shared_in(level, s, shared)
                    left[at] = _quantise(np.log10(np.maximum((sums[:, 1:] @ off) / np.maximum(sums[:, 0], 1), 1e-12)))
                    trie.put(f"probs{k}", s, [[np.zeros(0, np.uint16)], [left]])
                    continue
                keys = trie.part(f"keys{k}", s)[0].decoded() + level.bounds[s]
                small, much, counts = trie.part(f"counts{k}", s)
                count = small.astype(np.int64)
                count[much] = counts
                parent, sums = _context_sums(level, s, keys, count)
                at, whole = _shared_in(level, s, shared)
                sums[at] = whole
                seen = np.maximum(sums[:, 0], 1)
                left = np.where(sums[:, 0] > 0, (sums[:, 1:] @ off) / seen, 1.0)
                child = (keys % U64(level.width)).astype(np.int64)
                if k == 2:
                    word, of = np.unique(child, return_inverse=True)
                    below = (10 ** trie.log_unigram(trie.counts(word)))[of]
                else:
                    # p(w|v): the child's rank is its place among the successors of the parent's last word.
                    last = (trie.bigram_keys(level.low_parent(s), level.low_parent(s) + len(sums)) % U64(trie.words)).astype(np.int64)
                    word, of = np.unique(last, return_inverse=True)
                    below = 10 ** trie.log_p(2, trie.starts(word)[of][parent] + child)
                p = (count - off[np.minimum(count, 3) - 1]) / seen[parent] + left[parent] * below
                trie.put(f"probs{k}", s, [[_quantise(np.log10(np.maximum(p, 1e-16)))], [_quantise(np.log10(np.maximum(left, 1e-12)))]])
            yield pa.record_batch([batch.column(0)], ["shard"])

    return run


def _bounds(width: int, first: np.ndarray, rows: dict, successors) -> np.ndarray:
    """The bounds of the next level: at each cut, and within a heavy parent at even parts of its successors."""
    out: list[int] = []
    for s, r in sorted(rows.items()):
        out += [(int(first[s]) + c) * width for c in (0, *r["cuts"])]
        for p, pieces in zip(r["heavy"], r["pieces"], strict=True):
            parent = int(first[s]) + p
            out += [parent * width + successors(parent) * j // pieces for j in range(1, pieces)]
            out.append((parent + 1) * width)
    return np.array(out, U64)


def train(docs: DataFrame, text_col: str = "text", shard_tokens: int = SHARD_TOKENS, flush: int = FLUSH) -> Trie:
    """Learn the trie from all rows of docs."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Taken as eight bytes a token; two is the least.
    trie = Trie(work_dir(spark, "lm"), max(4, -(-size // (8 * shard_tokens))), shard_tokens, flush)

    def made(count, make, shards: int) -> dict:
        key = F.element_at(F.lit(spread_keys(spark, shards)), F.col("shard") + 1).alias("key")
        blobs = rows.mapInArrow(count, "shard int, blob binary").select(key, "shard", "blob").repartition(shards, "key")
        return {r["shard"]: r for r in blobs.groupBy("key").applyInArrow(make, _MADE).collect()}

    got = made(_count_words(trie), _make_words(trie), trie.shards)
    for s, r in got.items():
        trie.sizes[s] = r["n"]
        trie.tokens += r["total"]
    if trie.words >= 1 << 32:
        raise ValueError("more than 2**32 distinct words")
    if not trie.words:
        return trie

    def last_degree(place: int) -> int:
        word = int(trie.bigram_keys(place, place + 1)[0]) % trie.words
        a, b = trie.starts(np.array([word, word + 1])) if word + 1 < trie.words else (*trie.starts(np.array([word])), trie.levels[2].first[-1])
        return max(1, int(b - a))

    first = trie.first
    for k, count in ((2, _count_bigrams), (3, _count_trigrams)):
        width = trie.words if k == 2 else trie.levels[2].widest
        parents = int(first[-1])
        if parents * width >= 1 << 64:
            raise ValueError("keys of the model do not fit 64 bits")
        level = Level(k, width, _bounds(width, first, got, (lambda _: trie.words) if k == 2 else last_degree), parents * width)
        trie.levels[k] = level
        held = spark.sparkContext.broadcast(trie)
        got = made(count(held), _make_keys(held, k), level.shards)
        seen: dict[int, list[list[int]]] = {}
        split: set[int] = set()
        for s, r in got.items():
            level.sizes[s] = r["n"]
            level.widest = max(level.widest, r["widest"])
            for p, *sums in r["edges"]:
                seen.setdefault(p, []).append(sums)
                if level.shard_of(np.array([p * width], U64))[0] != s:
                    split.add(p)
        shared = np.array([[p, *(sum(x) for x in zip(*seen[p], strict=True))] for p in sorted(split)], np.int64).reshape(-1, 5)
        if k == 2:
            # A word whose successors lie in several shards has as many as all of them hold.
            level.widest = max(level.widest, int(shared[:, 2:].sum(axis=1).max(initial=0)))
        held = spark.sparkContext.broadcast(trie)
        shards = spark.range(0, level.shards, 1, min(level.shards, 10_000)).select(F.col("id").cast("int").alias("shard"))
        shards.mapInArrow(_make_probabilities(held, k, shared), "shard int").write.format("noop").mode("overwrite").save()
        remove(spark, f"{trie.path}/counts{k}")
        first = level.first
    return trie


def score_tokens(trie: Trie, h: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Of texts given by their token hashes: n_tokens, n_known, base_score and score."""
    n = len(first) - 1
    if not trie.words:
        zero = np.zeros(n)
        return {"n_tokens": np.diff(first), "n_known": np.zeros(n, np.int64), "base_score": zero, "score": zero}
    word, of = np.unique(h, return_inverse=True)
    ids, counts = trie.look_up(word)
    base = trie.log_unigram(counts)[of]
    left = np.zeros(len(word))
    left[ids >= 0] = trie.log_lambda(2, ids[ids >= 0])
    left, known, ids = left[of], (counts > 0)[of], ids[of]
    best = base.copy()
    place, rank, _ = _bigram_places(trie, ids, first)
    at = _with_before(first, len(h), 2)
    best[at] += left[at - 1]  # an unknown word's lambda is 1
    kept = np.flatnonzero(place >= 0)
    where, of = np.unique(place[kept], return_inverse=True)
    best[kept] = trie.log_p(2, where)[of]
    left = np.zeros(len(h))
    left[kept] = trie.log_lambda(3, where)[of]
    at = _with_before(first, len(h), 3)
    at = at[place[at - 1] >= 0]
    best[at] += left[at - 1]
    at = at[rank[at] >= 0]
    if len(at):
        key, of = np.unique(place[at - 1].astype(U64) * U64(trie.levels[3].width) + rank[at].astype(U64), return_inverse=True)
        got, equal = trie.find(3, key)
        p = np.zeros(len(key))
        p[equal] = trie.log_p(3, got[equal])
        hit = equal[of]
        best[at[hit]] = p[of[hit]]
    return {
        "n_tokens": np.diff(first),
        "n_known": kernels.sums(known.astype(float), first).astype(np.int64),
        "base_score": kernels.sums(base, first),
        "score": kernels.sums(best, first),
    }


def _score(trie_of):
    names = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of.value
        for held, h, first in _flushed(batches, 2, SCORED):
            got = score_tokens(trie, h, first)
            keys = [pa.concat_arrays([b.column(c).slice(at, n) for b, at, n in held]) for c in (0, 1)]
            yield pa.record_batch([*keys, *(pa.array(got[c]) for c in names)], ["id", "held_out", *names])

    return run


def score(docs: DataFrame, trie: Trie, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; scores are log10 of the whole text."""
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(trie)
    kind = f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    got = rows.mapInArrow(_score(held), kind)
    return got.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(trie.tokens).cast("long").alias("train_tokens"), "base_score", "score")
