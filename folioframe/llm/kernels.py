"""Vectorised text kernels shared by the operators of this subpackage.

Everything here works on a whole batch of texts at once: the texts are joined into one byte
array, word and line boundaries are found with numpy, and spans are hashed through prefix sums,
so the cost per byte does not depend on how the bytes are dealt over texts.

A word is a maximal run of bytes other than space and 0x09-0x0D; UTF-8 never uses those bytes
inside a longer character, so bytes and code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multiplier of the rolling polynomial (mod 2**64) and its inverse.
BASE = U64(0x9E3779B97F4A7C15)
BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of text that one call works on; a longer text is still worked on whole.
CHUNK_BYTES = 1_000_000

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Gaps between runs of letters: every ASCII byte that is none. Bytes of longer characters count as letters.
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits (the splitmix64 one)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        step = BASE if kind == "up" else BASE_INV
        out = np.full(max(n, 2 * len(have)), step, U64)
        out[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[kind] = np.multiply.accumulate(out)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends], equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        terms = _BYTE_VALUE[data]
        terms *= _powers("up", len(data))
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(terms, out=sums[1:])
        got = (sums[ends] - sums[starts]) * _powers("down", len(data))[starts]
        return mix(got + (ends - starts).astype(U64))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string array of about `limit` bytes, each with its first row."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="left"))
        last = min(max(last, first + 1), len(texts))
        yield first, texts.slice(first, last - first)
        first = last


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array, null as empty, and len+1 offsets into them."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    if texts.null_count:
        # A null may cover bytes; take the valid rows' bytes alone.
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a batch of texts.

    starts, ends: byte spans; doc: the text of each word; first: len+1 offsets of each text's words.
    gaps: which bytes stand between words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, gaps: np.ndarray = _IS_SPACE):
        self.data, self.offsets = raw(texts)
        if lower:
            self.data = _LOWER[self.data]
        n = len(self.data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~gaps[self.data]
        edge = inside[1:] != inside[:-1]  # edge[i]: a word starts or ends before byte i
        # A word also ends where its text ends.
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        touching = cut[inside[cut] & inside[cut + 1]]
        starts = np.flatnonzero(edge & inside[1:])
        ends = np.flatnonzero(edge & inside[:-1])
        if len(touching):
            touching = np.unique(touching)
            starts = np.sort(np.concatenate([starts, touching]))
            ends = np.sort(np.concatenate([ends, touching]))
        self.starts, self.ends = starts, ends
        self.first = np.searchsorted(starts, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each run of `width` word hashes; len(words) - width + 1 of them."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, U64)
        for i in range(width):
            out *= BASE
            out += words[i : i + n]
        return mix(out)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and len+1 offsets.

    A text with fewer than `width` words has its whole sequence as its one shingle; one without
    words has none.
    """
    h = words.hashes()
    n_docs = len(words.counts)
    all_grams = grams(h, width)
    whole = words.counts >= width
    per = np.where(whole, words.counts - width + 1, 0)
    index = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())
    doc = np.repeat(np.arange(n_docs), per)
    value = all_grams[index] if len(index) else np.zeros(0, U64)
    short = np.flatnonzero((words.counts > 0) & ~whole)
    if len(short):
        extra = np.empty(len(short), U64)
        for k, d in enumerate(short):
            w = h[words.first[d] : words.first[d + 1]]
            extra[k] = grams(w, len(w))[0] ^ U64(len(w))
        value, doc = np.concatenate([value, extra]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        value, doc = value[order], doc[order]
    ends = np.searchsorted(doc, np.arange(n_docs + 1))
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        value[a:b].sort()
    if len(value):
        keep = np.ones(len(value), bool)
        keep[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        value, doc = value[keep], doc[keep]
    return value, np.searchsorted(doc, np.arange(n_docs + 1))


def set_classes(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One int64 for each set: equal for equal sets, and for others by chance alone (2**-64 a pair).

    Empty sets get 0.
    """
    with np.errstate(over="ignore"):
        sums = np.zeros(len(value) + 1, U64)
        np.cumsum(mix(value), out=sums[1:])
        n = np.diff(first).astype(U64)
        out = mix(sums[first[1:]] - sums[first[:-1]] + n * BASE)
    out[n == 0] = 0
    return out.view(np.int64)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]; 0 for empty spans."""
    out = np.zeros(len(first) - 1, np.float64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[full], dtype=np.float64)
    return out
