"""Packing: token pieces into sequences of a fixed length, planned by non-negative least squares.

A document's ids (its tokens and an end id) are cut into pieces of the window; the last, shorter piece is
the tail. Full pieces fill a sequence each. The tails of a shard (SHARD documents of one input partition) are
packed together, so there is no shuffle and a shard's memory is bounded:

1. the tails' lengths make a histogram;
2. columns are all combinations of one, two or three of the lengths present that fill the window up to a
   small slack;
3. non-negative least squares finds how often to use each so that the histogram is met;
4. the counts are rounded down to what the histogram still holds;
5. tails left over are packed greedily, longest first, end to end, cut where a sequence is full; the
   rest of the shard is cut into sequences of powers of two, which need no padding.

Results depend on the order of rows in a partition alone, so a task that runs again gives the same ids.

Edge cases: null or empty text is its end id alone; repeated rows are packed each; an empty table gives no
rows; other columns are ignored; a text of any length is tokenized whole.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import give_back

WINDOW = 1024
SHARD = 16_384
#: Padding that a planned combination may leave, in tokens.
SLACK = 2
_TOKENIZERS: dict[tuple[str, str], object] = {}


class FastTokenizer:
    """The ids of a tokenizers file by the same vocabulary given as ranks (six times faster).

    Texts that hold one of the file's special tokens go through the tokenizers library itself, and all texts do if the two
    disagree on any text of SELF_CHECK.
    """

    SELF_CHECK = ("", " ", "Plain words, 12345 and it's.", "  two  spaces \n\n\ttab\r\nend ", "naïve Übergröße 漢字かな 😀👍🏽 \u200d\u0301", "x\u00a0y\u2028z\u3000", "a'S 'll I'VE ''", "#!@$%^&*()_+ 1.5e-7", "\x00\x7f\ufffd")

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        if any(self.fast.encode_ordinary(t) != self.full.encode(t, add_special_tokens=False).ids for t in self.SELF_CHECK):
            self.special.append("")  # which every text holds

    def __call__(self, text: str) -> list[int]:
        if any(t in text for t in self.special):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def tokenizer(name: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken"):
    """The tokenizer of a public vocabulary file, loaded once in a process."""
    if (name, ranks) not in _TOKENIZERS:
        import public_tokenizers

        _TOKENIZERS[name, ranks] = FastTokenizer(public_tokenizers.path(name), public_tokenizers.path(ranks), public_tokenizers.PATTERN)
    return _TOKENIZERS[name, ranks]


def combinations(lengths: np.ndarray, window: int, slack: int = SLACK) -> np.ndarray:
    """All rows (a, b, c) of lengths present with 0 for none, a >= b >= c, filling the window up to slack: at most about window**2 / 12 threes a gap."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    lengths = np.sort(lengths)[::-1]
    rows = [np.stack([a := lengths[lengths >= window - slack], 0 * a, 0 * a], 1)]
    for gap in range(slack + 1):
        rest = window - gap - lengths
        ok = (rest > 0) & (rest <= lengths) & have[np.clip(rest, 0, window)]
        rows.append(np.stack([lengths[ok], rest[ok], 0 * rest[ok]], 1))
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    a, b = a[a >= b], b[a >= b]
    for gap in range(slack + 1):
        rest = window - gap - a - b
        ok = (rest > 0) & (rest <= b)
        ok[ok] = have[rest[ok]]
        at = np.flatnonzero(ok)
        rows.append(np.stack([a[at], b[at], rest[at]], 1))
    return np.concatenate(rows)


def nnls(combos: np.ndarray, histogram: np.ndarray, steps: int = 150) -> np.ndarray:
    """Counts x >= 0 that minimise |A x - histogram| (A: how often each length is in each combination).

    Accelerated projected gradient with a diagonal step; deterministic.
    """
    used = [combos[:, k] for k in range(3)]
    present = [(u > 0).astype(float) for u in used]
    n = len(histogram)

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        for u, p in zip(used, present, strict=True):
            out += np.bincount(u, x * p, minlength=n)
        return out

    degree = forward(np.ones(len(combos)))
    step = 1 / np.maximum(sum(degree[u] * p for u, p in zip(used, present, strict=True)), 1)
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(steps):
        residual = forward(y) - histogram
        grad = sum(residual[u] * p for u, p in zip(used, present, strict=True))
        new = np.maximum(y - step * grad, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(lengths: np.ndarray, window: int = WINDOW) -> tuple[list[list[int]], list[int]]:
    """Groups of indices into lengths (all under window) that share a sequence, and the indices left over."""
    if not len(lengths):
        return [], []
    order = np.argsort(lengths, kind="stable")
    present, begin, count = np.unique(lengths[order], return_index=True, return_counts=True)
    combos = combinations(present, window)
    histogram = np.zeros(window + 1)
    histogram[present] = count
    left = dict(zip(present.tolist(), count.tolist(), strict=True))
    top = {length: int(b) for length, b in zip(present.tolist(), begin.tolist(), strict=True)}
    groups: list[list[int]] = []
    if len(combos):
        x = nnls(combos, histogram)
        # Whole counts first, then the combinations with the largest fractions while lengths last.
        rounds = [(np.flatnonzero(x >= 1), np.floor(x)), (np.argsort(-(x - np.floor(x)), kind="stable"), np.ceil(x - np.floor(x)))]
        for at, times in rounds:
            for k in at[times[at] > 0].tolist():
                parts = [v for v in combos[k].tolist() if v]
                for _ in range(int(times[k])):
                    need = {v: parts.count(v) for v in parts}
                    if any(left[v] < m for v, m in need.items()):
                        break
                    group = []
                    for v in parts:
                        left[v] -= 1
                        group.append(int(order[top[v]]))
                        top[v] += 1
                    groups.append(group)
    rest = [int(order[i]) for v in sorted(left, reverse=True) for i in range(top[v], top[v] + left[v])]
    return groups, rest


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer()
        sequence = TaskContext.get().partitionId() << 40
        ids: list = []
        tails: list[tuple[int, int, int, np.ndarray]] = []
        out: list[list] = [[] for _ in range(7)]

        def put(row: int, start: int, piece: np.ndarray, total: int, number: int, offset: int):
            for column, v in zip(out, (row, start, len(piece), zlib.crc32(piece.tobytes()), total, number, offset), strict=True):
                column.append(v)

        def flush() -> pa.RecordBatch:
            nonlocal sequence, ids, tails, out
            groups, rest = plan(np.array([len(t[3]) for t in tails], np.int64), window)
            for group in groups:
                offset = 0
                for k in group:
                    row, start, total, piece = tails[k]
                    put(row, start, piece, total, sequence, offset)
                    offset += len(piece)
                sequence += 1
            # Greedy end to end; what is left at the end goes into sequences of powers of two.
            remaining = sum(len(tails[k][3]) for k in rest)
            room = window if remaining >= window else 1 << max(0, remaining.bit_length() - 1)
            offset = 0
            for k in rest:
                row, start, total, piece = tails[k]
                while len(piece):
                    part = piece[: room - offset]
                    put(row, start, part, total, sequence, offset)
                    offset, start, piece = offset + len(part), start + len(part), piece[len(part) :]
                    remaining -= len(part)
                    if offset == room:
                        sequence, offset = sequence + 1, 0
                        room = window if remaining >= window else 1 << max(0, remaining.bit_length() - 1)
            got = pa.record_batch(
                [pa.concat_arrays(ids).take(pa.array(out[0], pa.int64())), *(pa.array(c, pa.int64()) for c in out[1:])],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            ids, tails, out = [], [], [[] for _ in range(7)]
            return got

        held = 0
        for batch in batches:
            for begin in range(0, batch.num_rows, SHARD):
                part = batch.slice(begin, SHARD)
                if held + part.num_rows > SHARD and held:
                    yield flush()
                    held = 0
                ids.append(part.column(0))
                for i, text in enumerate(part.column(1)):
                    tokens = np.array([*encode(text.as_py() or ""), 0], "<u4")
                    total = len(tokens)
                    whole = total // window * window
                    for start in range(0, whole, window):
                        put(held + i, start, tokens[start : start + window], total, sequence, 0)
                        sequence += 1
                    if whole < total:
                        tails.append((held + i, whole, total, tokens[whole:]))
                held += part.num_rows
        if held:
            yield flush()
        give_back()

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Pieces: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    kind = f"id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(_pieces(window), kind).withColumnRenamed("id", id_col)
