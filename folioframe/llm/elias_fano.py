"""Elias-Fano sequences over numpy arrays: non-decreasing integers in about 2 + log2(universe / n) bits each.

The lower bits of each value are packed; the upper bits are written in unary, so that the zeros of the bitmap
are the upper halves and the ones the values. All look-ups take arrays, and the arrays may be memory-mapped.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_ONE = U64(1)
#: Look-ups made at a time: their arrays stay in a core's cache.
BLOCK = 1 << 14
#: Place of the r-th set bit of each byte.
_PLACE = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _r, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _PLACE[_b, _r] = _p
#: The lowest and the highest bit of each byte, for sums of all bytes of a word at once.
_LOW, _HIGH = U64(0x0101010101010101), U64(0x8080808080808080)
_TWOS, _FOURS, _EIGHTS = U64(0x5555555555555555), U64(0x3333333333333333), U64(0x0F0F0F0F0F0F0F0F)


def _select_in_word(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit of each word, which must have more than k."""
    k = k.astype(U64)
    sums = bits - ((bits >> _ONE) & _TWOS)
    sums = (sums & _FOURS) + ((sums >> U64(2)) & _FOURS)
    sums = ((sums + (sums >> U64(4))) & _EIGHTS) * _LOW  # byte i: set bits of bytes 0 to i
    full = (((k * _LOW | _HIGH) - sums) & _HIGH) >> U64(7)  # 1 for each byte that the bit lies behind
    at = ((full * _LOW) >> U64(53)) & U64(0x78)
    rest = k - ((sums << U64(8)) >> at & U64(255))
    return (at + _PLACE[(bits >> at & U64(255)).astype(np.intp), rest.astype(np.intp)]).astype(np.int64)


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Values of `width` bits, packed into uint64 words (one spare word at the end)."""
    n = len(values)
    out = np.zeros(n * width // 64 + 2, U64)
    if width and n:
        at = np.arange(n, dtype=np.int64) * width
        word, shift = at >> 6, (at & 63).astype(U64)
        # Words rise with values, so those of one word are neighbours.
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[start]] = np.bitwise_or.reduceat(values << shift, start)
        over = np.flatnonzero((at & 63) + width > 64)
        out[word[over] + 1] |= values[over] >> (U64(64) - shift[over])
    return out


class EliasFano:
    """parts: n, low width, low words, upper words, and ones before each upper word."""

    def __init__(self, n: int, width: int, low: np.ndarray, upper: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.upper, self.ones = n, width, low, upper, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = values.astype(U64), len(values)
        width = max(0, int(np.floor(np.log2(max(1, universe // max(1, n))))))
        high = (values >> U64(width)).astype(np.int64)
        size = n + (universe >> width) + 2
        bits = np.zeros((size // 64 + 1) * 64, bool)
        bits[high + np.arange(n)] = True
        upper = np.packbits(bits, bitorder="little").view(U64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper).astype(np.int64))[:-1]])
        return cls(n, width, _bits(values & ((_ONE << U64(width)) - _ONE), width), upper, ones)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.width], np.int64), self.low, self.upper, self.ones]

    @classmethod
    def from_arrays(cls, parts: list[np.ndarray]) -> EliasFano:
        return cls(int(parts[0][0]), int(parts[0][1]), parts[1], parts[2], parts[3])

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), U64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(U64)
        value = self.low[word] >> shift
        over = np.where(shift > 0, self.low[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return (value | over) & ((_ONE << U64(self.width)) - _ONE)

    def _select(self, k: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th one (or zero) of the upper bitmap."""
        word = np.searchsorted(before, k, side="right") - 1
        bits = self.upper[word]
        return word * 64 + _select_in_word(~bits if flip else bits, k - before[word])

    def access(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, self.ones, False) - i
        return (high.astype(U64) << U64(self.width)) | self._lows(i)

    def decoded(self) -> np.ndarray:
        """All values; a pass over the bits is cheaper than a look-up each."""
        at = np.arange(self.n)
        place = np.flatnonzero(np.unpackbits(self.upper.view(np.uint8), bitorder="little"))
        return ((place - at).astype(U64) << U64(self.width)) | self._lows(at)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place with a value >= x (n if none), and whether that value is x."""
        if len(x) <= BLOCK:
            return self._successor(x)
        parts = [self._successor(x[k : k + BLOCK]) for k in range(0, len(x), BLOCK)]
        return np.concatenate([p for p, _ in parts]), np.concatenate([e for _, e in parts])

    def _successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(U64)
        high = (x >> U64(self.width)).astype(np.int64)
        want = x & ((_ONE << U64(self.width)) - _ONE)
        # Values with a lesser upper half stand before the zero that closes it; this half's own zero is the next one.
        zero = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, True), -1)
        begin = zero + 1 - high
        rest = ~self.upper[(zero + 1) >> 6] >> ((zero + 1) & 63).astype(U64)
        end = begin + np.bitwise_count((rest & (~rest + _ONE)) - _ONE)
        far = np.flatnonzero(rest == 0)
        if len(far):
            end[far] = self._select(high[far], self.zeros, True) - high[far]
        at, equal = begin.copy(), np.zeros(len(x), bool)
        # Binary search among the values of this upper half, which are few on average.
        low, up = begin.copy(), end.copy()
        while True:
            live = np.flatnonzero(low < up)
            if not len(live):
                break
            middle = (low[live] + up[live]) >> 1
            less = self._lows(middle) < want[live]
            low[live] = np.where(less, middle + 1, low[live])
            up[live] = np.where(less, up[live], middle)
        at = low
        inside = np.flatnonzero(at < end)
        equal[inside] = self._lows(at[inside]) == want[inside]
        return at, equal
