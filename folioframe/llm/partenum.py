"""PartEnum signatures for sets under a Jaccard threshold of 0.8.

Two sets of sizes s <= t with Jaccard similarity of 4/5 or more have t <= 5s/4 and differ in at
most (s + t) / 9 elements. Sets are dealt into size bands; a pair belongs to the band of its larger
set, so a set takes part in its own band and, near the upper edge, in the next one. A band splits the
feature domain twice by a hash of the element: into N first-level partitions, and each of these into SECOND second-level ones.

* Of each first-level partition the subsets of all second-level partitions but one are enumerated; the projection of
  a set onto such a subset is a signature, SECOND * N of them.
* A partition with no differing element gives SECOND equal signatures, one with a single differing element still gives
  one, and k = s // 4 elements at most can differ from any partner's. So at least 3N - 2k signatures are equal (2N - k if k > N), of 3N. N is
  over k / 2 for every size of the band, so there always is one.
* Under one total order of signatures, the first 3N - m + 1 of either set then share one, where m is that
  least number of equal ones (the prefix lemma): those are emitted. The order puts signatures with many elements first that are not in
  `common` (a set of very frequent shingles), so passages that many texts share seldom form a signature. Any
  `common` gives the same result; it only decides how many false candidates there are.
* Where the sizes sum to 17 or less the bound is one element, so the enumeration is complete over
  single elements: the smaller set emits its whole, the larger each subset lacking one element.
* Sets of three elements or fewer are similar only if equal, which the caller finds by class.
"""

from __future__ import annotations

import numpy as np

from folioframe.llm.kernels import U64, mix

#: Sizes from which the general scheme's bands start; each band is twice as wide as the one before.
FIRST = 9
#: Second-level partitions; one of them may differ.
SECOND = 3


def band(size: np.ndarray) -> np.ndarray:
    """The band of a pair whose larger set has this size (FIRST or more)."""
    return np.floor(np.log2(np.maximum(size, FIRST) / FIRST + 1e-12)).astype(np.int64)


def band_parts(b: np.ndarray) -> np.ndarray:
    """First-level partitions: more than half of what differs at most from a set of the band's largest size."""
    return (2 * (FIRST << b) - 1) // 4 // 2 + 1


def emitted(size: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """How many of the SECOND * parts signatures a set of this size must emit."""
    k = size // 4
    equal = np.where(k <= parts, SECOND * parts - (SECOND - 1) * k, 2 * parts - k)
    return SECOND * parts - equal + 1


class Common:
    """Membership in a sorted array of frequent shingle hashes."""

    def __init__(self, values: np.ndarray, bits: int = 20):
        self.values, self.mask = np.sort(values.astype(U64)), U64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.values & self.mask] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        if len(self.values):
            at = np.flatnonzero(self.maybe[h & self.mask])
            found = np.searchsorted(self.values, h[at])
            out[at] = self.values[np.minimum(found, len(self.values) - 1)] == h[at]
        return out


def signatures(value: np.ndarray, first: np.ndarray, common: Common) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets value[first[i]:first[i + 1]], and the set of each."""
    size = np.diff(first)
    got, of = [], []
    with np.errstate(over="ignore"):
        for i in np.flatnonzero((size >= 4) & (size <= 9)):
            m = mix(value[first[i] : first[i + 1]])
            total = m.sum(dtype=U64)
            whole = [] if size[i] > 8 else [total]
            less = total - m if size[i] >= 5 else m[:0]
            # The number of elements is hashed in: a whole of s meets a subset of s + 1 lacking one.
            sig = np.concatenate([mix(np.array(whole, U64) + U64(size[i])), mix(less + U64(size[i] - 1))])
            got.append(sig)
            of.append(np.full(len(sig), i))
        # (set, band) pairs of the general scheme: own band, and that of the largest partner.
        big = size * 5 // 4
        sets = np.flatnonzero(big >= 10)
        if len(sets):
            own, top = band(size[sets]), band(big[sets])
            has_own = size[sets] >= FIRST
            more = (top != own) | ~has_own
            which = np.concatenate([sets[has_own], sets[more]])
            bands = np.concatenate([own[has_own], top[more]])
            parts = band_parts(bands)
            base = np.concatenate([[0], np.cumsum(parts)])
            n = size[which]
            total = int(n.sum())
            element = np.repeat(first[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
            h = value[element]
            member = np.repeat(np.arange(len(which)), n)
            spread = mix(h + U64(0x51ED270B) * (bands[member] + 1).astype(U64))
            slot = (base[member] + ((spread >> U64(32)) * parts[member].astype(U64) >> U64(32)).astype(np.int64)) * SECOND + (spread % U64(SECOND)).astype(np.int64)
            cells = base[-1] * SECOND
            acc = np.zeros(cells, U64)
            np.add.at(acc, slot, spread)
            count = np.bincount(slot, minlength=cells)
            rare = count - np.bincount(slot[common(h)], minlength=cells)
            # All second-level partitions of a first-level one, less one each.
            less = lambda x: (x.reshape(-1, SECOND).sum(axis=1, dtype=x.dtype)[:, None] - x.reshape(-1, SECOND)).reshape(-1)
            acc, count, rare = less(acc), less(count), less(rare)
            owner = np.repeat(np.arange(len(which)), parts * SECOND)
            part = np.arange(cells) - base[owner] * SECOND
            sig = mix(acc + mix((part + 1).astype(U64) * U64(1 << 20) + (bands[owner] + 1).astype(U64)))
            order = np.argsort(sig, kind="stable")
            rank = (owner << 22) | ((2047 - np.minimum(rare, 2047)) << 11) | (2047 - np.minimum(count, 2047))
            order = order[np.argsort(rank[order], kind="stable")]
            keep = part < emitted(n, parts)[owner]  # order is by owner first
            got.append(sig[order[keep]])
            of.append(which[owner[keep]])
    if not got:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(got), np.concatenate(of)
