"""PartEnum signatures for Jaccard similarity: the set algebra, without Spark.

Let a set have n features and let similar mean |a & b| / |a | b| >= num / den. Similar sets lie in the same band of sizes or in
neighbouring bands, because a band reaches from lo to lo * den / num. If the larger of two similar sets is in a band that ends at hi, they differ in at
most k = 2 * hi * (den - num) / (den + num) features. The domain is hashed into m > k parts. At most k parts see a difference,
so at least m - k of the m projections (set restricted to one part) agree. Order the projections by the number of
features, largest first (a property of the projection, so the same for both sets): of two families of m elements that share
m - k, the first k + 1 in any common order have one in common. So k + 1 signatures for each band are enough, and they are the
fullest, most selective ones; empty parts are used only by a set that has fewer than k + 1 others. Every set signs for its own band (as "upper") and for the next (as
"lower"), so a pair that matters always has an upper member.
"""

from __future__ import annotations

import numpy as np

from secdata.llm.text import Words, mix, ranges

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Bands:
    """Bands of set sizes, the number of features that similar sets may differ in, and the number of parts."""

    def __init__(self, num: int, den: int, largest: int):
        hi, his = 0, [0]
        while hi < largest or len(his) < 3:
            lo = hi + 1
            hi = max(lo, lo * den // num)
            his.append(hi)
        hi = (hi + 1) * den // num
        self.num, self.den = num, den
        self.hi = np.array([*his, hi], np.int64)  # of band 0 (empty sets), 1, 2 ...
        self.differ = (2 * self.hi * (den - num)) // (den + num)
        self.parts = np.maximum(self.hi // 2, 4 * self.differ // 3) + 1
        self.parts[self.hi < 64] = self.hi[self.hi < 64] + self.differ[self.hi < 64] + 1

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hi, sizes)

    def needed(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        """How many signatures a set of each size must have in an instance: one more than it may differ from its largest possible partner there."""
        partner = np.minimum(self.hi[band], sizes * self.den // self.num)
        return (sizes + partner) * (self.den - self.num) // (self.den + self.num) + 1


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-word shingles of every value as (owner, hash), sorted by both; fewer words make one shingle."""
    h, first = words.hashes(), words.first
    counts = np.diff(first)
    k = len(h) - n + 1
    if k > 0:
        rolled = np.zeros(k, np.uint64)
        for j in range(n):
            rolled = rolled * _A + h[j : j + k]
        owner = words.owners()
        whole = owner[:k] == owner[n - 1 :]
        rolled, owner = mix(rolled[whole]), owner[:k][whole]
    else:
        rolled, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        total = np.full(len(short), 1, np.uint64) + counts[short].astype(np.uint64)
        for j in range(n - 1):
            has = counts[short] > j
            total[has] = total[has] * _B + h[first[short[has]] + j]
        rolled, owner = np.concatenate((rolled, mix(total))), np.concatenate((owner, short))
    order = np.lexsort((rolled, owner))
    rolled, owner = rolled[order], owner[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], rolled[new]


def set_hash(owner: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each of the n sets, 0 for an empty one."""
    sizes = np.bincount(owner, minlength=n)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(features ^ _C))))
    ends = np.cumsum(sizes)
    return np.where(sizes > 0, mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)), np.uint64(0))


def signatures(owner: np.ndarray, features: np.ndarray, n: int, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, set index, upper?) for n sets given as sorted (owner, feature) pairs."""
    sizes = np.bincount(owner, minlength=n)
    band = bands.of(sizes)
    found = []
    for up in (True, False):
        at = band + (0 if up else 1)
        parts, need = bands.parts[at], bands.needed(sizes, at)
        where = np.concatenate(([0], np.cumsum(parts)))
        # A multiplication deals the feature to a part; the band is mixed in, so that the parts of two bands are unrelated.
        spread = mix(features + _B * at[owner].astype(np.uint64))
        slot = where[owner] + ((spread >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        filled = np.bincount(slot, minlength=where[-1])
        content = np.zeros(where[-1], np.uint64)
        np.add.at(content, slot, mix(features ^ _A))
        part_of = ranges(np.zeros(n, np.int64), parts)
        holder = np.repeat(np.arange(n), parts)
        rank = np.argsort((holder << 24) - filled, kind="stable")
        chosen = rank[ranges(where[:-1], np.where(sizes > 0, need, 0))]
        who = holder[chosen]
        found.append((mix(mix(content[chosen] + _C * filled[chosen].astype(np.uint64)) + _A * part_of[chosen].astype(np.uint64) + _B * at[who].astype(np.uint64)), who, np.full(len(who), up)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
