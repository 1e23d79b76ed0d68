"""DartMinHash: sparse weighted signatures whose coordinates agree with the weighted Jaccard chance.

Picture for each element a plane of weight against time, into which darts fall at random
with density 1. Hashes of the element decide where, so all documents see the same darts. A
dart counts for a document if it lies below the element's weight there. Each dart also
belongs to one of `k` coordinates; the earliest dart of a coordinate is its signature. The
planes are cut into cells whose sides double, so a document only looks at the cells below
its weights and before its own time limit, which is set so that about `k ln k + 3k` darts
count: the work is that plus one look for each element, whatever `k` is.
"""

from __future__ import annotations

import math

import numpy as np

from veilcorpus.llm.shingles import Shingler, mix

# A key holds the dart's time as a fixed-point number (18 bits before the point) above 24 bits of its name.
TIME_BITS, ID_BITS, PART_BITS = 22, 24, 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _poisson(mean: float) -> np.ndarray:
    """Distribution function of a Poisson count, far enough out for 53-bit uniforms."""
    n = np.arange(int(mean + 12 * math.sqrt(mean) + 24))
    terms = -mean + n * math.log(mean) - np.array([math.lgamma(i + 1) for i in n])
    return np.cumsum(np.exp(terms))


class DartSketch:
    def __init__(self, k: int):
        self.k = k
        self.darts = k * math.log(k) + 3 * k
        self.counts: dict[int, np.ndarray] = {}

    def _throw(self, sig, element, weight, owner, limit) -> None:
        """Darts of these elements: `limit` is the time limit of each owner."""
        own_limit = limit[owner]
        for v in range(int(math.log2(1 + weight.max())) + 1):
            low_w, wide = (1 << v) - 1, 1 << v
            last = own_limit[weight > low_w].max(initial=0)
            r = 0
            while (low_t := (1 << r) >> 1) < last:
                long = max(1, low_t)
                some = np.flatnonzero((weight > low_w) & (own_limit > low_t)) if v or r else np.arange(len(element))
                self._cell(sig, element[some], weight[some], owner[some], own_limit[some], (v, low_w, wide), (r, low_t, long))
                r += 1

    def _cell(self, sig, element, weight, owner, limit, by_weight, by_time) -> None:
        (v, low_w, wide), (r, low_t, long) = by_weight, by_time
        area = wide * long
        if area not in self.counts:
            self.counts[area] = _poisson(area)
        name = mix(element + np.uint64(0x9E3779B97F4A7C15 * (1 + v * 64 + r) & 0xFFFFFFFFFFFFFFFF))
        number = np.searchsorted(self.counts[area], (name >> np.uint64(11)) * 2.0**-53, side="right")
        at = np.repeat(np.arange(len(element)), number)
        if not len(at):
            return
        nth = np.arange(len(at)) - np.repeat(np.cumsum(number) - number, number)
        dart = mix(name[at] + np.uint64(0xD1B54A32D192ED03) * (nth.astype(np.uint64) + np.uint64(1)))
        part = np.uint64((1 << PART_BITS) - 1)
        time = (dart >> np.uint64(64 - TIME_BITS)) * np.uint64(long) + np.uint64(low_t << TIME_BITS)
        counts = time < limit[at] * 2.0**TIME_BITS
        if v or (weight < 1).any():
            height = ((dart >> np.uint64(PART_BITS)) & part) * (wide * 2.0**-PART_BITS) + low_w
            counts &= height < weight[at]
        at, dart, time = at[counts], dart[counts], time[counts]
        coordinate = ((dart & part) * np.uint64(self.k)) >> np.uint64(PART_BITS)
        key = (time << np.uint64(ID_BITS)) | (mix(dart) >> np.uint64(64 - ID_BITS))
        np.minimum.at(sig, owner[at] * self.k + coordinate.astype(np.int64), key)

    def sketch(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Signatures, one row for each (element hashes, weights); sets may not be empty.

        Where a coordinate stays empty, that document's time limit is doubled and its darts
        are thrown again, until all are filled; earlier darts stay the same.
        """
        total = np.array([w.sum() for _, w in sets], float)
        limit = self.darts / total
        sig = np.full(len(sets) * self.k, NONE)
        todo = np.arange(len(sets))
        while len(todo):
            element = np.concatenate([sets[i][0] for i in todo])
            weight = np.concatenate([sets[i][1] for i in todo])
            owner = np.repeat(todo, [len(sets[i][0]) for i in todo])
            self._throw(sig, element, weight.astype(float), owner, limit)
            todo = np.flatnonzero((sig.reshape(len(sets), self.k) == NONE).any(axis=1))
            limit[todo] *= 2
        return sig.reshape(len(sets), self.k)


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash for each band of coordinates; the band's number is part of it."""
    rows = sig.shape[1] // bands
    cut = mix(sig[:, : bands * rows]).reshape(len(sig), bands, rows)
    place = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)).reshape(bands, rows) | np.uint64(1)
    return mix((cut * place).sum(axis=2, dtype=np.uint64)).view(np.int64)


def weighted_sets(shingler: Shingler, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles of each text, sorted, with how often each occurs as its weight."""
    return [np.unique(h, return_counts=True) for h in shingler.hashes(texts)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger; 0 if a set is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    low = int(np.minimum(a[1], b[1][at])[same].sum())
    return low / (int(a[1].sum()) + int(b[1].sum()) - low)


def parity_maps(sets: list[tuple[np.ndarray, np.ndarray]], words: int) -> np.ndarray:
    """A bit map of 64 * `words` bits for each set: every unit of weight flips one bit.

    Two maps differ in at most as many bits as the sets differ in units of weight, which
    bounds their similarity from above without any chance of error.
    """
    out = np.zeros((len(sets), words), np.int64)
    for row, (element, weight) in zip(out, sets):
        unit = np.repeat(element, weight)
        nth = np.arange(len(unit)) - np.repeat(np.cumsum(weight) - weight, weight)
        place = mix(unit + nth.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)) % np.uint64(64 * words)
        odd = (np.bincount(place.astype(np.int64), minlength=64 * words) & 1).astype(np.uint8)
        row[:] = np.packbits(odd, bitorder="little").view(np.int64)
    return out
