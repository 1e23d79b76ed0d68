"""Monotone integers in Elias-Fano form, searched in bulk by numpy, and a file of such levels that tasks map."""

from __future__ import annotations

import json
import mmap
import os

import numpy as np

U64 = np.uint64
ONE = U64(1)


def _select(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the set bit number `rank` (from 0) in each word."""
    place = np.zeros(len(words), dtype=U64)
    left = rank.astype(U64)
    for step in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count((words >> place) & U64((1 << step) - 1)).astype(U64)
        up = left >= below
        left -= np.where(up, below, U64(0))
        place += np.where(up, U64(step), U64(0))
    return place.astype(np.int64)


class EliasFano:
    """Sorted values (ties allowed): low bits packed, high bits in unary, zeros counted before each word."""

    def __init__(self, n: int, shift: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.shift, self.low, self.high, self.zeros = n, shift, low, high, zeros

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """`values` ascend and lie below `universe`, at most 2 ** 64."""
        values = values.astype(U64)
        n = len(values)
        shift = max(0, (universe // max(1, n)).bit_length() - 1)
        low = np.zeros((n * shift + 63) // 64 + 1, dtype=U64)
        if shift:
            at = np.arange(n, dtype=np.int64) * shift
            word, bit = at >> 6, (at & 63).astype(U64)
            kept = values & U64((1 << shift) - 1)
            np.add.at(low, word, kept << bit)  # the bits are disjoint, so sums are unions
            over = bit.astype(np.int64) + shift > 64
            np.add.at(low, word[over] + 1, kept[over] >> (U64(64) - bit[over]))
        ones = (values >> U64(shift)).astype(np.int64) + np.arange(n, dtype=np.int64)
        bits = (max(0, universe - 1) >> shift) + 1 + n
        high = np.zeros(bits // 64 + 2, dtype=U64)
        np.add.at(high, ones >> 6, ONE << (ones & 63).astype(U64))
        return cls(n, shift, low, high, cls._zeros(high))

    @staticmethod
    def _zeros(high: np.ndarray) -> np.ndarray:
        before = np.zeros(len(high), dtype=np.int64)
        np.cumsum(64 - np.bitwise_count(high[:-1]).astype(np.int64), out=before[1:])
        return before

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(i), dtype=U64)
        at = i * self.shift
        word, bit = at >> 6, (at & 63).astype(U64)
        rest = (U64(64) - bit) & U64(63)
        over = np.where(bit > 0, self.low[np.minimum(word + 1, len(self.low) - 1)] << rest, U64(0))
        return ((self.low[word] >> bit) | over) & U64((1 << self.shift) - 1)

    def _up_to(self, bucket: np.ndarray) -> np.ndarray:
        """How many values have high bits of at most `bucket`: the zero that ends it, less the zeros before."""
        word = np.searchsorted(self.zeros, bucket, side="right") - 1
        place = _select(~self.high[word], bucket - self.zeros[word])
        return word * 64 + place - bucket

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The values at places `i`."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros
        word = np.searchsorted(ones, i, side="right") - 1
        high = word * 64 + _select(self.high[word], i - ones[word]) - i
        return (high.astype(U64) << U64(self.shift)) | self._lows(i)

    def _search(self, x: np.ndarray, begin: np.ndarray | int, end: np.ndarray | int | None) -> tuple[np.ndarray, np.ndarray]:
        """The successor, and where the values that share its high bits end."""
        x = x.astype(U64)
        bucket = (x >> U64(self.shift)).astype(np.int64)
        first = np.where(bucket > 0, self._up_to(np.maximum(bucket - 1, 0)), 0)
        end = self.n if end is None else end
        last = np.minimum(self._up_to(bucket), end)
        low, high = np.minimum(np.maximum(first, begin), end), last.copy()
        wanted = x & U64((1 << self.shift) - 1)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            less = self._lows(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        return low, last

    def successor(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """First place in [begin, end) of a value of at least `x`, else `end`."""
        return self._search(x, begin, end)[0]

    def find(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Place of `x` in [begin, end), or -1."""
        if not self.n or not len(x):
            return np.full(len(x), -1, dtype=np.int64)
        at, last = self._search(x, begin, end)
        # The successor is `x` itself if both halves agree: it lies before `last`, and its low bits are those of `x`.
        hit = np.flatnonzero(at < last)
        same = self._lows(at[hit]) == x[hit].astype(U64) & U64((1 << self.shift) - 1)
        out = np.full(len(x), -1, dtype=np.int64)
        out[hit[same]] = at[hit[same]]
        return out


def write_levels(path: str, levels: dict[str, np.ndarray | EliasFano]) -> None:
    """One file of named levels; another attempt of the same task replaces it whole."""
    head, parts, at = {}, [], 0
    for name, level in levels.items():
        arrays = [level.low, level.high, level.zeros] if isinstance(level, EliasFano) else [level]
        head[name] = {"n": level.n, "shift": level.shift} if isinstance(level, EliasFano) else {}
        head[name]["parts"] = []
        for array in arrays:
            head[name]["parts"].append([array.dtype.str, at, len(array)])
            data = array.tobytes()
            parts.append(data + b"\0" * (-len(data) % 8))
            at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    own = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    with open(own, "wb") as f:
        f.write(len(text).to_bytes(8, "little") + text)
        f.writelines(parts)
    os.replace(own, path)


def map_levels(path: str) -> dict[str, np.ndarray | EliasFano]:
    """The levels of a file as views of its mapped pages."""
    with open(path, "rb") as f:
        held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(held[:8], "little")
    out: dict[str, np.ndarray | EliasFano] = {}
    for name, level in json.loads(held[8 : 8 + size]).items():
        arrays = [np.frombuffer(held, dtype=kind, count=n, offset=8 + size + at) for kind, at, n in level["parts"]]
        out[name] = EliasFano(level["n"], level["shift"], *arrays) if "shift" in level else arrays[0]
    return out
