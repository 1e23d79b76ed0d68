"""Word shingles as 64-bit hashes, computed for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
SEED = 0x9E3779B97F4A7C15
STEP = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2^64
STEP_BACK = np.uint64(pow(int(STEP), -1, 1 << 64))
SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


class Shingler:
    """Shingles of `size` words; words are split at ASCII white space, A-Z lower-cased."""

    def __init__(self, size: int = 5):
        self.size = size
        self.letter = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(SEED))
        upper = np.arange(65, 91)
        self.letter[upper] = self.letter[upper + 32]
        self.place = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
        self.up = self.down = np.zeros(0, np.uint64)

    def _words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word. A word's hash is a polynomial taken from prefix sums."""
        raw = np.frombuffer(data, np.uint8)
        n = len(raw)
        if n > len(self.up):
            self.up, self.down = _powers(STEP, n), _powers(STEP_BACK, n)
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = ~SPACE[raw]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.letter[raw] * self.up[:n], out=sums[1:])
        return start, mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def _chunk(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        start, word = self._words(b" ".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        bound = np.searchsorted(start, ends)
        n = max(0, len(word) - self.size + 1)
        joined = np.zeros(n, np.uint64)
        for j in range(self.size):
            joined += word[j : j + n] * self.place[j]
        joined = mix(joined)
        first = 0
        for last in bound:
            count = last - first
            if count >= self.size:
                yield joined[first : last - self.size + 1]
            elif count:
                yield mix((word[first:last] * self.place[:count]).sum(keepdims=True) + np.uint64(count))
            else:
                yield joined[:0]
            first = last

    def hashes(self, texts: list[str]) -> Iterator[np.ndarray]:
        """All shingle hashes of each text in turn, repeats kept.

        A text of fewer words than a shingle, but not none, is one shingle. Texts are taken
        in chunks of about 1 MB, so memory is about 60 bytes a byte of the longest text.
        """
        chunk: list[bytes] = []
        held = 0
        for text in texts:
            data = text.encode()
            if chunk and held + len(data) > CHUNK_BYTES:
                yield from self._chunk(chunk)
                chunk, held = [], 0
            chunk.append(data)
            held += len(data)
        if chunk:
            yield from self._chunk(chunk)
