"""SentencePiece encoding by sampling segmentations, and decoding that restores every text.

All segmentations of a text into vocabulary pieces form a lattice. Forward filtering gives
each position the total probability of the paths that reach it; backward sampling then
walks from the end, choosing each piece in proportion. Draws come from a hash of the row
key and the place in the text, so a row gets the same pieces wherever and whenever it runs.

Two neighbouring characters that stand together in no piece cut the lattice exactly, so a
text falls into short independent segments. Equal segments share one forward pass: a worker
holds the lattices it knows, up to a bound that changes no result. All steps run on arrays that
hold every segment of a chunk of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.llm.batches import small_batches
from veilcorpus.llm.shingles import mix

BLANK = "▁"  # stands for a space inside pieces
CHUNK_CHARS = 400_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
HELD_CHARS = 1_000_000


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.room, self.size = np.empty(1 << 10, kind), 0

    def __len__(self) -> int:
        return self.size

    def extend(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.room):
            room = np.empty(max(size, 2 * len(self.room)), self.room.dtype)
            room[: self.size] = self.view()
            self.room = room
        self.room[self.size : size] = values
        self.size = size

    def view(self) -> np.ndarray:
        return self.room[: self.size]


class Vocabulary:
    """Pieces of a model with weights, as a character trie in sorted arrays.

    A byte-pair model ranks its pieces but gives no probabilities; a piece of rank r gets
    weight 1 / (r + 1), the usual law of word frequencies, to the power 1 / `temperature`.
    A unigram model's scores are log-probabilities and are used as they are. Lattices are held
    until their segments have more than `most` characters, then all are forgotten.
    """

    def __init__(self, model_path: str, temperature: float = 1.0, ranked: bool = True, most: int = HELD_CHARS):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.surface: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, np.int32)
        pieces: list[tuple[str, int]] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.surface[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append((piece, i))
                self.surface[i] = piece.replace(BLANK, " ").encode()
        self.surfaces = pa.array(self.surface, pa.large_binary())
        singles = {p for p, _ in pieces if len(p) == 1}
        pieces = [(p, i) for p, i in pieces if singles.issuperset(p)]
        if BLANK not in singles:
            raise ValueError("the model has no piece for a space")
        alphabet = sorted(singles)
        number = {c: k + 1 for k, c in enumerate(alphabet)}
        #: Number of each code point; 0: in no piece. A space is the blank; the blank's own character is in no piece.
        self.number = np.zeros(0x110000, np.int32)
        for c, k in number.items():
            self.number[ord(c)] = k
        self.number[0x20], self.number[ord(BLANK)] = number[BLANK], 0
        self.width = len(alphabet) + 1
        self.joined = np.zeros(self.width * self.width, bool)

        states: dict[tuple[int, int], int] = {}
        piece_at: dict[int, int] = {}
        for piece, i in pieces:
            state = 0
            codes = [number[c] for c in piece]
            for a, b in zip(codes, codes[1:]):
                self.joined[a * self.width + b] = True
            for code in codes:
                state = states.setdefault((state, code), len(states) + 1)
            piece_at[state] = i
        keys = np.array([s * self.width + c for s, c in states], np.int64)
        order = np.argsort(keys)
        self.edge, self.target = keys[order], np.array(list(states.values()), np.int64)[order]
        self.piece = np.full(len(states) + 1, -1, np.int64)
        self.piece[list(piece_at)] = list(piece_at.values())
        score = np.array([model.get_score(i) for i in range(size)])
        self.log_weight = (-np.log1p(np.maximum(0, -score)) if ranked else score) / temperature
        #: Characters of each piece, and the state after each first character.
        self.chars = np.zeros(size, np.int64)
        self.chars[[i for _, i in pieces]] = [len(p) for p, _ in pieces]
        self.root = np.zeros(self.width, np.int64)
        self.root[[code for state, code in states if not state]] = [target for (state, _), target in states.items() if not state]
        self.most = most
        self._forget(1)

    def _arcs(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pieces inside segments, shorter ones first: start nodes and states of each length. A 0 follows each segment."""
        at = np.flatnonzero(codes)
        state = self.root[codes[at]]
        length = 1
        while len(at):
            full = self.piece[state] >= 0
            yield at[full], state[full]
            key = state * self.width + codes[at + length]
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            known = self.edge[place] == key
            at, state = at[known], self.target[place[known]]
            length += 1

    def _filter(self, codes: np.ndarray, node0: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward pass over distinct segments. A node stands before each character and, with code 0, after the last.

        Returns the number of arcs that end at each node and, sorted by that node and by length, the arcs'
        pieces and the running sums of their chances in 1 / 2^32, of which the last of a node is not used.
        """
        n = len(codes)
        found = [(at + length, self.piece[state]) for length, (at, state) in enumerate(self._arcs(codes), 1)]
        count = np.zeros(n, np.int64)
        for sinks, _ in found:
            count[sinks] += 1  # pieces of one length end at different nodes
        head = np.cumsum(count) - count
        free = head.copy()
        piece = np.zeros(int(count.sum()), np.int32)
        for sinks, pieces in found:
            place = free[sinks]
            piece[place] = pieces
            free[sinks] = place + 1
        sink = np.repeat(np.arange(n), count)
        source, weight = sink - self.chars[piece], self.log_weight[piece]

        # Nodes that are equally far into their segments are filled at once.
        depth = (np.arange(n) - np.repeat(node0, size + 1))[sink]
        deepest = int(size.max())
        order = np.argsort(depth.astype(np.uint16) if deepest < 1 << 16 else depth, kind="stable")
        sinks, sources, weights = sink[order], source[order], weight[order]
        first = np.append(True, sinks[1:] != sinks[:-1])
        group, heads = np.cumsum(first) - 1, np.flatnonzero(first)
        bounds = np.searchsorted(depth[order], np.arange(1, deepest + 2))
        reach = np.zeros(n)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            value = reach[sources[lo:hi]] + weights[lo:hi]
            local = group[lo:hi] - group[lo]
            starts = heads[group[lo] : group[hi - 1] + 1]
            top = np.maximum.reduceat(value, starts - lo)
            reach[sinks[starts]] = top + np.log(np.bincount(local, np.exp(value - top[local])))
        chance = np.exp(reach[source] + weight - reach[sink])
        share = np.maximum((chance * 2.0**32).astype(np.int64), 1)
        run = np.cumsum(share)
        before = (run - share)[head[sink]]
        return count, piece, np.minimum(run - before, (1 << 32) - 1).astype(np.uint32)

    def _learn(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        """Hold the lattices of some more segments, given by their places in `codes`."""
        node0 = np.cumsum(size + 1) - (size + 1)
        padded = np.zeros(int((size + 1).sum()), np.int64)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        padded[np.repeat(node0, size) + inside] = codes[np.repeat(first, size) + inside]
        count, piece, ladder = self._filter(padded, node0, size)
        self.held_node0.extend(len(self.held_codes) + node0)
        self.held_codes.extend(padded)
        self.held_end.extend(len(self.held_piece) + np.cumsum(count))
        self.held_piece.extend(piece)
        self.held_ladder.extend(ladder)

    def _forget(self, seed: int) -> None:
        self.seed = seed
        self.held: dict[int, int] = {}  # number of each segment, by its hash
        self.held_node0 = Grown(np.int64)  # of each segment, the node before its first character
        self.held_codes = Grown(np.int32)  # of each node, the character after it
        self.held_end = Grown(np.int64)  # of each node, the end of its arcs
        self.held_piece, self.held_ladder = Grown(np.int32), Grown(np.uint32)  # of each arc

    def _lattices(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segments in an order that puts equal ones together, and the first node of each one's lattice, in that order.

        A segment is looked up by a hash and then compared character by character; on a clash of hashes
        all is forgotten and another hash taken.
        """
        if len(self.held_codes) > self.most:
            self._forget(self.seed)
        inside = np.arange(len(codes)) - np.repeat(first, size)
        while True:
            value = mix((codes.astype(np.uint64) << np.uint64(32)) + inside.astype(np.uint64) + np.uint64(self.seed * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(value, out=sums[1:])
            name = mix(sums[first + size] - sums[first])
            order = np.argsort(name)
            name = name[order]
            fresh = np.append(True, name[1:] != name[:-1])
            names, where = name[fresh].tolist(), order[fresh]
            numbers = list(map(self.held.get, names))
            if None in numbers:
                new = [i for i, number in enumerate(numbers) if number is None]
                self.held.update(zip([names[i] for i in new], range(len(self.held), len(self.held) + len(new))))
                self._learn(codes, first[where[new]], size[where[new]])
                numbers = list(map(self.held.__getitem__, names))
            node0 = self.held_node0.view()[numbers][np.cumsum(fresh) - 1]
            stop, held = np.empty_like(node0), self.held_codes.view()
            stop[order] = node0
            if (held[np.repeat(stop, size) + inside] == codes).all() and not held[stop + size].any():
                return order, node0
            self._forget(self.seed + 1)

    def _draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The arc by which each node is left backwards, for draws `u` below 2^32: the first one whose running sum is above."""
        end, ladder = self.held_end.view(), self.held_ladder.view()
        lo, hi = end[node - 1], end[node] - 1
        for _ in range(int((hi - lo).max()).bit_length()):
            middle = (lo + hi) >> 1
            above = ladder[middle] > u
            # With one arc left, `middle` is that arc; it stays whatever the comparison says.
            lo, hi = np.where(above | (lo == hi), lo, middle + 1), np.where(above, middle, hi)
        return lo

    def _chunk(self, texts: list[str], seeds: np.ndarray) -> Iterator[np.ndarray]:
        points = np.frombuffer("".join([" " + t if t else "" for t in texts]).encode("utf-32-le"), np.uint32)
        if not len(points):
            yield from (np.zeros(0, np.int32) for _ in texts)
            return
        doc_end = np.cumsum([len(t) + 1 if t else 0 for t in texts])
        codes = self.number[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joined[codes[:-1].astype(np.int64) * self.width + codes[1:]]
        cut[doc_end[doc_end < len(points)]] = True
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, len(points)))
        doc_bounds = np.append(0, np.searchsorted(first, doc_end))
        in_doc = np.diff(doc_bounds)
        known = codes[first] > 0

        # Characters in no piece are segments of their own and become their UTF-8 bytes.
        raw = [chr(p).encode() for p in points[first[~known]].tolist()]
        number_of = np.zeros(len(first), np.int64)
        number_of[~known] = [len(b) for b in raw]

        own = np.flatnonzero(known)
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        if len(own):
            f2 = np.cumsum(size[own]) - size[own]
            order, stop = self._lattices(codes[codes > 0] if raw else codes, f2, size[own])
            at = own[order]
            nth = np.arange(len(first)) - np.repeat(doc_bounds[:-1], in_doc)
            base = mix((np.repeat(seeds, in_doc) + GOLDEN * (nth.astype(np.uint64) + np.uint64(1)))[at])
            node = stop + size[at]
            step = 0
            while len(at):
                u = (mix(base + np.uint64(step)) >> np.uint64(32)).astype(np.uint32)
                piece = self.held_piece.view()[self._draw(node, u)]
                drawn.append((at, piece))
                number_of[at] += 1
                node = node - self.chars[piece]
                left = node > stop
                at, base, node, stop = at[left], base[left], node[left], stop[left]
                step += 1
        offset = np.append(0, np.cumsum(number_of))
        out = np.zeros(offset[-1], np.int32)
        for step, (at, piece) in enumerate(drawn):
            out[offset[at + 1] - 1 - step] = piece
        if raw:
            lengths = number_of[~known]
            inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out[np.repeat(offset[:-1][~known], lengths) + inner] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        bounds = offset[doc_bounds]
        yield from (out[a:b] for a, b in zip(bounds[:-1], bounds[1:]))

    def encode(self, texts: list[str], seeds: np.ndarray) -> Iterator[np.ndarray]:
        """A sampled segmentation of each text.

        Memory is some 200 bytes a character of a chunk or of the longest text, and some 50 bytes a held character.
        """
        at = 0
        while at < len(texts):
            held, end = 0, at
            while end < len(texts) and (end == at or held + len(texts[end]) <= CHUNK_CHARS):
                held += len(texts[end])
                end += 1
            yield from self._chunk(texts[at:end], seeds[at:end])
            at = end

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.surface.__getitem__, ids.tolist())).decode(errors="replace")[1:]

    def restores(self, texts: list[str], coded: list[np.ndarray]) -> list[bool]:
        """Whether the ids of each text stand for its UTF-8 bytes after a blank; an empty text has no id."""
        if not texts:
            return []
        joined = self.surfaces.take(pa.array(np.concatenate(coded)))
        data = joined.buffers()[2].to_pybytes() if joined.buffers()[2] else b""
        ends = np.frombuffer(joined.buffers()[1], np.int64)[np.append(0, np.cumsum([len(ids) for ids in coded]))].tolist()
        return [data[lo:hi] == (" " + text if text else "").encode() for text, lo, hi in zip(texts, ends, ends[1:])]


@lru_cache(maxsize=1)
def held_vocabulary(model_path: str, temperature: float = 1.0, ranked: bool = True) -> Vocabulary:
    """The vocabulary of this Python worker, which keeps the lattices it knows from one task to the next."""
    return Vocabulary(model_path, temperature, ranked)


def sampled_pieces(
    text: Column, row_key: Column, model_path: str, *, seed: int = 0, temperature: float = 1.0, ranked: bool = True
) -> Column:
    """A struct `ids, restored`: a segmentation of `text` drawn by `row_key` and `seed`, and whether decoding gives the text back.

    Null text gives null ids and counts as restored; empty text has no id. Rows with equal
    key and text get equal ids; a null key is a key like any other.
    """

    @F.pandas_udf("ids array<int>, restored boolean")
    def encode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        vocabulary = held_vocabulary(model_path, temperature, ranked)
        for texts, keys in batches:
            there = texts.notna().to_numpy()
            own = list(texts[there])
            found = list(vocabulary.encode(own, keys.to_numpy()[there].astype(np.int64).view(np.uint64)))
            ids = np.full(len(texts), None, object)
            back = np.ones(len(texts), bool)
            back[there] = vocabulary.restores(own, found)
            for i, coded in zip(np.flatnonzero(there), found):
                ids[i] = coded
            yield pd.DataFrame({"ids": ids, "restored": back})

    return encode(text, F.xxhash64(F.lit(seed), row_key.cast("string")))


def restored_text(ids: Column, model_path: str) -> Column:
    """The text that ids stand for: spaces and byte pieces are put back, the leading blank taken off. Null gives null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = held_vocabulary(model_path)
        for batch in batches:
            yield pd.Series([None if ids is None else vocabulary.decode(np.asarray(ids, np.int64)) for ids in batch], dtype=object)

    return decode(ids)


def encode_and_restore(docs: DataFrame, model_path: str, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Add `ids`, `n_ids` and `lossless`: whether decoding the ids gives the text back.

    Columns of these names are replaced, others are kept. Null text: null ids, 0 of them, lossless.
    """
    small_batches(docs.sparkSession)
    coded = docs.withColumn("lossless", sampled_pieces(F.col(text), F.col(doc_id), model_path, **options))
    ids = F.col("lossless")["ids"]
    return coded.withColumns({"ids": ids, "n_ids": F.coalesce(F.size(ids), F.lit(0)).cast("bigint"), "lossless": F.col("lossless")["restored"]})
