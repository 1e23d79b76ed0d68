"""Token ids as compressed planes: encode documents, write chunks, read them back.

A chunk holds the ids of whole consecutive documents. Its ids are cut into blocks of a
fixed number; each block is transposed into planes, one for each byte (or bit) of an id,
so that the slowly varying high parts of neighbouring ids lie together, and each plane is
compressed with zstandard. Planes that are zero throughout are stored as nothing.

A dataset is two Parquet tables below one path. `chunks` holds a row a chunk: the planes
and the document boundaries. `index` holds a row a chunk without the planes: shard, chunk,
first and last document, number of ids and the position of its first id in the whole
stream. Spark's committer writes both, so a task that runs twice leaves one copy.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veilcorpus.llm.batches import small_batches

BLOCK_IDS = 1 << 14
CHUNK_IDS = 1 << 17
LEVEL = 3
UNITS = ("byte", "bit")
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# Kinds of UTF-8 bytes: letters that are so in any version of Unicode (in ASCII, and from U+00C0 to U+017F but for two
# signs), ASCII marks but the apostrophe (which may start a contraction), a line end, a blank, and anything else.
OTHER, LETTER, MARK, LINE_END, BLANK = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[[b for b in range(128) if chr(b).isalpha()]] = LETTER
KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = MARK
KIND[0x0A], KIND[0x20] = LINE_END, BLANK
LATIN = np.isin(np.arange(256), (0xC3, 0xC4, 0xC5))  # first bytes of those letters


def has_odd_blank(text: str) -> bool:
    """Whether a blank may stand at an end or beside other white space; true as well for any rarer white space."""
    return (
        text[:1] == " " or text[-1:] == " " or "  " in text or " \n" in text or "\n " in text or any(c in text for c in OTHER_SPACE)
    )

CHUNK_TYPE = (
    "shard int, chunk bigint, shard_start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "unit string, block_ids int, planes array<array<binary>>"
)


def to_planes(ids: np.ndarray, unit: str = "byte") -> list[bytes]:
    """Planes of one block of unsigned 32-bit ids, lowest first; trailing zero planes are left out."""
    parts = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        planes = np.packbits(np.unpackbits(parts, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(parts.T)
    used = np.flatnonzero(planes.any(axis=1))
    return [planes[i].tobytes() for i in range(used[-1] + 1 if len(used) else 0)]


def from_planes(planes: list[bytes], n: int, unit: str = "byte") -> np.ndarray:
    """The `n` ids of a block; planes that are missing are zero."""
    if unit == "bit":
        bits = np.zeros((32, n), np.uint8)
        for i, plane in enumerate(planes):
            bits[i] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
        parts = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        parts = np.zeros((n, 4), np.uint8)
        for i, plane in enumerate(planes):
            parts[:, i] = np.frombuffer(plane, np.uint8)
    return np.ascontiguousarray(parts).view("<u4").reshape(-1)


class WordCache:
    """Encodes texts with a byte-level BPE tokenizer, each distinct word once.

    Such a tokenizer cuts a text before every blank that stands between two characters that
    are no white space, and never merges across a cut; so the ids of a text are those of its
    pieces in turn. Other white space stays inside a piece. Words are cut further where the tokenizer always
    cuts, by the kinds of their bytes, and told apart by Arrow, many texts at a time, so that each distinct
    part is looked up once. Unknown ones that start words go to the tokenizer many at a time, joined by their blanks,
    and are told apart by the lengths of the tokens.
    A text that holds an added token (such as an end mark written out) goes to the tokenizer as a
    whole, since such tokens are cut out before anything else. Words, and pieces, are held in two generations
    of a quarter of `most` each: when the younger one is full, the older one goes, and words that come again
    in the meantime move over. That bounds memory and changes no result.
    """

    def __init__(self, tokenizer_path: str, most: int = 2_000_000):
        # Spark runs a task on each core already; more threads in it would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # In the vocabulary's spelling each character stands for one byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.length[number] = len(token)
        self.most = most
        # The younger and the older generation of parts of words (a first one with its blank), and of anything else as it is.
        self.held: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {"words": ({}, {}), "pieces": ({}, {})}

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), 64):
            for found in self.tokenizer.encode_batch_fast(texts[i : i + 64], add_special_tokens=False):
                yield np.array(found.ids, "<u4")

    @staticmethod
    def part_starts(data: np.ndarray) -> np.ndarray:
        """Where the parts of words start in UTF-8 bytes, of which the first is a blank and no two neighbours are.

        A word starts with its blank. If it holds letters, marks and single line ends only, runs of
        each are parts, between which the tokenizer always cuts; else it is one part.
        """
        kind = KIND[data]
        latin = np.flatnonzero(LATIN[data])
        second = data[latin + 1]
        latin = latin[(data[latin] != 0xC3) | ((second != 0x97) & (second != 0xB7))]
        kind[latin] = kind[latin + 1] = LETTER
        blanks = np.flatnonzero(kind == BLANK)
        odd = kind == OTHER
        odd[1:] |= (kind[1:] == LINE_END) & (kind[:-1] == LINE_END)
        whole = np.zeros(len(blanks), bool)
        whole[np.searchsorted(blanks, np.flatnonzero(odd)) - 1] = True
        turn = kind[1:] != kind[:-1]
        turn &= (kind[1:] != BLANK) & (kind[:-1] != BLANK)
        turns = np.flatnonzero(turn) + 1
        turns = turns[~whole[np.searchsorted(blanks, turns) - 1]]
        start = kind == BLANK
        start[turns] = True
        return np.flatnonzero(start)

    def _learn_parts(self, parts: list[str]) -> Iterator[bytes]:
        firsts = self._learn_firsts([part[1:] for part in parts if part[0] == " "])
        others = self._learn_pieces([part for part in parts if part[0] != " "])
        return (next(firsts) if part[0] == " " else next(others) for part in parts)

    def _learn_firsts(self, words: list[str]) -> Iterator[bytes]:
        groups = [words[i : i + 64] for i in range(0, len(words), 64)]
        for group, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups])):
            word_ends = np.cumsum([len(w.encode()) + 1 for w in group])
            cuts = 4 * (np.searchsorted(np.cumsum(self.length[ids]), word_ends) + 1)
            raw, start = ids.tobytes(), 0
            for end in cuts.tolist():
                yield raw[start:end]
                start = end

    def _learn_pieces(self, pieces: list[str]) -> Iterator[bytes]:
        return (ids.tobytes() for ids in self._encode(pieces))

    @staticmethod
    def odd_pieces(text: str) -> list[str]:
        """Pieces of a text in which a blank stands beside other white space or at an end."""
        first, *parts = text.split(" ")
        out = [first]
        for part in parts:
            if part and not part[0].isspace() and out[-1] and not out[-1][-1].isspace():
                out.append(" " + part)
            else:
                out[-1] += " " + part
        return out

    def _look_up(self, kind: str, wanted: list[str], learn: Callable[[list[str]], Iterable[bytes]]) -> list[bytes]:
        """Ids of each of some distinct words or pieces; what the older generation holds moves to the younger one."""
        young, old = self.held[kind]
        found = list(map(young.get, wanted))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            held = [old.get(wanted[i]) for i in missing]
            unknown = [i for i, ids in zip(missing, held) if ids is None]
            for i, ids in zip(missing, held):
                found[i] = ids
            for i, ids in zip(unknown, learn([wanted[i] for i in unknown])):
                found[i] = ids
            young.update((wanted[i], found[i]) for i in missing)
            if len(young) > self.most // 4:
                self.held[kind] = ({}, young)
        return found

    def _encode_words(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text of words between single blanks, each of which follows a blank as well."""
        if not texts:
            return []
        raw = "".join([" " + text for text in texts]).encode()
        starts = self.part_starts(np.frombuffer(raw, np.uint8))
        offsets = pa.py_buffer(np.append(starts, len(raw)).astype(np.int64))
        coded = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(raw)).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self._look_up("words", distinct, self._learn_parts)
        joined = pa.array(found, pa.large_binary()).take(coded.indices)
        ids = np.frombuffer(joined.buffers()[2], "<u4")
        text_starts = np.cumsum([len(text.encode()) + 1 for text in texts[:-1]])
        ends = np.frombuffer(joined.buffers()[1], np.int64)[np.searchsorted(starts, text_starts)]
        return np.split(ids, ends >> 2)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text in turn."""
        # A text becomes pieces, words and pieces again (the words' place in `middles`), or stays whole.
        cut: list[tuple[list[str], int | None, list[str]] | str] = []
        middles: list[str] = []
        new_pieces: set[str] = set()
        for text in texts:
            if any(mark in text for mark in self.added):
                cut.append(text)
                continue
            place, tail = None, []
            if has_odd_blank(text):
                head = self.odd_pieces(text)
            else:
                first, blank, middle = text.partition(" ")
                head = [first]
                if blank and middle[-1].isspace():
                    # White space at a word's end belongs to the text's last piece.
                    middle, blank, last = middle.rpartition(" ")
                    tail = [" " + last]
                if blank:
                    place = len(middles)
                    middles.append(middle)
            new_pieces.update(head, tail)
            cut.append((head, place, tail))
        pieces = list(new_pieces)
        piece = dict(zip(pieces, self._look_up("pieces", pieces, self._learn_pieces))).__getitem__
        words = self._encode_words(middles)
        for held in cut:
            if isinstance(held, str):
                yield from self._encode([held])
                continue
            head, place, tail = held
            ends = [np.frombuffer(b"".join(map(piece, part)), "<u4") for part in (head, tail)]
            yield np.concatenate([ends[0], words[place], ends[1]]) if place is not None else np.concatenate(ends)


@lru_cache(maxsize=1)
def word_cache(tokenizer_path: str) -> WordCache:
    """The cache of this Python worker, which keeps what it knows from one task to the next."""
    return WordCache(tokenizer_path)


def _chunk_writer(encoder: Callable[[], WordCache], end_id: int, unit: str, block_ids: int, chunk_ids: int, texts_at_once: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, pack = encoder(), zstandard.ZstdCompressor(level=LEVEL)
        shard = chunk = start = held = 0
        docs: list[int] = []
        ids: list[np.ndarray] = []

        def close() -> pd.DataFrame:
            all_ids = np.concatenate(ids) if ids else np.zeros(0, "<u4")
            planes = [
                [pack.compress(p) for p in to_planes(all_ids[i : i + block_ids], unit)]
                for i in range(0, len(all_ids), block_ids)
            ]
            row = (shard, chunk, start, len(all_ids), docs, [len(x) for x in ids], unit, block_ids, planes)
            return pd.DataFrame([row], columns=[c.split()[0] for c in CHUNK_TYPE.split(", ")])

        end = np.array([end_id], "<u4")
        for batch in batches:
            shard = int(batch["shard"].iloc[0]) if len(batch) else shard
            for i in range(0, len(batch), texts_at_once):
                part = batch.iloc[i : i + texts_at_once]
                texts = [t if t is not None else "" for t in part["text"]]
                for doc, found in zip(part["doc_id"], coder.encode(texts)):
                    docs.append(None if doc is None else int(doc))
                    ids.append(np.concatenate([found, end]))
                    held += len(ids[-1])
                    if held >= chunk_ids:
                        yield close()
                        chunk, start, held, docs, ids = chunk + 1, start + held, 0, [], []
        if docs:
            yield close()

    return write


def write_token_planes(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    unit: str = "byte",
    block_ids: int = BLOCK_IDS,
    chunk_ids: int = CHUNK_IDS,
    texts_at_once: int = 1000,
) -> None:
    """Encode every text, add `end_id` after each, and write the ids in ascending `doc_id` order.

    Documents are dealt into shards by ranges of (doc_id, crc32 of the text), so that rows
    of one id are split too; a null id comes first, and rows equal in both are equal rows or
    next to it, whose order is not defined. A null or empty text is the end id alone. An
    empty table writes no chunk. A document is never cut between chunks, so a chunk is as
    long as its longest document at least. Extra columns are not read.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.crc32(F.col(text)).alias("tie")
    )
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    # Ids travel as text: pandas would turn a column of integers with a null into floats.
    sharded = ordered.select(F.spark_partition_id().alias("shard"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    writer = _chunk_writer(lambda: word_cache(tokenizer_path), end_id, unit, block_ids, chunk_ids, texts_at_once)
    sharded.mapInPandas(writer, CHUNK_TYPE).write.option("compression", "none").parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks")
    slim = chunks.select(
        "shard", "chunk", "shard_start", "n_ids", F.size("doc_ids").alias("n_docs"),
        F.element_at("doc_ids", 1).alias("first_doc"), F.element_at("doc_ids", -1).alias("last_doc"),
    )
    starts = shard_starts(chunks)
    slim.join(starts, "shard").withColumn("start", F.col("base") + F.col("shard_start")).drop("base", "shard_start").write.parquet(f"{path}/index")


def shard_starts(chunks: DataFrame) -> DataFrame:
    """`shard, base`: ids before each shard. One row a shard, so the running sum is small."""
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def chunk_ids_of(planes, n_ids: int, unit: str, block_ids: int) -> np.ndarray:
    """All ids of a chunk."""
    unpack = zstandard.ZstdDecompressor()
    out = [np.zeros(0, "<u4")]
    for k, block in enumerate(planes):
        n = min(block_ids, n_ids - k * block_ids)
        out.append(from_planes([unpack.decompress(p) for p in block], n, unit))
    return np.concatenate(out)


DOC_TYPE = "shard int, doc_id bigint, shard_start bigint, n_tokens bigint, ids_crc32 bigint"


def _indexed_chunks(spark: SparkSession, path: str, wanted: Column) -> DataFrame:
    """The chunks whose index rows are `wanted`, with `start`; planes of others are not read.

    The index has a narrow row a chunk. What is left of it meets the chunks by shard and chunk number, and
    the range of its shards reaches the scan of the planes.
    """
    held = spark.read.parquet(f"{path}/index").filter(wanted).select("shard", "chunk", "start")
    ends = held.agg(F.min("shard").alias("lo"), F.max("shard").alias("hi")).first()  # two numbers
    chunks = spark.read.parquet(f"{path}/chunks")
    chunks = chunks.filter(F.col("shard").between(ends["lo"], ends["hi"])) if ends["lo"] is not None else chunks.limit(0)
    return chunks.join(held, ["shard", "chunk"])


def read_positions(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """`start, ids`: the ids from position `start` up to `stop` of the whole stream, a row a chunk that has some."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = chunk_ids_of(row.planes, row.n_ids, row.unit, row.block_ids)
                lo, hi = max(0, start - row.start), stop - row.start
                yield pd.DataFrame({"start": [row.start + lo], "ids": [ids[lo:hi].astype(np.int64)]})

    met = (F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)
    return _indexed_chunks(spark, path, met).select("start", "planes", "n_ids", "unit", "block_ids").mapInPandas(read, "start bigint, ids array<bigint>")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False, between: tuple[int, int] | None = None) -> DataFrame:
    """Documents read back: `doc_id, start, n_tokens, ids_crc32`, and `ids` if asked for.

    `between` asks for the documents whose ids lie in a range, ends included; the index tells which chunks hold
    them, and only these are read. Each chunk is decoded where Spark reads it; nothing is shuffled but one row
    a shard.
    """
    kind = DOC_TYPE + (", ids array<bigint>" if with_ids else "")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = chunk_ids_of(row.planes, row.n_ids, row.unit, row.block_ids)
                ends = np.cumsum(row.lengths)
                parts = np.split(ids, ends[:-1])
                out = {
                    "shard": row.shard,
                    "doc_id": pd.array(row.doc_ids, "Int64"),
                    "shard_start": row.shard_start + ends - row.lengths,
                    "n_tokens": row.lengths,
                    "ids_crc32": [zlib.crc32(p.tobytes()) for p in parts],
                }
                if with_ids:
                    out["ids"] = [p.astype(np.int64) for p in parts]
                yield pd.DataFrame(out)

    rest = ["ids"] if with_ids else []
    if between is not None:
        lo, hi = between
        # A chunk's ids ascend; null ids come first, and are in no range.
        holds = (F.coalesce("first_doc", F.lit(lo)) <= hi) & (F.col("last_doc") >= lo)
        chunks = _indexed_chunks(spark, path, holds)
        docs = chunks.withColumn("shard_start", F.col("start")).drop("start").mapInPandas(read, kind)
        return docs.filter(F.col("doc_id").between(lo, hi)).select("doc_id", F.col("shard_start").alias("start"), "n_tokens", "ids_crc32", *rest)
    chunks = spark.read.parquet(f"{path}/chunks")
    docs = chunks.mapInPandas(read, kind)
    # One row a shard, which is one task's worth of documents; the engine checks its size before it sends it around.
    return docs.join(shard_starts(chunks), "shard").select(
        "doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32", *rest
    )
