"""Log probabilities of texts under a word-pair model that is kept as Elias-Fano tries in mapped files.

Words are hashed to 64 bits (two of V words share a hash with a chance of about V*V / 2**65). A pair is a word
and the one before it (a begin mark for the first); every text closes with an end mark, a token too. Pairs are
dealt to shards by the word, those of a frequent word also by its predecessor, and counted there. Pairs take

    p(w | u) = (c(uw) - D) / c(u) + bow(u) * p(w),   bow(u) = D * followers(u) / c(u),   D = n1 / (n1 + 2 * n2)

with p(w) = (c + 0.1) / (N + 0.1 * (V + 1)), and unseen pairs bow(u) * p(w), where a word that is no context has
bow 1. The trie of a shard is a file in the shared folder: the words with the code of p(w), monotone pointers to
their pairs, and per word the ascending numbers of its predecessors, each with the code of p(w | u). A pair is
found by the word's range and a search for the successor of the predecessor's number in it. Codes are whole
multiples of STEP of -log10 p, and sums of them are exact, so the order in which tasks add has no influence.

To score, the pairs of a chunk of documents go to their shards, where the files are mapped; sums for each
document come back, and for unseen pairs the predecessors are asked for bow in a second step. No task holds more
than a shard's pairs and a chunk's sums, and nothing but one line a shard and the frequent words reaches the driver.

Null texts are empty: they consist of the end mark. Null ids belong to the training fold and may repeat, as any
id: every row is scored for itself. A document longer than a chunk forms a chunk of its own. An empty table gives
an empty result, and without any training token a pair's base is 0.1 / 0.1. Other columns take no part.
"""

from __future__ import annotations

import os
import uuid
from array import array
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilcorpus.llm.batches import small_batches
from veilcorpus.llm.elias_fano import EliasFano, map_levels, write_levels
from veilcorpus.session import discard, materialize, shared_dir

FOLDS = 10
STEP = 1 / 4096  # of -log10 p
FIXED = 1 << 32  # base scores are added as multiples of 1 / FIXED
CHUNK_TOKENS = 2_000_000
SHARD_BYTES = 24 << 20  # of text
MOST_SHARDS = 100_000  # beyond that shards grow
SAMPLE_DOCS = 2_000  # the frequent words, which only decide where pairs are counted
HOT_PER_SHARD = 8  # a word is frequent from a share of 1 / (HOT_PER_SHARD * shards)
BEGIN, END = (xxhash.xxh3_64_intdigest(mark) for mark in (b" begin", b" end"))  # no word holds a blank


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


# -- arrays as bytes -------------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays in the narrowest type that holds them, compressed."""
    parts = [len(arrays).to_bytes(1, "little")]
    for a in arrays:
        kind = np.min_scalar_type(int(a.max())) if len(a) else np.dtype(np.uint8)
        parts += [kind.itemsize.to_bytes(1, "little"), len(a).to_bytes(8, "little"), np.ascontiguousarray(a.astype(kind)).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 1
    for _ in range(data[0]):
        size, n = data[at], int.from_bytes(data[at + 1 : at + 9], "little")
        out.append(np.frombuffer(data, dtype=f"u{size}", count=n, offset=at + 9))
        at += 9 + size * n
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of an ascending array, which pack well."""
    return np.diff(a, prepend=a.dtype.type(0))


# -- words and pairs -------------------------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers of words in order of arrival, and their hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = [BEGIN, END]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return n


def words(text: bytes | None) -> list[bytes]:
    """A-Z in lower case; bytes split on exactly the blanks of ASCII."""
    return (text or b"").lower().split()


def _chunks(batches: Iterable[pa.RecordBatch], tokens: int) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, ids, ascending hashes of the words, and words, predecessors (as places in these) and documents of all tokens."""
    row, ids, w, lengths, number = None, [], array("i"), [], _Numbers()

    def made():
        hashes = np.array(number.hashes, dtype=np.uint64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        # From here on words are numbered in the order of their hashes.
        tokens = rank[np.frombuffer(w, dtype=np.int32)]
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[np.cumsum([0, *lengths[:-1]])] = rank[0]
        return row, ids, hashes[order], tokens, before, np.repeat(np.arange(len(ids), dtype=np.int32), lengths)

    for batch in batches:
        for at, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            row = at if row is None else row
            seen = words(text.as_py())
            ids.append(doc_id)
            lengths.append(len(seen) + 1)
            w.extend(map(number.__getitem__, seen))
            w.append(1)
            if len(w) >= tokens:
                yield made()
                row, ids, w, lengths, number = None, [], array("i"), [], _Numbers()
    if ids:
        yield made()


def _shard(w: np.ndarray, u: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    mixed = np.where(np.isin(w, hot), w ^ (u >> np.uint64(7) | u << np.uint64(57)), w)
    return (mixed % np.uint64(shards)).astype(np.int64)


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys starts, and how long it is."""
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.empty(0, dtype=np.int64)
    return first, np.diff(first, append=len(sorted_keys))


def _pairs_by_shard(hashes, w, u, docs, hot, shards) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """For each shard its pairs (see `_coded`), documents a pair, and (pair by pair) documents with counts.

    `docs` may be None: then a pair has one entry, its count.
    """
    n_words, n_docs = len(hashes), int(docs[-1]) + 1 if docs is not None else 1
    pairs = w.astype(np.uint64) * np.uint64(n_words) + u.astype(np.uint64)
    if docs is None:
        cells = np.sort(pairs)
        per_cell = 1
    elif n_words * n_words * n_docs < 1 << 64:
        cells = np.sort(pairs * np.uint64(n_docs) + docs.astype(np.uint64))
        per_cell = n_docs
    else:  # a chunk of very many words and documents
        every, of = np.unique(pairs, return_inverse=True)
        cells = np.sort(of.astype(np.uint64) * np.uint64(n_docs) + docs.astype(np.uint64))
        per_cell = n_docs
    first, counts = _runs(cells)
    pair_of, doc_of = np.divmod(cells[first], np.uint64(per_cell))
    if docs is not None and n_words * n_words * n_docs >= 1 << 64:
        pair_of = every[pair_of.astype(np.int64)]
    starts, per_pair = _runs(pair_of)
    w_of, u_of = (x.astype(np.int32) for x in np.divmod(pair_of[starts], np.uint64(n_words)))
    shard = _shard(hashes[w_of], hashes[u_of], hot, shards).astype(np.int32 if shards > 32_000 else np.int16)
    order = np.argsort(shard, kind="stable")  # pairs stay ascending within a shard
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)):
        mine = order[edges[s] : edges[s + 1]]
        n = per_pair[mine]
        at = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        yield int(s), _coded(hashes, w_of[mine], u_of[mine]), n, doc_of[at], counts[at]


def _coded(hashes: np.ndarray, w: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
    """Pairs ascending by word and predecessor, as lists of distinct hashes and places in these."""
    w_first, w_runs = _runs(w)
    u_list, u_at = np.unique(u, return_inverse=True)
    return [steps(hashes[w[w_first]]), w_runs, steps(hashes[u_list]), u_at]


def _decoded(w_steps, w_runs, u_steps, u_at) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, each pair's place in them, and the same of predecessors."""
    w_list = _sum(w_steps)
    return w_list, np.repeat(np.arange(len(w_list), dtype=np.int32), w_runs), _sum(u_steps), u_at


def _sum(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a.astype(np.uint64), dtype=np.uint64)


# -- counts ----------------------------------------------------------------------------------------------------


def _frequent_words(train: DataFrame, shards: int) -> np.ndarray:
    """Hashes of the words that are too frequent for one shard, as far as a sample of documents shows."""
    if shards == 1:
        return np.empty(0, dtype=np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, hashes, w, _, _ in _chunks(batches, CHUNK_TOKENS):
            seen = np.bincount(w, minlength=len(hashes))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(seen)], ["word", "n"])

    share = min(1.0, SAMPLE_DOCS / max(1, train.count()))
    seen = train.sample(fraction=share, seed=7).mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    seen = materialize(seen)
    whole = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # The shares add to one, so these are at most HOT_PER_SHARD * shards rows.
    rows = seen.filter(F.col("n") * HOT_PER_SHARD * shards >= whole).filter("n > 0").select("word").collect()
    return np.sort(np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64))


def _counted(train: DataFrame, hot: np.ndarray, shards: int, tokens: int) -> DataFrame:
    """One row a shard: its distinct pairs with their counts, and sums over them."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, hashes, w, u, docs in _chunks(batches, tokens):
            for s, coded, _, _, n in _pairs_by_shard(hashes, w, u, None, hot, shards):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([pack(*coded, n)], pa.binary())], ["shard", "pairs"])

    def add(table: pa.Table) -> pa.Table:
        cells = [unpack(cell.as_py()) for cell in table.column("pairs")]
        w_list, u_list = (np.unique(np.concatenate([_sum(cell[i]) for cell in cells])) for i in (0, 2))
        keys = []
        for *coded, _ in cells:
            w, w_at, u, u_at = _decoded(*coded)
            key = np.searchsorted(w_list, w).astype(np.uint64)[w_at]
            keys.append(key * np.uint64(len(u_list)) + np.searchsorted(u_list, u).astype(np.uint64)[u_at])
        key, n = np.concatenate(keys), np.concatenate([cell[4].astype(np.int32) for cell in cells])
        del keys, cells
        order = np.argsort(key)
        key, n = key[order], n[order]
        first, _ = _runs(key)
        n = np.add.reduceat(n, first, dtype=np.int64)
        w, u = (x.astype(np.int32) for x in np.divmod(key[first], np.uint64(len(u_list))))
        is_hot = np.isin(w_list, hot)
        of_word = np.bincount(w, weights=n, minlength=len(w_list)).astype(np.int64)
        w_first, w_runs = _runs(w)
        row = {
            "shard": table.column("shard")[0].as_py(), "pairs": pack(steps(w_list), w_runs, steps(u_list), u, n), "tokens": int(n.sum()),
            "others": int((~is_hot).sum()), "n1": int((n == 1).sum()), "n2": int((n == 2).sum()),
            "hot": [{"at": int(np.searchsorted(hot, w_list[i])), "n": int(of_word[i])} for i in np.flatnonzero(is_hot)],
        }
        return pa.Table.from_pylist([row], schema=counted)

    counted = pa.schema([
        ("shard", pa.int32()), ("pairs", pa.binary()), ("tokens", pa.int64()), ("others", pa.int64()), ("n1", pa.int64()),
        ("n2", pa.int64()), ("hot", pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int64())]))),
    ])
    dealt = train.mapInArrow(deal, "shard int, pairs binary")
    return dealt.groupBy("shard").applyInArrow(
        add, "shard int, pairs binary, tokens bigint, others bigint, n1 bigint, n2 bigint, hot array<struct<at:int,n:bigint>>"
    )


def _at_home(u_list: np.ndarray, shards: int) -> list[np.ndarray]:
    """Places in an ascending list of predecessors, by the shard that adds them up."""
    home = (u_list % np.uint64(shards)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    return np.split(order, np.searchsorted(home[order], np.arange(1, shards)))


def _contexts(counted: DataFrame, shards: int) -> DataFrame:
    """`shard, home, sums`: count and followers of each predecessor in a shard, in the order of its list; and, with
    `shard` = `home` and its words, of all predecessors that are at home there."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, cell in zip(batch.column("shard").to_pylist(), batch.column("pairs"), strict=True):
                _, _, u_steps, u_at, n = unpack(cell.as_py())
                u_list = _sum(u_steps)
                count = np.bincount(u_at, weights=n, minlength=len(u_list)).astype(np.int64)
                followers = np.bincount(u_at, minlength=len(u_list))
                asked = [(h, pack(steps(u_list[at]), count[at], followers[at])) for h, at in enumerate(_at_home(u_list, shards)) if len(at)]
                homes, cells = zip(*asked, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s] * len(homes), pa.int32()), pa.array(homes, pa.int32()), pa.array(cells, pa.binary())], ["shard", "home", "sums"]
                )

    def answer(table: pa.Table) -> pa.Table:
        asked = [unpack(cell.as_py()) for cell in table.column("sums")]
        lists = [_sum(a[0]) for a in asked]
        u, of = np.unique(np.concatenate(lists), return_inverse=True)
        count = np.bincount(of, weights=np.concatenate([a[1] for a in asked]), minlength=len(u)).astype(np.int64)
        followers = np.bincount(of, weights=np.concatenate([a[2] for a in asked]), minlength=len(u)).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])[:-1]
        home = table.column("home")[0].as_py()
        rows = [
            {"shard": s, "home": home, "own": False, "sums": pack(count[at], followers[at])}
            for s, at in zip(table.column("shard").to_pylist(), np.split(of, ends), strict=True)
        ]
        rows.append({"shard": home, "home": home, "own": True, "sums": pack(steps(u), count, followers)})
        return pa.Table.from_pylist(rows, schema=pa.schema([("shard", pa.int32()), ("home", pa.int32()), ("own", pa.bool_()), ("sums", pa.binary())]))

    asked = counted.select("shard", "pairs").mapInArrow(ask, "shard int, home int, sums binary")
    return asked.groupBy("home").applyInArrow(answer, "shard int, home int, own boolean, sums binary")


# -- the model -------------------------------------------------------------------------------------------------


def log_code(p: np.ndarray) -> np.ndarray:
    """-log10 p in steps; 16 bits reach down to 1e-16."""
    return np.minimum(np.rint(-np.log10(p) / STEP), 65535).astype(np.uint16)


class Model:
    """What every task needs to know: sizes, the frequent words and the folder of the tries."""

    def __init__(self, folder: str, shards: int, hot: np.ndarray, hot_counts: np.ndarray, tokens: int, distinct: int, discount: float):
        self.folder, self.shards, self.hot, self.hot_counts = folder, shards, hot, hot_counts
        self.tokens, self.distinct, self.discount = tokens, distinct, discount

    def path(self, shard: int) -> str:
        return f"{self.folder}/{shard:06d}.trie"

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1))


def mounted_dir(spark: SparkSession) -> str:
    """The shared folder as a path that every host has; tries are files to be mapped."""
    named = urlparse(shared_dir(spark))
    if named.scheme not in ("", "file"):
        raise ValueError(f"tries are mapped from files: spark.checkpoint.dir must be a mounted folder, not {named.scheme}://")
    return named.path


def _build(model: Model) -> callable:
    def build(counted: pa.Table, contexts: pa.Table) -> pa.Table:
        shard = (counted if counted.num_rows else contexts).column("shard")[0].as_py()
        w = u_at = n = np.empty(0, dtype=np.int64)
        u_list, w_list = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
        for cell in counted.column("pairs"):  # one row at most
            *coded, n = unpack(cell.as_py())
            w_list, w, u_list, u_at = _decoded(*coded)
        total, followers = np.zeros(len(u_list), dtype=np.int64), np.zeros(len(u_list), dtype=np.int64)
        places = _at_home(u_list, model.shards)
        homes: list[np.ndarray] = [np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)]
        for home, own, cell in zip(contexts.column("home").to_pylist(), contexts.column("own").to_pylist(), contexts.column("sums"), strict=True):
            if own:
                u, c, f = unpack(cell.as_py())
                homes = [_sum(u), c.astype(np.int64), f.astype(np.int64)]
            else:
                c, f = unpack(cell.as_py())
                total[places[home]], followers[places[home]] = c, f
        counts = np.bincount(w, weights=n, minlength=len(w_list)).astype(np.int64)
        # Frequent words have pairs in many shards, and each of these knows their whole count.
        every = np.union1d(w_list, model.hot[model.hot_counts > 0])
        pairs_of = np.zeros(len(every), dtype=np.int64)
        at = np.searchsorted(every, w_list)
        whole = np.zeros(len(every), dtype=np.int64)
        whole[at] = counts
        pairs_of[at] = np.bincount(w, minlength=len(w_list))
        whole[np.searchsorted(every, model.hot[model.hot_counts > 0])] = model.hot_counts[model.hot_counts > 0]
        below = model.unigram(whole)
        d, w = model.discount, at[w]
        p = (n.astype(np.int64) - d) / total[u_at] + d * followers[u_at] / total[u_at] * below[w]
        bow = d * homes[2] / np.maximum(homes[1], 1)
        write_levels(
            model.path(shard),
            {
                "words": EliasFano.of(every, 1 << 64),
                "counts": whole,
                "unigrams": log_code(below),
                "pointers": EliasFano.of(np.concatenate([[0], np.cumsum(pairs_of)]), len(p) + 1),
                "predecessors": EliasFano.of(u_list, 1 << 64),
                "pairs": EliasFano.of(w.astype(np.uint64) * np.uint64(len(u_list)) + u_at.astype(np.uint64), max(1, len(every) * len(u_list))),
                "codes": log_code(np.maximum(p, 1e-300)),
                "contexts": EliasFano.of(homes[0], 1 << 64),
                "backoffs": log_code(np.maximum(bow, 1e-300)),
            },
        )
        return pa.table({"shard": pa.array([shard], pa.int32()), "pairs": pa.array([len(p)], pa.int64())})

    return build


def _prepared(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows as tasks take them; a row's number is its place in the scan, so the rows of a chunk are consecutive."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )


def train_model(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES, chunk_tokens: int = CHUNK_TOKENS
) -> Model:
    """Learn from all of `docs`."""
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    shards = max(1, min(MOST_SHARDS, -(-size // shard_bytes)))
    folder = f"{mounted_dir(spark)}/tries-{uuid.uuid4().hex}"
    os.makedirs(folder)
    train = _prepared(docs, doc_id, text)
    hot = _frequent_words(train, shards)
    counted = materialize(_counted(train, hot, shards, chunk_tokens))
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "others", "n1", "n2")]).first()
    hot_counts = np.zeros(len(hot), dtype=np.int64)
    for r in counted.select(F.inline("hot")).groupBy("at").agg(F.sum("n").alias("n")).collect():  # a row a frequent word
        hot_counts[r["at"]] = r["n"]
    discount = sums["n1"] / (sums["n1"] + 2 * sums["n2"]) if sums["n1"] else 0.5
    model = Model(folder, shards, hot, hot_counts, sums["tokens"], sums["others"] + int((hot_counts > 0).sum()), discount)
    contexts = _contexts(counted, shards)
    # Every shard gets a file, also one in which nothing was counted.
    all_shards = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    have = counted.select("shard", "pairs").join(all_shards, "shard", "right")
    have = have.withColumn("pairs", F.coalesce("pairs", F.lit(pack(*[np.empty(0, dtype=np.uint8)] * 5))))
    built = have.groupBy("shard").cogroup(contexts.groupBy("shard")).applyInArrow(_build(model), "shard int, pairs bigint")
    built.agg(F.sum("pairs")).first()
    discard(counted)
    return model


# -- scores ----------------------------------------------------------------------------------------------------

SCORED = "chunk bigint, ids array<bigint>, sums binary, asked binary"


def _deal(model: Model, tokens: int) -> callable:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("pairs", pa.binary())])
        for row, ids, hashes, w, u, docs in _chunks(batches, tokens):
            for s, coded, n_docs, doc_of, counts in _pairs_by_shard(hashes, w, u, docs, model.hot, model.shards):
                packed = pack(*coded, n_docs, doc_of, counts)
                yield pa.RecordBatch.from_pylist([{"shard": s, "chunk": row, "ids": ids, "pairs": packed}], schema=kinds)
                ids = None  # the documents travel once

    return deal


def _score(model: Model) -> callable:
    unknown = np.array([0])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sums", pa.binary()), ("asked", pa.binary())])
        none_base, none_code = np.log10(model.unigram(unknown))[0], log_code(model.unigram(unknown))[0]
        held, trie = -1, {}
        for batch in batches:
            for line in batch.to_pylist():
                if line["shard"] != held:
                    held, trie = line["shard"], map_levels(model.path(line["shard"]))
                *coded, n_docs, docs, counts = unpack(line["pairs"])
                w_list, w, u_list, u = _decoded(*coded)
                # Words and predecessors are looked up once each, then every pair in its word's range.
                at = trie["words"].find(w_list)
                here = np.flatnonzero(at >= 0)
                base = np.full(len(w_list), none_base)
                base[here] = np.log10(model.unigram(trie["counts"][at[here]]))
                base = np.rint(-base * FIXED).astype(np.int64)
                alone = np.full(len(w_list), none_code, dtype=np.int64)
                alone[here] = trie["unigrams"][at[here]]
                begin, end = np.zeros(len(w_list), dtype=np.int64), np.zeros(len(w_list), dtype=np.int64)
                begin[here], end[here] = trie["pointers"][at[here]], trie["pointers"][at[here] + 1]
                previous = trie["predecessors"].find(u_list)
                i = np.flatnonzero((at[w] >= 0) & (previous[u] >= 0))
                key = at[w[i]].astype(np.uint64) * np.uint64(trie["predecessors"].n) + previous[u[i]].astype(np.uint64)
                pair = trie["pairs"].find(key, begin[w[i]], end[w[i]])
                code, seen = alone[w], np.zeros(len(w), dtype=bool)
                seen[i[pair >= 0]] = True
                code[i[pair >= 0]] = trie["codes"][pair[pair >= 0]]
                counts, docs, of = counts.astype(np.int64), docs.astype(np.int64), np.repeat(np.arange(len(w)), n_docs)
                word = w[of]
                asked = np.flatnonzero(~seen[of])
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "chunk": line["chunk"],
                            "ids": line["ids"],
                            "sums": _by_doc(docs, counts, counts * (at >= 0)[word], counts * base[word], counts * code[of]),
                            "asked": pack(u_list[u[of[asked]]], docs[asked], counts[asked]) if len(asked) else None,
                        }
                    ],
                    schema=kinds,
                )

    return score


def _by_doc(docs: np.ndarray, *values: np.ndarray) -> bytes:
    """Sums of `values` for each document, packed with the documents."""
    order = np.argsort(docs, kind="stable")
    first = np.flatnonzero(np.diff(docs[order], prepend=-1))
    return pack(steps(docs[order][first]), *[np.add.reduceat(v[order], first) for v in values])


def _ask(shards: int) -> callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, cell in zip(batch.column("chunk").to_pylist(), batch.column("asked"), strict=True):
                u, docs, counts = unpack(cell.as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((u % np.uint64(shards)).astype(np.int32)), pa.array(np.full(len(u), chunk)),
                        pa.array(u.astype(np.uint64).view(np.int64)), pa.array(docs.astype(np.int64)), pa.array(counts.astype(np.int64)),
                    ],
                    ["home", "chunk", "word", "doc", "n"],
                )

    return ask


def _back_off(model: Model) -> callable:
    def back_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sums", pa.binary())])
        held, trie = -1, {}
        for batch in batches:
            home, chunk, word, doc, n = (batch.column(i).to_numpy() for i in range(5))
            code = np.zeros(len(home), dtype=np.int64)
            for h in np.unique(home):
                if h != held:
                    held, trie = h, map_levels(model.path(int(h)))
                mine = np.flatnonzero(home == h)
                at = trie["contexts"].find(word[mine].view(np.uint64))
                code[mine[at >= 0]] = trie["backoffs"][at[at >= 0]]
            rows = []
            for c in np.unique(chunk):
                mine = chunk == c
                none = np.zeros(mine.sum(), dtype=np.int64)
                rows.append({"chunk": int(c), "ids": None, "sums": _by_doc(doc[mine], none, none, none, n[mine] * code[mine])})
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return back_off


def _add_up(table: pa.Table) -> pa.Table:
    ids = next(x.as_py() for x in table.column("ids") if x.is_valid)
    sums = np.zeros((4, len(ids)), dtype=np.int64)
    for cell in table.column("sums"):
        docs, *parts = unpack(cell.as_py())
        sums[:, _sum(docs).astype(np.int64)] += np.array([p.astype(np.int64) for p in parts])
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "n_tokens": sums[0], "n_known": sums[1], "base_score": -sums[2] / FIXED, "score": -sums[3] * STEP,
    })


def score_texts(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """`doc_id, n_tokens, n_known, base_score, score` of each row."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), model.shards)
    dealt = _prepared(docs, doc_id, text).mapInArrow(_deal(model, chunk_tokens), "shard int, chunk bigint, ids array<bigint>, pairs binary")
    # Files are mapped from anywhere: a shard may go to several tasks, which evens them out.
    dealt = dealt.repartition(parts, "shard", F.pmod(F.xxhash64("chunk"), F.lit(16))).sortWithinPartitions("shard")
    scored = materialize(dealt.mapInArrow(_score(model), SCORED))
    # Likewise a frequent predecessor.
    asked = scored.filter("asked IS NOT NULL").select("chunk", "asked")
    asked = asked.mapInArrow(_ask(model.shards), "home int, chunk bigint, word bigint, doc bigint, n bigint")
    asked = asked.repartition("home", F.pmod(F.xxhash64("chunk"), F.lit(16))).sortWithinPartitions("home")
    more = asked.mapInArrow(_back_off(model), "chunk bigint, ids array<bigint>, sums binary")
    sums = scored.select("chunk", "ids", "sums").unionAll(more)
    return sums.groupBy("chunk").applyInArrow(_add_up, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all documents by the model of those that are not held out."""
    model = train_model(docs.filter(~held_out(F.col("doc_id"))))
    return score_texts(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
