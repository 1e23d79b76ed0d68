import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilcorpus.llm import trie_scores as ts
from veilcorpus.llm.elias_fano import EliasFano, map_levels, write_levels

SCHEMA = "doc_id bigint, text string"


@pytest.mark.parametrize(("n", "universe"), [(0, 9), (1, 1), (7, 2**64), (500, 2**64), (3000, 900), (2000, 10**9)])
def test_elias_fano_is_a_sorted_list(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
    level = EliasFano.of(values, universe)
    asked = np.concatenate([values, rng.integers(0, universe - 1, 500, dtype=np.uint64, endpoint=True)])
    assert (level.find(asked) >= 0).tolist() == np.isin(asked, values).tolist()
    if n:
        assert (level[np.arange(n)] == values).all()
        assert (level.successor(asked) == np.searchsorted(values, asked)).all()
        begin = rng.integers(0, n, len(asked))
        end = np.minimum(n, begin + rng.integers(0, 9, len(asked)))
        wanted = [b + np.searchsorted(values[b:e], x) for b, e, x in zip(begin, end, asked, strict=True)]
        assert level.successor(asked, begin, end).tolist() == wanted


def test_levels_are_smaller_than_lists_and_mapped(tmp_path):
    values = np.sort(np.random.default_rng(1).integers(0, 10**7, 20_000, dtype=np.uint64))
    write_levels(f"{tmp_path}/x", {"a": EliasFano.of(values, 10**7), "b": np.arange(5, dtype=np.uint16)})
    held = map_levels(f"{tmp_path}/x")
    assert (held["a"][np.arange(20_000)] == values).all() and held["b"].tolist() == list(range(5))
    assert not held["a"].high.flags.owndata and (tmp_path / "x").stat().st_size < 20_000 * 2.5


def test_arrays_are_packed_losslessly():
    arrays = [np.array([], dtype=np.int64), np.array([0, 255]), np.array([2**64 - 1], dtype=np.uint64), np.array([70_000, 1])]
    assert [a.tolist() for a in ts.unpack(ts.pack(*arrays))] == [a.tolist() for a in arrays]


def words(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def model_of(rows):
    uni, pair, total, followers = Counter(), Counter(), Counter(), Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            tokens = [*words(text), "END"]
            uni.update(tokens)
            pair.update(zip(["BEGIN", *tokens], tokens, strict=False))
    for (u, _), c in pair.items():
        total[u] += c
        followers[u] += 1
    n1, n2 = sum(c == 1 for c in pair.values()), sum(c == 2 for c in pair.values())
    d = n1 / (n1 + 2 * n2) if n1 else 0.5

    def p(w, u=None):
        if u is None:
            return (uni[w] + 0.1) / (uni.total() + 0.1 * (len(uni) + 1))
        if not total[u]:
            return p(w)
        return max(0, pair[u, w] - d) * (pair[u, w] > 0) / total[u] + d * followers[u] / total[u] * p(w)

    return uni, pair, p


def brute(rows):
    uni, _, p = model_of(rows)
    out = []
    for doc_id, text in rows:
        tokens = [*words(text), "END"]
        base = math.fsum(math.log10(p(w)) for w in tokens)
        score = math.fsum(math.log10(p(w, u)) for u, w in zip(["BEGIN", *tokens], tokens, strict=False))
        out.append((doc_id, held_out(doc_id), len(tokens), sum(uni[w] > 0 for w in tokens), uni.total(), base, score))
    return out


def compare(got, rows):
    """Scores may differ by the rounding of their codes: half a step a token, twice for pairs that are not seen."""
    key = lambda r: (str(r[:5]), round(r[5], 6), r[6])
    got = sorted([tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in got], key=key)
    wanted = sorted(brute(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    for a, b in zip(got, wanted, strict=True):
        assert a[5] == pytest.approx(b[5], abs=1e-8 * a[2]) and a[6] == pytest.approx(b[6], abs=ts.STEP * 1.001 * a[2])


def odd_rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ä", "日本", "ÉÀ", "x y"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(150)]
    rows += [(i, " ".join(rng.choice(["the", f"q{rng.randint(0, 400)}"]) for _ in range(60))) for i in range(200, 260)]  # one word is half of all
    rows += [(i, "same text here") for i in range(500, 560)]
    rows += [(5, "twice"), (5, "twice"), (None, "no id"), (None, None), (2**62 + 1, ""), (2**62 + 3, " \t\n\x0b\f ")]
    rows += [(i, "UNKNOWN" + str(i) + " the w1 neverseen" + str(i)) for i in range(1000, 1060)]
    rows += [(3001, "long word " * 20_000 + "z" * 100_000)]
    return rows


@pytest.mark.parametrize(("shard_bytes", "chunk_tokens"), [(1 << 30, 10**7), (40_000, 500)])
def test_equals_brute_force(spark, monkeypatch, shard_bytes, chunk_tokens):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("row", "shard", "chunk", "pairs", "held_out", "score"):
        docs = docs.withColumn(name, F.lit("user"))
    monkeypatch.setattr(ts.train_model, "__defaults__", ("doc_id", "text", shard_bytes, chunk_tokens))
    monkeypatch.setattr(ts.score_texts, "__defaults__", ("doc_id", "text", chunk_tokens))
    compare(ts.score_documents(docs).collect(), rows)


def test_frequent_words_are_split_and_stay_whole(spark):
    rows = [(i, " ".join(f"the x{i * 30 + j}" for j in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = ts.train_model(docs.filter(~ts.held_out(F.col("doc_id"))), shard_bytes=1500)
    the = ts.xxhash.xxh3_64_intdigest(b"the")
    assert model.shards > 5 and the in model.hot.tolist()
    files = [map_levels(model.path(s)) for s in range(model.shards)]
    at = [f["words"].find(np.array([the], dtype=np.uint64))[0] for f in files]
    count = sum(30 for i, _ in rows if not held_out(i))
    assert {int(f["counts"][i]) for f, i in zip(files, at, strict=True)} == {count}
    parts = [int(f["pointers"][np.array([i + 1])][0] - f["pointers"][np.array([i])][0]) for f, i in zip(files, at, strict=True)]
    # Its pairs: one with the begin mark and one with each word that is not the last of its text.
    train = sum(not held_out(i) for i, _ in rows)
    assert sum(parts) == train * 29 + 1 and max(parts) < sum(parts) / 2
    compare(ts.score_texts(docs, model).select("*", ts.held_out(F.col("doc_id")).alias("held_out"), F.lit(model.tokens).alias("train_tokens")).collect(), rows)


def test_probabilities_add_to_one_and_pairs_help(spark):
    rows = [(i, "a b a b c d" if i % 2 else "c d c d a b") for i in range(80)]
    uni, _, p = model_of(rows)
    for u in ("BEGIN", b"a", b"d", b"unseen"):
        assert sum(p(w, u) for w in [*uni, b"another"]) == pytest.approx(1)
    out = ts.score_documents(spark.createDataFrame(rows, SCHEMA)).filter("held_out").collect()
    assert out and all(r["score"] > r["base_score"] for r in out)


def test_no_rows_and_nothing_to_learn_from(spark):
    assert ts.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    lone = next(i for i in range(1000) if held_out(i))
    row = ts.score_documents(spark.createDataFrame([(lone, "a b")], SCHEMA)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)
