import random
import re
import uuid
import zlib

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from veilcorpus.llm.token_planes import UNITS, WordCache, from_planes, has_odd_blank, read_documents, read_positions, to_planes, word_cache, write_token_planes
from veilcorpus.session import shared_dir

FILE = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    """The plain call, with nothing set: what the ids must equal."""
    return Tokenizer.from_file(FILE)


@pytest.mark.parametrize("unit", UNITS)
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(unit, n):
    rng = np.random.default_rng(n)
    for top in (1, 50_000, 1 << 32):
        ids = rng.integers(0, top, n).astype("<u4")
        assert (from_planes(to_planes(ids, unit), n, unit) == ids).all()


def test_words_are_encoded_as_the_whole_text_is(tokenizer):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", " ", "é", "日本", " x", "'s", "1", "\x1c", "\x85", "!", ".", ",", "Ça.\nEt", " do.", " \n ", " ", "😀", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)]
    cache = WordCache(FILE, most=700)
    for i in range(0, len(texts), 50):
        for text, ids in zip(texts[i : i + 50], cache.encode(texts[i : i + 50])):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_only_new_stems_go_to_the_tokenizer(tokenizer, monkeypatch):
    cache, sent = WordCache(FILE, most=400), []
    real = cache._encode
    monkeypatch.setattr(cache, "_encode", lambda texts: sent.extend(texts) or real(texts))
    texts = ["x one two, three.\nOne one, two.", "x one. two three!! (1) two.\nOne. d'one one\n\nOne", "x été, été. ab_c --x 1one, one1 two\u0301, a.b;c"]
    plain = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in cache.encode(texts[:1])] == plain[:1]
    assert sum(t.split().count("one") + t.split().count("two") for t in sent) == 2
    sent.clear()
    assert [x.tolist() for x in cache.encode(texts)] == plain
    assert not {"one", "two", "one.", "two."} & {w for t in sent for w in t.split(" ")}
    # Words that come again outlive others, and the cache stays within its bound.
    sent.clear()
    for i in range(60):
        some = f"x often {' '.join(f'w{i}q{j}' for j in range(20))} end"
        assert [x.tolist() for x in cache.encode([some])] == [tokenizer.encode(some, add_special_tokens=False).ids]
        assert sum(map(len, cache.held["words"])) < 400
    assert sum("often" in t for t in sent) == 1


def test_words_are_held_by_their_parts(tokenizer):
    """A word with a mark or a line end after it is not looked up as a word of its own."""
    texts = ["x one, two.\nÉté one. one!! one\ntwo, d'one é.×y a\n\nb z"]
    cache = WordCache(FILE)
    assert [x.tolist() for x in cache.encode(texts)] == [tokenizer.encode(texts[0], add_special_tokens=False).ids]
    assert set(cache.held["words"][0]) == {" one", " two", ",", ".", "\n", "Été", "!!", "two", " d'one", " é.×y", " a\n\nb", " z"}


def test_parts_of_words_are_those_of_a_plain_cut():
    rng = random.Random(5)
    parts = ["a", "Z", "é", "À", "ſ", "ƀ", "×", "÷", "日", "😀", "1", "'", ".", "~", "!", "\n", "\x00", "\x7f", "\x85", "º"]
    runs = re.compile(r"[A-Za-zÀ-ÖØ-öø-ſ]+|[!-&(-/:-@\[-`{-~]+|\n")
    for _ in range(300):
        words = ["".join(rng.choices(parts, k=rng.randint(1, 6), weights=[9, 5, 5, 2, 2] + [1] * 5 + [1, 1, 5, 2, 2, 3, 1, 1, 1, 1])) for _ in range(20)]
        want = []
        for word in words:
            found = runs.findall(word)
            want += [" " + found[0], *found[1:]] if "".join(found) == word and "\n\n" not in word else [" " + word]
        raw = "".join(" " + word for word in words).encode()
        starts = WordCache.part_starts(np.frombuffer(raw, np.uint8)).tolist()
        assert [raw[a:b].decode() for a, b in zip(starts, starts[1:] + [len(raw)])] == want


def test_every_white_space_is_known():
    assert all(has_odd_blank(f"a{c}b") == (c.isspace() and c not in " \n") for c in map(chr, range(0x110000)))


def test_a_worker_keeps_its_cache():
    assert word_cache(FILE) is word_cache(FILE)


@pytest.mark.parametrize("unit", UNITS)
def test_files_hold_every_document(spark, tokenizer, unit):
    rows = [(5, "five words are in here", "x"), (2, None, "x"), (9, "", "x"), (1, "long " * 30_000, "x"), (2, "two", "x"), (2, "two", "x"), (None, "no id", "x"), (7, "a\nb  c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    path = f"{shared_dir(spark)}/planes-{uuid.uuid4().hex}"
    write_token_planes(df, path, FILE, unit=unit, chunk_ids=40, block_ids=16)
    got = sorted((tuple(r) for r in read_documents(spark, path, with_ids=True).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 2, 2, 5, 7, 9]
    start = 0
    left = [(i, (t or "")) for i, t, _ in rows]
    for doc, at, n, crc, ids in got:
        assert at == start and n == len(ids)
        start += n
        text = next(t for d, t in left if d == doc and tokenizer.encode(t, add_special_tokens=False).ids + [0] == ids)
        left.remove((doc, text))
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert not left
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert sum(r["n_ids"] for r in index) == start and index[0]["start"] == 0


def test_added_tokens_are_those_of_the_plain_call(tokenizer):
    texts = ["foo <|endoftext|> bar", "<|endoftext|>", "a<|endoftext|>b  c\n", "foo <|endoftext| bar", " <|endoftext|><|endoftext|> x", "plain"]
    for text, ids in zip(texts, WordCache(FILE).encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert 50256 in tokenizer.encode(texts[0], add_special_tokens=False).ids


def test_the_index_finds_documents_and_positions(spark, tokenizer):
    rows = [(i, f"text of {i} " * (i % 7)) for i in range(300)] + [(None, "no id"), (None, None), (150, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = f"{shared_dir(spark)}/planes-{uuid.uuid4().hex}"
    write_token_planes(df, path, FILE, chunk_ids=50, block_ids=16)
    whole = {(r["doc_id"], r["start"]): tuple(r) for r in read_documents(spark, path, with_ids=True).collect()}
    for lo, hi in ((140, 160), (0, 0), (299, 10**9), (-5, -1), (0, 299)):
        some = [tuple(r) for r in read_documents(spark, path, with_ids=True, between=(lo, hi)).collect()]
        assert sorted(map(str, some)) == sorted(str(r) for (i, _), r in whole.items() if i is not None and lo <= i <= hi)
    stream = [x for r in sorted(whole.values(), key=lambda r: r[1]) for x in r[4]]
    for start, stop in ((0, 10), (45, 200), (len(stream) - 3, len(stream) + 9), (7, 7), (len(stream), len(stream) + 1)):
        found = sorted(map(tuple, read_positions(spark, path, start, stop).collect()))
        assert [x for _, ids in found for x in ids] == stream[start:stop]
    chosen = read_documents(spark, path, between=(140, 142))
    assert chosen.count() == 3
    scanned = spark.read.parquet(f"{path}/index").filter("first_doc <= 142 AND last_doc >= 140").count()
    assert 0 < scanned < spark.read.parquet(f"{path}/index").count() / 10


def test_empty_table(spark):
    path = f"{shared_dir(spark)}/planes-{uuid.uuid4().hex}"
    write_token_planes(spark.createDataFrame([], "doc_id long, text string"), path, FILE)
    assert read_documents(spark, path).count() == 0
    with pytest.raises(ValueError):
        write_token_planes(spark.createDataFrame([], "doc_id long, text string"), path, FILE, unit="nibble")
