import collections
import math
import random

import numpy as np
import pytest
from public_tokenizers import PATTERN, path as tokenizer_path
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from veilcorpus.llm.language_id import ByteConvNet, as_windows, detect_language, language_report, learning_fold, train_language_net
from veilcorpus.llm.piece_lattice import Vocabulary, encode_and_restore, held_vocabulary, restored_text
from veilcorpus.llm.token_counts import SpanEncoder, attribute, line_spans, section_token_counts

PIECES = tokenizer_path("piece_bpe_32k.model")
RANKS = tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PIECES)


def test_sampling_follows_the_lattice(vocabulary):
    n = 20_000
    seen = collections.Counter(tuple(x.tolist()) for x in vocabulary.encode(["hello"] * n, np.arange(n, dtype=np.uint64)))
    ids = {s: i for i, s in enumerate(vocabulary.surface) if i > 258}

    def paths(text):
        if not text:
            yield ()
        for k in range(1, len(text) + 1):
            if text[:k] in ids:
                for rest in paths(text[k:]):
                    yield (ids[text[:k]], *rest)

    weight = {p: math.exp(sum(vocabulary.log_weight[i] for i in p)) for p in paths(b" hello")}
    total = sum(weight.values())
    assert set(seen) <= set(weight)
    assert max(abs(seen[p] / n - w / total) for p, w in weight.items()) < 0.02


def test_any_text_comes_back(vocabulary):
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "日本", " word", "▁", "1", "\x00", "!", "😀", "Straße", "́", "\U000fffff"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(500)] + ["x" * 5000]
    seeds = np.arange(len(texts), dtype=np.uint64)
    model = SentencePieceProcessor(model_file=PIECES)
    together = list(vocabulary.encode(texts, seeds))
    for i, (text, ids) in enumerate(zip(texts, together)):
        assert vocabulary.decode(ids) == text
        if "\x00" not in text:
            assert model.decode(ids.tolist()) == text
        if i < 60:
            alone = next(iter(vocabulary.encode([text], seeds[i : i + 1])))
            assert (alone == ids).all()


def test_a_segment_is_filtered_once(monkeypatch):
    vocabulary, filtered = Vocabulary(PIECES, most=3000), []
    real = vocabulary._filter
    monkeypatch.setattr(vocabulary, "_filter", lambda codes, node0, size: filtered.append(len(size)) or real(codes, node0, size))
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé日1.", k=rng.randint(1, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=20)) for _ in range(200)]
    seeds = np.arange(len(texts), dtype=np.uint64)
    want = [next(iter(Vocabulary(PIECES).encode([text], seeds[i : i + 1]))).tolist() for i, text in enumerate(texts[:40])]
    assert [x.tolist() for x in vocabulary.encode(texts[:2], seeds[:2])] == want[:2]
    assert filtered.pop() and not filtered
    list(vocabulary.encode(texts[:2], seeds[:2]))
    assert not filtered
    # Forgetting, and names that stand for other segments, change no result.
    for i in range(0, len(texts), 20):
        got = [x.tolist() for x in vocabulary.encode(texts[i : i + 20], seeds[i : i + 20])]
        assert got[: len(want[i:])] == want[i : i + 20]
        assert len(vocabulary.held_codes) < 3000 + 2000
    vocabulary.held = dict(zip(vocabulary.held, reversed(vocabulary.held.values())))
    assert [x.tolist() for x in vocabulary.encode(texts[180:] + texts[:40], np.append(seeds[180:], seeds[:40]))][20:] == want
    assert vocabulary.seed == 2


def test_wrong_ids_restore_nothing(vocabulary):
    texts = ["some words", "", "日本 été", "x"]
    ids = list(vocabulary.encode(texts, np.arange(4, dtype=np.uint64)))
    assert vocabulary.restores(texts, ids) == [True] * 4 and vocabulary.restores([""], ids[1:2]) == [True]
    assert vocabulary.restores(texts, [ids[0][:-1], ids[3], ids[2][::-1], ids[1]]) == [False] * 4


def test_a_worker_keeps_its_vocabulary():
    assert held_vocabulary(PIECES) is held_vocabulary(PIECES)


def test_encode_and_restore(spark):
    rows = [(1, "some words here", "x"), (1, "some words here", "x"), (2, None, "x"), (3, "", "x"), (None, "no key", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = encode_and_restore(df, PIECES).withColumn("back", restored_text(F.col("ids"), PIECES)).collect()
    again = encode_and_restore(df.repartition(3), PIECES).collect()
    assert all(r["lossless"] and r["back"] == r["text"] for r in out)
    assert {(r["doc_id"], r["n_ids"]) for r in out} >= {(2, 0), (3, 0)}
    assert sorted(str((r["doc_id"], r["ids"])) for r in out) == sorted(str((r["doc_id"], r["ids"])) for r in again)
    assert encode_and_restore(df.limit(0), PIECES).count() == 0


def brute_attribution(encoder, text, spans, rule):
    """Owner of each byte, then each token by counting its bytes."""
    owner = []
    for i, c in enumerate(text):
        inside = [k for k in sorted(range(len(spans)), key=lambda k: spans[k][0]) if spans[k][0] <= i < spans[k][1]]
        owner += [inside[0] if inside else -1] * len(c.encode())
    counts, start = collections.Counter(), 0
    for end in encoder.ends(text).tolist():
        own = owner[start:end]
        if rule == "start":
            counts[own[0]] += 1
        elif rule == "split":
            for k in own:
                counts[k] += 1 / len(own)
        else:
            n = collections.Counter(own)
            counts[max(n, key=lambda k: (n[k], -own.index(k)))] += 1
        start = end
    return [counts[k] for k in range(len(spans))], counts[-1]


@pytest.mark.parametrize("rule", ["most", "start", "split"])
def test_attribution_equals_brute_force(rule):
    rng = random.Random(2)
    encoder = SpanEncoder(RANKS, PATTERN)
    for _ in range(120):
        text = "".join(rng.choices(["word", " ", "é", "日本", "\n", "abcde", "😀"], k=rng.randint(0, 20)))
        spans = [tuple(sorted(rng.choices(range(len(text) + 1), k=2))) for _ in range(rng.randint(0, 5))]
        spans = list({s[0]: s for s in spans}.values())
        got, rest = attribute(encoder.ends(text), text, np.array([s for s, _ in spans], np.int64), np.array([e for _, e in spans], np.int64), rule)
        want, left = brute_attribution(encoder, text, spans, rule)
        assert np.allclose(got, want) and abs(rest - left) < 1e-9, (text, spans)


def test_lines_are_sections_that_cover_the_text():
    for text in ("", "a", "a\n", "\n\n", "a\nb", "\na\n"):
        starts, ends = line_spans(text)
        assert "".join(text[s:e] for s, e in zip(starts, ends)) == text and all(e > s for s, e in zip(starts, ends))


def test_section_counts_on_odd_rows(spark):
    rows = [(1, "one two\nthree", None), (1, "one two\nthree", None), (2, None, None), (3, "", []), (None, "x\n" * 2000, None), (5, "whole text", [(0, 5), (90, 95), (7, 3), (None, 4)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, start array<struct<start:long,end:long>>")
    out = section_token_counts(df, RANKS, PATTERN)
    totals = out.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.first("doc_tokens").alias("t"), F.count("*").alias("rows")).collect()
    assert {r["doc_id"]: r["rows"] for r in totals} == {1: 4, None: 2000, 5: 1}
    given = section_token_counts(df.filter("doc_id = 5"), RANKS, PATTERN, sections=F.col("start")).collect()
    assert [(r["section"], r["n_tokens"]) for r in given] == [(0, 2.0), (1, 0.0), (2, 0.0), (3, 0.0), (-1, 1.0)]
    assert section_token_counts(df.limit(0), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        section_token_counts(df, RANKS, PATTERN, rule="guess")


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = ByteConvNet(["a", "b", "c"], seed=3)
    windows, labels, weight = rng.integers(0, 256, (4, 30), dtype=np.uint8), np.array([0, 1, 2, 1]), np.ones(4)
    params = [net.embed, net.filters, net.lift, net.dense, net.bias]
    for i, p in enumerate(params):
        params[i] = p

    def loss():
        z = net.logits(windows).astype(float)
        z -= z.max(axis=1, keepdims=True)
        return -(z[np.arange(4), labels] - np.log(np.exp(z).sum(axis=1))).mean()

    for p, g in zip(params, net._gradients(windows, labels, weight)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held, step = p[at].copy(), 1e-2
        p[at] = held + step
        up = loss()
        p[at] = held - step
        down = loss()
        p[at] = held
        assert abs((up - down) / (2 * step) - g[at]) < 0.15 * abs(g[at]) + 1e-3


def test_windows_hold_every_byte():
    for n in (1, 191, 192, 193, 1000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        assert as_windows(text).tobytes()[:n].decode() == text


def test_language_is_learned_and_odd_texts_are_unknown(spark):
    rng = random.Random(4)
    words = {"xx": ["abla", "oro", "ene", "ulu"], "yy": ["krst", "zbry", "pstrk", "vlk"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=40)), lang) for i, lang in enumerate(["xx", "yy"] * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = train_language_net(df.filter(learning_fold(F.col("doc_id"))), per_language=60)
    odd = spark.createDataFrame([(900, None, "xx"), (901, "", None), (902, "12 34 !", None), (None, "pstrk vlk " * 3000, None)], df.schema)
    got = {r["doc_id"]: r for r in language_report(df.unionByName(odd), net).collect()}
    held = [i for i, _, _ in rows if got[i]["held_out"]]
    assert 60 < len(held) < 140 and all(got[i]["lang_pred"] == rows[i][2] for i in held)
    assert [got[i]["lang_pred"] for i in (900, 901, 902, None)] == ["und", "und", "und", "yy"]
    assert got[900]["score"] == 0.0 and 0.5 < got[None]["score"] <= 1.0 and not got[None]["held_out"]
    assert train_language_net(df.limit(0)) is None
    assert detect_language(df.limit(3), None).select("language.lang_pred").distinct().collect()[0][0] == "und"
    assert detect_language(df.limit(0), net).count() == 0


def test_scores_equal_a_naive_network(spark):
    """Every window, filter and place by plain loops, narrow filters at their own width."""
    from veilcorpus.llm.language_id import DIMENSIONS, FILTERS, WIDTHS, WINDOW

    net = ByteConvNet(["a", "b", "c"], seed=5)
    net.lift += 0.1
    net.bias += np.array([0.2, -0.1, 0.0], np.float32)

    def naive(text):
        data = text.encode()
        windows = [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)]
        total = np.zeros(3)
        for w in windows:
            w = (w * (WINDOW // len(w) + 1))[:WINDOW]
            pooled = []
            for k, width in enumerate(WIDTHS):
                for f in range(FILTERS):
                    column = net.filters[:, k * FILTERS + f].reshape(-1, DIMENSIONS)[:width].astype(float)
                    best = max(sum(float(net.embed[w[at + j]] @ column[j]) for j in range(width)) for at in range(WINDOW - max(WIDTHS) + 1))
                    pooled.append(max(best + float(net.lift[k * FILTERS + f]), 0.0))
            total += np.array(pooled) @ net.dense + net.bias
        p = np.exp(total / len(windows))
        p /= p.sum()
        return net.languages[int(p.argmax())], float(p.max())

    texts = ["short", "é日 mixed text", "x" * WINDOW, "several windows of text " * 20]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_report(df, net).collect()}
    for i, text in enumerate(texts):
        lang, score = naive(text)
        assert got[i][0] == lang and abs(got[i][1] - score) < 1e-4


def test_copies_do_not_fill_a_language(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(ByteConvNet, "train", lambda self, windows, labels, seed=0: seen.update(windows=windows, labels=labels))
    rows = [(f"copy of one text in {i % 2}", "en") for i in range(400)] + [(f"text number {i} of its own", "en") for i in range(100)]
    rows += [("seul texte", "fr"), (None, "fr"), ("", "fr"), ("no language", None)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    train_language_net(df, per_language=1000)
    assert len(seen["windows"]) == 2 * (2 + 100 + 1) and (seen["labels"] == 1).sum() == 2
    train_language_net(df, per_language=30)
    assert len({bytes(w) for w in seen["windows"][seen["labels"] == 0]}) >= 30
