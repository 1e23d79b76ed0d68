import random
from collections import Counter

import numpy as np

from veilcorpus.llm.dart_minhash import DartSketch, band_hashes, parity_maps, weighted_jaccard, weighted_sets
from veilcorpus.llm.near_copies import near_copy_classes, one_of_each_class
from veilcorpus.llm.shingles import Shingler


def bag(text):
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    x, y = bag(a), bag(b)
    total = sum((x | y).values())
    return sum((x & y).values()) / total if total else 0.0


def changed(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(words)), n):
        out[i] = f"new{rng.random()}"
    return out


def test_similarity_is_exact():
    rng = random.Random(1)
    for _ in range(50):
        a = rng.choices("abcd", k=rng.randint(0, 60))
        b = changed(rng, a, min(len(a), 2)) if a else ["z"]
        x, y = weighted_sets(Shingler(), [" ".join(a).upper(), "\n".join(b)])
        assert abs(weighted_jaccard(x, y) - similarity(" ".join(a), " ".join(b))) < 1e-12


def test_signature_agreement_estimates_weighted_similarity():
    rng = random.Random(2)
    sketch = DartSketch(1500)
    for n in (6, 60, 2000):
        a = [f"w{rng.randint(0, 9 * n)}" for _ in range(n)] * 2
        b = changed(rng, a, max(1, n // 30))
        sets = weighted_sets(Shingler(), [" ".join(a), " ".join(b)])
        sig = sketch.sketch(sets)
        assert abs((sig[0] == sig[1]).mean() - weighted_jaccard(*sets)) < 0.06
        assert (band_hashes(sig, 30)[0] != band_hashes(sig, 30)[1]).any()


def test_real_weights_are_sketched_too():
    element = np.arange(40, dtype=np.uint64) * np.uint64(7919)
    a, b = np.full(40, 0.5), np.full(40, 3.25)
    sig = DartSketch(2000).sketch([(element, a), (element, b)])
    assert abs((sig[0] == sig[1]).mean() - 0.5 / 3.25) < 0.05


def test_maps_never_exceed_the_difference():
    rng = random.Random(4)
    for _ in range(30):
        a = rng.choices([f"w{i}" for i in range(30)], k=80)
        b = changed(rng, a, rng.randint(0, 40))
        x, y = weighted_sets(Shingler(), [" ".join(a), " ".join(b)])
        maps = parity_maps([x, y], 8).view(np.uint64)
        bits = sum(bin(int(v)).count("1") for v in maps[0] ^ maps[1])
        assert bits <= sum(((bag(" ".join(a)) - bag(" ".join(b))) + (bag(" ".join(b)) - bag(" ".join(a)))).values())


def brute_classes(rows):
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a is not None and b is not None and (a == b or similarity(a, b) >= 0.8):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    lows = {}
    for i, (d, _) in enumerate(rows):
        lows.setdefault(top(i), []).append(d)
    return sorted((d, min(lows[top(i)])) for i, (d, _) in enumerate(rows))


def test_classes_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 500)}" for _ in range(120)]
        chain = base
        for k in range(12):
            rows.append((len(rows), " ".join(chain)))
            if k % 3 == 0:
                rows.append((len(rows), " ".join(changed(rng, base, 6))))
            chain = changed(rng, chain, 1)
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base))]
    # One large group: many copies with 2 words changed, and strangers to it that share most of it.
    base = [f"hot{i}" for i in range(200)]
    rows += [(len(rows) + i, " ".join(changed(rng, base, 2))) for i in range(60)]
    rows += [(len(rows) + i, " ".join(changed(rng, base, 14))) for i in range(20)]
    rows += [(len(rows), "tiny"), (len(rows) + 1, "tiny"), (len(rows) + 2, ""), (len(rows) + 3, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, digest string").repartition(5)
    found = near_copy_classes(df).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in found) == brute_classes(rows)
    assert sum(r["first"] for r in found) == len({r["class_id"] for r in found})


def test_one_of_each_class_keeps_rows_whole(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text, "a"), (3, text, "a"), (5, text + " end", "b"), (None, text, "c"), (7, None, "d"), (7, None, "d"), (None, "other words", "e"), (8, "", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    kept = one_of_each_class(df)
    assert kept.columns == df.columns
    got = sorted((str(r["doc_id"]), r["class_id"]) for r in kept.collect())
    assert got == [("3", "a"), ("7", "d"), ("7", "d"), ("8", "f"), ("None", "e")]
    assert one_of_each_class(df.limit(0)).count() == 0
