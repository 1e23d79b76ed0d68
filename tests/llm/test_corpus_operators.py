import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilcorpus.llm import quality_divergence as quality
from veilcorpus.llm.kd_shards import kd_tree_shards
from veilcorpus.llm.license_scan import TEMPLATES, TRIGGER, ancestors, directory_of, license_scan
from veilcorpus.llm.toxicity import (
    FEATURES,
    FuzzyTrie,
    ToxicLexicon,
    ToxicScorer,
    choose_terms,
    edits_allowed,
    fit_weights,
    learn_lexicon,
    learning_fold,
    toxicity_report,
)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automata_find_what_edit_distance_finds():
    rng = random.Random(1)
    terms = ["idiot", "moron", "scum", "worthless", "abc", "disgusting"]
    trie = FuzzyTrie(terms, [])
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choices("abcdiotx1", k=rng.randint(0, 1))
        word = "".join(word)
        near = [(distance(word, t), t) for t in terms if distance(word, t) <= edits_allowed(t)]
        found = trie.find(word)
        assert (found and found[:2]) == ((min(near)[1], min(near)[0]) if near else None), word


def test_stems_are_found_exactly():
    trie = FuzzyTrie(["moron"], ["vequ"])
    assert trie.find("vequoi") == ("vequ", 0, False)
    assert trie.find("veqoi") is None and trie.find("") is None


def test_context_tells_quotation_from_abuse():
    scorer = ToxicScorer(ToxicLexicon(words={"idiot": 0.99, "moron": 0.99}, weights=(-5, 8, 1, 1, 1, 8, 3, 1)))
    assert scorer.score("you are an idiot") > 0.5
    assert scorer.score("you are an id1ot, really") > 0.5 and scorer.score("an idiooot") > 0.5
    assert scorer.score('she said "you idiot" to the court') < 0.5
    assert scorer.score("") == scorer.score("nothing here") < 0.1


def test_terms_that_beat_chance():
    counts = [("bad", 20, 20), ("rare", 3, 3), ("stem*", 30, 31), ("stemmed*", 20, 20), ("common", 30, 90)]
    chosen = choose_terms(counts, 50, 500, 1000)
    assert set(chosen) == {"bad", "stem*"}


def test_toxicity_is_learned_and_odd_rows_get_a_score(spark):
    rng = random.Random(2)
    plain = ["table", "river", "green", "walks", "sunday", "paper"]
    rows, labels = [], []
    for i in range(500):
        words = rng.choices(plain, k=30)
        toxic = i % 5 == 1
        if toxic:
            words[rng.randrange(30)] = rng.choice(["scumbag,", "worthless"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    lexicon = learn_lexicon(df, lab)
    assert set(lexicon.words) == {"scumbag", "worthless"} and not lexicon.stems
    odd = spark.createDataFrame([(900, None, ""), (901, "", ""), (None, "river " * 20_000 + "worthless", "")], df.schema)
    got = {r["doc_id"]: r for r in toxicity_report(df.unionByName(odd), lexicon).collect()}
    assert all(got[i]["predicted"] == t for i, t in labels)
    assert got[5]["held_out"] == (zlib.crc32(b"5") % 5 == 0)
    assert got[900]["predicted"] == got[901]["predicted"] == 0 and got[None]["predicted"] == 1
    empty = learn_lexicon(df.limit(0), lab)
    assert toxicity_report(df.limit(2), empty).filter("score between 0 and 1").count() == 2
    assert df.select(learning_fold(F.lit(None).cast("long")).alias("f")).distinct().collect()[0]["f"] is False


def test_copies_and_shared_ids_do_not_fill_the_sample(spark):
    rng = random.Random(12)
    plain = ["table", "river", "green", "walks", "sunday", "paper"]
    rows = [(i, " ".join(rng.choices(plain, k=30)) + (" scumbag" if i % 5 == 1 else "")) for i in range(300)]
    rows += [(1, f"river table {i} walks") for i in range(300)]  # an id that half of all rows share, labelled toxic
    rows += [(1000 + i, "copy " * 20) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 5 == 1 and i != 1)) for i in range(1300)], "doc_id long, toxic int")
    lexicon = learn_lexicon(df, lab, sample_rows=500)
    assert "scumbag" in lexicon.words


def test_no_term_is_left_out_for_its_number():
    counts = [(f"term{i:04d}x", 20, 20) for i in range(900)]
    assert len(choose_terms(counts, 50, 500, 1000)) == 900


def test_weights_do_not_run_away():
    x = np.zeros((80, len(FEATURES)))
    x[:, 0] = 1.0
    y = np.array([1.0] * 9 + [0.0] * 71)
    bias = fit_weights(x, y)[0]
    assert abs(1 / (1 + math.exp(-bias)) - 9 / 80) < 0.03


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n ", "a b c", "a b c a b c", "x y z\n" * 5]
    texts += ["".join(rng.choices(["a", "b", " ", "\n", "\t", "é", "#", "<", "😀", "\x0b", "\r"], k=rng.randint(0, 80))) for _ in range(200)]
    texts.append("long text " * 20_000)
    df = spark.createDataFrame([(i, t, "en" if i % 3 else None, 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, kept int")
    out = {r["doc_id"]: r for r in quality.quality_report(df.unionByName(df.limit(3))).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute_measures(t), t
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality_report(df.limit(0)).count() == 0


def test_divergence_is_jensen_shannon(spark):
    pairs = [([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.2, 0.8, 0.0], [0.5, 0.25, 0.25])]
    df = spark.createDataFrame(pairs, "p array<double>, q array<double>")
    for (p, q), r in zip(pairs, df.select(quality.divergence(F.col("p"), F.col("q")).alias("d")).collect()):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        want = sum(x * math.log2(x / y) for s in (p, q) for x, y in zip(s, m) if x) / 2
        assert abs(r["d"] - math.sqrt(want)) < 1e-9


def test_odd_text_is_not_kept_and_common_text_is(spark):
    rng = random.Random(5)
    common = ["the", "of", "and", "to"]
    prose = lambda: " ".join(rng.choice(common) if rng.random() < 0.4 else "w" + "".join(rng.choices("abcdefgh", k=5)) for _ in range(200))
    junk = " ".join("".join(rng.choices("0123456789$%&", k=8)) for _ in range(200))
    df = spark.createDataFrame([(i, prose(), "en") for i in range(60)] + [(99, junk, "en")], "doc_id long, text string, lang string")
    refs = {r["ref"]: r for r in quality.references(df).collect()}
    assert set(common) <= set(refs["en"]["shares"]) and abs(sum(refs["en"]["shares"].values()) - refs["en"]["common"]) < 1e-9
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(df).collect()}
    assert not kept.pop(99) and all(kept.values())


def test_gibberish_and_the_wrong_language_fall(spark):
    rng = random.Random(15)
    common = {"en": ["the", "of", "and", "to", "is"], "de": ["der", "die", "und", "das", "ist"]}

    def prose(lang, n=300):
        return " ".join(rng.choice(common[lang]) if rng.random() < 0.35 else "".join(rng.choices("abcdefghiklmnorst", k=rng.randint(3, 9))) for _ in range(n))

    rows = [(f"{lang}{i}", prose(lang).capitalize() + ".", lang) for lang in common for i in range(40)]
    rows += [("few", prose("en", 400), "xx"), ("no language", prose("en", 400), None)]
    rows += [(f"gibberish {lang}", " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(300)), lang) for lang in [*common, "xx", None]]
    rows += [("german as english", prose("de"), "en"), ("english as german", prose("en"), "de"), ("short gibberish", "qq ww " + " ".join("zz" + str(i) for i in range(60)), "en")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    assert {r["ref"] for r in quality.references(df).collect()} == {"en", "de", None}
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_report(df).collect()}
    fallen = {k for k, v in kept.items() if not v}
    assert fallen == {"gibberish en", "gibberish de", "gibberish xx", "gibberish None", "german as english", "english as german"}


def test_shards_share_bytes_evenly(spark):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randint(0, 200), rng.choice(["a", "b", None]), 1) for i in range(2000)]
    rows += [(5000, "same text " * 9, "a", 1)] * 900 + [(None, None, "c", 1)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int").repartition(4)
    out = kd_tree_shards(df, dims=["source", "doc_id"], shards=13).collect()
    assert len(out) == len(rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
    total = sum(r["size"] for r in out)
    assert sorted(by) == list(range(13))
    for members in by.values():
        assert abs(sum(r["size"] for r in members) - total / 13) <= 2 * 216
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] is None} == {(16, 0)}
    known = {i: t for i, t, _, _ in rows}
    assert all(r["size"] == len(known[r["doc_id"]] or "") + 16 for r in out)
    assert kd_tree_shards(df.limit(0), dims=["source"], shards=4).count() == 0
    few = kd_tree_shards(df, dims=["doc_id"], target_bytes=total // 5).agg(F.count_distinct("shard")).first()[0]
    assert few == 5
    with pytest.raises(ValueError):
        kd_tree_shards(df, dims=["doc_id"])


def test_splits_follow_the_widest_dimension(spark):
    # Of 400 cells, the first split halves `a`, after which `b` is wider: quarters, not strips.
    rows = [(i, "x" * 10, i % 20, (i // 20) * 1000) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, a long, b long")
    out = kd_tree_shards(df, dims=["a", "b"], shards=4).collect()
    assert {(r["shard"], r["doc_id"] % 20 < 10, r["doc_id"] < 200) for r in out} == {(0, True, True), (1, True, False), (2, False, True), (3, False, False)}
    # One far value keeps each half of `a` that has it wide: there `a` is split again.
    far = spark.createDataFrame([(i, "x" * 10, 10_000 if i == 399 else i % 20, (i // 20) * 1000) for i in range(400)], df.schema)
    out = kd_tree_shards(far, dims=["b", "a"], shards=4).collect()
    by = collections.defaultdict(set)
    for r in out:
        by[r["shard"]].add(r["doc_id"] % 20)
    assert len(by[0]) == len(by[1]) == 20 and len(by[2] & by[3]) <= 1


def brute_tree(rows, shards):
    """Shard of each (id, size, place, place ...); no two rows share a place."""
    dims = range(2, len(rows[0]))
    ranges = {d: max(r[d] for r in rows) - min(r[d] for r in rows) for d in dims}
    out = {}

    def grow(members, first, k):
        if k == 1 or not members:
            out.update((r[0], first) for r in members)
            return
        d = max(dims, key=lambda d: ((max(r[d] for r in members) - min(r[d] for r in members)) / ranges[d], -d))
        members = sorted(members, key=lambda r: r[d])
        share, done, cut = sum(r[1] for r in members) * (k // 2) / k, 0, 0
        for cut, r in enumerate(members):
            if done + r[1] >= share:
                cut += done + r[1] - share <= share - done
                break
            done += r[1]
        grow(members[:cut], first, k // 2)
        grow(members[cut:], first + k // 2, k - k // 2)

    grow(rows, 0, shards)
    return out


def test_shards_equal_a_brute_force_tree(spark, monkeypatch):
    rng = random.Random(8)
    prefix = "https://a.very.long.common.prefix.example/"  # only the ends of the sources differ
    ids = [*(rng.randint(-(2**63), 2**63 - 1) for _ in range(150)), *rng.sample(range(10**6), 150)]
    rows = [(i, "x" * rng.randint(0, 300), f"{prefix}{rng.random():.12f}", rng.random() - 0.5) for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double").repartition(5)
    for name in ("row", "node", "tie", "p0", "d0", "value", "place", "slot"):
        df = df.withColumn(name, F.lit("user"))
    monkeypatch.setattr("veilcorpus.llm.kd_shards.CELLS", 7)
    monkeypatch.setattr("veilcorpus.llm.kd_shards.ROWS_A_TASK", 40)
    sizes = {r[0]: len(r[1]) + 16 for r in rows}

    def by_weight(key):
        done, places = 0, {}
        for r in sorted(rows, key=key):
            places[r[0]], done = done, done + sizes[r[0]]
        return places

    source, quality = by_weight(lambda r: r[2]), by_weight(lambda r: r[3])
    wanted = brute_tree([(r[0], sizes[r[0]], source[r[0]], quality[r[0]], r[0]) for r in rows], 11)
    out = {r["doc_id"]: r["shard"] for r in kd_tree_shards(df, dims=["source", "quality", "doc_id"], shards=11).collect()}
    assert out == wanted


def test_every_template_has_a_trigger_and_wins_for_itself(spark):
    assert all(re.search(TRIGGER, text) for _, text in TEMPLATES)
    rows = [(i, f"prose before\n{text}\n") for i, (_, text) in enumerate(TEMPLATES)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan(df, F.concat(F.lit("d"), F.col("doc_id"), F.lit("/f.txt"))).collect()}
    assert all(got[i]["license"] == name and got[i]["how"] == "own" for i, (name, _) in enumerate(TEMPLATES))


def test_nearest_directory_is_inherited(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/code.py", "print()"), (3, "a/b/COPYING", gpl), (4, "a/x.py", ""), (5, "z/x.py", None),
        (6, None, "no path"), (7, "a/b/own.py", "# code " * 50 + "\n" + mit), (8, "ab/x.py", "text"), (2, "a/b/c/code.py", "print()"), (9, "a/b/d/long.txt", "word " * 50_000),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, file string, text string, path string")
    got = {r["doc_id"]: (r["license"], r["how"], r["from_directory"]) for r in license_scan(df, F.col("file")).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("GPL-3.0", "inherited", "a/b"), 3: ("GPL-3.0", "own", None), 4: ("MIT", "inherited", "a"),
        5: (None, "none", None), 6: (None, "none", None), 7: ("MIT", "own", None), 8: (None, "none", None), 9: ("GPL-3.0", "inherited", "a/b"),
    }
    assert license_scan(df, F.col("file")).count() == len(rows)
    assert license_scan(df.limit(0), F.col("file")).count() == 0


def test_wrapped_licence_text_is_a_licence_file(spark):
    words = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.".split()
    wrapped = "\n".join(" ".join(words[i : i + 5]) for i in range(0, len(words), 5))
    notice = "Released under the MIT License."
    rows = [
        (1, "a/1.txt", f"My project\n\n{wrapped}\n"), (2, "a/2.txt", "prose"), (3, "b/3.txt", f"{wrapped}\n\n" + "prose " * 40), (4, "b/4.txt", "prose"),
        # A line of a matching paragraph counts once: 15 of 31 words are no licence file, 15 of 30 are one.
        (5, "c/5.txt", f"{notice}\n{notice}\n\n{notice}\n\n" + "prose " * 16), (6, "c/6.txt", "prose"),
        (7, "d/7.txt", f"{notice}\n{notice}\n\n{notice}\n\n" + "prose " * 15), (8, "d/8.txt", "prose"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, file string, text string")
    got = {r["doc_id"]: (r["license"], r["how"], r["from_directory"]) for r in license_scan(df, F.col("file")).collect()}
    assert got[2] == ("MIT", "inherited", "a") and got[8] == ("MIT", "inherited", "d")
    assert got[4] == got[6] == (None, "none", None)


def test_real_texts_headers_and_spdx_lines_are_found(spark):
    mit = (
        "Copyright (c) 2020 Jane Roe\n\nPermission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\n"
        "files (the \"Software\"), to deal in the Software without\nrestriction, including without limitation the rights to use,\ncopy, modify, merge, publish, distribute, sublicense, and/or sell\n"
        "copies of the Software, and to permit persons to whom the\nSoftware is furnished to do so, subject to the following\nconditions:\n"
    )
    clause = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n"
    bsd = f"Copyright (c) 2021, Jane Roe\nAll rights reserved.\n\n{clause}\n"
    neither = "3. Neither the name of Jane Roe nor the names of other\ncontributors may be used to endorse or promote products derived from\nthis software without specific prior written permission.\n"
    apache = "# Copyright 2019 Jane Roe\n#\n# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n"
    heads = "                   GNU {}GENERAL PUBLIC LICENSE\n                       Version 3, {} 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n"
    cases = [
        (mit, "MIT"), ("prose\n" + bsd, "BSD-2-Clause"), (bsd + neither, "BSD-3-Clause"), (apache, "Apache-2.0"),
        (heads.format("", "29 June"), "GPL-3.0"), (heads.format("AFFERO ", "19 November"), "AGPL-3.0"),
        ("All rights reserved.", "Proprietary"), ("// SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: (MIT OR Zlib)", "MIT OR Zlib"),
        ("MIT License", "MIT"), ("Licensed under the BSD 2-Clause License.", "BSD-2-Clause"), ("All rights reserved.\nMIT License", "MIT"),
        ("1. Definitions.\nA licence to print money.", None),
    ]
    df = spark.createDataFrame([(i, "plain words\n" + t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["license"] for r in license_scan(df, F.lit(None).cast("string")).collect()}
    assert got == {i: name for i, (_, name) in enumerate(cases)}


def test_ancestors(spark):
    df = spark.createDataFrame([("a/b/c.txt",), ("c.txt",), ("/r/x",)], "p string")
    got = [r["x"] for r in df.select(ancestors(directory_of(F.col("p"))).alias("x")).collect()]
    assert got == [["a/b", "a", ""], [""], ["/r", "", ""]]
