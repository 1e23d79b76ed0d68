import random

from pyspark.sql import functions as F

from veilcorpus.llm.decontaminate import contamination_report, find_contamination, scan, searchers, words

DOCS = "doc_id long, text string, n_words string"


def brute(text, items, size=13):
    """Hit positions and items by comparing every place."""
    own, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        m = min(size, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            for j in range(len(own) - m + 1):
                if own[j : j + m] == w[i : i + m]:
                    hit |= set(range(j, j + m))
                    found.add(item)
    return len(own), sorted(hit), sorted(found)


def test_words_fold_ascii_only():
    assert words("ÄB-c Déjà_2") == ["Äb".encode(), b"c", "déjà".encode(), b"2"]
    assert words(None) == words("") == words(" \x00!") == []


def test_search_equals_brute_force():
    rng = random.Random(3)
    for trial in range(60):
        vocabulary = [chr(97 + i) for i in range(rng.choice((2, 3, 8)))]
        items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 5, 13, 14, 20))))) for i in range(6)]
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 120)))
        size = rng.choice((4, 13))
        rows = []
        for item, t in items:
            w = words(t)
            m = min(size, len(w))
            rows += [(b" ".join(w[i : i + m]).decode(), item) for i in range(len(w) - m + 1 if m else 0)]
        assert scan(searchers(sorted(set(rows))), text) == brute(text, items, size)


def test_report_over_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    items = spark.createDataFrame([(1, passage), (1, passage), (2, "Short One"), (3, None), (None, "lonely"), (4, "")], "item_id long, text string")
    long = "x " * 50_000 + passage
    docs = spark.createDataFrame(
        [(1, passage.upper(), "a"), (1, passage.upper(), "a"), (2, None, None), (3, "", "b"), (4, long, "c"), (None, "short-one", "d"), (5, "lonely", "e")], DOCS
    )
    rows = contamination_report(docs, items).collect()
    assert len(rows) == 7
    by = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert (by[1, 13]["n_hit"], by[1, 13]["n_items"], by[1, 13]["contaminated"]) == (13, 1, True)
    assert (by[2, 0]["n_hit"], by[2, 0]["contaminated"]) == (0, False)
    assert (by[4, 50_013]["n_hit"], by[4, 50_013]["contaminated"]) == (13, False)
    assert by[None, 2]["n_items"] == 1 and by[None, 2]["contaminated"]
    assert by[5, 1]["n_hit"] == 1 and by[5, 1]["n_items"] == 0
    kept = find_contamination(docs, items, out="found")
    assert kept.columns == ["doc_id", "text", "n_words", "found"]


def test_blocks_of_patterns_give_the_same(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("abc", k=20))) for i in range(8)]
    docs = [(i, " ".join(rng.choices("abc", k=200)), "") for i in range(20)]
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(contamination_report(d, b, size=5).collect())
    many = sorted(contamination_report(d, b, size=5, windows_per_pass=30).collect())
    assert one == many and any(r["n_hit"] for r in one)
    empty = contamination_report(d, b.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert empty == 0
    assert contamination_report(d.limit(0), b).count() == 0
