"""Quality rules: how far a text's histograms lie from those of its language.

Two histograms are compared by Jensen-Shannon distance: shares of character classes, and
shares of the common words of the language with one bin for all other words. References
are taken over all documents. Every step is a Spark SQL expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.session import discard, materialize

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
#: Character classes in the order in which they are taken out of a text; what is left is the last class.
CLASSES = {
    "lower": r"[a-z]+",
    "space": SPACES,
    "upper": r"\p{Lu}+",
    "beyond_ascii": r"[^\x00-\x7F]+",
    "digit": r"[0-9]+",
    "mark": r"[.,;:!?'\"()-]+",
}
MARKS = ".,;:!?()[]{}#*$%&|<>-"
BETWEEN = r"[.,;:!?()\[\]{}#*$%&|<>-]*[\x20\x09-\x0D]+[.,;:!?()\[\]{}#*$%&|<>-]*"
COMMON_SHARE = 0.005  # a common word is at least this share of its language's words, so there are 200 at most
LANGUAGE_WORDS = 2_000  # a language with fewer words in all is held against the whole corpus
WORD_SHARE = 0.85  # of the distance that a text without any common word of the language has
CLASS_LIMIT = 0.3
WORD_GUARD, CLASS_GUARD = 100, 400
FEW_WORDS, REPEAT_PERCENT = 50, 50


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of `[^\\x20\\x09-\\x0D]+`; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more; each word counts once."""

    def covered(windows: Column) -> Column:
        # Sorted, equal windows are neighbours.
        def twin(x: Column, i: Column) -> Column:
            before = F.coalesce(F.get(windows, i - 1)["h"] == x["h"], F.lit(False))
            return before | F.coalesce(F.get(windows, i + 1)["h"] == x["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(windows, twin), lambda x: x["at"]))
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    def in_hashes(hashes: Column) -> Column:
        # Most texts repeat no window, and need no sorting.
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(F.sort_array(placed), covered)).otherwise(0)

    def all_windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) >= 3, let(hashes, in_hashes)).otherwise(0)

    return let(words, all_windows)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def common_form(text: Column) -> Column:
    """Words as they are compared: lower case, without marks at their ends; words of marks alone are empty.

    The text is cut at white space together with the marks around it, so no word is handled on its own.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.split(F.btrim(lowered, F.lit(MARKS + " \t\n\x0b\f\r")), BETWEEN)


def with_class_counts(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: characters of each class, the last being all the rest; and `<out>_n_symbols`.

    Classes are taken out one by one, so only the first pattern sees the whole text, and the rarer ones
    little of it.
    """
    columns = docs.columns
    left = docs.withColumn(f"{out}_0", F.coalesce(F.col(text), F.lit("")))
    for i, pattern in enumerate(CLASSES.values()):
        left = left.withColumn(f"{out}_{i + 1}", F.regexp_replace(f"{out}_{i}", pattern, ""))
    sizes = [F.length(f"{out}_{i}") for i in range(len(CLASSES) + 1)]
    counts = [*[a - b for a, b in zip(sizes, sizes[1:])], sizes[-1]]
    unspaced = F.col(f"{out}_2")
    symbols = F.length(unspaced) - F.length(F.regexp_replace(unspaced, SYMBOLS, ""))
    return left.select(*columns, F.array(*counts).alias(out), symbols.alias(f"{out}_n_symbols"))


def _part(a: Column, b: Column) -> Column:
    return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)


def _both(a: Column, b: Column) -> Column:
    """A bin's share of the squared Jensen-Shannon distance."""
    return (_part(a, b) + _part(b, a)) / 2


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two arrays of shares in the same order."""
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(p, q, _both), F.lit(0.0), lambda x, y: x + y)))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return let(total, lambda n: F.transform(counts, lambda c: F.when(n > 0, c / n).otherwise(F.lit(0.0))))


def distance_without_common_words(common: float) -> float:
    """Word distance of a text that has no common word, where these are the share `common` of the language."""
    rest = 1.0 - common
    part = math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest > 0 else 0.0)
    return math.sqrt(max(0.0, common / 2 + part / 2))


REFERENCE = "ref string, shares map<string,double>, common double, word_limit double, class_shares array<double>"


def references(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row for each language with LANGUAGE_WORDS words, and one with null `ref` for all documents.

    `shares` has the common words (200 at most), `common` their sum, `word_limit` the distance beyond which
    a text has too few of them. Words are counted over all documents; only the rows of this table reach the driver.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    tokens = source.select("lang", F.explode(common_form(F.col("text"))).alias("w")).filter("w <> ''")
    counted = materialize(tokens.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    large = totals.filter(F.col("lang").isNotNull() & (F.col("total") >= LANGUAGE_WORDS))
    whole = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = counted.join(large, "lang").filter(F.col("n") >= COMMON_SHARE * F.col("total"))
    every = counted.groupBy("w").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON_SHARE * whole)
    found = own.select("lang", "w", (F.col("n") / F.col("total")).alias("q")).unionByName(
        every.select(F.lit(None).cast("string").alias("lang"), "w", (F.col("n") / whole).alias("q") if whole else F.lit(0.0).alias("q"))
    )
    common: dict[str | None, dict[str, float]] = {r["lang"]: {} for r in large.select("lang").collect()} | {None: {}}
    for r in found.collect():
        common[r["lang"]][r["w"]] = r["q"]
    n = len(CLASSES) + 1
    classes = with_class_counts(source.select("lang", "text"), "text", "c")
    sums = [F.coalesce(F.sum(F.col("c")[i]), F.lit(0)).alias(f"c{i}") for i in range(n)]
    by_language = materialize(classes.groupBy("lang").agg(*sums))
    chars = {r["lang"]: [r[f"c{i}"] for i in range(n)] for r in by_language.join(large, "lang").collect()}
    chars[None] = list(by_language.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)) for i in range(n)]).first())
    rows = []
    for key, q in common.items():
        total = min(1.0, math.fsum(q.values()))
        limit = WORD_SHARE * distance_without_common_words(total)
        rows.append((key, q, total, limit, [c / max(1, sum(chars[key])) for c in chars[key]]))
    discard(counted)
    return spark.createDataFrame(rows, REFERENCE)


def quality_measures(docs: DataFrame, refs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document the base counts, `class_distance`, `word_distance` and the reference's `word_limit`.

    `refs` (see `references`) has at most 200 words a language; its words are literals of the plan, and the
    engine decides by its size how it is joined.
    """
    known = refs.collect()
    common = sorted({w for r in known for w in r["shares"]})
    large = [r["ref"] for r in known if r["ref"] is not None]
    ref = F.when(F.col(lang).isin(large), F.col(lang)) if large else F.lit(None).cast("string")
    own = docs.select(F.col(doc_id).alias("doc_id"), ref.alias("own_ref"), F.col(text).alias("text"))
    kept = F.filter(common_form(F.col("text")), lambda w: w.isin(common)) if common else F.array().cast("array<string>")

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    measured = with_class_counts(own, "text", "classes").select(
        "doc_id",
        "own_ref",
        "classes",
        F.col("classes_n_symbols").alias("n_symbols"),
        let(words_of(F.col("text")), of_words).alias("m"),
        F.array_sort(kept).alias("kept"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
    )
    held = measured.join(refs, F.col("own_ref").eqNullSafe(F.col("ref")), "left")

    # Sorted, equal words are a run: its place and length give the word and its count.
    def first_of_run(w: Column, i: Column) -> Column:
        return (i == 0) | (w != F.coalesce(F.get("kept", i - 1), F.lit("")))

    starts = F.filter(F.transform("kept", lambda w, i: F.when(first_of_run(w, i), i)), lambda i: i.isNotNull())

    def run(at: Column, i: Column, all_: Column) -> Column:
        n = F.coalesce(F.get(all_, i + 1), F.size("kept")) - at
        return F.struct(F.try_element_at("shares", F.get("kept", at)).alias("q"), (n / F.col("m.n_words")).alias("p"))

    seen = F.filter(let(starts, lambda s: F.transform(s, lambda at, i: run(at, i, s))), lambda x: x["q"].isNotNull())
    sums = F.aggregate(
        seen,
        F.struct(F.lit(0.0).alias("js"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q")),
        lambda t, x: F.struct((t["js"] + _both(x["p"], x["q"])).alias("js"), (t["p"] + x["p"]).alias("p"), (t["q"] + x["q"]).alias("q")),
    )
    rest = _both(F.greatest(F.lit(0.0), 1 - F.col("s.p")), F.greatest(F.lit(0.0), 1 - F.col("common")))
    by_words = F.sqrt(F.greatest(F.lit(0.0), F.col("s.js") + (F.col("common") - F.col("s.q")) / 2 + rest))
    chars = F.aggregate("classes", F.lit(0), lambda a, b: a + b)
    return held.withColumn("s", sums).select(
        "doc_id",
        F.col("m.n_words").cast("bigint").alias("n_words"),
        (chars - F.col("classes")[1]).cast("bigint").alias("word_chars"),
        F.col("n_symbols").cast("bigint").alias("n_symbols"),
        F.col("n_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.col("m.n_repeat_words").cast("bigint").alias("n_repeat_words"),
        chars.alias("n_chars"),
        divergence(shares(F.col("classes")), F.col("class_shares")).alias("class_distance"),
        F.when(F.col("m.n_words") > 0, by_words).otherwise(0.0).alias("word_distance"),
        "word_limit",
    )


def quality_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", class_limit: float = CLASS_LIMIT) -> DataFrame:
    """Base counts, `base_failed`, the two distances, and `kept`.

    A document that passes the base rules is kept unless a histogram with enough behind it is too far from its
    reference: of WORD_GUARD words, farther than WORD_SHARE of the distance that a text without any common word
    of the language has (so gibberish and texts under a wrong language fall); of CLASS_GUARD characters, farther
    than `class_limit`. Null and empty texts have no words and fail the base rules. A null language, or one with
    few words, is held against all documents. Repeated rows are each judged; extra columns are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    out = quality_measures(slim, references(slim))
    failed = (F.col("n_words") < FEW_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    odd_words = (F.col("n_words") >= WORD_GUARD) & (F.col("word_distance") > F.col("word_limit"))
    odd_classes = (F.col("n_chars") >= CLASS_GUARD) & (F.col("class_distance") > class_limit)
    rated = out.withColumn("base_failed", failed)
    return rated.withColumn("kept", ~F.col("base_failed") & ~odd_words & ~odd_classes).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 9).alias("class_distance"), F.round("word_distance", 9).alias("word_distance"),
    )
