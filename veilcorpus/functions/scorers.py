"""Text scorers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from veilcorpus.functions.text import let, words

IDEAL_WORDS = 100


def length_score(output: Column) -> Column:
    """1 at 100 words, falling to 0 at none or 200."""
    n = F.size(words(output))
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(n - IDEAL_WORDS) / F.lit(float(IDEAL_WORDS)))


def diversity_score(output: Column) -> Column:
    """Distinct lower-case words over words; 0 for no words."""

    def ratio(tokens: Column) -> Column:
        distinct = F.size(F.array_distinct(tokens))
        return F.when(F.size(tokens) > 0, distinct / F.size(tokens)).otherwise(F.lit(0.0))

    return let(words(F.lower(output)), ratio)


def coherence_score(output: Column) -> Column:
    """Twice the mean word overlap of all sentence pairs, at most 1.

    The overlap of a pair is its shared words over the size of the smaller set. Pairs are
    never formed: for each word, its sentences are taken from the largest set to the
    smallest, and each adds (sentences seen before it) / (its size), which is the sum over
    the pairs that share the word. That is a sort, not a square.
    """
    parts = F.split(output, "[.]")
    word_sets = F.filter(
        F.transform(parts, lambda s: F.array_distinct(words(F.lower(s)))), lambda ws: F.size(ws) > 0
    )
    score = let(word_sets, _pair_overlap)
    return F.when(F.contains(output, F.lit(".")), score).when(output.isNotNull(), F.lit(0.5))


def _pair_overlap(word_sets: Column) -> Column:
    n = F.size(word_sets)
    entries = F.flatten(
        F.transform(
            word_sets,
            lambda ws: F.transform(ws, lambda w: F.struct(w.alias("w"), (-F.size(ws)).alias("s"))),
        )
    )
    start = F.struct(
        F.lit(None).cast("string").alias("w"), F.lit(0).alias("seen"), F.lit(0.0).alias("sum")
    )

    def step(acc: Column, e: Column) -> Column:
        same = acc.getField("w") == e.getField("w")
        seen = F.when(same, acc.getField("seen")).otherwise(F.lit(0))
        added = acc.getField("sum") + seen / (-e.getField("s"))
        return F.struct(e.getField("w").alias("w"), (seen + 1).alias("seen"), added.alias("sum"))

    total = F.aggregate(F.array_sort(entries), start, step, lambda acc: acc.getField("sum"))
    pairs = n.cast("double") * (n - 1) / 2
    return F.when(n < 2, F.lit(0.5)).otherwise(F.least(F.lit(1.0), total / pairs * 2))


# Scorers of one output text, by name.
OUTPUT_SCORERS: dict[str, Callable[[Column], Column]] = {
    "response_length": length_score,
    "coherence": coherence_score,
    "diversity": diversity_score,
}
