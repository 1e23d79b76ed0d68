"""Regex scans: leaks in hard negatives, and simple detectors for unlabelled text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veilcorpus.fixed_values import LEAK_PATTERNS

# Detectors for text that carries no labels: label -> (must contain, pattern).
# The first part is a cheap literal test that skips the regex on most rows.
DETECTORS = {
    "EMAIL": ("@", r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9]+(?:\.[A-Za-z0-9]+)*"),
    "TELEPHONENUM": ("+1 (", r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    "CREDITCARDNUMBER": (None, r"\b[0-9]{16}\b"),
    "IPV4": (".", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"),
    "TOKEN": (None, r"\b[0-9a-f]{40}\b"),
}


def has_leak(text: Column, category: str) -> Column:
    """True if the text holds something that looks like a value of the category."""
    pattern = LEAK_PATTERNS.get(category)
    return F.lit(False) if pattern is None else text.rlike("(?U)" + pattern)


def leaks_own_category(text: Column, category: Column) -> Column:
    """`has_leak` with the category taken from the row; other categories have no pattern."""
    out = F.lit(False)
    for name in LEAK_PATTERNS:
        out = F.when(category == name, has_leak(text, name)).otherwise(out)
    return out


def _labelled(values: Column, label: str) -> Column:
    return F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(label).alias("label")))


def detect_mask(text: Column, detectors: dict = DETECTORS) -> Column:
    """`ARRAY<STRUCT<value, label>>` of all detector hits, detector by detector."""
    found = []
    for label, (needle, pattern) in detectors.items():
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if needle is not None:
            hits = F.when(F.contains(text, F.lit(needle)), hits).otherwise(
                F.array().cast("array<string>")
            )
        found.append(_labelled(hits, label))
    return F.concat(*found)


def all_verbatim(text: Column, entities: Column) -> Column:
    """Every entity occurs in the text exactly as written."""
    return F.forall(entities, lambda e: F.contains(text, e))
