"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive benchmark words. All windows of one length are
searched together: a table gives, for the block of words at the end of the current
position, how far the search may jump without passing an occurrence; where it gives 0,
the bucket of that block, split by the first word, holds the windows to compare directly.
Documents are scanned once each and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilcorpus.llm.batches import small_batches
from veilcorpus.session import materialize

# Lower-cases A-Z, keeps digits, a-z and every byte of a non-ASCII character, and turns all else into a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
BLOCK = 2
Window = tuple[bytes, ...]


def words(text: str | None) -> list[bytes]:
    """Words of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; null has none."""
    return text.encode().translate(FOLD).split() if text else []


class WuManber:
    """Finds windows of one length `m` in a list of words."""

    def __init__(self, m: int, windows: dict[Window, list[str]]):
        self.m, self.block = m, min(BLOCK, m)
        self.far = m - self.block + 1
        self.shift: dict[Window, int] = {}
        self.buckets: dict[Window, dict[bytes, list[tuple[Window, list[str]]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, m + 1):
                part = window[end - self.block : end]
                self.shift[part] = min(self.shift.get(part, self.far), m - end)
            last = window[m - self.block :]
            self.buckets.setdefault(last, {}).setdefault(window[0], []).append((window, items))

    def find(self, text: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start of each occurrence and the items whose window it is."""
        m, block, far, shift, buckets = self.m, self.block, self.far, self.shift, self.buckets
        end, n = m, len(text)
        while end <= n:
            part = tuple(text[end - block : end])
            jump = shift.get(part, far)
            if jump:
                end += jump
                continue
            tests = buckets[part].get(text[end - m], ())
            if tests:
                found = tuple(text[end - m : end])
                for window, items in tests:
                    if window == found:
                        yield end - m, items
            end += 1


def searchers(rows: Iterable[tuple[str, str]]) -> list[WuManber]:
    """One searcher for each window length among `(window words joined by spaces, item)` rows."""
    by_length: dict[int, dict[Window, list[str]]] = {}
    for text, item in rows:
        window = tuple(text.encode().split(b" "))
        by_length.setdefault(len(window), {}).setdefault(window, []).append(item)
    return [WuManber(m, windows) for m, windows in sorted(by_length.items())]


def scan(tables: list[WuManber], text: str | None) -> tuple[int, list[int], list[str]]:
    """Number of words, positions inside an occurrence, and the ids of the items found."""
    own = words(text)
    hit: set[int] = set()
    items: set[str] = set()
    for table in tables:
        for start, found in table.find(own):
            hit.update(range(start, start + table.m))
            items.update(found)
    items.discard(None)
    return len(own), sorted(hit), sorted(items)


def windows_of(items: DataFrame, item_id: str, item_text: str, size: int) -> DataFrame:
    """Distinct `(window, item)` rows; an item of fewer than `size` words is one window."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"]):
                own = words(text)
                m = min(size, len(own))
                starts = range(len(own) - m + 1) if m else ()
                rows += [(b" ".join(own[i : i + m]).decode(), item) for i in starts]
            yield pd.DataFrame(rows, columns=["window", "item"])

    slim = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    return slim.mapInPandas(cut, "window string, item string").distinct()


SCAN_TYPE = "n_words bigint, hit array<int>, items array<string>"


def _scanner(patterns: list[tuple[str, str]], earlier: bool):
    """A column function for one set of patterns; with `earlier` it adds to what other sets found."""

    @F.pandas_udf(SCAN_TYPE)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        tables = searchers(shared.value)
        for batch in batches:
            rows = [scan(tables, text) for text in (batch[0] if earlier else batch)]
            if earlier:
                held = zip(rows, batch[1]["hit"], batch[1]["items"])
                rows = [(n, sorted({*hit, *h}), sorted({*items, *i})) for (n, hit, items), h, i in held]
            yield pd.DataFrame(rows, columns=["n_words", "hit", "items"])

    shared = SparkSession.active().sparkContext.broadcast(patterns)
    return run


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "contamination",
    size: int = 13,
    one_in: int = 20,
    windows_per_pass: int = 500_000,
) -> DataFrame:
    """Add the struct `out`: `n_words, hit (word positions), items (ids, sorted as strings), contaminated`.

    A document is contaminated when some word is hit and hits are at least one word in `one_in` (that is, n_hit * one_in >= n_words).
    The windows are broadcast, at most about `windows_per_pass` at a time: they are dealt into
    sets by hash of (window, item), and a larger benchmark takes more passes over the
    documents, each adding to the last one's struct, which is written to the shared folder.

    Null and empty texts have no words, no hits and are clean. A null item id hits words but
    is not listed. Repeated items count once; repeated documents are each judged alone. An
    empty benchmark leaves all clean. A column named like `out` is replaced, others are kept.
    """
    small_batches(docs.sparkSession)
    found = windows_of(items, item_id, item_text, size)
    passes = 1
    if (n := found.count()) > windows_per_pass:
        found, passes = materialize(found), -(-n // windows_per_pass)
    dealt = found.withColumn("set", F.pmod(F.xxhash64("window", "item"), F.lit(passes)))
    for k in range(passes):
        patterns = [(r["window"], r["item"]) for r in dealt.filter(F.col("set") == k).select("window", "item").collect()]
        scanner = _scanner(patterns, earlier=k > 0)
        args: list[Column] = [F.col(text)] + ([F.col(out)] if k else [])
        docs = docs.withColumn(out, scanner(*args))
        if k + 1 < passes:
            docs = materialize(docs)
    n_hit, n_words = F.size(F.col(out)["hit"]), F.col(out)["n_words"]
    return docs.withColumn(out, F.col(out).withField("contaminated", (n_hit > 0) & (n_hit * one_in >= n_words)))


def contamination_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: `doc_id, n_words, n_hit, n_items, items_sha256, contaminated`.

    The sha256 is over the found item ids, sorted as strings and joined by commas.
    """
    seen = find_contamination(docs, items, out="_found", **options)
    got = F.col("_found")
    return seen.select(
        "doc_id",
        got["n_words"].alias("n_words"),
        F.size(got["hit"]).cast("bigint").alias("n_hit"),
        F.size(got["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", got["items"]), 256).alias("items_sha256"),
        got["contaminated"].alias("contaminated"),
    )
