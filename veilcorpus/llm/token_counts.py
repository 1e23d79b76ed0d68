"""Token counts of fields or sections, with each document encoded once and whole.

Encoding sections apart would count other tokens than the model sees, because a token may
cross a boundary. So the whole text is encoded, each token's span in the text is known from
the lengths of the tokens, and spans of tokens are joined with spans of sections.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.llm.batches import small_batches

RULES = ("most", "start", "split")
REST = -1  # section number of text that lies in no section


class SpanEncoder:
    """Byte spans of the tokens of a text, for a byte-level BPE given as ranks."""

    def __init__(self, ranks_path: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("spans", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """End of each token in the text's UTF-8 bytes; a token starts where the last one ends."""
        return np.cumsum(self.length[self.encoding.encode_ordinary(text)])


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of lines, each with its line feed; a text that ends in one has no further line."""
    sizes = [len(part) + 1 for part in text.split("\n")]
    sizes[-1] -= 1
    if not sizes[-1]:
        sizes.pop()
    ends = np.cumsum(np.array(sizes, np.int64))
    return ends - np.array(sizes, np.int64), ends


def attribute(token_ends: np.ndarray, text: str, starts: np.ndarray, ends: np.ndarray, rule: str = "most") -> tuple[np.ndarray, float]:
    """Tokens of each section, and tokens of the text in none of them.

    A character that several sections claim belongs to the one that starts first, and of
    those that start together to the first given. `most`: a token on a boundary goes to
    the section with most of its bytes, the first of equals; `start`: to the section of its
    first byte; `split`: to each by its share of the bytes.
    """
    data = text.encode()
    char_at = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
    counts = np.zeros(len(starts) + 1)
    if not len(token_ends):
        return counts[:-1], 0.0
    edges, owners, done = [], [], 0
    for k in np.argsort(starts, kind="stable").tolist():
        low, high = max(int(starts[k]), done), min(int(ends[k]), len(char_at) - 1)
        if high <= low:
            continue
        if low > done:
            edges.append(done)
            owners.append(REST)
        edges.append(low)
        owners.append(k)
        done = high
    if done < len(char_at) - 1:
        edges.append(done)
        owners.append(REST)
    edge, owner = char_at[edges], np.array(owners)
    token_starts = np.append(0, token_ends[:-1])
    head = np.searchsorted(edge, token_starts, side="right") - 1
    tail = np.searchsorted(edge, token_ends - 1, side="right") - 1
    whole = (head == tail) | (rule == "start")
    np.add.at(counts, owner[head[whole]], 1.0)
    limits = np.append(edge, len(data))
    for t in np.flatnonzero(~whole):
        parts = np.arange(head[t], tail[t] + 1)
        overlap = np.minimum(limits[parts + 1], token_ends[t]) - np.maximum(limits[parts], token_starts[t])
        if rule == "split":
            np.add.at(counts, owner[parts], overlap / overlap.sum())
        else:
            held = np.zeros(len(counts))
            np.add.at(held, owner[parts], overlap)
            best = max(parts.tolist(), key=lambda p: (held[owner[p]], -p))
            counts[owner[best]] += 1
    return counts[:-1], float(counts[-1])


def section_token_counts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    sections: Column | None = None,
    rule: str = "most",
) -> DataFrame:
    """Rows `doc_id, section, start, end, n_tokens, doc_tokens`, one for each section of each document.

    `sections` is an array of structs `(start, end)` in characters, end exclusive; without it
    the lines are the sections. `section` counts from 0 in the order given; tokens in no
    section are counted in a row of section -1 with null span, which is left out if it is 0.
    Spans that are null, reversed or outside the text get no token. A null or empty text has
    no lines, and with sections given has 0 tokens in each. Repeated rows give repeated
    results. The counts of a document always add up to `doc_tokens`. Extra columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    small_batches(docs.sparkSession)

    @F.pandas_udf("start array<bigint>, end array<bigint>, n array<double>, rest double, total bigint")
    def count(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoder = SpanEncoder(ranks_path, pattern)
        for texts, given_starts, given_ends in batches:
            out = []
            for own, s, e in zip(texts, given_starts, given_ends):
                own = own or ""
                token_ends = encoder.ends(own)
                if s is None:
                    starts, ends = line_spans(own)
                else:
                    starts = np.nan_to_num(np.asarray(s, float), nan=0).astype(np.int64)
                    ends = np.where(np.isnan(np.asarray(s, float)), 0, np.nan_to_num(np.asarray(e, float), nan=0)).astype(np.int64)
                n, rest = attribute(token_ends, own, starts, ends, rule)
                out.append((starts, ends, n, rest, len(token_ends)))
            yield pd.DataFrame(out, columns=["start", "end", "n", "rest", "total"])

    none = F.lit(None).cast("array<bigint>")
    if sections is None:
        starts, ends = none, none
    else:
        given = F.coalesce(sections, F.array().cast("array<struct<start:bigint,end:bigint>>"))
        starts = F.transform(given, lambda s: s["start"].cast("bigint"))
        ends = F.transform(given, lambda s: s["end"].cast("bigint"))
    counted = docs.select(F.col(doc_id).alias("doc_id"), count(F.col(text), starts, ends).alias("c"))
    inside = F.transform(
        F.arrays_zip("c.start", "c.end", "c.n"),
        lambda x, i: F.struct(i.alias("section"), x["start"].alias("start"), x["end"].alias("end"), x["n"].alias("n_tokens")),
    )
    outside = F.struct(
        F.lit(REST).alias("section"), F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("end"), F.col("c.rest").alias("n_tokens")
    )
    rows = F.when(F.col("c.rest") > 0, F.concat(inside, F.array(outside))).otherwise(inside)
    return counted.select("doc_id", F.inline(rows), F.col("c.total").alias("doc_tokens"))
