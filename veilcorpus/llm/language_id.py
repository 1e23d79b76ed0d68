"""Language identification by a byte convolutional network.

Each byte becomes a small vector; filters of several widths slide over a window of fixed
length, each keeps its largest response, and a softmax layer turns these into languages.
The network is trained in numpy on a bounded sample of windows, and then applied to all
windows of every text, whose evidence is averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from veilcorpus.llm.batches import small_batches

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
DIMENSIONS = 8
PER_LANGUAGE = 800
UNKNOWN = "und"
FOLDS = 3
BINS = 64
BATCH_WINDOWS = 512


class ByteConvNet:
    def __init__(self, languages: list[str], seed: int = 0):
        rng = np.random.default_rng(seed)
        self.languages = languages
        wide, n = max(WIDTHS), FILTERS * len(WIDTHS)
        self.embed = rng.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32)
        # Narrow filters are wide ones whose last places are held at zero.
        self.mask = np.concatenate(
            [np.repeat(np.arange(wide) < w, DIMENSIONS)[:, None].repeat(FILTERS, 1) for w in WIDTHS], axis=1
        ).astype(np.float32)
        self.filters = rng.normal(0, 0.3, self.mask.shape).astype(np.float32) * self.mask
        self.lift = np.zeros(n, np.float32)
        self.dense = rng.normal(0, 0.1, (n, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _responses(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Patches of embedded bytes, and the response of every filter at every place."""
        wide, places = max(WIDTHS), windows.shape[1] - max(WIDTHS) + 1
        bytes_ = self.embed[windows]
        patches = np.concatenate([bytes_[:, j : j + places] for j in range(wide)], axis=2)
        return patches, patches @ self.filters

    def logits(self, windows: np.ndarray) -> np.ndarray:
        _, response = self._responses(windows)
        return np.maximum(response.max(axis=1) + self.lift, 0) @ self.dense + self.bias

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 14, batch: int = 128, rate: float = 0.004, seed: int = 0) -> None:
        """Adam on the cross-entropy; each language counts alike, however many windows it has."""
        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=len(self.languages))
        importance = (len(labels) / (len(self.languages) * np.maximum(share, 1)))[labels]
        params = [self.embed, self.filters, self.lift, self.dense, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                step += 1
                for p, g, m, v in zip(params, self._gradients(windows[some], labels[some], importance[some]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, windows, labels, importance) -> list[np.ndarray]:
        n = len(labels)
        patches, response = self._responses(windows)
        best = response.argmax(axis=1)
        peak = np.take_along_axis(response, best[:, None, :], axis=1)[:, 0] + self.lift
        pooled = np.maximum(peak, 0)
        z = pooled @ self.dense + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), labels] -= 1
        dz = (p * importance[:, None] / n).astype(np.float32)
        d_peak = (dz @ self.dense.T) * (peak > 0)
        chosen = patches[np.arange(n)[:, None], best]  # rows, filters, patch
        d_filters = np.einsum("nf,nfp->pf", d_peak, chosen) * self.mask
        d_embed = np.zeros_like(self.embed)
        d_patch = d_peak[:, :, None] * self.filters.T[None]
        for j in range(max(WIDTHS)):
            own = d_patch[:, :, j * DIMENSIONS : (j + 1) * DIMENSIONS]
            np.add.at(d_embed, windows[np.arange(n)[:, None], best + j], own)
        return [d_embed, d_filters, d_peak.sum(0), pooled.T @ dz, dz.sum(0)]

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        """Language and its probability for each text that is not empty, from all its windows."""
        held: list[np.ndarray] = []
        for text in texts:
            held.append(as_windows(text))
            if sum(map(len, held)) >= BATCH_WINDOWS:
                yield from self._judge(held)
                held = []
        if held:
            yield from self._judge(held)

    def _judge(self, held: list[np.ndarray]) -> Iterator[tuple[str, float]]:
        windows = np.concatenate(held)
        z = np.concatenate([self.logits(windows[i : i + BATCH_WINDOWS]) for i in range(0, len(windows), BATCH_WINDOWS)])
        sizes = np.array([len(h) for h in held])
        mean = np.add.reduceat(z.astype(float), np.cumsum(sizes) - sizes) / sizes[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for row in p:
            k = int(row.argmax())
            yield self.languages[k], float(row[k])


def as_windows(text: str) -> np.ndarray:
    """The UTF-8 bytes in windows of fixed length; the last is filled up from its own start, again and again."""
    data = np.frombuffer(text.encode(), np.uint8)
    whole = len(data) // WINDOW * WINDOW
    out = data[:whole].reshape(-1, WINDOW)
    if whole < len(data):
        out = np.concatenate([out, np.resize(data[whole:], (1, WINDOW))])
    return out


def learning_fold(doc_id: Column) -> Column:
    """Whether a row may be learned from: crc32 of the id as text, mod 3, is not 1. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS != 1, F.lit(False))


def train_language_net(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, seed: int = 0
) -> ByteConvNet | None:
    """A network for the languages in `labelled`, from two random windows of `per_language` rows of each.

    The texts of a language are those with the smallest hashes, of equal ones one, so neither the order of rows nor
    copies matter. Hashes are ranked in bins first, so no task gets a whole language, and the sample is cut on the
    executors: at most `per_language` short rows a language reach the driver. None if no row has a text and a language.
    """
    known = labelled.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    draw = F.xxhash64(F.lit(seed), text)
    room = F.greatest(F.length(text) - WINDOW, F.lit(0)) + 1
    cuts = [F.substring(F.col(text), (F.pmod(d, room) + 1).cast("int"), F.lit(WINDOW)) for d in (draw, F.shiftrightunsigned(draw, 20))]
    slim = known.select(F.col(lang).cast("string").alias("lang"), draw.alias("draw"), F.array(*cuts).alias("cuts"))
    distinct = slim.select("lang", "draw").distinct()
    for keys in (["lang", F.pmod("draw", F.lit(BINS))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("draw"))
        distinct = distinct.withColumn("r", place).filter(F.col("r") <= per_language).drop("r")
    # At most `per_language` pairs of numbers a language; the engine decides by their size how they meet the rows.
    rows = slim.join(distinct, ["lang", "draw"]).dropDuplicates(["lang", "draw"]).collect()
    rows.sort(key=lambda r: (r["lang"], r["draw"]))
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    windows = np.concatenate([as_windows(cut)[:1] for r in rows for cut in r["cuts"]])
    labels = np.repeat([languages.index(r["lang"]) for r in rows], 2)
    net = ByteConvNet(languages, seed)
    net.train(windows, labels, seed=seed)
    return net


def detect_language(docs: DataFrame, net: ByteConvNet | None, *, text: str = "text", out: str = "language") -> DataFrame:
    """Add the struct `out`: `lang_pred, score`, from the text alone.

    `und` with score 0 for a null text, a text without a letter, or without a network. A
    column named like `out` is replaced, all others are kept.
    """

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            there = batch.notna().to_numpy()
            rows = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0}, index=range(len(batch)))
            if net is not None and there.any():
                found = list(net.predict(list(batch[there])))
                rows.loc[there, "lang_pred"] = [lang for lang, _ in found]
                rows.loc[there, "score"] = [score for _, score in found]
            yield rows

    small_batches(docs.sparkSession)
    return docs.withColumn(out, judge(F.when(F.col(text).rlike(r"\p{L}"), F.col(text))))


def language_report(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """Per document: `doc_id, held_out, lang_pred, score`.

    Null texts and texts without a letter are `und` with score 0. A null id is not held out; repeated rows are each
    judged. Extra columns are not read.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return detect_language(docs.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score"
    )
