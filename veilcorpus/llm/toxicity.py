"""Toxicity: a learned lexicon, found even when misspelled, weighed by its surroundings.

Words and word stems that mark toxic documents are learned from labelled rows. The lexicon
is a trie; each term has a Levenshtein automaton that accepts spellings within its number
of edits. Both run together: a state is a set of (trie node, edits used), and the sets are
numbered as they are met, so reading a letter is one look into a table and most words die
after two or three. A hit inside a quotation, or after a verb of reporting, counts less.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from veilcorpus.llm.batches import small_batches
from veilcorpus.session import materialize

FOLDS = 5
SAMPLE_ROWS = 8000
STEM_SIZES = range(3, 9)
STEM_REPEATS, STEM_ONE_IN = 2, 150
#: Edges of a word that are not part of it.
TRIM = "\"'`´‘’‚“”„«»‹›()[]{}<>.,;:!?¡¿…*#$%&|~_=+/\\-–—^@"
OPENERS, CLOSERS = "\"'“„«‹‘‚", "\"'”“»›’‘"
#: Verbs and nouns that report someone's words.
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes term word sagte sagt schrieb nannte zitat wort "
    "dit écrit appelle citation mot dijo dice escribió llamó cita palabra".split()
)
WINDOW = 8
#: Share of a hit's chance that is left after a word of reporting.
REPORTED = 0.8
MOST_KNOWN = 300_000


def words_of(text: str) -> list[str]:
    return text.lower().split()


def core(word: str) -> str:
    return word.strip(TRIM)


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class FuzzyTrie:
    """Whole words within their number of edits, and stems exactly."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.room, self.word_at, self.stem_at = [0], [None], [None]
        for term, whole in [(w, True) for w in words] + [(s, False) for s in stems]:
            node, budget = 0, edits_allowed(term) if whole else 0
            path = [0]
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                    self.word_at.append(None)
                    self.stem_at.append(None)
                node = self.children[node][letter]
                path.append(node)
            for n in path:
                self.room[n] = max(self.room[n], budget)
            (self.word_at if whole else self.stem_at)[node] = term
        self._reset()

    def _reset(self) -> None:
        self.sets: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, reached: dict[int, int]) -> tuple[tuple[int, int], ...]:
        """Add what leaving out letters of the term reaches; drop what has no edit left."""
        todo = list(reached.items())
        while todo:
            node, used = todo.pop()
            for child in self.children[node].values():
                if used + 1 <= self.room[child] and used + 1 < reached.get(child, 99):
                    reached[child] = used + 1
                    todo.append((child, used + 1))
        return tuple(sorted((n, e) for n, e in reached.items() if e <= self.room[n]))

    def _state(self, members: tuple) -> int:
        if members not in self.number:
            self.number[members] = len(self.sets)
            self.sets.append(members)
            self.moves.append({})
        return self.number[members]

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, used in self.sets[state]:
            steps = [(child, used + (c != letter)) for c, child in self.children[node].items()] + [(node, used + 1)]
            for child, e in steps:
                if e <= self.room[child] and e < reached.get(child, 99):
                    reached[child] = e
        found = self._state(self._closed(reached))
        self.moves[state][letter] = found
        return found

    def find(self, word: str) -> tuple[str, int, bool] | None:
        """The best term: (term, edits, whole word); of equal edits the first by name. A stem found ends the search."""
        if len(self.sets) > 50_000:
            self._reset()
        state = self.start
        for letter in word:
            state = self.moves[state][letter] if letter in self.moves[state] else self._move(state, letter)
            members = self.sets[state]
            if not members:
                return None
            for node, used in members:
                if not used and self.stem_at[node]:
                    return self.stem_at[node], 0, False
        ends = [(e, self.word_at[n]) for n, e in self.sets[state] if self.word_at[n] and e <= edits_allowed(self.word_at[n])]
        if not ends:
            return None
        edits, term = min(ends)
        return term, edits, True


def squeezed(word: str) -> str:
    return "".join(c for i, c in enumerate(word) if not i or c != word[i - 1])


def kind_of(word: str, term: str, edits: int) -> str | None:
    """`exact`; `disguised` by signs or repeated letters; `spelling`; None for a short word spelled otherwise."""
    if not edits:
        return "exact"
    if not word.isalpha() or squeezed(word) == squeezed(term):
        return "disguised"
    return "spelling" if len(term) >= 5 else None


#: What the score of a text is made of, and the weight each part has before any label is seen.
FEATURES = {
    "bias": -4.0,
    "word": 6.0,  # best chance of an open hit of a whole word
    "more_words": 0.5,  # log of the number of such hits
    "stems": 1.0,  # log of 1 + the number of words with a learned stem
    "stem_share": 1.5,  # their share of all words, 2 in 100 as 1, at most 2
    "disguised": 5.0,  # best chance of a hit disguised by signs or repeated letters
    "spelling": 3.0,  # the same for other misspellings
    "quoted": 1.0,  # best chance of a hit inside a quotation
}
PRIOR_STRENGTH = 0.3


@dataclass
class ToxicLexicon:
    """What was learned: terms with the chance that a text holding one is toxic, and the weights of the score."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    ordinary: frozenset[str] = frozenset()
    weights: tuple[float, ...] = tuple(FEATURES.values())


class ToxicScorer:
    def __init__(self, lexicon: ToxicLexicon):
        self.lexicon = lexicon
        self.trie = FuzzyTrie(sorted(lexicon.words), sorted(lexicon.stems))
        self.known: dict[str, tuple[str, str] | None] = {}

    def look(self, raw: str) -> tuple[str, str] | None:
        """(kind, term) of a word as it stands in the text."""
        if raw in self.known:
            return self.known[raw]
        if len(self.known) >= MOST_KNOWN:
            self.known.clear()
        word = core(raw)
        found = self.trie.find(word) if word else None
        if not found and squeezed(word) != word:
            found = self.trie.find(squeezed(word))
        hit = None
        if found:
            term, edits, _ = found
            kind = kind_of(word, term, edits)
            if kind and not (kind != "exact" and word in self.lexicon.ordinary):
                hit = kind, term
        self.known[raw] = hit
        return hit

    def hits(self, text: str) -> list[tuple[str, str, bool, bool, str]]:
        """(kind, term, quoted, reported, word) of each hit."""
        words = words_of(text)
        marked = {w: h for w in set(words) if (h := self.look(w))}
        if not marked:
            return []
        return [(*marked[w], is_quoted(words, i), is_reported(words, i), w) for i, w in enumerate(words) if w in marked]

    def features(self, text: str, ordinary: frozenset[str] | set[str] = frozenset()) -> list[float]:
        """The parts of a text's score; `ordinary` words are no misspellings."""
        words, stems = self.lexicon.words, 0
        best = dict.fromkeys(("word", "disguised", "spelling", "quoted"), 0.0)
        open_ = 0
        for kind, term, quoted, reported, raw in self.hits(text):
            if term not in words:
                stems += not quoted
                continue
            if kind != "exact" and core(raw) in ordinary:
                continue
            chance = words[term] * (REPORTED if reported else 1.0)
            part = "quoted" if quoted else "word" if kind == "exact" else kind
            best[part] = max(best[part], chance)
            open_ += part == "word"
        share = min(2.0, 50.0 * stems / max(1, len(text.split()))) if stems else 0.0
        return [1.0, best["word"], math.log(max(1, open_)), math.log1p(stems), share, best["disguised"], best["spelling"], best["quoted"]]

    def score(self, text: str) -> float:
        z = sum(w * f for w, f in zip(self.lexicon.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def is_quoted(words: list[str], at: int) -> bool:
    """A quotation opens at most WINDOW words before and closes at most WINDOW words after, without a break between."""
    for i in range(at, max(-1, at - WINDOW), -1):
        if i < at and words[i][-1] in CLOSERS and words[i][:1] not in OPENERS:
            return False
        if words[i][0] in OPENERS:
            return any(w.rstrip(".,;:!?")[-1:] in CLOSERS and w.rstrip(".,;:!?") for w in words[at : at + WINDOW] if len(w) > 1)
    return False


def is_reported(words: list[str], at: int) -> bool:
    return any(core(w) in REPORTING for w in words[max(0, at - WINDOW) : at])


def terms_of(text: str) -> list[str]:
    """Distinct words of a text; and, with a star behind, the beginnings that STEM_REPEATS words or more share, at least one word in STEM_ONE_IN."""
    words = [w for w in map(core, words_of(text)) if w]
    starts = Counter(w[:n] for w in words for n in STEM_SIZES if len(w) >= n)
    least = max(STEM_REPEATS, len(words) / STEM_ONE_IN)
    return sorted({*words, *(s + "*" for s, n in starts.items() if n >= least)})


@F.pandas_udf(T.ArrayType(T.StringType()))
def _terms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(terms_of)


def choose_terms(counts: list[tuple[str, int, int]], toxic: int, rows: int, n_terms: int) -> dict[str, float]:
    """Terms (with their chance) that stand for themselves among `(term, toxic rows, rows)`.

    A term must beat chance after allowing for the number of terms tried. Of terms that tell
    nearly the same, whole words come before stems and longer before shorter; a longer form
    of a chosen stem is left out.
    """
    base = min(max(toxic / max(rows, 1), 1e-4), 0.5)

    def surprise(t: int, n: int) -> float:
        q = min(max(t / n, base), 0.999)
        return t * math.log(q / base) + (n - t) * math.log((1 - q) / (1 - base))

    strong = [(w, t, n) for w, t, n in counts if t >= 3 and (t + 0.5) / (n + 1) >= 0.85 and surprise(t, n) > math.log(n_terms) + 3]
    strong.sort(key=lambda x: (-round(math.log(surprise(x[1], x[2])) / 0.03), x[0].endswith("*"), -len(x[0]), x[0]))
    chosen: dict[str, tuple[float, int]] = {}
    for term, t, n in strong:
        stem = term.rstrip("*") if term.endswith("*") else None
        own = stem if stem is not None else term
        covered = any(c.endswith("*") and own.startswith(c[:-1]) for c in chosen)
        same = stem is not None and any(c.rstrip("*").startswith(stem) and t <= 1.03 * s + 1 for c, (_, s) in chosen.items())
        if not covered and not same:
            chosen[term] = ((t + 0.5) / (n + 1), t)
    return {term: chance for term, (chance, _) in chosen.items()}


def learning_fold(doc_id: Column) -> Column:
    """Whether labels may be learned from a row: crc32 of the id as text, mod 5, is not 0. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS != 0, F.lit(False))


def learn_lexicon(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicLexicon:
    """A lexicon from at most `sample_rows` labelled texts of the learning folds, those with the smallest hashes.

    Null labels and texts are left out; an id labelled twice takes the larger label. Of equal texts one counts, so
    neither copies nor an id that many rows share fill the sample; it is cut on the executors, and only hashes of it
    are broadcast. In each round terms are counted on Spark, all that pass the test of chance are taken, and rows
    that hold one leave, so that rare groups of terms come up too, until no round finds any. Extra columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = labels.filter(learning_fold(F.col(doc_id)) & F.col(label).isNotNull())
    rows = rows.groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label)).cast("int").alias("toxic"))
    # Texts are hashed where they lie: ids and hashes meet the labels.
    present = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    few = present.select("_id", "h").join(rows, "_id").groupBy("h").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("h"), "h").limit(sample_rows)
    # One row a text again: the first copy that is met.
    found = present.select("text", "h").join(F.broadcast(few), "h").dropDuplicates(["h"])
    sample = materialize(found.select("toxic", "text", (F.pmod(F.col("h"), F.lit(2))).cast("int").alias("half")))
    listed = materialize(sample.select("toxic", _terms("text").alias("terms")))
    chances: dict[str, float] = {}
    left = listed
    while True:
        n, toxic = left.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if not toxic:
            break
        counted = left.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
        # Terms that can't pass stay on the executors; the others are terms of the sample's toxic texts.
        good = counted.filter("t >= 3 AND t + 0.5 >= 0.85 * (n + 1)")
        new = choose_terms([tuple(r) for r in good.collect()], int(toxic), n, max(2, int(n * 200)))
        if not new:
            break
        chances |= new
        left = left.filter(~F.arrays_overlap("terms", F.array(*[F.lit(t) for t in new])))
    lexicon = ToxicLexicon(
        words={t: c for t, c in chances.items() if not t.endswith("*")},
        stems={t[:-1]: c for t, c in chances.items() if t.endswith("*")},
    )
    return _weighed(sample, lexicon)


def _weighed(sample: DataFrame, lexicon: ToxicLexicon) -> ToxicLexicon:
    """The lexicon with ordinary words that look like terms, and with fitted weights.

    Each half of the sample is scored with the ordinary words of the other half's clean
    rows, so that misspellings are judged as they will be in unseen texts. At most a short
    row for each sampled text comes to the driver.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = ToxicScorer(lexicon)
        for batch in batches:
            near = [
                sorted({core(w) for w in set(words_of(t)) if (h := scorer.look(w)) and h[0] != "exact"}) if not toxic else []
                for t, toxic in zip(batch["text"], batch["toxic"])
            ]
            yield pd.DataFrame({"half": batch["half"], "words": near})

    near = sample.mapInPandas(look, "half int, words array<string>").select("half", F.explode("words").alias("word")).distinct()
    clean: list[set[str]] = [set(), set()]
    for row in near.collect():
        clean[row["half"]].add(row["word"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = ToxicScorer(lexicon)
        for batch in batches:
            parts = [scorer.features(t, clean[1 - h]) for t, h in zip(batch["text"], batch["half"])]
            yield pd.DataFrame({"toxic": batch["toxic"], "parts": parts})

    rows = sample.mapInPandas(measure, "toxic int, parts array<double>").collect()
    if rows:
        lexicon.weights = fit_weights(np.array([r["parts"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    lexicon.ordinary = frozenset(clean[0] | clean[1])
    return lexicon


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, ...]:
    """Logistic regression by Newton steps, held to the weights of FEATURES where labels say little."""
    prior = np.array(list(FEATURES.values()))
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + PRIOR_STRENGTH * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(len(w))
        # A full step can overshoot where the curve is flat; short ones can't run away.
        w = w - np.clip(np.linalg.solve(curve, gradient), -1.0, 1.0)
    names = list(FEATURES)
    if not x[:, names.index("disguised")].any():  # never met: it weighs as the word itself
        w[names.index("disguised")] = max(w[names.index("disguised")], w[names.index("word")])
    return tuple(w.tolist())


def toxic_score(text: Column, lexicon: ToxicLexicon) -> Column:
    """Score of each text from 0 to 1; a null or empty text has the score of a text without hits."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = ToxicScorer(lexicon)
        for batch in batches:
            yield pd.Series([scorer.score(t or "") for t in batch], dtype=float)

    return score(text)


def toxicity_report(docs: DataFrame, lexicon: ToxicLexicon) -> DataFrame:
    """Per document: `doc_id, held_out, score, predicted`.

    Null and empty texts have the score of a text without hits. A null id is not held out; repeated rows are each
    scored. Extra columns are not read.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    scored = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), toxic_score(F.col("text"), lexicon).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
