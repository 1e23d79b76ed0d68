"""Mix corpora: concatenate 2 to 4 rarity-weighted rows per output row.

The corpus table has `row_id, source, input_text, annotation`; row ids are unique
over all sources, and rows without a source form a source of their own, which comes first. One output row `i` draws k sources (with replacement, by size) and
takes the next row of each source's queue. A queue is a weighted shuffle of the
source; when it runs out a fresh shuffle follows, so epoch e of a source is the
shuffle with salt e. Slot number r of a source therefore reads epoch `r div N`,
position `r mod N`, and the whole loop becomes two ranks and one equi-join on
(source, epoch, position), a key that is unique on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veilcorpus.fixed_values import MIX_DELIMITERS
from veilcorpus.functions.frames import join_null_safe
from veilcorpus.functions.hashing import draw, unit
from veilcorpus.operators.annotate import is_hard_negative, merge_annotations
from veilcorpus.operators.profile import rarity_terms, sample_weight
from veilcorpus.operators.rank import (
    bucketed_rank,
    default_buckets,
    exponential_bucket,
    first_in_shuffle,
    shuffle_positions,
    uniform_key,
    weighted_key,
)
from veilcorpus.session import discard, materialize

TICKET_CELLS = 4096


def row_budget(n: int, negative_ratio: float) -> tuple[int, int]:
    """(positive rows, negative rows); the negative count is rounded half to even."""
    if not 0.0 <= negative_ratio < 1.0:
        raise ValueError("negative_ratio must be at least 0.0 and less than 1.0")
    n_negative = round(n * negative_ratio)
    return n - n_negative, n_negative


def source_sizes(corpus: DataFrame) -> DataFrame:
    """`source, n_source, start`: rows of each source, and of those before it by name. One row a source."""
    counted = corpus.groupBy("source").agg(F.count(F.lit(1)).alias("n_source"))
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(counted.withColumn("start", F.coalesce(F.sum("n_source").over(before), F.lit(0))))


def draw_slots(
    spark: SparkSession, n_rows: int, sizes: DataFrame, seed: int
) -> DataFrame:
    """`(i, j, source)`: k in {2, 3, 4} source draws for each output row i.

    A draw is a ticket below the number of all rows. Tickets are cut into equal cells, each
    source is repeated for the cells that its range touches, and the two meet on the cell,
    so any number of sources is one equi-join.
    """
    sources, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_source"), F.lit(0))).first()
    outputs = spark.range(n_rows).select(
        F.col("id").alias("i"), (F.lit(2) + draw(seed, "size", F.col("id")) % 3).cast("int").alias("k")
    )
    slots = outputs.select("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("j"))
    if not total:
        return slots.withColumn("source", F.lit(None).cast("string")).limit(0)
    width = max(1, total // max(TICKET_CELLS, 4 * sources))
    drawn = slots.withColumn("ticket", draw(seed, "source", F.col("i"), F.col("j")) % F.lit(total))
    cells = sizes.withColumn("cell", F.explode(F.expr(f"sequence(start div {width}, (start + n_source - 1) div {width})")))
    met = drawn.withColumn("cell", F.expr(f"ticket div {width}")).join(cells, "cell")
    return met.filter("ticket >= start AND ticket < start + n_source").select("i", "j", "source")


def rank_slots(slots: DataFrame, n_rows: int) -> DataFrame:
    """Number the slots of each source in draw order (i, then j)."""
    buckets = default_buckets(slots.sparkSession)
    width = max(1, -(-n_rows // buckets))
    chunked = slots.withColumn("_b", F.expr(f"i div {width}"))
    return bucketed_rank(chunked, ["i", "j"], "_b", ["source"], "slot")


def queue_slots(
    spark: SparkSession, n_rows: int, sizes: DataFrame, seed: int
) -> DataFrame:
    """`(i, j, source, epoch, position)`: which queue entry each slot takes."""
    ranked = rank_slots(draw_slots(spark, n_rows, sizes, seed), n_rows)
    return join_null_safe(ranked, sizes.select("source", "n_source"), ["source"]).select(
        "i",
        "j",
        "source",
        F.expr("slot div n_source").alias("epoch"),
        (F.col("slot") % F.col("n_source")).alias("position"),
    )


def queue_entries(
    weighted: DataFrame, n_rows: int, sizes: DataFrame, seed: int
) -> DataFrame:
    """`(row_id, source, epoch, position)` of every queue entry that a slot may take.

    `weighted` has `row_id, source, weight`. Each source is repeated once per epoch that
    is really used, and in the last epoch only the leading buckets are sorted.
    """
    spark = weighted.sparkSession
    drawn = draw_slots(spark, n_rows, sizes, seed).groupBy("source").agg(F.count(F.lit(1)).alias("n_slots"))
    used = join_null_safe(drawn, sizes.select("source", "n_source"), ["source"])
    # One row a source from here.
    epochs = used.select("source", F.expr("(n_slots - 1) div n_source").alias("last_epoch"))
    needed = used.select(
        "source",
        F.explode(F.expr("sequence(0L, (n_slots - 1) div n_source)")).alias("epoch"),
        "n_slots",
        "n_source",
    ).select(
        "source",
        "epoch",
        F.least(F.col("n_slots") - F.col("epoch") * F.col("n_source"), F.col("n_source")).alias("needed"),
    )
    repeated = join_null_safe(weighted, epochs, ["source"]).select(
        "row_id", "source", "weight", F.explode(F.expr("sequence(0L, last_epoch)")).alias("epoch")
    )
    u = unit(draw(seed, "queue", F.col("epoch"), F.col("row_id")))
    keyed = repeated.withColumn("_k", weighted_key(u, F.col("weight")))
    keyed = keyed.withColumn("_b", exponential_bucket(F.col("_k"), default_buckets(spark)))
    ranked = bucketed_rank(
        keyed, ["_k", "row_id"], "_b", ["source", "epoch"], "position", needed=needed
    )
    return ranked.select("row_id", "source", "epoch", "position")


def corpus_weights(corpus: DataFrame) -> DataFrame:
    """`row_id, source, weight`: rarity weights over all sources together."""
    terms = rarity_terms(corpus)
    return corpus.select(
        "row_id", "source", sample_weight(terms, F.col("annotation")).alias("weight")
    )


def chosen_rows(corpus: DataFrame, n_rows: int, seed: int) -> DataFrame:
    """`(i, j, row_id)`: the corpus rows of each output row. Ids only, no text."""
    spark = corpus.sparkSession
    sizes = source_sizes(corpus)
    slots = queue_slots(spark, n_rows, sizes, seed)
    entries = queue_entries(corpus_weights(corpus), n_rows, sizes, seed)
    return join_null_safe(slots, entries, ["source", "epoch", "position"]).select("i", "j", "row_id")


def concatenate_rows(
    corpus: DataFrame, chosen: DataFrame, seed: int, delimiters: tuple[str, ...] = MIX_DELIMITERS
) -> DataFrame:
    """`(i, input_text, annotation, row_ids)`: the chosen rows in a shuffled order, joined."""
    texts = corpus.select("row_id", "input_text", "annotation")
    picked = chosen.join(texts, "row_id").select(
        "i",
        F.struct(
            draw(seed, "order", F.col("i"), F.col("j")).alias("h"), "j", "row_id", "input_text", "annotation"
        ).alias("row"),
    )
    # At most four rows per group by construction.
    grouped = picked.groupBy("i").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    choice = draw(seed, "delimiter", F.col("i")) % len(delimiters)
    delimiter = F.element_at(F.array(*[F.lit(d) for d in delimiters]), (choice + 1).cast("int"))
    return grouped.select(
        "i",
        _join_with(F.col("rows"), delimiter).alias("input_text"),
        merge_annotations(F.col("rows")).alias("annotation"),
        F.transform("rows", lambda r: r.getField("row_id")).alias("row_ids"),
    )


def _join_with(rows: Column, delimiter: Column) -> Column:
    """`array_join` takes only a literal delimiter, so the texts are folded together."""
    texts = F.transform(rows, lambda r: r.getField("input_text"))
    return F.aggregate(
        F.slice(texts, 2, 3),
        F.element_at(texts, 1),
        lambda done, text: F.concat(done, delimiter, text),
    )


def mixed_positives(corpus: DataFrame, n_rows: int, seed: int = 42, chosen: DataFrame | None = None) -> DataFrame:
    return concatenate_rows(corpus, chosen_rows(corpus, n_rows, seed) if chosen is None else chosen, seed)


def sample_negatives(corpus: DataFrame, n_rows: int, seed: int = 42) -> DataFrame:
    """`n_rows` rows whose annotation is empty.

    Without replacement while the pool is large enough, otherwise every draw is with
    replacement. An empty pool gives no rows. Output: `draw_no` plus the corpus columns.
    """
    pool = corpus.filter(is_hard_negative(F.col("annotation")))
    size = pool.count()
    if n_rows <= size:
        taken = first_in_shuffle(pool, "row_id", n_rows, seed, "negative") if n_rows else pool.limit(0)
        return taken.withColumn("draw_no", F.lit(0).cast("bigint"))
    if size == 0:
        return pool.withColumn("draw_no", F.lit(0).cast("bigint"))
    draws = corpus.sparkSession.range(n_rows).select(
        F.col("id").alias("draw_no"),
        (draw(seed, "negative draw", F.col("id")) % F.lit(size)).alias("position"),
    )
    # Positions are unique on the pool side and the draws are spread evenly over them.
    ranked = shuffle_positions(pool.select("row_id"), "row_id", seed, "negative")
    picked = draws.join(ranked, "position").select("draw_no", "row_id")
    return picked.join(pool, "row_id")


@contextmanager
def drawn_rows(corpus: DataFrame, n_rows: int, negative_ratio: float, seed: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The rows that `mix_corpus` draws, `(i, j, row_id)` and `(draw_no, row_id)`, written for as long as the block lasts."""
    n_positive, n_negative = row_budget(n_rows, negative_ratio)
    chosen = materialize(chosen_rows(corpus, n_positive, seed), "zstd")
    negatives = sample_negatives(corpus, n_negative, seed) if n_negative else corpus.limit(0).withColumn("draw_no", F.lit(0))
    sampled = materialize(negatives.select(F.col("draw_no").cast("bigint").alias("draw_no"), "row_id"), "zstd")
    try:
        yield chosen, sampled
    finally:
        discard(chosen)
        discard(sampled)


def mix_corpus(
    corpus: DataFrame, n_rows: int = 10_000, negative_ratio: float = 0.1, seed: int = 42,
    drawn: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Mixed positives and sampled negatives: `mixed_id, input_text, annotation`.

    `mixed_id` is stable, and `shuffle_key` is a uniform key: ordering a written table by
    it removes the order of generation. `drawn` are the `drawn_rows`, so that a mix which is computed
    in parts doesn't draw them again for each.
    """
    n_positive, n_negative = row_budget(n_rows, negative_ratio)
    positives = mixed_positives(corpus, n_positive, seed, drawn[0] if drawn else None).select(
        F.concat(F.lit("pos:"), F.col("i").cast("string")).alias("mixed_id"), "input_text", "annotation"
    )
    mixed = positives
    if n_negative:
        sampled = drawn[1].join(corpus, "row_id") if drawn else sample_negatives(corpus, n_negative, seed)
        negatives = sampled.select(
            F.concat_ws(":", F.lit("neg"), "draw_no", "row_id").alias("mixed_id"),
            "input_text",
            "annotation",
        )
        mixed = positives.unionByName(negatives)
    return mixed.withColumn("shuffle_key", uniform_key(seed, "mixed", F.col("mixed_id")))
