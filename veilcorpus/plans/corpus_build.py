"""Corpus build: normalise, mix, format, split. Each step reads and writes tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilcorpus import schema as S
from veilcorpus.functions.hashing import bit_of
from veilcorpus.functions.jsonx import decode_annotation, encode_annotation
from veilcorpus.operators.annotate import annotate_masked_text, annotate_typed_entities
from veilcorpus.operators.chat import extraction_chat
from veilcorpus.operators.mix import drawn_rows, mix_corpus
from veilcorpus.operators.profile import category_profile
from veilcorpus.operators.split import train_validation_split
from veilcorpus.session import bucketed, discard, materialize, shuffles_dropped
from veilcorpus.sources.readers import path_exists, read_corpora, read_corpus, read_table
from veilcorpus.sources.writers import dataset_card, save_card, save_corpus, save_shuffled, save_splits

COPIES_PER_CHUNK = 10_000
CONTENT = ("source", "input_text", "annotation_json")
BITS_A_HASH = 32
STRETCH = 1 << 15  # bits in a row of a bitmap
MOST_STRETCHES = 2048  # 8 MB of bits


def prepare_masked(spark: SparkSession, raw: str, out: str, language: str = "ja") -> None:
    save_corpus(annotate_masked_text(read_table(spark, raw, S.MASKED_TEXT), language), out)


def prepare_typed(spark: SparkSession, raw: str, out: str, format: str = "parquet") -> None:
    save_corpus(annotate_typed_entities(read_table(spark, raw, S.TYPED_ENTITIES)), out, format)


def with_row_ids(corpus: DataFrame) -> DataFrame:
    """Give `source, input_text, annotation_json` rows a stable, unique `row_id`.

    The id is a content hash and the number of the copy, so it depends on neither files
    nor partitions. Copies are counted (partial counts first) and written out again from
    the count, in chunks that are spread over the cluster where a row has very many.
    """
    return _each_copy(_counted(corpus)).select("row_id", *CONTENT)


def _counted(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy(*CONTENT).agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", _content_hash())


def _content_hash() -> Column:
    return F.sha2(F.concat_ws("\u0001", *CONTENT), 256)


def _each_copy(counted: DataFrame) -> DataFrame:
    """Rows with a hash `_h` and a number of copies `_n`, once for each copy, with `row_id`."""
    few = counted.filter(F.col("_n") <= COPIES_PER_CHUNK).withColumn("_chunk", F.lit(0).cast("bigint"))
    many = (
        counted.filter(F.col("_n") > COPIES_PER_CHUNK)
        .withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPIES_PER_CHUNK})")))
        .repartition("_h", "_chunk")
    )
    first = F.col("_chunk") * COPIES_PER_CHUNK
    last = F.least(first + COPIES_PER_CHUNK, F.col("_n")) - 1
    copies = few.unionByName(many).withColumn("_copy", F.explode(F.sequence(first, last)))
    return copies.withColumn("row_id", F.concat_ws(":", "_h", "_copy"))


@contextmanager
def identified(corpus: DataFrame) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """`(n, ids, rows)`: the rows of `with_row_ids`, of which few are shuffled, their number, and their ids alone.

    They are there for as long as the block lasts.

    Copies are counted by hashes. A bitmap of the hashes that come more than once tells where a row
    is: rows off the bitmap come once and stay in place, with copy 0 as their only one. Texts on it, by chance
    also some that come once, are counted like in `with_row_ids` and written once each.
    """
    # Lengths tell texts apart that are alike only when written one after the other.
    hashed = corpus.withColumns({"_h": _content_hash(), "_t": F.octet_length("input_text"), "_a": F.octet_length("annotation_json")})
    own = ["source", "_h", "_t", "_a"]
    counted = materialize(hashed.groupBy(*own).agg(F.count(F.lit(1)).alias("_n")), "zstd")
    made = [counted]
    try:
        repeated = counted.filter("_n > 1")
        n, n_repeated = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if(F.expr("_n > 1"))).first()
        stretches = min(MOST_STRETCHES, -(-n_repeated * BITS_A_HASH // STRETCH))
        rows = hashed.withColumn("row_id", F.concat_ws(":", "_h", F.lit("0")))
        if stretches:
            place = F.pmod(F.xxhash64(*own), F.lit(stretches * STRETCH)) + 1  # numbers count from 1
            bits = repeated.groupBy(F.bitmap_bucket_number(place).alias("_stretch"))
            bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
            placed = rows.withColumn("_place", place).withColumn("_stretch", F.bitmap_bucket_number("_place"))
            met = placed.join(F.broadcast(bits), "_stretch", "left")  # MOST_STRETCHES rows at most, whatever the corpus is
            on = F.coalesce(bit_of(F.col("_bits"), F.bitmap_bit_position("_place").cast("int")), F.lit(False))
            made.append(materialize(_counted(met.filter(on)), "zstd"))
            rows = met.filter(~on).select("row_id", *CONTENT).unionByName(_each_copy(made[-1]).select("row_id", *CONTENT))
        yield n, _each_copy(counted).select("row_id"), rows.select("row_id", *CONTENT)
    finally:
        for table in made:
            discard(table)


def mix(
    spark: SparkSession,
    corpora: dict[str, str],
    out: str,
    n_rows: int = 10_000,
    negative_ratio: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Mix the corpora that exist, save the result in shuffled order, return its profile."""
    annotation = decode_annotation(F.col("annotation_json")).alias("annotation")
    with shuffles_dropped(spark), identified(read_corpora(spark, corpora)) as (_, _, rows):
        # Texts lie in buckets by id, so the parts of the mix meet them without moving them again.
        with (
            bucketed(rows.select("row_id", "source", "input_text", annotation), "row_id") as held,
            drawn_rows(held, n_rows, negative_ratio, seed) as drawn,
        ):
            mixed = mix_corpus(held, n_rows, negative_ratio, seed, drawn)
            encoded = encode_annotation(F.col("annotation")).alias("annotation_json")
            save_shuffled(mixed.select("input_text", encoded, "shuffle_key"), out, rows=n_rows)
            bare = held.withColumn("input_text", F.lit(None).cast("string"))  # a profile needs no texts
            profile = materialize(category_profile(mix_corpus(bare, n_rows, negative_ratio, seed, drawn)))
    return profile


def format_chat(
    spark: SparkSession,
    mixed: str,
    originals: dict[str, str],
    out: str,
    include_originals: bool = True,
    val_ratio: float = 0.05,
    seed: int = 42,
    name: str = "sensitive-entity-extraction-chat",
) -> DataFrame:
    """Chat rows of the mixed corpus (required) and the originals, split and saved.

    Writes `out/data/split=<name>` and the card `out/card`; returns the card.
    """
    parts = [read_corpus(spark, mixed).withColumn("source", F.lit("mixed"))]
    present = [n for n, p in originals.items() if include_originals and path_exists(spark, p)]
    if present:
        parts.append(read_corpora(spark, {n: originals[n] for n in present}))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    with shuffles_dropped(spark), identified(rows) as (n, ids, texts):
        split = train_validation_split(texts, "row_id", val_ratio, seed, ids=ids)
        chat = split.select(
            "row_id",
            "split",
            extraction_chat(F.col("input_text"), F.col("annotation_json")).alias("messages"),
        )
        save_splits(chat, f"{out}/data", seed, rows=n)
    card = dataset_card(spark.read.parquet(f"{out}/data"), name, ["mixed", *present])
    save_card(card, f"{out}/card")
    return card
