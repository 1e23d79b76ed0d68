"""Corpora, chats and run histories derived from the driver's tables.

The tables carry no labels, so entities are found with simple detectors and the label
map is extended by the two labels that the detectors add.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilcorpus.fixed_values import MASK_LABELS, SYNTHETIC_CATEGORIES
from veilcorpus.functions.detect import detect_mask
from veilcorpus.functions.entities import FORMATS
from veilcorpus.functions.frames import small_table
from veilcorpus.functions.jsonx import encode_annotation
from veilcorpus.functions.text import let
from veilcorpus.operators.annotate import annotation_from_entities

DETECTED_LABELS = {
    "EMAIL": MASK_LABELS["EMAIL"],
    "TELEPHONENUM": MASK_LABELS["TELEPHONENUM"],
    "CREDITCARDNUMBER": MASK_LABELS["CREDITCARDNUMBER"],
    "IPV4": "network_identifier",
    "TOKEN": "account_identifier",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def masked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the shape of a masked corpus: `doc_id, source_text, language, privacy_mask`."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.col("text").alias("source_text"),
        F.col("lang").alias("language"),
        detect_mask(F.col("text")).alias("privacy_mask"),
    )


def annotated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus per language: `row_id, source, input_text, annotation`."""
    masked = masked_documents(spark, sf_dir)
    return masked.select(
        F.col("doc_id").alias("row_id"),
        F.col("language").alias("source"),
        F.col("source_text").alias("input_text"),
        annotation_from_entities(F.col("privacy_mask"), DETECTED_LABELS).alias("annotation"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`row_id, raw_output, gold_json`: model output made from the gold by fixed rules on the id.

    Every 5th row loses its e-mail addresses, every 7th gains a made-up address, every
    13th holds a number, a boolean and a null besides text, every 11th is cut short, and
    every 17th has text after the object.
    """
    docs = annotated_documents(spark, sf_dir)
    row_id, gold = F.col("row_id"), F.col("annotation")
    email = F.when(row_id % 5 == 0, F.array().cast("array<string>")).otherwise(gold["email_address"])
    spurious = F.array(F.concat(F.lit("spurious "), row_id.cast("string")))
    address = F.when(row_id % 7 == 0, spurious).otherwise(gold["address"])
    changed = gold.withField("email_address", email).withField("address", address)

    def spoiled(text: Column) -> Column:
        odd = F.replace(text, F.lit('"human_name": []'), F.lit('"human_name": [12, true, null, "x"]'))
        return (
            F.when(row_id % 11 == 0, F.left(text, F.length(text) - 1))
            .when(row_id % 17 == 0, F.concat(text, F.lit(" end")))
            .when(row_id % 13 == 0, odd)
            .otherwise(text)
        )

    raw = let(encode_annotation(changed), spoiled)
    return docs.select("row_id", raw.alias("raw_output"), encode_annotation(gold).alias("gold_json"))


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pair_id, system, question, answer`: every user turn with the assistant turn after it, null if none is.

    An equi-join on (chat, turn), whose keys are unique, so a chat with very many turns is
    spread like any other rows. The system text is that of a system turn right before.
    """
    turns = table(spark, sf_dir, "conversations")
    ask = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    reply = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    lead = turns.filter("role = 'system'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("system")
    )
    key = ["conv_id", "turn"]
    joined = ask.join(reply, key, "left").join(lead, key, "left")
    return joined.select(
        F.concat_ws(":", "conv_id", "turn").alias("pair_id"), "conv_id", "turn", "system", "question", "answer"
    )


def little_endian(number: Column) -> Column:
    """A whole number as four bytes, the lowest first."""
    byte = [F.lpad(F.hex(F.shiftright(number.cast("bigint"), 8 * i).bitwiseAND(F.lit(255))), 2, "0") for i in range(4)]
    return F.unhex(F.concat(*byte))


def audio_turns(spark: SparkSession, sf_dir: str, byte_rate: int = 100) -> DataFrame:
    """`conv_id, turn, audio`: chat turns as WAV files whose samples are the text's bytes; every 5th turn is cut off in its head."""
    turns = table(spark, sf_dir, "conversations")
    samples = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = F.octet_length(samples)
    form = F.unhex(F.lit("0100" + "0100" + "64000000" + byte_rate.to_bytes(4, "little").hex() + "0100" + "0800"))
    head = [F.lit(b"RIFF"), little_endian(size + 36), F.lit(b"WAVEfmt "), little_endian(F.lit(16)), form, F.lit(b"data"), little_endian(size)]
    whole = F.concat(*head, samples)
    return turns.select("conv_id", "turn", F.when(F.col("turn") % 5 == 0, F.substring(whole, 1, 30)).otherwise(whole).alias("audio"))


def situations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`category, idx, situation`: turns as situations, spread over the four categories."""
    turns = table(spark, sf_dir, "conversations")
    idx = (F.col("conv_id") * 1_000_000 + F.col("turn")).cast("bigint")
    names = F.array(*[F.lit(c) for c in SYNTHETIC_CATEGORIES])
    return turns.select(
        F.element_at(names, (F.col("conv_id") % 4 + 1).cast("int")).alias("category"),
        idx.alias("idx"),
        F.col("text").alias("situation"),
    )


def subtypes(spark: SparkSession) -> DataFrame:
    """The 40 subtypes as a spec table; the description is the name in words."""
    rows = [
        (category, category.replace("_", " "), name, name.replace("_", " "), [f"{name} example {i}" for i in range(6)])
        for category, formats in FORMATS.items()
        for name in formats
    ]
    return small_table(
        spark, rows, "category STRING, category_desc STRING, name STRING, description STRING, examples ARRAY<STRING>"
    )


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`run_id, step, metric, value`: a run per user; purchases below 1 log no sample."""
    events = table(spark, sf_dir, "events")
    value = F.when((F.col("event_type") == "purchase") & (F.col("value") < 1), None).otherwise(F.col("value"))
    return events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.col("event_type").alias("metric"),
        value.alias("value"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`run_id, run_name, state`: the state comes from the last event of the user."""
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.max_by("event_type", "event_id").alias("last_event"), F.count(F.lit(1)).alias("n")
    )
    state: Column = (
        F.when(F.col("last_event") == "error", F.lit("failed"))
        .when(F.col("last_event") == "signup", F.lit("running"))
        .otherwise(F.lit("finished"))
    )
    name = F.concat(F.lit("run "), (F.col("n") % 40).cast("string"))
    return last.select(F.col("user_id").alias("run_id"), name.alias("run_name"), state.alias("state"))
