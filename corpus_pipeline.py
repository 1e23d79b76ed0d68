"""A corpus from raw documents: each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession, functions as F

from veilcorpus.functions.frames import free_name
from veilcorpus.llm import language_id, toxicity
from veilcorpus.llm.decontaminate import find_contamination
from veilcorpus.llm.near_copies import one_of_each_class
from veilcorpus.llm.piece_lattice import encode_and_restore
from veilcorpus.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_CERTAIN = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half. The lexicon is learned from the labelled ones of the learning folds.

    Null and empty texts have the score of a text without hits and stay; repeated rows are each judged.
    """
    lexicon = toxicity.learn_lexicon(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.toxic_score(F.col("text"), lexicon) < 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network recognises; null texts and texts without a letter go."""
    net = language_id.train_language_net(docs.filter(language_id.learning_fold(F.col("doc_id"))))
    out = free_name("_language", docs)
    seen = language_id.detect_language(docs, net, out=out)
    found = F.col(out)
    return seen.filter((found["lang_pred"] != language_id.UNKNOWN) & (found["score"] >= LEAST_CERTAIN)).drop(out)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id, null last.

    Null texts stay; empty texts are copies of one another, and so are repeated rows.
    """
    return one_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are less than one word in twenty; null and empty texts are clean."""
    out = free_name("_found", docs)
    seen = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=out)
    return seen.filter(~F.col(out)["contaminated"]).drop(out)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of a sampled segmentation, and whether these give the text back."""
    return encode_and_restore(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]
ORACLE_SQL: str | None = None  # the stages train models and draw signatures, which SQL can't express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
