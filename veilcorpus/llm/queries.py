"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from public_tokenizers import PATTERN, path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession, functions as F

from veilcorpus.llm.decontaminate import contamination_report
from veilcorpus.llm.kd_shards import kd_tree_shards
from veilcorpus.llm.language_id import language_report, learning_fold, train_language_net
from veilcorpus.llm.license_scan import license_scan
from veilcorpus.llm.merkle_manifest import document_manifest
from veilcorpus.llm.near_copies import near_copy_classes
from veilcorpus.llm.piece_lattice import encode_and_restore
from veilcorpus.llm.quality_divergence import quality_report
from veilcorpus.llm.subvector_clusters import subvector_clusters
from veilcorpus.llm.token_counts import section_token_counts
from veilcorpus.llm.token_planes import read_documents, write_token_planes
from veilcorpus.llm.toxicity import learn_lexicon, toxicity_report
from veilcorpus.llm.trie_scores import score_documents
from veilcorpus.session import shared_dir

SHARDS = 40
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_copy_classes(table(spark, sf, "documents"))


@query
def op3_token_planes(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-planes-{uuid.uuid4().hex}"
    write_token_planes(table(spark, sf, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return read_documents(spark, path)


@query
def op4_sampled_pieces(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = encode_and_restore(docs, tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_ids", "lossless", "ids")


@query
def op5_section_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = section_token_counts(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), PATTERN)
    return out.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))


@query
def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    net = train_language_net(docs.filter(learning_fold(F.col("doc_id"))))
    return language_report(docs.select("doc_id", "text"), net)


@query
def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents stand for files: one tree for each source, with a folder for every 1,000 and every 50 ids."""
    number = F.col("doc_id")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.floor(number / 1000), F.floor(number / 50), F.concat(number, F.lit(".txt")))
    return license_scan(table(spark, sf, "documents"), path)


@query
def op8_kd_tree_shards(spark: SparkSession, sf: str) -> DataFrame:
    out = kd_tree_shards(table(spark, sf, "documents"), dims=["lang", "source", "doc_id"], shards=SHARDS)
    return out.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_quality_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(table(spark, sf, "documents")).drop("class_distance", "word_distance")


@query
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity_report(docs, learn_lexicon(docs, table(spark, sf, "labels")))


@query
def op11_subvector_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return subvector_clusters(table(spark, sf, "embeddings"))


@query
def op12_trie_scores(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return document_manifest(table(spark, sf, "documents"))
