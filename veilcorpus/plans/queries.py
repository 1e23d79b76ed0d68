"""Named queries over the driver's tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilcorpus.fixed_values import CATEGORIES, LEAK_PATTERNS, POOLED_SUBTYPES
from veilcorpus.functions import detect, jsonx, prompts, scorers, text as tx
from veilcorpus.functions.entities import add_entities
from veilcorpus.operators import audit, chat, compare, complete, evaluate, mix, profile, rank, sketches, split, tasks, validate
from veilcorpus.operators.annotate import annotate_masked_text, is_hard_negative, labelled_entities, long_annotation
from veilcorpus.plans import corpus_build, testdata as td
from veilcorpus.session import bucketed, materialize, path_of, shared_dir
from veilcorpus.sources import readers, writers
from veilcorpus.sources.arrow_corpus import arrow_splits, read_arrow_corpus, save_arrow_splits
from veilcorpus.streaming.incremental_generation import start_generation
from veilcorpus.streaming.running_profile import read_profile, start_running_profile, stream_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _fresh(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def _ids(corpus: DataFrame) -> DataFrame:
    """Annotated corpus without its text, written once: detectors run once per query."""
    return materialize(corpus.select("row_id", "source", "annotation"))


def _corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus for mixing: written annotations joined back to the text of the source table."""
    annotated = _ids(td.annotated_documents(spark, sf))
    texts = td.table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("input_text")
    )
    return annotated.join(texts, "row_id").select("row_id", "source", "input_text", "annotation")


# --- Annotation and profile ---------------------------------------------------


@query
def category_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.category_profile(td.annotated_documents(spark, sf))
    return _rounded(out.drop("category_index"), "coverage")


@query
def category_profile_rollup(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.category_profile_by_source(td.annotated_documents(spark, sf))
    return _rounded(out.drop("category_index"), "coverage")


@query
def profile_report(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.formatted_profile(profile.category_profile(td.annotated_documents(spark, sf)))
    return out.select("category", "entity_count_text", "row_count_text", "coverage_text")


@query
def label_map_entities(spark: SparkSession, sf: str) -> DataFrame:
    masked = td.masked_documents(spark, sf)
    out = labelled_entities(masked, "doc_id", "privacy_mask", td.DETECTED_LABELS)
    return out.select("doc_id", "label", "category", "value")


@query
def masked_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Language filter, label map (labels without a category are dropped) and JSON."""
    return annotate_masked_text(td.masked_documents(spark, sf), language="fr").select(
        F.md5("input_text").alias("text_md5"), "annotation_json"
    )


@query
def annotation_json(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.annotated_documents(spark, sf)
    return docs.select("row_id", jsonx.encode_annotation(F.col("annotation")).alias("annotation_json"))


@query
def annotation_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    encoded = annotation_json(spark, sf)
    decoded = encoded.select("row_id", jsonx.decode_annotation(F.col("annotation_json")).alias("annotation"))
    return long_annotation(decoded, "row_id").withColumn("pos", F.col("pos").cast("bigint"))


@query
def json_strings(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text of every chat turn, checked by its digest."""
    turns = td.table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", F.md5(jsonx.quote(F.col("text"))).alias("json_md5"))


@query
def negative_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.annotated_documents(spark, sf)
    return docs.filter(is_hard_negative(F.col("annotation"))).select("row_id", "source")


@query
def document_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return profile.document_frequency(td.annotated_documents(spark, sf))


@query
def union_with_originals(spark: SparkSession, sf: str) -> DataFrame:
    """Bag union of corpora: a mixed part first, then the originals, counted by part."""
    docs = td.table(spark, sf, "documents").select("doc_id", "text", F.lit("original").alias("part"))
    turns = td.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"), "text", F.lit("mixed").alias("part")
    )
    both = turns.unionByName(docs)
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("characters")
    )


def _built_corpus(spark: SparkSession, sf: str) -> tuple[str, dict[str, str]]:
    """Two normalised corpora on disk and a path where none is.

    The first keeps the German documents, the second has all others, also those without a language.
    """
    folder = _fresh(spark, "build")
    with path_of(td.masked_documents(spark, sf)) as raw:
        corpus_build.prepare_masked(spark, raw, f"{folder}/a", language="de")
    docs = td.table(spark, sf, "documents").filter("NOT lang <=> 'de'")
    typed = F.struct(F.left("text", F.lit(4)).alias("name"), F.lit("人名").alias("type"), F.lit(0).alias("span_start"), F.lit(4).alias("span_end"))
    with path_of(docs.select("text", F.array(typed).alias("entities"))) as raw:
        corpus_build.prepare_typed(spark, raw, f"{folder}/b", format="arrow")
    return folder, {"a": f"{folder}/a", "b": f"{folder}/b", "missing": f"{folder}/none"}


@query
def corpus_build_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage of the normalised corpora, read back from where the build wrote them."""
    _, paths = _built_corpus(spark, sf)
    rows = readers.read_corpora(spark, paths)
    annotated = rows.select("source", jsonx.decode_annotation(F.col("annotation_json")).alias("annotation"))
    out = profile.category_profile(annotated)
    return _rounded(out.drop("category_index"), "coverage")


@query
def corpus_build_card(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the saved chat dataset, built end to end with and without the originals."""
    folder, paths = _built_corpus(spark, sf)
    n = readers.read_corpora(spark, paths).count()
    corpus_build.mix(spark, paths, f"{folder}/mixed", n, 0.1)
    out = []
    for originals in (True, False):
        corpus_build.format_chat(spark, f"{folder}/mixed", paths, f"{folder}/chat-{originals}", include_originals=originals)
        preview = writers.split_preview(spark, f"{folder}/chat-{originals}/card")
        written = spark.read.parquet(f"{folder}/chat-{originals}/data").agg(F.count(F.lit(1)).alias("written"))
        out.append(preview.select(F.lit(originals).alias("originals"), "train", "validation", "total").crossJoin(written))
    return out[0].unionByName(out[1])


@query
def arrow_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The documents saved as Arrow splits by language and read back, without their texts' column."""
    folder = _fresh(spark, "arrow")
    docs = td.annotated_documents(spark, sf)
    rows = docs.select("row_id", "input_text", jsonx.encode_annotation(F.col("annotation")).alias("annotation_json"), F.when(F.col("source") == "de", "a").otherwise("b").alias("split"))
    save_arrow_splits(rows, folder, ("a", "b"))
    parts = [
        read_arrow_corpus(spark, f"{folder}/{name}", ["annotation_json", "row_id"]).withColumn("split", F.lit(name)) for name in arrow_splits(folder)
    ]
    return parts[0].unionByName(parts[1])


# --- Evaluation ---------------------------------------------------------------


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.parse_predictions(td.predictions(spark, sf))


@query
def json_parse_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.parse_rate(td.predictions(spark, sf)), "json_parse_rate")


@query
def eval_per_category(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.evaluation_table(_parsed(spark, sf), micro=False)
    out = out.select("category", "tp", "fp", "fn", "precision", "recall", "f1")
    return _rounded(out, "precision", "recall", "f1")


@query
def eval_micro(spark: SparkSession, sf: str) -> DataFrame:
    out = evaluate.evaluation_table(_parsed(spark, sf)).filter("category = 'micro avg'")
    return _rounded(out.select("tp", "fp", "fn", "precision", "recall", "f1"), "precision", "recall", "f1")


@query
def eval_weakest_first(spark: SparkSession, sf: str) -> DataFrame:
    ranked = evaluate.weakest_first(evaluate.evaluation_table(_parsed(spark, sf), micro=False))
    return ranked.select("category", "f1_text", "precision_text", "recall_text")


@query
def eval_row_confusion(spark: SparkSession, sf: str) -> DataFrame:
    cells = evaluate.row_confusion(_parsed(spark, sf), keys=("row_id",))
    return cells.filter("tp + fp + fn > 0").select(
        "row_id", "category", *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn")]
    )


@query
def eval_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    table = evaluate.evaluation_table(_parsed(spark, sf))
    return _rounded(evaluate.metric_rows(table, F.lit("run-1"), F.lit(200).cast("bigint")), "value")


@query
def metric_table(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of three evaluations in one table; each is written twice and is there once."""
    table = materialize(evaluate.evaluation_table(_parsed(spark, sf)))
    path = _fresh(spark, "metrics")
    for run, step in (("run-1", 200), ("007", 100), ("007", 200)) * 2:
        writers.save_metrics(evaluate.metric_rows(table, F.lit(run), F.lit(step)), path)
    return _rounded(readers.read_metrics(spark, path), "value")


# --- Ranks, weights and splits ------------------------------------------------


@query
def idf_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(mix.corpus_weights(_ids(td.annotated_documents(spark, sf))), "weight")


@query
def shuffle_rank(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents").select("doc_id")
    return rank.shuffle_positions(docs, "doc_id", seed=42)


@query
def weighted_shuffle_rank(spark: SparkSession, sf: str) -> DataFrame:
    weighted = mix.corpus_weights(_ids(td.annotated_documents(spark, sf)))
    ranked = rank.weighted_shuffle_positions(weighted, "row_id", "weight", seed=42, groups=["source"])
    return ranked.select("row_id", "source", "position")


@query
def train_val_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents").select("doc_id")
    return split.train_validation_split(docs, "doc_id", ratio=0.05, seed=42)


@query
def carve_out_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents").select("doc_id")
    return split.carve_out(docs, "doc_id", ratio=0.1, seed=42)


@query
def three_way_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents").select("doc_id")
    return split.three_way_split(docs, "doc_id", 0.2, 0.1, seed=42)


@query
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_counts(train_val_split(spark, sf))


@query
def dataset_card(spark: SparkSession, sf: str) -> DataFrame:
    card = writers.dataset_card(train_val_split(spark, sf), "documents chat", ["mixed"])
    return card.select("dataset_name", "language", "task", "num_rows.*")


@query
def evaluation_subset(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50 rows of a seeded shuffle (the sample size of an evaluation)."""
    return readers.evaluation_subset(td.table(spark, sf, "documents").select("doc_id"), "doc_id", 50)


# --- Mixing -------------------------------------------------------------------


@query
def augment_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Queue entry of every slot, for as many output rows as there are documents."""
    sizes = mix.source_sizes(td.table(spark, sf, "documents").select(F.col("lang").alias("source")))
    return mix.queue_slots(spark, sizes.agg(F.sum("n_source")).first()[0], sizes, seed=42)


@query
def augment_mixed(spark: SparkSession, sf: str) -> DataFrame:
    corpus = _corpus(spark, sf)
    n = td.table(spark, sf, "documents").count()
    mixed = mix.mixed_positives(corpus, n, seed=42)
    return mixed.select(
        "i",
        F.size("row_ids").cast("bigint").alias("n_rows"),
        F.md5("input_text").alias("text_md5"),
        jsonx.encode_annotation(F.col("annotation")).alias("annotation_json"),
    )


# The same over a corpus in which one source has no name.
_UNNAMED = "CASE WHEN source <> 'es' THEN source END"


@query
def augment_slots_unnamed(spark: SparkSession, sf: str) -> DataFrame:
    named = td.table(spark, sf, "documents").select(F.col("lang").alias("source"))
    sizes = mix.source_sizes(named.withColumn("source", F.expr(_UNNAMED)))
    return mix.queue_slots(spark, sizes.agg(F.sum("n_source")).first()[0], sizes, seed=42)


@query
def augment_mixed_unnamed(spark: SparkSession, sf: str) -> DataFrame:
    corpus = _corpus(spark, sf).withColumn("source", F.expr(_UNNAMED))
    mixed = mix.mixed_positives(corpus, td.table(spark, sf, "documents").count(), seed=42)
    return mixed.select(
        "i",
        F.size("row_ids").cast("bigint").alias("n_rows"),
        F.md5("input_text").alias("text_md5"),
        jsonx.encode_annotation(F.col("annotation")).alias("annotation_json"),
    )


@query
def weighted_shuffle_rank_unnamed(spark: SparkSession, sf: str) -> DataFrame:
    weighted = mix.corpus_weights(_ids(td.annotated_documents(spark, sf))).withColumn("source", F.expr(_UNNAMED))
    ranked = rank.weighted_shuffle_positions(weighted, "row_id", "weight", seed=42, groups=["source"])
    return ranked.select("row_id", "source", "position")


@query
def negative_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the number of documents, drawn from the rows without entities."""
    corpus = _ids(td.annotated_documents(spark, sf))
    _, n = mix.row_budget(corpus.count(), 0.1)
    return mix.sample_negatives(corpus, n, seed=42).select("row_id", "source")


@query
def negative_sample_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """More draws than the pool has rows: all draws are with replacement."""
    corpus = _ids(td.annotated_documents(spark, sf))
    return mix.sample_negatives(corpus, 2 * corpus.count(), seed=42).select("draw_no", "row_id")


@query
def mixed_profile(spark: SparkSession, sf: str) -> DataFrame:
    corpus = _corpus(spark, sf)
    mixed = mix.mix_corpus(corpus, td.table(spark, sf, "documents").count(), 0.1, seed=42)
    return _rounded(profile.category_profile(mixed).drop("category_index"), "coverage")


# --- Chat ---------------------------------------------------------------------


def _messages_json(messages: Column) -> Column:
    """Scalar text of a messages array, so that results compare as plain values."""
    cells = F.transform(messages, lambda m: F.concat_ws("=", m.getField("role"), F.md5(m.getField("content"))))
    return F.array_join(cells, ";")


def _chat_out(df: DataFrame, mapper: str | None = None) -> DataFrame:
    made = chat.to_chat(df, mapper, keep=("pair_id",))
    return made.select("pair_id", _messages_json(F.col("messages")).alias("chat"))


@query
def chat_three_turn(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.annotated_documents(spark, sf)
    messages = chat.extraction_chat(F.col("input_text"), jsonx.encode_annotation(F.col("annotation")))
    return docs.select("row_id", _messages_json(messages).alias("chat"))


@query
def chat_mapper(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf).withColumn("system", F.coalesce("system", F.lit("")))
    return _chat_out(pairs, "user=question,assistant=answer,system=system")


@query
def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    """`messages` wins over instruction/output; rows without a list fall back to the latter."""
    pairs = td.turn_pairs(spark, sf)
    listed = F.array(chat.turn("user", F.col("question")), chat.turn("tool", F.col("answer")))
    shaped = pairs.select(
        "pair_id",
        F.when(F.col("turn") % 4 != 0, listed).alias("messages"),
        F.col("question").alias("instruction"),
        F.col("answer").alias("output"),
    )
    return _chat_out(shaped)


@query
def chat_from_sharegpt(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf)

    def said(sender: str, value: str) -> Column:
        return F.struct(F.lit(sender).alias("from"), F.col(value).alias("value"))

    return _chat_out(
        pairs.select(
            "pair_id",
            F.array(said("human", "question"), said("gpt", "answer"), said("tool", "question")).alias("conversations"),
        )
    )


@query
def chat_from_alpaca(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf)
    return _chat_out(
        pairs.select(
            "pair_id",
            F.col("question").alias("instruction"),
            F.when(F.col("turn") % 4 == 0, F.lit("")).otherwise(F.col("system")).alias("input"),
            F.col("answer").alias("output"),
        )
    )


@query
def chat_from_dolly(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf)
    return _chat_out(
        pairs.select(
            "pair_id",
            F.col("question").alias("instruction"),
            F.col("system").alias("context"),
            F.col("answer").alias("response"),
        )
    )


@query
def chat_from_inputs_targets(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf)
    return _chat_out(
        pairs.select("pair_id", F.col("question").alias("inputs"), F.col("answer").alias("targets"))
    )


@query
def chat_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that have no usable messages, over the whole table."""
    turns = td.table(spark, sf, "conversations")
    shaped = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", F.col("text")).alias("inputs"),
        F.when(F.col("turn") % 3 != 0, F.col("text")).alias("targets"),
    )
    return chat.bad_chat_rows(shaped).select("conv_id", "turn")


@query
def chat_single_turn(spark: SparkSession, sf: str) -> DataFrame:
    out = chat.single_turn_from_turns(td.table(spark, sf, "conversations"), "conv_id", "turn")
    return out.select(
        "conv_id",
        F.md5("user_text").alias("user_md5"),
        F.md5("reference_text").alias("reference_md5"),
        "is_bad",
    )


def _three_turns(pairs: DataFrame) -> Column:
    turns = F.array(chat.turn("user", F.col("question")), chat.turn("assistant", F.col("answer")))
    system = F.array(chat.turn("system", F.col("system")))
    return F.when(F.col("system").isNotNull(), F.concat(system, turns)).otherwise(turns)


@query
def chat_prompt_and_gold(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf)
    messages = F.when(F.col("turn") % 4 == 0, chat.prompt_messages(_three_turns(pairs))).otherwise(_three_turns(pairs))
    shaped = pairs.select("pair_id", messages.alias("messages"))
    return shaped.select(
        "pair_id",
        _messages_json(chat.prompt_messages(F.col("messages"))).alias("prompt"),
        F.md5(chat.gold_answer(F.col("messages"))).alias("gold_md5"),
        F.size(chat.messages_with_role(F.col("messages"), "user")).cast("bigint").alias("n_user"),
    )


@query
def chat_template_render(spark: SparkSession, sf: str) -> DataFrame:
    pairs = td.turn_pairs(spark, sf)
    messages = _three_turns(pairs)
    training = chat.render_chat(messages)
    asking = chat.render_chat(
        chat.prompt_messages(messages), default_system="", tools=["search", {"name": "sum"}],
        bos="<s>", generation_prompt=True,
    )
    return pairs.select(
        "pair_id", F.md5(training).alias("training_md5"), F.md5(asking).alias("asking_md5")
    )


@query
def chat_json_content(spark: SparkSession, sf: str) -> DataFrame:
    """Chats kept as JSON text whose content is a string, an object, a list, a number or null, rendered."""
    turns = td.table(spark, sf, "conversations")
    text, kind = jsonx.quote(F.col("text")), F.col("turn") % 5
    content = (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit('{"query":'), text, F.lit(',"n":1.50,"<at>":['), F.col("turn").cast("string"), F.lit("]}")))
        .when(kind == 2, F.concat(F.lit("[ "), text, F.lit(" ,null,true,1E3]")))
        .when(kind == 3, F.col("turn").cast("string"))
        .otherwise(F.lit("null"))
    )
    role = F.when(F.col("role") == "assistant", F.lit("tool")).otherwise(F.col("role"))
    listed = F.concat(F.lit('[{"role":"user","content":"ask"},{"role":"'), role, F.lit('","content":'), content, F.lit("}]"))
    tools = chat.tools_from_json(F.concat(F.lit('["search",{"name":"sum","max":'), F.col("turn").cast("string"), F.lit(".0}]")))
    rendered = chat.render_chat(chat.messages_from_json(listed), default_system="", tools=tools)
    return turns.select("conv_id", "turn", F.md5(rendered).alias("rendered_md5"))


@query
def context_filter(spark: SparkSession, sf: str) -> DataFrame:
    turns = td.table(spark, sf, "conversations")
    kept = chat.within_context(turns, F.size(tx.words(F.col("text"))), 256)
    return kept.select("conv_id", "turn")


@query
def audio_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Audio rows from chat turns (the bytes stand in for audio), bad rows dropped."""
    turns = td.table(spark, sf, "conversations")
    payload = F.when(F.col("turn") % 5 == 0, F.lit("")).when(F.col("turn") % 7 == 0, F.lit(None)).otherwise(F.col("text"))
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("transcription"),
        F.struct(payload.cast("binary").alias("bytes"), F.lit("turn").alias("path")).alias("audio"),
    )
    usable = rows.filter(chat.usable_audio(F.col("transcription"), F.col("audio")))
    made = usable.withColumn("messages", chat.audio_chat(F.col("transcription"), F.col("audio")))
    return made.select(
        "conv_id",
        "turn",
        F.array_join(F.transform("messages", lambda m: m.getField("role")), ",").alias("roles"),
        F.md5(F.get("messages", 1).getField("text")).alias("text_md5"),
        F.md5(F.get("messages", 2).getField("audio")).alias("audio_md5"),
    )


@query
def audio_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Audio rows of at most three seconds by their heads, and those whose head is broken."""
    turns = td.audio_turns(spark, sf)
    measured = turns.select("conv_id", "turn", readers.audio_seconds(F.col("audio")).alias("a")).select("conv_id", "turn", "a.*")
    kept = chat.within_context(measured.filter("status = 'ok'"), F.col("seconds"), 3)
    return kept.unionByName(measured.filter("status <> 'ok'"))


# --- Validation ---------------------------------------------------------------


@query
def leak_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents")
    return docs.select("doc_id", *[detect.has_leak(F.col("text"), c).alias(c) for c in LEAK_PATTERNS])


@query
def leak_scan_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = td.table(spark, sf, "pages")
    return pages.select("page_id", *[detect.has_leak(F.col("html"), c).alias(c) for c in LEAK_PATTERNS])


@query
def verbatim_check(spark: SparkSession, sf: str) -> DataFrame:
    """Entities of a document against its own text and against the text without the digit 7."""
    docs = td.annotated_documents(spark, sf)
    entities = F.concat(*[F.col("annotation").getField(c) for c in CATEGORIES])
    shown = F.replace(F.col("input_text"), F.lit("7"), F.lit(""))
    return docs.select(
        "row_id",
        detect.all_verbatim(F.col("input_text"), entities).alias("in_text"),
        detect.all_verbatim(shown, entities).alias("in_changed_text"),
    )


@query
def clean_output(spark: SparkSession, sf: str) -> DataFrame:
    """Turns wrapped as models wrap their answers."""
    turns = td.table(spark, sf, "conversations")
    body, n = F.col("text"), F.col("turn") % 5
    wrapped = (
        F.when(n == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(n == 1, F.concat(F.lit('"'), body, F.lit('"')))
        .when(n == 2, F.concat(F.lit('"「'), body, F.lit('」"')))
        .when(n == 3, F.concat(F.lit("  '"), body, F.lit('"')))
        .otherwise(F.concat(F.lit("「"), body, F.lit("」\n")))
    )
    return turns.select("conv_id", "turn", F.md5(tx.clean_output(wrapped)).alias("clean_md5"))


@query
def pool_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the documents as one-per-line answers: markers off, distinct, order kept."""
    docs = td.table(spark, sf, "documents")
    marked = F.concat(F.lit("- "), F.regexp_replace(F.coalesce("text", F.lit("")), f"({tx.LINE_BREAK})", "$1- "))
    pool = tx.clean_pool_lines(marked)
    return docs.select("doc_id", F.size(pool).cast("bigint").alias("n"), F.md5(F.array_join(pool, "\n")).alias("pool_md5"))


# --- Synthesis ----------------------------------------------------------------


def _tasks(spark: SparkSession, sf: str, reps: int = 1, synthesize: bool = True) -> DataFrame:
    return tasks.expand_tasks(td.subtypes(spark), td.situations(spark, sf), reps, synthesize=synthesize)


@query
def synthesis_tasks(spark: SparkSession, sf: str) -> DataFrame:
    expanded = _tasks(spark, sf, reps=2, synthesize=False)
    return expanded.select("task_id", "category_key", "subtype_name", "positive", F.md5("situation").alias("situation_md5"))


@query
def synthesis_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Pending tasks when the log already holds the positive tasks of every third situation."""
    expanded = _tasks(spark, sf, synthesize=False)
    idx = F.split("task_id", "/")[2].cast("bigint")
    done = F.when(F.col("positive") & (idx % 3 == 0), F.col("task_id"))
    log = expanded.select(F.struct(done.alias("task_id")).alias("_meta"))
    return tasks.pending_tasks(expanded, log).select("task_id")


@query
def synth_entities(spark: SparkSession, sf: str) -> DataFrame:
    expanded = _tasks(spark, sf)
    return expanded.filter("positive").select("task_id", jsonx.encode_strings(F.col("entities")).alias("entities"))


@query
def synth_entities_pooled(spark: SparkSession, sf: str) -> DataFrame:
    """Pools in place of the formats of the pooled subtypes; the others keep their formats."""
    expanded = _tasks(spark, sf, synthesize=False)
    pools = {s: [f"{s}-{i}" for i in range(30)] for s in POOLED_SUBTYPES}
    made = add_entities(expanded, "task_id", pools=pools)
    return made.select("task_id", jsonx.encode_strings(F.col("entities")).alias("entities"))


@query
def task_prompts(spark: SparkSession, sf: str) -> DataFrame:
    messages = prompts.task_messages()
    return _tasks(spark, sf).select("task_id", _messages_json(messages).alias("chat"))


def lossy_echo(options: Mapping[str, object]) -> complete.Completer:
    """Offline stand-in with faults: drops the digit 7, and fails on some lengths."""

    def answer(messages: list[dict]) -> complete.Answer:
        prompt = messages[-1]["content"]
        if len(prompt) % 13 == 0:
            raise RuntimeError("no answer")
        return complete.Answer(prompt.replace("7", ""), len(prompt), 1)

    return answer


_ONE_TRY = complete.CallPolicy(attempts=1)


@query
def generate_validate(spark: SparkSession, sf: str) -> DataFrame:
    judged = complete.generate_and_validate(_tasks(spark, sf), lossy_echo, _ONE_TRY)
    return judged.select(
        "task_id",
        "status",
        "polarity",
        F.when(F.col("status") == validate.REJECTED, F.col("reason")).alias("reason"),
        F.col("attempt").cast("bigint").alias("attempt"),
    )


@query
def generation_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    judged = complete.generate_and_validate(_tasks(spark, sf), lossy_echo, _ONE_TRY)
    return validate.outcome_counts(judged)


@query
def generation_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows written as JSON lines and read back, without and with the strict reader."""
    judged = complete.generate_and_validate(_tasks(spark, sf), lossy_echo, _ONE_TRY)
    path = _fresh(spark, "log")
    writers.append_generation_log(validate.log_rows(judged), path)
    log = readers.read_generation_log(spark, path, strict=True)
    return log.select(
        "_meta.task_id", "_meta.category", "_meta.subtype", "_meta.polarity", "annotation_json",
        F.md5("input_text").alias("text_md5"),
    )


@query
def incremental_generation(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of task files; the second run finds its tasks finished and adds nothing."""
    task_path, log_path = _fresh(spark, "tasks"), _fresh(spark, "log")
    made = _tasks(spark, sf)
    made.write.parquet(task_path)
    stream = spark.readStream.schema(made.schema).parquet(task_path)
    for _ in range(2):
        start_generation(
            stream, log_path, _fresh(spark, "state"), lossy_echo, _ONE_TRY, read_tasks=lambda: spark.read.schema(made.schema).parquet(task_path)
        ).awaitTermination()
    log = readers.read_generation_log(spark, log_path)
    return log.groupBy(F.col("_meta.category").alias("category"), F.col("_meta.polarity").alias("polarity")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def batch_complete_stub(spark: SparkSession, sf: str) -> DataFrame:
    items = td.table(spark, sf, "benchmark")
    asked = items.select("item_id", complete.prompt_batch("Answer briefly.", F.col("text")).alias("messages"))
    done = complete.complete_table(asked)
    return done.select(
        "item_id",
        F.md5("content").alias("content_md5"),
        "model",
        "provider",
        F.col("usage")["prompt_tokens"].cast("bigint").alias("prompt_tokens"),
        F.col("usage")["completion_tokens"].cast("bigint").alias("completion_tokens"),
        "error",
    )


@query
def usage_totals(spark: SparkSession, sf: str) -> DataFrame:
    turns = td.table(spark, sf, "conversations")
    asked = turns.select(F.array(chat.turn("user", F.col("text"))).alias("messages"))
    totals = complete.usage_totals(complete.complete_table(asked, lossy_echo, _ONE_TRY))
    return totals.select("requests", "failures", "prompt_tokens", "completion_tokens", "total_tokens")


# --- Scorers and comparison ---------------------------------------------------


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return td.table(spark, sf, "documents")


@query
def score_length(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return _rounded(docs.select("doc_id", scorers.length_score(F.col("text")).alias("score")), "score")


@query
def score_diversity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return _rounded(docs.select("doc_id", scorers.diversity_score(F.col("text")).alias("score")), "score")


@query
def score_coherence(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return _rounded(docs.select("doc_id", scorers.coherence_score(F.col("text")).alias("score")), "score")


@query
def score_summary(spark: SparkSession, sf: str) -> DataFrame:
    turns = td.table(spark, sf, "conversations")
    scored = compare.score_table(turns, "text")
    return _rounded(compare.score_summary(scored, list(scorers.OUTPUT_SCORERS)), "mean")


@query
def comparison_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Two models' outputs aligned on the prompt id, as lines of a Markdown table; one model leaves out some prompts."""
    items = td.table(spark, sf, "documents").select(F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt"))
    base = items.withColumn("content", F.replace("prompt", F.lit("e"), F.lit("E")))
    tuned = items.filter("prompt_id % 10 <> 0").select("prompt_id", F.replace("prompt", F.lit(" "), F.lit("|")).alias("content"))
    lines = compare.markdown_rows(compare.align_models(base, tuned))
    return lines.select("prompt_id", "line")


@query
def comparison_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two comparisons in one table; the second write of one takes the place of the first."""
    items = td.table(spark, sf, "documents").select(F.col("doc_id").alias("prompt_id"), F.col("text").alias("prompt"))
    path = _fresh(spark, "comparisons")
    with bucketed(items, "prompt_id") as prompts_by_id:
        tuned = prompts_by_id.filter("prompt_id % 10 <> 0").withColumn("content", F.col("prompt"))
        for name, letter in (("first", "e"), ("second", "E"), ("second", "EE")):
            base = prompts_by_id.withColumn("content", F.replace("prompt", F.lit("e"), F.lit(letter)))
            writers.save_comparison(compare.align_models(base, tuned), path, name)
    return readers.read_comparison(spark, path).groupBy("comparison").agg(
        F.count(F.lit(1)).alias("n"), F.count("finetune").alias("n_finetune"), F.sum(F.length(F.coalesce("base", F.lit("")))).alias("base_characters")
    )


@query
def improvement_rate(spark: SparkSession, sf: str) -> DataFrame:
    """First against last day of each user's events, per event type."""
    events = td.table(spark, sf, "events")
    daily = events.groupBy(
        F.col("user_id").alias("run_id"), F.date_diff("ts", F.lit("2024-01-01").cast("date")).alias("step"),
        F.col("event_type").alias("metric"),
    ).agg(F.round(F.avg("value"), 6).alias("value"))
    return _rounded(compare.improvement_rate(daily, ["run_id"]), "improvement", digits=6)


# --- Audit --------------------------------------------------------------------

REQUIRED = ["click", "purchase", "refund"]


@query
def metric_gate(spark: SparkSession, sf: str) -> DataFrame:
    return audit.metric_gate(td.runs(spark, sf), td.run_history(spark, sf), REQUIRED)


@query
def metric_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of every run's values, written twice, merged by metric; the median's true rank is within the bound."""
    history = td.run_history(spark, sf)
    path = _fresh(spark, "sketches")
    of_run = sketches.value_sketches(history.withColumn("run_id", F.concat_ws("/", "metric", "run_id")), ["run_id"])
    for _ in range(2):
        writers.save_sketches(of_run, path)
    held = readers.read_sketches(spark, path).withColumn("metric", F.substring_index("run_id", "/", 1))
    merged = materialize(sketches.merge_sketches(held, ["metric"]))
    found = merged.select(
        "metric", "n", *[sketches.quantile(F.col("sketch"), p).alias(name) for name, p in (("least", 0.0), ("median", 0.5), ("most", 1.0))]
    )
    ranks = history.filter("value IS NOT NULL").join(found, "metric").groupBy("metric", "n", "least", "most").agg(
        F.avg((F.col("value") < F.col("median")).cast("int")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("upto")
    )
    close = (F.col("below") <= 0.5 + 2 * sketches.RANK_ERROR) & (F.col("upto") >= 0.5 - 2 * sketches.RANK_ERROR)
    return ranks.select("metric", "n", "least", "most", close.alias("median_is_close"))


@query
def run_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return audit.run_lookup(td.runs(spark, sf))


@query
def run_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return audit.verdict(td.runs(spark, sf), td.run_history(spark, sf), REQUIRED[:2], allow_running=True)


@query
def run_failures(spark: SparkSession, sf: str) -> DataFrame:
    return audit.failures(td.runs(spark, sf), td.run_history(spark, sf), REQUIRED)


@query
def system_report(spark: SparkSession, sf: str) -> DataFrame:
    """Events as system metrics; clicks stand for GPU readings."""
    history = td.run_history(spark, sf).withColumn(
        "metric", F.when(F.col("metric") == "click", F.lit("GPU.0.load")).otherwise(F.col("metric"))
    )
    return audit.system_report(history)


@query
def gpu_metric_names(spark: SparkSession, sf: str) -> DataFrame:
    history = td.run_history(spark, sf).withColumn("metric", F.concat(F.lit("gpu/"), F.col("run_id").cast("string")))
    return audit.gpu_metric_names(history)


@query
def summary_values(spark: SparkSession, sf: str) -> DataFrame:
    """One key of a summary kept as JSON text; every tenth text is broken."""
    events = td.table(spark, sf, "events")
    text = F.when(F.col("event_id") % 10 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return events.select("event_id", jsonx.summary_value(text, "k").alias("k"))


@query
def summary_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested summaries as long rows with `a/b` names."""
    events = td.table(spark, sf, "events")
    meta = F.struct(F.col("event_type").alias("type"), F.struct(F.col("user_id").alias("id")).alias("user"))
    ids = F.create_map(F.lit("event"), F.col("event_id"), F.lit("user"), F.col("user_id"))
    nested = events.select("event_id", F.struct(meta.alias("meta"), ids.alias("ids"), F.lit(None).cast("string").alias("gone")).alias("summary"))
    return audit.flatten_summary(nested, "summary", ("event_id",))


@query
def run_found(spark: SparkSession, sf: str) -> DataFrame:
    """Lookups by id, by a shared name and by a name that no run has."""
    runs = td.runs(spark, sf).withColumn("run_id", F.col("run_id").cast("string"))
    asked = [{"run_id": "1"}, {"run_id": "-1"}, {"run_name": "run 0"}, {"run_name": "no such run"}]
    found = [audit.find_run(runs, **a) for a in asked]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@query
def run_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return audit.run_candidates(td.runs(spark, sf), "run 0")


# --- Streaming ----------------------------------------------------------------


@query
def stream_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The category profile, kept by a stream over the documents."""
    docs = td.table(spark, sf, "documents")
    # A table is a file or a folder of files; as a pattern, its path may be either (a stream's plain path must be a folder).
    source = spark.readStream.schema(docs.schema).parquet(f"{sf}/document[s].parquet")
    masked = source.select(detect.detect_mask(F.col("text")).alias("mask"))
    annotated = masked.select(td.annotation_from_entities(F.col("mask"), td.DETECTED_LABELS).alias("annotation"))
    out = _fresh(spark, "profile")
    start_running_profile(annotated, out, _fresh(spark, "state")).awaitTermination()
    return _rounded(read_profile(spark, out).drop("category_index"), "coverage")


@query
def log_running_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The category profile of a generation log, kept by a stream over its files in several triggers."""
    docs = td.annotated_documents(spark, sf)
    meta = F.struct(F.col("row_id").cast("string").alias("task_id"), F.col("source").alias("category"), F.lit("").alias("subtype"), F.lit("pos").alias("polarity"))
    rows = docs.select("row_id", "input_text", jsonx.encode_annotation(F.col("annotation")).alias("annotation_json"), meta.alias("_meta"))
    log, out = _fresh(spark, "log"), _fresh(spark, "profile")
    for part in range(3):
        writers.append_generation_log(rows.filter(F.col("row_id") % 3 == part).drop("row_id"), log)
    files = len(readers.read_generation_log(spark, log).inputFiles())
    start_running_profile(stream_log(spark, log, -(-files // 3)), out, _fresh(spark, "state")).awaitTermination()
    return _rounded(read_profile(spark, out).drop("category_index"), "coverage")


@query
def log_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of a log with blank, broken and id-less lines, filled by the scan that writes its rows."""
    turns = td.table(spark, sf, "conversations")
    polarity = F.when(F.col("conv_id") % 2 == 0, "pos").otherwise("neg")
    meta = F.struct(F.concat_ws("/", "conv_id", "turn").alias("task_id"), F.lit("c").alias("category"), F.lit("s").alias("subtype"), polarity.alias("polarity"))
    whole = F.to_json(F.struct(F.col("text").alias("input_text"), F.lit("{}").alias("annotation_json"), meta.alias("_meta")))
    bare = F.to_json(F.struct(F.col("text").alias("input_text"), F.lit("{}").alias("annotation_json")))
    line = F.when(F.col("turn") % 7 == 0, F.lit("  ")).when(F.col("turn") % 11 == 0, F.left(whole, F.length(whole) - 3))
    path = _fresh(spark, "log")
    turns.select(line.when(F.col("turn") % 13 == 0, bare).otherwise(whole).alias("value")).write.text(path)
    rows, counted = readers.read_counted_log(spark, path)
    written = materialize(rows)
    counts = [F.lit(counted.get[name]).cast("bigint").alias(name) for name in readers.LOG_COUNTERS]  # six numbers
    return written.agg(F.count(F.lit(1)).alias("rows_written")).select(*counts, "rows_written")
