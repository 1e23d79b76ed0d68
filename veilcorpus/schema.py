"""Schemas of the tables that the operators read and write."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from veilcorpus.fixed_values import CATEGORIES

STRINGS = "ARRAY<STRING>"
ANNOTATION_TYPE = T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in CATEGORIES])

MASKED_TEXT = (
    "source_text STRING, language STRING, "
    "privacy_mask ARRAY<STRUCT<value: STRING, label: STRING, start: INT, end: INT>>"
)
TYPED_ENTITIES = (
    "text STRING, entities ARRAY<STRUCT<name: STRING, type: STRING, span_start: INT, span_end: INT>>"
)
CORPUS_COLUMNS = ("input_text", "annotation_json")
CORPUS = "input_text STRING, annotation_json STRING"
GENERATION_LOG = (
    "input_text STRING, annotation_json STRING, "
    "_meta STRUCT<task_id: STRING, category: STRING, subtype: STRING, polarity: STRING>"
)
TASK = (
    "task_id STRING, category_key STRING, category_desc STRING, subtype_name STRING, "
    "subtype_desc STRING, examples ARRAY<STRING>, situation STRING, positive BOOLEAN, "
    "entities ARRAY<STRING>"
)
COMPLETION_FIELDS = (
    "content STRING, model STRING, provider STRING, usage MAP<STRING, INT>, "
    "latency_s DOUBLE, error STRING"
)
METRICS = "metric STRING, value DOUBLE, run_id STRING, step BIGINT"
SKETCHES = "n BIGINT, sketch BINARY, run_id STRING"
COMPARISON = "prompt STRING, base STRING, finetune STRING, comparison STRING"
AUDIO_ROWS = "transcription STRING, audio STRUCT<bytes: BINARY, path: STRING>"


def empty_strings() -> Column:
    return F.array().cast(STRINGS)


def strings_or_empty(values: Column) -> Column:
    """A null array means 'no values'."""
    return F.coalesce(values, empty_strings())


def build_annotation(per_category) -> Column:
    """Struct of the 11 arrays; `per_category(name)` gives the array, or None for empty."""
    fields = []
    for name in CATEGORIES:
        values = per_category(name)
        fields.append((empty_strings() if values is None else strings_or_empty(values)).alias(name))
    return F.struct(*fields)


def empty_annotation() -> Column:
    return build_annotation(lambda name: None)
