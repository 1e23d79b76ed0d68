"""From labelled source rows to the 11-category annotation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.fixed_values import CATEGORIES, ENTITY_TYPES, MASK_LABELS
from veilcorpus.functions.frames import small_table
from veilcorpus.functions.jsonx import encode_annotation
from veilcorpus.schema import build_annotation


def filter_language(df: DataFrame, language: str = "ja", column: str = "language") -> DataFrame:
    return df.filter(F.col(column) == language)


def annotation_from_entities(
    entities: Column, labels: Mapping[str, str], value: str = "value", label: str = "label"
) -> Column:
    """Values per category, in source order with duplicates; unknown labels are dropped."""

    def per_category(name: str) -> Column | None:
        wanted = [lab for lab, category in labels.items() if category == name]
        if not wanted:
            return None
        hits = F.filter(entities, lambda e: e.getField(label).isin(*wanted))
        return F.transform(hits, lambda e: e.getField(value))

    return build_annotation(per_category)


def annotate_masked_text(
    df: DataFrame, language: str = "ja", labels: Mapping[str, str] = MASK_LABELS
) -> DataFrame:
    """Rows of `source_text, language, privacy_mask` to `input_text, annotation_json`."""
    kept = filter_language(df, language)
    annotation = annotation_from_entities(F.col("privacy_mask"), labels)
    return kept.select(
        F.col("source_text").alias("input_text"),
        encode_annotation(annotation).alias("annotation_json"),
    )


def annotate_typed_entities(
    df: DataFrame, labels: Mapping[str, str] = ENTITY_TYPES
) -> DataFrame:
    """Rows of `text, entities` to `input_text, annotation_json`."""
    annotation = annotation_from_entities(F.col("entities"), labels, value="name", label="type")
    return df.select(
        F.col("text").alias("input_text"), encode_annotation(annotation).alias("annotation_json")
    )


def labelled_entities(
    df: DataFrame,
    id_column: str,
    entities: str,
    labels: Mapping[str, str],
    value: str = "value",
    label: str = "label",
) -> DataFrame:
    """Long form `(id, pos, label, category, value)`; unknown labels are dropped.

    A label table as small as the fixed one is broadcast by the engine, which checks its size, and no row moves.
    """
    table = small_table(df.sparkSession, labels.items(), "label STRING, category STRING")
    exploded = df.select(F.col(id_column), F.posexplode(F.col(entities)).alias("pos", "entity"))
    flat = exploded.select(
        id_column,
        "pos",
        F.col("entity").getField(label).alias("label"),
        F.col("entity").getField(value).alias("value"),
    )
    return flat.join(table, "label").select(
        id_column, "pos", "label", "category", "value"
    )


def long_annotation(df: DataFrame, id_column: str, annotation: str = "annotation") -> DataFrame:
    """Long form `(id, category, pos, value)` of the annotation struct."""
    per_category = F.array(
        *[
            F.struct(F.lit(c).alias("category"), F.col(annotation).getField(c).alias("values"))
            for c in CATEGORIES
        ]
    )
    split = df.select(id_column, F.explode(per_category).alias("c"))
    return split.select(
        id_column, F.col("c.category").alias("category"), F.posexplode("c.values").alias("pos", "value")
    )


def is_hard_negative(annotation: Column) -> Column:
    """All 11 arrays are empty."""
    empty = F.lit(True)
    for name in CATEGORIES:
        empty = empty & (F.coalesce(F.size(annotation.getField(name)), F.lit(0)) <= 0)
    return empty


def annotation_from_task(positive: Column, category: Column, entities: Column) -> Column:
    """The task's own category holds its distinct entities; a negative task has none."""
    return build_annotation(
        lambda name: F.when(positive & (category == name), F.array_distinct(entities))
    )


def merge_annotations(rows: Column) -> Column:
    """Union of the annotations of `rows` (an array of structs with an `annotation` field).

    Values keep the order of the rows; only the first occurrence stays.
    """
    return build_annotation(
        lambda name: F.array_distinct(
            F.flatten(F.transform(rows, lambda r: r.getField("annotation").getField(name)))
        )
    )
