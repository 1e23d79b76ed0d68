"""Accept or reject generated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.functions.detect import all_verbatim, leaks_own_category
from veilcorpus.functions.jsonx import encode_annotation
from veilcorpus.functions.text import clean_output, truthy
from veilcorpus.operators.annotate import annotation_from_task

ACCEPTED, REJECTED, FAILED = "ok", "rejected", "error"


def reject_reason(text: Column, positive: Column, category: Column, entities: Column) -> Column:
    """Null if the text is acceptable, else the first reason against it."""
    return (
        F.when(~truthy(text), F.lit("empty"))
        .when(positive & ~F.coalesce(all_verbatim(text, entities), F.lit(True)), F.lit("entity missing"))
        .when(~positive & leaks_own_category(text, category), F.lit("leak"))
    )


def answer_text(content: Column) -> Column:
    """The text of an answer as it is judged and logged; empty where there is no answer."""
    return clean_output(F.coalesce(content, F.lit("")))


def judge(df: DataFrame, content: str = "content", error: str | None = "error") -> DataFrame:
    """Add `input_text`, `reason`, `status` and `polarity` to task rows with an answer."""
    judged = df.withColumn("input_text", answer_text(F.col(content)))
    judged = judged.withColumn(
        "reason",
        reject_reason(
            F.col("input_text"), F.col("positive"), F.col("category_key"), F.col("entities")
        ),
    )
    failed = F.col(error).isNotNull() if error else F.lit(False)
    status = (
        F.when(failed, F.lit(FAILED)).when(F.col("reason").isNotNull(), F.lit(REJECTED)).otherwise(F.lit(ACCEPTED))
    )
    return judged.withColumns(
        {
            "status": status,
            "polarity": F.when(F.col("positive"), F.lit("pos")).otherwise(F.lit("neg")),
        }
    )


def outcome_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("status", "polarity").agg(F.count(F.lit(1)).alias("n"))


def log_rows(judged: DataFrame) -> DataFrame:
    """Generation-log rows of the accepted answers."""
    accepted = judged.filter(F.col("status") == ACCEPTED)
    annotation = annotation_from_task(F.col("positive"), F.col("category_key"), F.col("entities"))
    return accepted.select(
        "input_text",
        encode_annotation(annotation).alias("annotation_json"),
        F.struct(
            "task_id",
            F.col("category_key").alias("category"),
            F.col("subtype_name").alias("subtype"),
            "polarity",
        ).alias("_meta"),
    )
