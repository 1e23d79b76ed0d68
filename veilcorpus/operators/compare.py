"""Scorecards and side-by-side comparison of two models."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.functions.scorers import OUTPUT_SCORERS
from veilcorpus.functions.text import markdown_cell


def score_table(df: DataFrame, output: str = "output", scorers: Mapping[str, Callable[[Column], Column]] = OUTPUT_SCORERS) -> DataFrame:
    """Add one column per scorer."""
    return df.withColumns({name: fn(F.col(output)) for name, fn in scorers.items()})


def score_summary(scored: DataFrame, names: list[str]) -> DataFrame:
    """Long `(metric, mean)` of the named score columns; booleans count as 0 and 1."""
    wide = scored.agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in names])
    cells = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("mean")) for n in names]
    return wide.select(F.inline(F.array(*cells)))


def improvement_rate(history: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Percent change from the first to the last evaluation, for metrics in both.

    `history`: `step, metric, value` (and groups). The first and last step are those of the
    group, and a metric that is missing in either is left out.
    """
    groups = groups or []
    present = history.filter("value is not null")
    per_metric = present.groupBy(*groups, "metric").agg(
        F.min_by("value", "step").alias("first"),
        F.max_by("value", "step").alias("last"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
    )
    bounds = history.groupBy(*groups).agg(F.min("step").alias("lo"), F.max("step").alias("hi"))
    if groups:
        joined = per_metric.join(bounds, groups)
    else:
        ends = bounds.select(F.struct("lo", "hi").alias("ends")).scalar()
        joined = per_metric.withColumns({"lo": ends.getField("lo"), "hi": ends.getField("hi")})
    kept = joined.filter("first_step = lo and last_step = hi and lo < hi")
    change = (F.col("last") - F.col("first")) / F.abs("first") * 100
    return kept.select(
        *groups, "metric", "first", "last",
        F.when(F.col("first") != 0, change).otherwise(F.lit(0.0)).alias("improvement"),
    )


def align_models(base: DataFrame, finetuned: DataFrame, key: str = "prompt_id") -> DataFrame:
    """`(key, prompt, base, finetune)`; outputs meet on the prompt id, never on row order.

    A prompt that only one model answered stays, with null for the other's output.
    """
    left = base.select(key, "prompt", F.col("content").alias("base"))
    own = F.col("prompt") if "prompt" in finetuned.columns else F.lit(None).cast("string")
    right = finetuned.select(key, own.alias("other_prompt"), F.col("content").alias("finetune"))
    joined = left.join(right, key, "full")
    return joined.select(key, F.coalesce("prompt", "other_prompt").alias("prompt"), "base", "finetune")


def markdown_rows(compared: DataFrame, prompt_width: int | None = None, output_width: int | None = None) -> DataFrame:
    """Add `line`: the row of a Markdown comparison table, with whole texts unless widths are given."""

    def cell(name: str, width: int | None, flatten: bool) -> Column:
        # A missing output is an empty cell.
        return F.coalesce(markdown_cell(F.col(name), width, flatten=flatten), F.lit(""))

    cells = [cell("prompt", prompt_width, False), cell("base", output_width, True), cell("finetune", output_width, True)]
    line = F.concat(F.lit("| "), cells[0], F.lit(" | "), cells[1], F.lit(" | "), cells[2], F.lit(" |"))
    return compared.withColumn("line", line)


def audio_markdown_rows(compared: DataFrame, prompt_width: int | None = None) -> DataFrame:
    """The same for `(prompt, base_wav, ft_wav)` paths, which are shown as code."""

    def path(name: str) -> Column:
        return F.concat(F.lit("`"), markdown_cell(F.col(name), None, flatten=False), F.lit("`"))

    prompt = markdown_cell(F.col("prompt"), prompt_width, flatten=False)
    line = F.concat(
        F.lit("| "), prompt, F.lit(" | "), path("base_wav"), F.lit(" | "), path("ft_wav"), F.lit(" |")
    )
    return compared.withColumn("line", line)
