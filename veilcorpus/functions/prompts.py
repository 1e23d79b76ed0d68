"""Prompt texts as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from veilcorpus.fixed_values import (
    NEGATIVE_PROMPT,
    POOL_PROMPT,
    POOL_SYSTEM_PROMPT,
    POSITIVE_PROMPT,
    WRITER_PROMPT,
)
from veilcorpus.operators.chat import turn

EXAMPLES_SHOWN = 4


def fill(template: str, **values: Column) -> Column:
    """The template text with each `{name}` replaced by a column."""
    pieces = re.split(r"\{(\w+)\}", template)
    columns = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)]
    return F.concat(*columns)


def bullets(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit("- "), v)), "\n")


def positive_prompt(situation: Column, description: Column, entities: Column) -> Column:
    return fill(
        POSITIVE_PROMPT, situation=situation, description=description, bullets=bullets(entities)
    )


def negative_prompt(situation: Column, description: Column, examples: Column) -> Column:
    shown = bullets(F.slice(examples, 1, EXAMPLES_SHOWN))
    return fill(NEGATIVE_PROMPT, situation=situation, description=description, bullets=shown)


def task_messages() -> Column:
    """Messages of a synthesis task row."""
    user = F.when(
        F.col("positive"),
        positive_prompt(F.col("situation"), F.col("subtype_desc"), F.col("entities")),
    ).otherwise(negative_prompt(F.col("situation"), F.col("subtype_desc"), F.col("examples")))
    return F.array(turn("system", F.lit(WRITER_PROMPT)), turn("user", user))


def pool_messages(description: Column, examples: Column, count: int = 30) -> Column:
    """Messages that ask for `count` values of one kind, one per line."""
    user = fill(
        POOL_PROMPT, count=F.lit(str(count)), description=description, bullets=bullets(examples)
    )
    return F.array(turn("system", F.lit(POOL_SYSTEM_PROMPT)), turn("user", user))
