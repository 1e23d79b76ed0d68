"""Synthesis tasks: expansion of a spec, resume, and polarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilcorpus.functions.entities import add_entities, known_subtypes
from veilcorpus.functions.text import task_id


def expand_tasks(
    subtypes: DataFrame,
    situations: DataFrame,
    reps: int = 1,
    limit_situations: int = 0,
    synthesize: bool = True,
    seed: int = 42,
    pools: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Subtypes x situations of the same category x polarity x repetition.

    `subtypes`: `category, category_desc, name, description, examples`; `situations`:
    `category, idx, situation`. The pairing is an equi-join on category. A spec's subtype
    list is the small side, but its size is left to the optimizer to check. Situations are dealt
    out evenly before each becomes many rows, three tasks a core, however few files hold them. With `synthesize`
    every subtype must have formats or a pool; one that has none raises before anything runs.
    """
    if synthesize:
        strange = subtypes.filter(~F.col("name").isin(known_subtypes(pools))).select("name").limit(5).collect()
        if strange:
            raise ValueError(f"no formats and no pool for the subtypes {[r['name'] for r in strange]}")
    if limit_situations > 0:
        situations = situations.filter(F.col("idx") < limit_situations)
    dealt = situations.repartition(3 * situations.sparkSession.sparkContext.defaultParallelism)
    paired = dealt.join(subtypes, "category")
    copies = paired.select(
        F.col("category").alias("category_key"),
        "category_desc",
        F.col("name").alias("subtype_name"),
        F.col("description").alias("subtype_desc"),
        "examples",
        "situation",
        "idx",
        F.explode(F.array(F.lit(True), F.lit(False))).alias("positive"),
    ).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
    named = copies.withColumn(
        "task_id",
        task_id(
            F.col("category_key"), F.col("subtype_name"), F.col("idx").cast("string"), F.col("positive"),
            F.col("rep").cast("string"),
        ),
    ).drop("idx", "rep")
    if not synthesize:
        return named
    with_values = add_entities(named, "task_id", "subtype_name", seed, pools)
    return with_values.withColumn("entities", F.when(F.col("positive"), F.col("entities")))


def pending_tasks(tasks: DataFrame, log: DataFrame) -> DataFrame:
    """Tasks that the log does not hold yet; log rows without a task id do not count."""
    done = log.select(F.col("_meta.task_id").alias("task_id")).filter("task_id is not null and task_id <> ''")
    return tasks.join(done, "task_id", "left_anti")
