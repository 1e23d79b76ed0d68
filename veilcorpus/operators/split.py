"""Train / validation / test splits.

The rows of a split are the two ends of a seeded permutation, so the split is a
comparison with one cut key: a narrow pass over the data, and no shuffle of it. A column
named `split` is replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.functions.frames import free_name
from veilcorpus.operators.rank import key_at_position, uniform_key


def _check_ratio(ratio: float) -> None:
    if not 0.0 < ratio < 1.0:
        raise ValueError("ratio must be greater than 0.0 and less than 1.0")


def validation_rows(total: Column, ratio: float) -> Column:
    """max(1, half-even rounding of total x ratio)."""
    return F.greatest(F.lit(1), F.bround(total * F.lit(ratio), 0)).cast("bigint")


def carved_rows(total: Column, ratio: float) -> Column:
    return F.ceil(total * F.lit(ratio)).cast("bigint")


def _key(row_id: str, seed: int, salt: str) -> Column:
    return uniform_key(seed, salt, F.col(row_id))


def train_validation_split(
    df: DataFrame, row_id: str, ratio: float = 0.05, seed: int = 42, salt: str = "shuffle", ids: DataFrame | None = None
) -> DataFrame:
    """Add `split`: the last rows of the permutation are the validation rows.

    `ids` has the row ids of `df`; the cut, one key, is then taken from there at once, for a `df` that is
    costly to compute.
    """
    _check_ratio(ratio)
    key = _key(row_id, seed, salt)
    cut = key_at_position(df if ids is None else ids, key, row_id, lambda n: n - validation_rows(n, ratio))
    if ids is not None:
        found = ids.sparkSession.range(1).select(cut.alias("cut")).first()["cut"]
        cut = F.struct(F.lit(found["k"]).alias("k"), F.lit(found["id"]).alias("id")) if found else F.lit(None)
    here = F.struct(key.alias("k"), F.col(row_id).alias("id"))
    split = F.when(here >= cut, F.lit("validation")).otherwise(F.lit("train"))
    return df.withColumn("split", split)


def carve_out(
    df: DataFrame, row_id: str, ratio: float = 0.1, seed: int = 42, salt: str = "carve",
    name: str = "test",
) -> DataFrame:
    """Add `split`: the first ceil(n x ratio) rows of the permutation are carved from train."""
    _check_ratio(ratio)
    key = _key(row_id, seed, salt)
    cut = key_at_position(df, key, row_id, lambda n: carved_rows(n, ratio))
    here = F.struct(key.alias("k"), F.col(row_id).alias("id"))
    # No row at the cut position means that every row was carved out.
    split = F.when(cut.isNull() | (here < cut), F.lit(name)).otherwise(F.lit("train"))
    return df.withColumn("split", split)


def three_way_split(
    df: DataFrame, row_id: str, test_ratio: float = 0.2, validation_ratio: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Test rows first, then validation rows from what is left."""
    name = free_name("_outer", df)
    outer = carve_out(df, row_id, test_ratio, seed, "test", "test").withColumnRenamed("split", name)
    rest = outer.filter(F.col(name) == "train")
    key = _key(row_id, seed, "validation")
    cut = key_at_position(rest, key, row_id, lambda n: carved_rows(n, validation_ratio))
    here = F.struct(key.alias("k"), F.col(row_id).alias("id"))
    inner = F.when(cut.isNull() | (here < cut), F.lit("validation")).otherwise(F.lit("train"))
    split = F.when(F.col(name) == "test", F.lit("test")).otherwise(inner)
    return outer.withColumn("split", split).drop(name)


def evaluation_split(
    splits: dict[str, DataFrame], row_id: str, ratio: float = 0.1, seed: int = 42
) -> tuple[DataFrame, DataFrame | None]:
    """(train, evaluation): an existing validation split, else test, else a carve-out, else none."""
    train = splits["train"]
    for name in ("validation", "test"):
        if name in splits:
            return train, splits[name]
    if ratio <= 0:
        return train, None
    carved = carve_out(train, row_id, ratio, seed)
    return (
        carved.filter("split = 'train'").drop("split"),
        carved.filter("split = 'test'").drop("split"),
    )


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split and in total."""
    return (
        df.groupBy("split")
        .agg(F.count(F.lit(1)).alias("rows"))
        .rollup("split")
        .agg(F.sum("rows").alias("rows"), F.grouping("split").alias("is_total"))
        .select(
            F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.col("split")).alias("split"),
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        )
    )
