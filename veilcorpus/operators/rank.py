"""Positions in a seeded permutation, computed in parallel.

A plain `row_number()` over a group puts the group into one task. Here the sort
key is cut into buckets by a fixed, monotone function of the key. Rows per
bucket are counted (with map-side partial counts), a running sum over that small
table gives each bucket's offset, and rows are numbered inside their bucket. A
group that holds most of the data is spread over all buckets, and since the
bucket is a function of the row alone, a retried task gives the same answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veilcorpus.functions.frames import free_name, join_null_safe
from veilcorpus.functions.hashing import draw, unit

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def default_buckets(spark: SparkSession) -> int:
    """Enough buckets for every shuffle task to get several."""
    return max(128, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def uniform_key(seed: int, salt: str, row_id: Column) -> Column:
    """Sort key of a uniform shuffle."""
    return unit(draw(seed, salt, row_id))


def weighted_key(u: Column, weight: Column) -> Column:
    """Exponential key: ascending order is weighted sampling without replacement."""
    return -F.log(u) / weight


def uniform_bucket(key: Column, buckets: int) -> Column:
    return F.floor(key * F.lit(float(buckets))).cast("bigint")


def exponential_bucket(key: Column, buckets: int) -> Column:
    """Equal steps of log2(key).

    For one weight, log2 of an exponential key has its peak density at about a
    quarter per unit, so with buckets/4 steps per unit no bucket holds much more
    than 1/buckets of the rows, whatever the mix of weights is.
    """
    return F.floor(F.log2(key) * F.lit(buckets / 4.0)).cast("bigint")


def bucketed_rank(
    df: DataFrame,
    order: Sequence[str],
    bucket: str,
    groups: Sequence[str] = (),
    position: str = "position",
    needed: DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group; a null group is a group like any other.

    `bucket` must be monotone in `order`. `needed` (groups + a count as its last column) keeps only
    the first rows of each group; buckets beyond that are dropped before any sort. A column that is
    named like `position` is replaced; all others stay, whatever their names.
    """
    groups = list(groups)
    n, offset, limit = (free_name(base, df) for base in ("_n", "_offset", "_needed"))
    counts = df.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias(n))
    running = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(*_BEFORE)
    offsets = counts.select(*groups, bucket, F.coalesce(F.sum(n).over(running), F.lit(0)).alias(offset))
    if needed is not None:
        bounds = needed.withColumnRenamed(needed.columns[-1], limit)
        offsets = join_null_safe(offsets, bounds, groups).filter(F.col(offset) < F.col(limit))
    within = Window.partitionBy(*groups, bucket).orderBy(*order)
    ranked = join_null_safe(df, offsets, [*groups, bucket]).withColumn(
        position, (F.col(offset) + F.row_number().over(within) - 1).cast("bigint")
    )
    if needed is not None:
        ranked = ranked.filter(F.col(position) < F.col(limit)).drop(limit)
    return ranked.drop(offset, bucket)


def _ranked_by_key(
    df: DataFrame, key: Column, bucket: Callable[[Column, int], Column], row_id: str, groups: Sequence[str], position: str
) -> DataFrame:
    """Positions in the order of a key column and then the row id."""
    k, b = free_name("_k", df), free_name("_b", df)
    keyed = df.withColumn(k, key)
    keyed = keyed.withColumn(b, bucket(F.col(k), default_buckets(df.sparkSession)))
    return bucketed_rank(keyed, [k, row_id], b, groups, position).drop(k)


def shuffle_positions(
    df: DataFrame, row_id: str, seed: int, salt: str = "shuffle", groups: Sequence[str] = (),
    position: str = "position",
) -> DataFrame:
    """Position of each row in a uniform shuffle (of each group)."""
    return _ranked_by_key(df, uniform_key(seed, salt, F.col(row_id)), uniform_bucket, row_id, groups, position)


def weighted_shuffle_positions(
    df: DataFrame, row_id: str, weight: str, seed: int, salt: str = "weighted",
    groups: Sequence[str] = (), position: str = "position",
) -> DataFrame:
    """Position of each row in a weighted shuffle: a larger weight tends to come first."""
    key = weighted_key(uniform_key(seed, salt, F.col(row_id)), F.col(weight))
    return _ranked_by_key(df, key, exponential_bucket, row_id, groups, position)


def key_at_position(
    df: DataFrame, key: Column, row_id: str, target: Callable[[Column], Column]
) -> Column:
    """Scalar struct `(k, id)` of the row at position `target(total rows)` of a uniform order.

    Only bucket counts and the rows of one bucket are needed, so a cut through a
    permutation costs no shuffle of the data. Null when the position is out of range.
    """
    buckets = default_buckets(df.sparkSession)
    keyed = df.select(key.alias("k"), F.col(row_id).alias("id")).withColumn(
        "b", uniform_bucket(F.col("k"), buckets)
    )
    # At most `buckets` rows from here on, so one task is enough.
    counts = keyed.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    runs = counts.select(
        "b",
        "n",
        F.sum("n").over(everything.orderBy("b").rowsBetween(*_UP_TO)).alias("upto"),
        F.sum("n").over(everything).alias("total"),
    ).withColumn("target", target(F.col("total")).cast("bigint"))
    hit = runs.filter((F.col("target") < F.col("upto")) & (F.col("target") >= F.col("upto") - F.col("n")))
    found = hit.select(
        F.struct("b", (F.col("target") - F.col("upto") + F.col("n")).alias("r")).alias("hit")
    ).scalar()
    inside = keyed.filter(F.col("b") == found.getField("b"))
    numbered = inside.withColumn("i", F.row_number().over(Window.partitionBy("b").orderBy("k", "id")) - 1)
    return (
        numbered.filter(F.col("i") == found.getField("r")).select(F.struct("k", "id").alias("cut")).scalar()
    )


def first_in_shuffle(
    df: DataFrame, row_id: str, n: int, seed: int, salt: str = "shuffle"
) -> DataFrame:
    """The first `n` rows of a uniform shuffle, `n` <= 0 keeps all; order is not kept."""
    if n <= 0:
        return df
    key = uniform_key(seed, salt, F.col(row_id))
    cut = key_at_position(df, key, row_id, lambda total: F.lit(n))
    here = F.struct(key.alias("k"), F.col(row_id).alias("id"))
    return df.filter(cut.isNull() | (here < cut))
