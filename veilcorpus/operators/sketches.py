"""Quantiles that can be merged: a KLL sketch for each run, stored, and added up when read.

A sketch is a few kilobytes whatever it has seen. A quantile of it has a rank within RANK_ERROR of the wanted
one (99 times in 100), and so has a quantile of merged sketches. Least and greatest value are exact. Null values
are not counted; a group without any value has no sketch and null quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

K = 200
RANK_ERROR = 0.0165  # of a sketch with this K


def value_sketches(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """`keys, n, sketch` of a column of numbers; partial sketches are merged before and after the shuffle."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(number, F.lit(K)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sketches of all rows of a group as one; no keys: of all rows."""
    held = sketches.filter("n > 0")
    return held.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(K)).alias("sketch"))


def quantile(sketch: Column, rank: float) -> Column:
    """The value at a rank from 0 (the least) to 1 (the greatest)."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))


def latency_sketches(completions: DataFrame, run_id: Column) -> DataFrame:
    """`run_id, n, sketch` of the latencies of a run's answered requests."""
    return value_sketches(completions.select(run_id.cast("string").alias("run_id"), "latency_s"), ["run_id"], "latency_s")
