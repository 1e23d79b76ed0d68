"""Helpers over whole DataFrames: small tables, names that are free, and joins in which null meets null."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def small_table(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """Rows of the driver (texts, whole numbers, booleans, arrays and structs of these) as a local relation.

    Its size is known to the optimizer, which broadcasts it where that is small. A list given to
    `createDataFrame` counts as endlessly large, and the other side of a join is then shuffled by few keys.
    """
    kind = T.StructType.fromDDL(ddl)
    texts = [json.dumps(_by_name(tuple(row), kind)) for row in rows]
    held = spark.createDataFrame(pa.table({"row": pa.array(texts, pa.string())}))
    return held.select(F.from_json("row", kind).alias("row")).select("row.*")


def _by_name(value: Any, kind: T.DataType) -> Any:
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _by_name(v, f.dataType) for f, v in zip(kind.fields, value, strict=True)}
    return [_by_name(v, kind.elementType) for v in value] if isinstance(kind, T.ArrayType) else value


def free_name(base: str, *frames: DataFrame) -> str:
    """`base`, or `base` with a number, such that no column has that name (case does not count)."""
    taken = {c.lower() for df in frames for c in df.columns}
    return next(n for n in (base, *(f"{base}{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on `keys` in which equal nulls meet; the left keys stay, like in a join by names."""
    names = {k: free_name(f"_right_{i}", left, right) for i, k in enumerate(keys)}
    renamed = right.select(*[F.col(f"`{k}`").alias(n) for k, n in names.items()], *[F.col(f"`{c}`") for c in right.columns if c not in names])
    met = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(renamed, met, how).drop(*names.values())
