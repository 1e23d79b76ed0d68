"""Category coverage and rarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.fixed_values import CATEGORIES

WEIGHT_FLOOR = 1e-9


def _size(annotation: Column, name: str) -> Column:
    return F.greatest(F.coalesce(F.size(annotation.getField(name)), F.lit(0)), F.lit(0))


def _wide_profile(annotation: Column) -> list[Column]:
    sums = [F.count(F.lit(1)).alias("total_rows")]
    for name in CATEGORIES:
        n = _size(annotation, name)
        sums.append(F.coalesce(F.sum(n.cast("bigint")), F.lit(0)).alias(f"e_{name}"))
        sums.append(
            F.coalesce(F.sum((n > 0).cast("bigint")), F.lit(0)).alias(f"r_{name}")
        )
    return sums


def _long_profile(wide: DataFrame, keys: list[str]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("category_index"),
                F.lit(name).alias("category"),
                F.col(f"e_{name}").alias("entity_count"),
                F.col(f"r_{name}").alias("row_count"),
            )
            for i, name in enumerate(CATEGORIES)
        ]
    )
    coverage = F.when(
        F.col("total_rows") > 0, F.col("row_count") / F.col("total_rows") * 100
    ).otherwise(F.lit(0.0))
    return (
        wide.select(*keys, "total_rows", F.inline(rows))
        .withColumn("coverage", coverage)
        .select(
            *keys, "category_index", "category", "total_rows", "entity_count", "row_count", "coverage"
        )
    )


def category_profile(df: DataFrame, annotation: str = "annotation") -> DataFrame:
    """Entities, rows and coverage per category: always 11 rows, in one pass over `df`."""
    return _long_profile(df.agg(*_wide_profile(F.col(annotation))), [])


def category_profile_by_source(
    df: DataFrame, source: str = "source", annotation: str = "annotation", total_name: str = "(all)"
) -> DataFrame:
    """One profile per source, and a combined one when there is more than one source.

    Counts add up, so the combined profile is taken from the per-source sums and
    the data is neither read twice nor expanded.
    """
    per_source = df.groupBy(source).agg(*_wide_profile(F.col(annotation)))
    measures = [c for c in per_source.columns if c != source]
    both = (
        per_source.rollup(source)
        .agg(
            *[F.sum(c).alias(c) for c in measures],
            F.grouping(source).alias("is_total"),
            F.count(F.lit(1)).alias("n_sources"),
        )
        .filter((F.col("is_total") == 0) | (F.col("n_sources") > 1))
        .withColumn(source, F.when(F.col("is_total") == 1, F.lit(total_name)).otherwise(F.col(source)))
    )
    return _long_profile(both, [source])


def formatted_profile(profile: DataFrame) -> DataFrame:
    """Add display texts: thousands separators and a one-decimal percentage."""
    return profile.withColumns(
        {
            "entity_count_text": F.format_number("entity_count", 0),
            "row_count_text": F.format_number("row_count", 0),
            "coverage_text": F.format_string("%.1f%%", F.col("coverage")),
        }
    )


def document_frequency(df: DataFrame, annotation: str = "annotation") -> DataFrame:
    """Rows with at least one value, per category that occurs at all."""
    profile = category_profile(df, annotation)
    return profile.filter("row_count > 0").select("category", "row_count", "total_rows")


def rarity_terms(df: DataFrame, annotation: str = "annotation") -> Column:
    """ln(total / rows) per category as one scalar-subquery struct; 0 where nothing occurs.

    It is one aggregated row over all sources together, so using it costs a small
    broadcast and no join.
    """
    wide = df.agg(*_wide_profile(F.col(annotation)))
    terms = [
        F.when(F.col(f"r_{c}") > 0, F.log(F.col("total_rows") / F.col(f"r_{c}")))
        .otherwise(F.lit(0.0))
        .alias(c)
        for c in CATEGORIES
    ]
    return wide.select(F.struct(*terms).alias("terms")).scalar()


def sample_weight(terms: Column, annotation: Column) -> Column:
    """Sum of the rarity terms of the categories present, added in category order."""
    weight = F.lit(0.0)
    for name in CATEGORIES:
        weight = weight + F.when(_size(annotation, name) > 0, terms.getField(name)).otherwise(
            F.lit(0.0)
        )
    return F.greatest(weight, F.lit(WEIGHT_FLOOR))
