"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus import schema as S
from veilcorpus.fixed_values import CATEGORIES
from veilcorpus.functions.frames import free_name, join_null_safe
from veilcorpus.operators.rank import uniform_bucket, uniform_key
from veilcorpus.operators.split import split_counts
from veilcorpus.session import discard, materialize, shuffles_dropped
from veilcorpus.sources.arrow_corpus import save_arrow_corpus
from veilcorpus.sources.readers import path_exists

SKETCH_FOLDERS = 64
#: Ordered rows are written a part of the order after the other, so that no more than a part is shuffled at a time.
ORDER_PARTS = 4
LEAST_ROWS_A_FILE = 250
#: Texts get about a tenth smaller than with the default level and pages of 1 MB.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(8 << 20)}


def save_corpus(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Overwrite a corpus directory, in Parquet or as a folder of Arrow files (`arrow`); both are packed with zstd."""
    if format == "arrow":
        save_arrow_corpus(df, path, compression="zstd")
    elif format == "parquet":
        df.write.mode("overwrite").options(**PACKED).parquet(path)
    else:
        df.write.mode("overwrite").format(format).save(path)


def save_shuffled(df: DataFrame, path: str, key: str = "shuffle_key", rows: int | None = None) -> None:
    """Overwrite a directory with the rows in the order of a uniform key (dropped on write).

    The order is global: a file holds a range of the key, its name tells which, and its rows are sorted.
    `rows`, about how many there are, spares a few rows many files.
    """
    _save_ordered(df, path, key, [], rows)


def _save_ordered(df: DataFrame, path: str, key: str, folders: list[str], rows: int | None) -> None:
    """Rows in the order of a uniform key, dropped on write, with a folder for each value of `folders`.

    The key tells a row's file, so the order takes no sample of the rows. Files are written in ORDER_PARTS
    actions, each of which computes and shuffles its own rows of `df`; the last one marks the directory as whole.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # An action has a part of the files, enough of them for all cores where there are as many partitions.
    files = max(partitions, ORDER_PARTS * min(partitions, spark.sparkContext.defaultParallelism))
    if rows is not None:
        files = max(1, min(files, rows // LEAST_ROWS_A_FILE))
    width = -(-files // min(ORDER_PARTS, files))
    file = free_name("_file", df)
    number = F.least(F.greatest(F.coalesce(uniform_bucket(F.col(key), files), F.lit(0)), F.lit(0)), F.lit(files - 1))
    numbered = df.withColumn(file, number.cast("int"))
    starts = range(0, files, width)
    for start in starts:
        part = numbered.filter(F.expr(f"`{file}` div {width}") == start // width)
        ordered = part.repartitionById(files, F.col(file)).sortWithinPartitions(*folders, key).drop(file, key)
        writer = ordered.write.mode("append" if start else "overwrite").partitionBy(*folders).options(**PACKED)
        # The first action replaces all folders, also those that only later ones have rows for.
        writer = writer.option("partitionOverwriteMode", "static")
        whole = str(start == starts[-1]).lower()
        with shuffles_dropped(spark):
            writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", whole).parquet(path)


def append_generation_log(log: DataFrame, path: str) -> None:
    """Append finished rows as JSON lines (gzip); a failed job leaves no partial rows behind."""
    log.write.mode("append").json(path, compression="gzip")


def replace_log_part(log: DataFrame, path: str) -> None:
    """Write one folder of a log anew; a second write of the same part replaces the first."""
    log.write.mode("overwrite").json(path, compression="gzip")


def export_log(log: DataFrame, path: str, format: str = "parquet") -> None:
    """The corpus columns of a log, as a corpus."""
    save_corpus(log.select("input_text", "annotation_json"), path, format)


def save_splits(df: DataFrame, path: str, seed: int = 42, row_id: str = "row_id", rows: int | None = None) -> None:
    """One directory per split, `path/split=train` and so on, rows in shuffled order; `rows` as for `save_shuffled`."""
    key = free_name("_key", df)
    keyed = df.withColumn(key, uniform_key(seed, "shuffle", F.col(row_id))).drop(row_id)
    _save_ordered(keyed, path, key, ["split"], rows)


def dataset_card(df: DataFrame, name: str, sources: list[str], language: str = "ja",
                 description: str = "") -> DataFrame:
    """One-row description of a chat dataset with a `split` column."""
    counts = split_counts(df)
    by_name = counts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("split") == s, F.col("rows"))), F.lit(0)).alias(s)
            for s in ("train", "validation", "total")
        ]
    )

    def texts(values: list[str] | tuple[str, ...]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return by_name.select(
        F.lit(name).alias("dataset_name"),
        F.lit(description).alias("description"),
        F.lit(language).alias("language"),
        F.lit("named-entity-recognition").alias("task"),
        F.lit("see source datasets").alias("license"),
        texts(CATEGORIES).alias("categories"),
        texts(sources).alias("source_datasets"),
        F.struct("train", "validation", "total").alias("num_rows"),
        F.struct(
            F.lit("messages").alias("column"),
            texts(("system", "user", "assistant")).alias("roles"),
            F.lit("see the default prompt of the chat template").alias("system_prompt"),
        ).alias("format"),
    )


def save_card(card: DataFrame, path: str) -> None:
    card.coalesce(1).write.mode("overwrite").json(path)


def split_preview(spark, card_path: str) -> DataFrame:
    """Row counts of a saved card; writes nothing."""
    return spark.read.json(card_path).select("dataset_name", "num_rows.*")


def _replace_parts(df: DataFrame, path: str, keys: list[str], format: str) -> None:
    """Overwrite the partitions that `df` has rows for, and no others."""
    empty = df.filter(F.greatest(*[F.coalesce(F.col(k).cast("string") == "", F.lit(False)) for k in keys], F.lit(False))).limit(1)
    if not empty.isEmpty():
        raise ValueError(f"{keys} must not be empty texts: a folder name can't tell them from null")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if format == "parquet":
        writer = writer.option("compression", "zstd")
    writer.partitionBy(*keys).format(format).save(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """Write `(run_id, step, metric, value)` rows into a table of all runs.

    What the table holds of the same run and step is replaced, so a repeated evaluation leaves one
    copy, and all else stays. A null step is a part of its own.
    """
    keyed = metrics.select(F.col("run_id").cast("string"), F.col("step").cast("bigint"), "metric", F.col("value").cast("double"))
    _replace_parts(keyed, path, ["run_id", "step"], "parquet")


def save_sketches(sketches: DataFrame, path: str) -> None:
    """Write `run_id, n, sketch` rows into a table of all runs, in place of what it holds of these runs.

    The table has a fixed number of folders, into which runs are dealt by a hash of their id, so a million runs
    make no million files. Folders that hold any of these runs are written anew, with their other runs.
    """
    spark = sketches.sparkSession
    bucket = F.pmod(F.xxhash64("run_id"), F.lit(SKETCH_FOLDERS)).cast("int")
    new = materialize(sketches.select(F.col("run_id").cast("string"), "n", "sketch").withColumn("bucket", bucket))
    rows = new
    if path_exists(spark, path):
        held = spark.read.schema(f"{S.SKETCHES}, bucket INT").parquet(path)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most SKETCH_FOLDERS
        others = join_null_safe(held.filter(F.col("bucket").isin(touched)), new.select("run_id"), ["run_id"], "left_anti")
        rows = new.unionByName(others)
    writer = rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)
    discard(new)


def save_comparison(compared: DataFrame, path: str, name: str, format: str = "parquet") -> None:
    """Write the rows of the comparison `name` into a table of all comparisons, in place of older ones of that name.

    A comparison without rows leaves what is there.
    """
    rows = compared.select("prompt", "base", "finetune", F.lit(name).alias("comparison"))
    _replace_parts(rows, path, ["comparison"], format)
