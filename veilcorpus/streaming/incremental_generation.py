"""Resumable generation: task files in, finished rows appended to a log, each task once.

A stream writes the rows of its batch number b to `<log>/run-<id>/batch-<b>`, where the id belongs to the
stream's checkpoint. A batch that is run again, after a failure at any moment, replaces its own folder; nothing
else ever writes there. Task ids that the stream has seen are keyed state (in RocksDB, on the executors), so a
batch costs what its tasks cost, however long the log is. Only the first batch of a stream reads the log: it
leaves out what other streams finished. A task that was rejected or failed is tried again by the next stream,
as it is not in the log.

Where the tasks are Parquet files that can be read again, only ids and the rows' places (file and row number)
are shuffled by the state. The new rows of a batch travel as one bit each, and its tasks are then read where they
lie, so neighbours with the same texts stay neighbours in all that is written later.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from veilcorpus import schema as S
from veilcorpus.functions.frames import free_name
from veilcorpus.functions.hashing import bit_of
from veilcorpus.operators.complete import CallPolicy, CompleterFactory, echo_completer, generate_and_validate
from veilcorpus.operators.tasks import pending_tasks
from veilcorpus.operators.validate import log_rows
from veilcorpus.session import discard, materialize
from veilcorpus.sources.readers import path_exists, read_generation_log
from veilcorpus.sources.writers import append_generation_log, replace_log_part

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def log_or_empty(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """The log, or no rows where none was written yet; `without` names a folder whose rows don't count."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], S.GENERATION_LOG)
    log = read_generation_log(spark, path)
    return log.filter(~F.col("_metadata.file_path").contains(f"/{without}/")) if without else log


def generate_pending(
    tasks: DataFrame,
    log_path: str,
    factory: CompleterFactory = echo_completer,
    policy: CallPolicy = CallPolicy(),
    max_attempts: int = 2,
) -> DataFrame:
    """One run: skip finished and repeated task ids, generate the rest, append what was accepted."""
    log = log_or_empty(tasks.sparkSession, log_path)
    judged = generate_and_validate(pending_tasks(tasks.dropDuplicates(["task_id"]), log), factory, policy, max_attempts)
    append_generation_log(log_rows(judged), log_path)
    return judged


def place_bits(places: DataFrame) -> DataFrame:
    """Places (`file, row`) as bits, a row for every 32,768 rows of a file; written, so that the optimizer knows its size."""
    number = F.col("row") + 1  # numbers count from 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    return materialize(places.groupBy("file", F.bitmap_bucket_number(number).alias("stretch")).agg(bits))


def rows_at(tasks: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows of Parquet files at the places of `bits`, in the order of the files, of which no others are read.

    The optimizer broadcasts the bits after its size check; only beyond that are rows shuffled, by stretches of a file.
    """
    files = [r["file"] for r in bits.select("file").distinct().collect()]  # names of the files that hold such rows
    file, row, stretch, held = (free_name(name, tasks) for name in ("_file", "_row", "_stretch", "_bits"))
    at = {file: F.col("_metadata.file_path"), row: F.col("_metadata.row_index") + 1}
    placed = tasks.filter(F.col("_metadata.file_path").isin(files)).withColumns(at).withColumn(stretch, F.bitmap_bucket_number(row))
    wanted = bits.select(F.col("file").alias(file), F.col("stretch").alias(stretch), F.col("bits").alias(held))
    bit = F.bitmap_bit_position(row).cast("int")
    return placed.join(wanted, [file, stretch]).filter(bit_of(F.col(held), bit)).select(*tasks.columns)


def run_folder(checkpoint: str) -> str:
    """The part of the log that belongs to a stream: the same after every restart from its checkpoint."""
    return f"run-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"


def start_generation(
    task_stream: DataFrame,
    log_path: str,
    checkpoint: str,
    factory: CompleterFactory = echo_completer,
    policy: CallPolicy = CallPolicy(),
    max_attempts: int = 2,
    read_tasks: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """The same for a stream of task rows, each task id once for all restarts; a null id is no task.

    `read_tasks`, for a plain stream of Parquet files, gives the same files as a table; a batch then shuffles no texts.
    """
    spark = task_stream.sparkSession
    own = run_folder(checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 and path_exists(spark, log_path):
            # Its own folder may hold rows of a first try, which are replaced.
            batch = pending_tasks(batch, log_or_empty(spark, log_path, without=own))
        bits = place_bits(batch) if read_tasks else None
        todo = rows_at(read_tasks(), bits) if read_tasks else batch
        judged = generate_and_validate(todo, factory, policy, max_attempts)
        replace_log_part(log_rows(judged), f"{log_path}/{own}/batch-{batch_id:09d}")
        if bits is not None:
            discard(bits)

    named = task_stream.filter("task_id IS NOT NULL")
    if read_tasks:
        named = named.select("task_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    fresh = named.dropDuplicates(["task_id"])
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = fresh.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)
