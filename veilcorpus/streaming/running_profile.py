"""Category profile of a log that grows, as a Structured Streaming job.

Every trigger writes the whole profile (11 rows) to a folder of its own, `version-<batch>`, and then puts the
name of that folder into the file `current` in one step. A reader follows the name once, so it sees one version
whole, whatever a writer does meanwhile. Old versions stay until KEEP newer ones exist. A trigger that runs again
writes the same version again; the name is put in place only after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veilcorpus import schema as S
from veilcorpus.functions.jsonx import decode_annotation
from veilcorpus.operators.profile import category_profile
from veilcorpus.sources.files import drop_folder, folders_in, put_text, read_text

CURRENT = "current"
KEEP = 3


def stream_log(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Generation log as a stream, malformed lines dropped, with the annotation parsed."""
    reader = spark.readStream.schema(S.GENERATION_LOG).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true")
    lines = reader.option("maxFilesPerTrigger", files_per_trigger).json(path)
    return lines.withColumn("annotation", decode_annotation(lines["annotation_json"]))


def publish(profile: DataFrame, table_path: str, batch_id: int) -> None:
    """Make `profile` the current version of a table."""
    name = f"version-{batch_id:09d}"
    if read_text(f"{table_path}/{CURRENT}") == name:
        return  # a trigger that is run again after its version was published
    profile.write.mode("overwrite").parquet(f"{table_path}/{name}")
    put_text(f"{table_path}/{CURRENT}", name)
    versions = [v for v in folders_in(table_path) if v.startswith("version-") and v <= name]
    for old in versions[:-KEEP]:
        drop_folder(f"{table_path}/{old}")


def read_profile(spark: SparkSession, table_path: str) -> DataFrame:
    """The current version; an error before the first one."""
    name = read_text(f"{table_path}/{CURRENT}")
    if name is None:
        raise FileNotFoundError(f"no profile in {table_path}")
    return spark.read.parquet(f"{table_path}/{name}")


def start_running_profile(
    annotated: DataFrame, table_path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Keep the table at `table_path` equal to the profile of all rows seen so far; `read_profile` reads it.

    State is one row of 23 counters.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        publish(batch, table_path, batch_id)

    profile = category_profile(annotated)
    writer = profile.writeStream.outputMode("complete").foreachBatch(replace)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
