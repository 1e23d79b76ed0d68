"""Sizes of the batches in which whole texts go to Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 1000
BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Send at most ROWS rows or about BYTES bytes to Python at once; settings that are lower stay.

    Spark's own 10,000 rows would be some 100 MB of texts and results in each Python worker.
    """
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    held = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")
    if not held.lstrip("-").isdigit() or not 0 < int(held) <= BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))
