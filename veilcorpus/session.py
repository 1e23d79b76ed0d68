"""Session settings and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", app: str = "veilcorpus", **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only where that is unset (tests, local runs) a folder of our own is made and
    recorded in the session, so later calls share it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="veilcorpus-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back; `compression` names a Parquet codec other than the session's.

    Used where a costly result is read several times, or where it must not be
    computed again (model calls). A Parquet table survives lost executors and,
    unlike a checkpoint, still lets later readers prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def path_of(df: DataFrame) -> Iterator[str]:
    """The path of `df`, written in zstd for as long as the block lasts."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    try:
        yield path
    finally:
        _delete(df.sparkSession, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block, what an action shuffled is deleted when the action ends, not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def bucketed(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """`df` written once as a table dealt into buckets by `key`: joins on the key move none of its rows again.

    The table is dropped at the end of the block, by when all that reads it must have run.
    """
    spark = df.sparkSession
    made = uuid.uuid4().hex
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd")
    dealt.saveAsTable(f"bucketed_{made}", path=f"{shared_dir(spark)}/table-{made}")
    table = spark.table(f"bucketed_{made}")
    try:
        yield table
    finally:
        discard(table)
        spark.sql(f"DROP TABLE bucketed_{made}")


def discard(table: DataFrame) -> None:
    """Delete the folder of a table that `materialize` wrote, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        _delete(table.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not re.fullmatch(r"table-[0-9a-f]{32}", path.getName()):
        raise ValueError(f"{folder} was not written by materialize")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
