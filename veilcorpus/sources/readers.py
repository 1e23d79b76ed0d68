"""Readers. Schemas are explicit, so nothing is inferred by reading data twice."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from veilcorpus import schema as S
from veilcorpus.functions.audio import LENGTH, header_length
from veilcorpus.functions.frames import small_table
from veilcorpus.functions.text import strip
from veilcorpus.operators.rank import first_in_shuffle
from veilcorpus.sources import arrow_corpus
from veilcorpus.sources.files import store_of


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path (or glob) matches something, on any file system Spark can read."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in (exc.getCondition() or str(exc)):
            return False
        raise
    return True


def read_table(spark: SparkSession, path: str, ddl: str | None = None, format: str = "parquet") -> DataFrame:
    """A Parquet or JSON-lines table; a missing path is an error."""
    reader = spark.read.schema(ddl) if ddl else spark.read
    return reader.format(format).load(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """A required corpus of `input_text, annotation_json`, saved as Parquet or as Arrow files.

    A folder that holds neither is an error, like a missing one.
    """
    if path_exists(spark, f"{path}/{arrow_corpus.STATE}") or path_exists(spark, f"{path}/*.arrow"):
        return arrow_corpus.read_arrow_corpus(spark, path, S.CORPUS_COLUMNS)
    if not path_exists(spark, f"{path}/*.parquet"):
        raise FileNotFoundError(f"corpus not found: {path}")
    return read_table(spark, path, S.CORPUS)


def read_corpora(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """All corpora that exist, with their name in `source`. It is an error if none does."""
    parts = []
    for name, path in paths.items():
        try:
            parts.append(read_corpus(spark, path).withColumn("source", F.lit(name)))
        except FileNotFoundError:
            continue
    if not parts:
        raise FileNotFoundError(f"none of the corpora exist: {sorted(paths.values())}")
    return reduce(DataFrame.unionByName, parts)


def first_rows(df: DataFrame, n: int, order_by: str | None = None) -> DataFrame:
    """The first `n` rows, all if `n` is 0; with `order_by` the answer is stable."""
    if n <= 0:
        return df
    return (df.orderBy(order_by) if order_by else df).limit(n)


def evaluation_subset(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """`n` rows of a seeded shuffle, all if `n` is 0."""
    return first_in_shuffle(df, row_id, n, seed, "evaluation")


def read_generation_log(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """JSON lines of generated rows. Blank lines are skipped in both modes.

    Lenient drops malformed lines; strict raises on the first one.
    """
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    reader = spark.read.schema(S.GENERATION_LOG).option("mode", mode)
    return reader.option("recursiveFileLookup", "true").json(path)  # streams log in folders of their own


def _log_lines(spark: SparkSession, path: str) -> DataFrame:
    """`value, blank, row, corrupt` of every line: its parse, and whether that failed."""
    # Spark refuses a query of a file's corrupt-record column alone, so the lines are parsed here.
    held = F.from_json("value", S.GENERATION_LOG + ", _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    lines = spark.read.option("recursiveFileLookup", "true").text(path).withColumn("row", held)
    blank = F.trim("value") == ""
    corrupt = F.coalesce(F.col("row._corrupt").isNotNull() | F.col("row").isNull(), F.lit(False))
    return lines.withColumn("blank", blank).withColumn("corrupt", ~blank & corrupt)


def rejected_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """The malformed lines that the lenient reader drops."""
    return _log_lines(spark, path).filter("corrupt").select(F.col("value").alias("_corrupt"))


LOG_COUNTERS = ("lines", "blank", "malformed", "without_task_id", "positive", "negative")


def read_counted_log(spark: SparkSession, path: str) -> tuple[DataFrame, Observation]:
    """The rows of the lenient reader, and counters of all lines that the same scan fills.

    The counters (see LOG_COUNTERS) are there after the first action over the rows; polarities
    count the rows that have a task id. An action that stops early, such as a limit, counts only
    what it read.
    """
    counted = Observation(f"log-{uuid.uuid4().hex}")
    lines = _log_lines(spark, path)
    good = ~F.col("blank") & ~F.col("corrupt")
    task = F.coalesce(F.length("row._meta.task_id") > 0, F.lit(False))

    def times(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0).cast("bigint")), F.lit(0)).alias(name)

    polarity = F.col("row._meta.polarity")
    seen = lines.observe(
        counted, F.count(F.lit(1)).alias("lines"), times(F.col("blank"), "blank"), times(F.col("corrupt"), "malformed"),
        times(good & ~task, "without_task_id"), times(good & task & (polarity == "pos"), "positive"), times(good & task & (polarity == "neg"), "negative"),
    )
    return seen.filter(good).select("row.input_text", "row.annotation_json", "row._meta"), counted


def spec_tables(spark: SparkSession, spec: Mapping[str, Any]) -> tuple[DataFrame, DataFrame]:
    """`(subtypes, situations)` of a synthesis spec.

    The spec is what a YAML or JSON file holds: category -> `description`, `subtypes`
    (`name`, `description`, `examples`) and `situations`.
    """
    subtypes, situations = [], []
    for category, body in spec.items():
        description = body.get("description", "")
        for sub in body["subtypes"]:
            subtypes.append(
                (category, description, sub["name"], sub.get("description", ""), list(sub.get("examples", [])))
            )
        situations += [(category, i, text) for i, text in enumerate(body.get("situations", []))]
    return (
        small_table(
            spark,
            subtypes,
            "category STRING, category_desc STRING, name STRING, description STRING, examples ARRAY<STRING>",
        ),
        spark.createDataFrame(situations, "category STRING, idx INT, situation STRING"),
    )


def load_spec(spark: SparkSession, path: str) -> dict:
    """A spec file; JSON always works, YAML where a YAML parser is installed."""
    import json

    (row,) = spark.read.text(path, wholetext=True).collect()  # one small file
    if path.endswith(".json"):
        return json.loads(row["value"])
    try:
        import yaml
    except ImportError as exc:
        raise ImportError("reading a YAML spec needs PyYAML; use a JSON spec instead") from exc
    return yaml.safe_load(row["value"])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """`run_id, step, metric, value` of all runs; run ids stay text, also where they look like numbers."""
    return spark.read.schema(S.METRICS).parquet(path).select("run_id", "step", "metric", "value")


def read_comparison(spark: SparkSession, path: str, name: str | None = None, format: str = "parquet") -> DataFrame:
    """`comparison, prompt, base, finetune` of all comparisons, or of one: only its folder is read."""
    rows = spark.read.schema(S.COMPARISON).format(format).load(path).select("comparison", "prompt", "base", "finetune")
    return rows if name is None else rows.filter(F.col("comparison") == name)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """`run_id, n, sketch` of all runs."""
    return spark.read.schema(S.SKETCHES).parquet(path).select("run_id", "n", "sketch")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """`prompt_id, prompt`: one prompt per line, trimmed, blank lines dropped.

    Repeated lines all stay. The id is a 128-bit hash of the text and the number of its copy,
    so it is the same in every run and distinct for every row.
    """
    prompts = spark.read.text(path).select(strip(F.col("value")).alias("prompt"))
    counted = prompts.filter(F.col("prompt") != "").groupBy("prompt").agg(F.count(F.lit(1)).alias("n"))
    each = counted.select("prompt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy"))
    return each.select(F.md5(F.concat_ws(":", F.col("copy").cast("string"), "prompt")).alias("prompt_id"), "prompt")


def read_audio_rows(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts with undecoded audio bytes."""
    return read_table(spark, path, S.AUDIO_ROWS)


def list_audio(spark: SparkSession, folder: str) -> DataFrame:
    """`name, path, n_bytes` of every file below a folder; no file is opened. Spark lists no empty files."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    below = F.expr(f"substring(path, locate({_quoted(root)}, path) + {len(root)})")
    return files.select(below.alias("name"), "path", F.col("length").alias("n_bytes"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def audio_lengths(files: DataFrame) -> DataFrame:
    """Add `seconds` and `status` to rows with a `path`, from the head of each file; a null path is `missing`."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_head_of(path) for path in batch.column("path").to_pylist()]
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "seconds", "status"])

    return files.mapInArrow(read, T.StructType(files.schema.fields + T.StructType.fromDDL(LENGTH).fields))


def _head_of(path: str | None) -> tuple[float | None, str]:
    if path is None:
        return None, "missing"
    store, at = store_of(path)
    try:
        with store.open_input_file(at) as f:
            return header_length(f)
    except FileNotFoundError:
        return None, "missing"


def read_audio_folder(spark: SparkSession, folder: str, transcripts: DataFrame, max_seconds: float | None = None) -> DataFrame:
    """Rows `(path, transcription)` with the file that each path names below `folder`.

    `status` is `ok`, `missing` for a transcript whose file is not there or empty, or `too long` beyond `max_seconds`;
    `seconds` comes from the file's head, and `head` tells whether that could be read (see `functions.audio`).
    Files are listed and met by name first; bytes are read only of those whose status is `ok`.
    """
    named = transcripts.select(F.regexp_replace("path", "^(\\./)+", "").alias("name"), "transcription")
    rows = audio_lengths(named.join(list_audio(spark, folder), "name", "left").select("transcription", "path"))
    long = F.coalesce(F.col("seconds") > max_seconds, F.lit(False)) if max_seconds is not None else F.lit(False)
    status = F.when(F.col("head") == "missing", F.lit("missing")).when(long, F.lit("too long")).otherwise(F.lit("ok"))
    rows = rows.withColumnRenamed("status", "head").withColumn("status", status)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():  # one file a batch, so no more than one is held
                path = row.pop("path")
                row["audio"] = None
                if row["status"] == "ok":
                    store, at = store_of(path)
                    with store.open_input_stream(at) as f:
                        row["audio"] = {"bytes": f.read(), "path": path}
                yield pa.RecordBatch.from_pylist([row], schema=kind)

    kind = pa.schema([
        ("transcription", pa.string()), ("audio", pa.struct([("bytes", pa.binary()), ("path", pa.string())])),
        ("status", pa.string()), ("seconds", pa.float64()), ("head", pa.string()),
    ])
    return rows.mapInArrow(read, "transcription string, audio struct<bytes:binary,path:string>, status string, seconds double, head string")


def audio_seconds(audio: Column) -> Column:
    """`seconds, status` of a column of audio bytes, from their heads; null bytes are `missing`."""

    @F.arrow_udf(T.StructType.fromDDL(LENGTH))
    def read(column: pa.Array) -> pa.Array:
        found = [(None, "missing") if x is None else header_length(io.BytesIO(x)) for x in column.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.string())], ["seconds", "status"])

    return read(audio)


def read_splits(spark: SparkSession, root: str, names: Iterable[str] = ("train", "validation", "test")) -> dict[str, DataFrame]:
    """The splits that exist below `root`: Parquet folders `root/split=<name>`, or a saved folder of Arrow corpora."""
    if path_exists(spark, f"{root}/{arrow_corpus.SPLITS}"):
        present = arrow_corpus.arrow_splits(root)
        return {n: arrow_corpus.read_arrow_corpus(spark, f"{root}/{n}") for n in names if n in present}
    found = {n: f"{root}/split={n}" for n in names if path_exists(spark, f"{root}/split={n}")}
    return {n: spark.read.parquet(p) for n, p in found.items()}
