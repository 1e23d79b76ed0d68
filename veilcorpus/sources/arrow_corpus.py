"""Corpora saved as a folder of Arrow IPC files, as a Spark data source.

A corpus is a folder with `state.json`, which names its data files in order, and the files, each an Arrow
stream (or an Arrow file, with a footer). Reading takes one partition for each run of record batches and hands
whole batches to Spark; only the columns of the requested schema leave the file. Writing makes one file a task
under a name of its own; the commit then puts a new `state.json` in place, so a reader sees the old corpus or
the new one, and files of failed or repeated tasks are never named.

A folder without `state.json` is read as all its `*.arrow` files by name. A folder with neither is no corpus, and
reading it is an error. A stream must end with its end mark: a torn file raises, however neatly it was cut. The
folder must be one that every host reaches by the same path or URI (a mounted path, or a store that Arrow knows).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from veilcorpus.sources.files import put_text, read_text, store_of

STATE, INFO, SPLITS = "state.json", "dataset_info.json", "dataset_dict.json"
STREAM_END = b"\xff\xff\xff\xff\0\0\0\0"
FILE_MAGIC = b"ARROW1"
RANGE_BYTES = 64 << 20
LEVELS = {"zstd": 6}
FORMAT = "arrow_corpus"


def data_files(path: str) -> list[str]:
    """Names of a corpus' data files, in order."""
    store, root = store_of(path)
    state = read_text(f"{path}/{STATE}")
    if state is not None:
        return [f["filename"] for f in json.loads(state)["_data_files"]]
    found = store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    names = sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(".arrow"))
    if not names:
        raise FileNotFoundError(f"no Arrow corpus in {path}")
    return names


class _IpcFile:
    """One data file in either form; iterating gives its batches, of the wanted fields only."""

    def __init__(self, path: str, name: str, fields: Sequence[str] | None = None):
        store, root = store_of(path)
        local = isinstance(store, pafs.LocalFileSystem)
        # Mapped, so that batches before the wanted ones cost no reading.
        self.file = pa.memory_map(f"{root}/{name}") if local else store.open_input_file(f"{root}/{name}")
        self.size = self.file.size()
        self.random = self.file.read(6) == FILE_MAGIC
        if not self.random:
            self.file.seek(max(0, self.size - len(STREAM_END)))
            if self.file.read() != STREAM_END:
                raise OSError(f"{path}/{name} is torn: it has no end mark")
        self.file.seek(0)
        opened = pa.ipc.open_file if self.random else pa.ipc.open_stream
        reader = opened(self.file)
        self.schema = reader.schema
        if fields is not None:
            missing = [f for f in fields if self.schema.get_field_index(f) < 0]
            if missing:
                raise ValueError(f"{path}/{name} has no column {', '.join(missing)}; it has {', '.join(self.schema.names)}")
            self.file.seek(0)
            reader = opened(self.file, options=pa.ipc.IpcReadOptions(included_fields=sorted(self.schema.get_field_index(f) for f in fields)))
        self.reader = reader

    def count(self) -> int:
        if self.random:
            return self.reader.num_record_batches
        self.file.seek(0)  # messages are told apart by their heads; their buffers are not unpacked
        return sum(m.type == "record batch" for m in pa.ipc.MessageReader.open_stream(self.file))

    def batches(self, start: int, stop: int) -> Iterator[pa.RecordBatch]:
        if self.random:
            for i in range(start, min(stop, self.reader.num_record_batches)):
                yield self.reader.get_batch(i)
        else:
            for i, batch in enumerate(self.reader):
                if i >= stop:
                    return
                if i >= start:
                    yield batch


@dataclass
class _Range(InputPartition):
    name: str
    start: int
    stop: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.fields = path, schema.names

    def partitions(self) -> list[_Range]:
        out = []
        for name in data_files(self.path):
            file = _IpcFile(self.path, name)
            n = file.count()
            step = max(1, n * RANGE_BYTES // max(1, file.size))
            out += [_Range(name, i, min(n, i + step)) for i in range(0, n, step)]
        return out or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        file = _IpcFile(self.path, partition.name, self.fields)
        for batch in file.batches(partition.start, partition.stop):
            yield batch.select(self.fields)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    rows: int


def _feature(kind: pa.DataType) -> dict:
    """A column's type as the corpus' description names it."""
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return {"feature": _feature(kind.value_type), "_type": "List"}
    if pa.types.is_struct(kind):
        return {f.name: _feature(f.type) for f in kind}
    names = {"double": "float64", "float": "float32"}
    return {"dtype": names.get(str(kind), str(kind)), "_type": "Value"}


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool, compression: str | None):
        self.path, self.schema, self.overwrite, self.compression = path, schema, overwrite, compression

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, root = store_of(self.path)
        store.create_dir(root, recursive=True)
        name, rows, writer = f"data-{uuid.uuid4().hex}.arrow", 0, None
        for batch in iterator:
            if writer is None:
                sink = store.open_output_stream(f"{root}/{name}")
                codec = pa.Codec(self.compression, LEVELS.get(self.compression)) if self.compression else None
                writer = pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=codec))
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return _Written(None, 0)
        writer.close()
        sink.close()
        return _Written(name, rows)

    def commit(self, messages: list[_Written | None]) -> None:
        store, root = store_of(self.path)
        store.create_dir(root, recursive=True)
        old = [] if self.overwrite else self._present()
        new = [m.name for m in messages if m is not None and m.name]
        if not old and not new:
            new = [f"data-{uuid.uuid4().hex}.arrow"]
            empty = pa.schema([pa.field(f.name, _arrow_type(f.dataType)) for f in self.schema])
            with store.open_output_stream(f"{root}/{new[0]}") as sink, pa.ipc.new_stream(sink, empty):
                pass
        features = {f.name: _feature(f.type) for f in _IpcFile(self.path, (old + new)[0]).schema}
        info = {"citation": "", "description": "", "features": features, "homepage": "", "license": ""}
        state = {
            "_data_files": [{"filename": n} for n in old + new], "_fingerprint": uuid.uuid4().hex[:16], "_format_columns": None,
            "_format_kwargs": {}, "_format_type": None, "_output_all_columns": False, "_split": None,
        }
        put_text(f"{self.path}/{INFO}", json.dumps(info, indent=2))
        put_text(f"{self.path}/{STATE}", json.dumps(state, indent=2))  # from here on the new corpus is the corpus
        if self.overwrite:
            for f in store.get_file_info(pafs.FileSelector(root)):
                if f.base_name.endswith(".arrow") and f.base_name not in new:
                    store.delete_file(f.path)

    def _present(self) -> list[str]:
        try:
            return data_files(self.path)
        except FileNotFoundError:
            return []

    def abort(self, messages: list[_Written | None]) -> None:
        store, root = store_of(self.path)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{root}/{m.name}")


def _arrow_type(kind) -> pa.DataType:
    """For the one file of an empty corpus: plain types, lists and structs."""
    plain = {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "boolean": pa.bool_(), "binary": pa.binary(),
    }
    if kind.typeName() == "array":
        return pa.list_(_arrow_type(kind.elementType))
    if kind.typeName() == "struct":
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind])
    return plain[kind.simpleString()]


class ArrowCorpus(DataSource):
    """`spark.read.format("arrow_corpus").schema(...).load(path)` and `df.write.format("arrow_corpus").save(path)`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], schema, overwrite, self.options.get("compression"))


def arrow_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of a saved corpus, from the head of its first file."""
    return spark.createDataFrame(_IpcFile(path, data_files(path)[0]).schema.empty_table()).schema


def read_arrow_corpus(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns of a corpus, or some: others never leave the files."""
    spark.dataSource.register(ArrowCorpus)
    schema = arrow_schema(spark, path)
    if columns is not None:
        missing = [c for c in columns if c not in schema.names]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(schema.names)}")
        schema = StructType([schema[c] for c in columns])
    return spark.read.format(FORMAT).schema(schema).load(path)


def save_arrow_corpus(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write a corpus; `overwrite` replaces it in one step, `append` adds files to it.

    `compression`, `zstd` or `lz4` frames, packs the buffers of the batches, which all readers of Arrow files unpack by themselves.
    """
    df.sparkSession.dataSource.register(ArrowCorpus)
    writer = df.write.format(FORMAT).mode(mode)
    (writer.option("compression", compression) if compression else writer).save(path)


def save_arrow_splits(df: DataFrame, path: str, names: Sequence[str] = ("train", "validation"), split: str = "split") -> None:
    """One corpus a split below `path`, named by a file that is written last."""
    for name in names:
        save_arrow_corpus(df.filter(df[split] == name).drop(split), f"{path}/{name}")
    put_text(f"{path}/{SPLITS}", json.dumps({"splits": list(names)}))


def arrow_splits(path: str) -> list[str]:
    """Names of the splits of a folder of corpora; none if it is no such folder."""
    text = read_text(f"{path}/{SPLITS}")
    return [] if text is None else json.loads(text)["splits"]
