import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilcorpus.sources import arrow_corpus as ac, readers

SCHEMA = pa.schema([("input_text", pa.string()), ("n", pa.int64()), ("annotation_json", pa.string()), ("tags", pa.list_(pa.string()))])


def batch(start, n):
    at = range(start, start + n)
    return pa.record_batch([[f"text {i} 日" if i % 7 else None for i in at], list(at), [f'{{"i": {i}}}' for i in at], [["a", str(i)] for i in at]], schema=SCHEMA)


def save(folder, name, batches, form=pa.ipc.new_stream, state=None):
    os.makedirs(folder, exist_ok=True)
    with pa.OSFile(f"{folder}/{name}", "wb") as sink, form(sink, SCHEMA) as writer:
        for b in batches:
            writer.write_batch(b)
    if state is not None:
        (open(f"{folder}/state.json", "w")).write(json.dumps({"_data_files": [{"filename": n} for n in state]}))


@pytest.mark.parametrize("form", [pa.ipc.new_stream, pa.ipc.new_file])
def test_corpus_written_by_arrow_is_read(spark, tmp_path, monkeypatch, form):
    folder = f"{tmp_path}/c"
    save(folder, "data-00000-of-00002.arrow", [batch(0, 40), batch(40, 1), batch(41, 59)], form)
    save(folder, "data-00001-of-00002.arrow", [batch(100, 20)], form, state=["data-00000-of-00002.arrow", "data-00001-of-00002.arrow"])
    save(folder, "data-left-over.arrow", [batch(900, 20)], form)
    df = ac.read_arrow_corpus(spark, folder)
    assert df.columns == SCHEMA.names and df.schema["tags"].dataType.simpleString() == "array<string>"
    rows = sorted(tuple(r) for r in df.select("n", "input_text", "tags").collect())
    assert rows == [(i, f"text {i} 日" if i % 7 else None, ["a", str(i)]) for i in range(120)]
    corpus = readers.read_corpus(spark, f"file://{folder}")
    assert corpus.columns == ["input_text", "annotation_json"] and corpus.count() == 120


def test_partitions_are_runs_of_batches_and_columns_are_pruned(tmp_path, monkeypatch):
    from pyspark.sql.types import StructType

    folder = f"{tmp_path}/c"
    save(folder, "data-0.arrow", [batch(i * 10, 10) for i in range(9)])
    monkeypatch.setattr(ac, "RANGE_BYTES", os.path.getsize(f"{folder}/data-0.arrow") // 3)
    reader = ac.ArrowCorpus({"path": folder}).reader(StructType.fromDDL("tags array<string>, n bigint"))
    parts = reader.partitions()
    assert len(parts) > 2 and [(p.start, p.stop) for p in parts][0] == (0, parts[1].start)
    seen = [b for p in parts for b in reader.read(p)]
    assert {tuple(b.schema.names) for b in seen} == {("tags", "n")}
    assert [i for b in seen for i in b.column("n").to_pylist()] == list(range(90))
    held = ac._IpcFile(folder, "data-0.arrow", ["n"])
    assert next(held.batches(0, 1)).schema.names == ["n"]


def test_round_trip_append_and_overwrite(spark, tmp_path):
    path = f"{tmp_path}/saved"
    df = spark.range(0, 1000, 1, 5).select("id", F.concat(F.lit("t"), "id").alias("t"), F.array("id").alias("ids"), F.struct("id").alias("s"))
    ac.save_arrow_corpus(df, path)
    assert sorted(map(tuple, ac.read_arrow_corpus(spark, path).collect())) == sorted(map(tuple, df.collect()))
    ac.save_arrow_corpus(df.filter("id < 10"), path, "append")
    assert ac.read_arrow_corpus(spark, path, ["id"]).count() == 1010
    # What was written is a corpus to plain Arrow too.
    names = [f["filename"] for f in json.load(open(f"{path}/state.json"))["_data_files"]]
    assert sum(pa.ipc.open_stream(pa.memory_map(f"{path}/{n}")).read_all().num_rows for n in names) == 1010
    features = json.load(open(f"{path}/dataset_info.json"))["features"]
    assert features["id"] == {"dtype": "int64", "_type": "Value"} and features["ids"]["_type"] == "List" and set(features["s"]) == {"id"}
    ac.save_arrow_corpus(df.filter("id < 3"), path)
    assert ac.read_arrow_corpus(spark, path).count() == 3
    assert len([n for n in os.listdir(path) if n.endswith(".arrow")]) == len(ac.data_files(path))


def test_failed_write_leaves_the_corpus_as_it_was(spark, tmp_path):
    path = f"{tmp_path}/saved"
    ac.save_arrow_corpus(spark.range(10), path)
    files = set(os.listdir(path))
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 90, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        ac.save_arrow_corpus(broken, path)
    assert ac.read_arrow_corpus(spark, path).count() == 10 and ac.data_files(path) == [n for n in ac.data_files(path) if n in files]


def test_torn_missing_and_empty(spark, tmp_path):
    folder = f"{tmp_path}/torn"
    save(folder, "data-0.arrow", [batch(0, 40), batch(40, 40)])
    data = open(f"{folder}/data-0.arrow", "rb").read()
    # Cut in the middle, cut before the end mark only, and cut inside it.
    for n in (len(data) // 2, len(data) - 8, len(data) - 3):
        open(f"{folder}/data-0.arrow", "wb").write(data[:n])
        with pytest.raises(Exception, match="torn"):
            ac.read_arrow_corpus(spark, folder).count()
    open(f"{folder}/data-0.arrow", "wb").write(data)
    assert ac.read_arrow_corpus(spark, folder).count() == 80
    open(f"{folder}/state.json", "w").write(json.dumps({"_data_files": [{"filename": "data-0.arrow"}, {"filename": "gone.arrow"}]}))
    with pytest.raises(Exception, match="gone.arrow"):
        ac.read_arrow_corpus(spark, folder).count()
    os.makedirs(f"{tmp_path}/empty")
    for path in (f"{tmp_path}/empty", f"{tmp_path}/not there"):
        with pytest.raises(FileNotFoundError):
            ac.read_arrow_corpus(spark, path)
        with pytest.raises(FileNotFoundError):
            readers.read_corpus(spark, path)
    with pytest.raises(ValueError, match="no column"):
        ac.read_arrow_corpus(spark, f"{tmp_path}/torn", ["nope"])
    none = spark.createDataFrame([], "a string, b array<struct<x:int,y:double>>")
    ac.save_arrow_corpus(none, f"{tmp_path}/none")
    back = ac.read_arrow_corpus(spark, f"{tmp_path}/none")
    assert back.count() == 0 and back.columns == ["a", "b"]


def test_splits_and_optional_corpora(spark, tmp_path):
    df = spark.range(20).select("id", F.when(F.col("id") < 15, "train").otherwise("validation").alias("split"))
    ac.save_arrow_splits(df, f"{tmp_path}/d")
    found = readers.read_splits(spark, f"{tmp_path}/d")
    assert {n: s.count() for n, s in found.items()} == {"train": 15, "validation": 5}
    save(f"{tmp_path}/a", "data-0.arrow", [batch(0, 5)])
    spark.createDataFrame([("t", "{}")], "input_text string, annotation_json string").write.parquet(f"{tmp_path}/p")
    both = readers.read_corpora(spark, {"a": f"{tmp_path}/a", "p": f"{tmp_path}/p", "gone": f"{tmp_path}/gone"})
    assert {r["source"]: r["count"] for r in both.groupBy("source").count().collect()} == {"a": 5, "p": 1}


def test_packed_batches_are_read_and_counted(spark, tmp_path):
    df = spark.range(3000).selectExpr("id", "repeat(cast(id as string), 50) AS text").repartition(2)
    for name, codec in (("plain", None), ("packed", "zstd")):
        ac.save_arrow_corpus(df, f"{tmp_path}/{name}", compression=codec)
        assert sorted(map(tuple, ac.read_arrow_corpus(spark, f"{tmp_path}/{name}").collect())) == sorted(map(tuple, df.collect()))
    size = {n: sum(os.path.getsize(f"{tmp_path}/{n}/{f}") for f in ac.data_files(f"{tmp_path}/{n}")) for n in ("plain", "packed")}
    assert size["packed"] < size["plain"] / 4
    for n in ac.data_files(f"{tmp_path}/packed"):
        assert ac._IpcFile(f"{tmp_path}/packed", n).count() == len(list(ac._IpcFile(f"{tmp_path}/packed", n).batches(0, 10**9))) > 0
