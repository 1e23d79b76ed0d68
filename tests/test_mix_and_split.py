import base64
import collections
import contextlib
import os
import random
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from veilcorpus import session
from veilcorpus.functions import jsonx
from veilcorpus.functions.hashing import draw
from veilcorpus.operators import mix, profile, rank, split
from veilcorpus.plans import corpus_build, queries
from veilcorpus.sources import readers, writers
from veilcorpus.fixed_values import CATEGORIES

EMPTY = {c: [] for c in CATEGORIES}


def corpus(spark, rows):
    """Rows `(row_id, source, text, {category: values})`."""
    ddl = "row_id string, source string, input_text string, annotation struct<" + ",".join(f"{c}:array<string>" for c in CATEGORIES) + ">"
    return spark.createDataFrame([(i, s, t, {**EMPTY, **a}) for i, s, t, a in rows], ddl)


def test_draw_is_the_published_number(spark):
    assert spark.range(1).select(draw(42, 7).alias("d")).first()["d"] == 1477910627807661


def test_row_budget():
    assert [mix.row_budget(n, 0.1)[1] for n in (10_000, 25, 35)] == [1000, 2, 4]
    with pytest.raises(ValueError):
        mix.row_budget(10, 1.0)


def test_queue_runs_through_epochs(spark):
    sizes = mix.source_sizes(spark.createDataFrame([("a",)] * 3, "source string"))
    slots = mix.queue_slots(spark, 3, sizes, seed=1).orderBy("i", "j").collect()
    assert [(r["epoch"], r["position"]) for r in slots] == [(k // 3, k % 3) for k in range(len(slots))]


def test_many_sources_can_be_mixed(spark):
    rows = [(f"{s}-{k}", f"s{s}", f"text {s} {k}", {"address": [f"a{s}"]}) for s in range(1500) for k in range(2)]
    out = mix.mix_corpus(corpus(spark, rows), 300, 0.0).collect()
    assert len(out) == 300 and len({r["mixed_id"] for r in out}) == 300


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_mixing_does_not_depend_on_partitions(spark, partitions):
    rows = [(str(i), "ab"[i % 2], f"t{i}", {"address": ["x"]} if i % 3 else {}) for i in range(60)]
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = sorted((r["mixed_id"], r["input_text"]) for r in mix.mix_corpus(corpus(spark, rows).repartition(int(partitions)), 40, 0.2).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    seen = test_mixing_does_not_depend_on_partitions.__dict__.setdefault("first", out)
    assert out == seen and len(out) == 40


def test_concatenation_joins_texts_and_annotations(spark):
    two = corpus(spark, [("1", "s", "A", {"address": ["a", "b"]}), ("2", "s", "B", {"address": ["b", "c"]})])
    chosen = spark.createDataFrame([(0, 0, "1"), (0, 1, "2")], "i long, j int, row_id string")
    row = mix.concatenate_rows(two, chosen, 1, ("。",)).first()
    assert row["input_text"] in ("A。B", "B。A") and sorted(row["annotation"]["address"]) == ["a", "b", "c"]


def test_negatives(spark):
    df = corpus(spark, [(str(i), "s", f"t{i}", {}) for i in range(3)] + [("9", "s", "p", {"address": ["x"]})])
    assert sorted(r["row_id"] for r in mix.sample_negatives(df, 3).collect()) == ["0", "1", "2"]
    more = mix.sample_negatives(df, 5).collect()
    assert len(more) == 5 and {r["row_id"] for r in more} <= {"0", "1", "2"}
    assert mix.sample_negatives(df.filter("row_id = '9'"), 2).count() == 0


def test_splits(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("row_id"))
    parts = collections.Counter(r["split"] for r in split.train_validation_split(df, "row_id", 0.05).collect())
    assert parts == {"train": 9, "validation": 1}
    carved = collections.Counter(r["split"] for r in split.carve_out(df, "row_id", 0.25).collect())
    assert carved == {"test": 3, "train": 7}
    three = collections.Counter(r["split"] for r in split.three_way_split(df, "row_id").collect())
    assert sum(three.values()) == 10 and set(three) == {"train", "validation", "test"}
    with pytest.raises(ValueError):
        split.train_validation_split(df, "row_id", 1.5)


def test_corpus_is_built_from_files(spark, tmp_path):
    mask = "array<struct<value:string,label:string,start:int,end:int>>"
    raw = [(f"text {i} t@x.jp", "ja" if i % 4 else "en", [("t@x.jp", "EMAIL", 0, 1)] if i % 2 else []) for i in range(80)] + [("same", "ja", [])] * 5
    spark.createDataFrame(raw, f"source_text string, language string, privacy_mask {mask}").write.parquet(f"{tmp_path}/raw_a")
    typed = [(f"会社 {i}", [("会社", "法人名", 0, 2)]) for i in range(20)]
    spark.createDataFrame(typed, "text string, entities array<struct<name:string,type:string,span_start:int,span_end:int>>").write.parquet(f"{tmp_path}/raw_b")
    corpus_build.prepare_masked(spark, f"{tmp_path}/raw_a", f"{tmp_path}/a")
    corpus_build.prepare_typed(spark, f"{tmp_path}/raw_b", f"{tmp_path}/b")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 65
    found = {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b", "missing": f"{tmp_path}/none"}
    counts = {r["category"]: r["entity_count"] for r in corpus_build.mix(spark, found, f"{tmp_path}/mixed", 60, 0.1).collect()}
    assert spark.read.parquet(f"{tmp_path}/mixed").count() == 60 and counts["email_address"] > 0
    card = corpus_build.format_chat(spark, f"{tmp_path}/mixed", found, f"{tmp_path}/out").first()
    assert card["num_rows"]["total"] == 60 + 65 + 20 and card["num_rows"]["validation"] == 7
    alone = corpus_build.format_chat(spark, f"{tmp_path}/mixed", found, f"{tmp_path}/alone", include_originals=False).first()
    assert alone["num_rows"]["total"] == 60
    rows = spark.read.parquet(f"{tmp_path}/out/data")
    assert rows.count() == 145 and [m["role"] for m in rows.first()["messages"]] == ["system", "user", "assistant"]


def test_null_groups_and_any_names_stay(spark):
    rows = [(1, "a", 1.0), (2, None, 2.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, source string, weight double")
    for name in ("_u", "_b", "_k", "_n", "_offset", "_needed", "_outer", "_right_0", "position2"):
        df = df.withColumn(name, F.lit("user"))
    for ranked in (
        rank.weighted_shuffle_positions(df, "row_id", "weight", 1, groups=["source"]),
        rank.shuffle_positions(df, "row_id", 1, groups=["source"]),
    ):
        got = ranked.collect()
        assert sorted((r["source"] or "", r["position"]) for r in got) == [("", 0), ("", 1), ("a", 0)]
        assert all(r[n] == "user" for r in got for n in ("_u", "_b", "_k", "_n", "_offset", "_needed", "_right_0"))
    parts = split.three_way_split(df, "row_id", 0.3, 0.3)
    assert parts.columns == [*df.columns, "split"] and parts.filter("_outer = 'user'").count() == 3
    sizes = mix.source_sizes(df)
    slots = mix.queue_slots(spark, 50, sizes, 7).collect()
    drawn = mix.draw_slots(spark, 50, sizes, 7).count()
    assert len(slots) == drawn and {r["source"] for r in slots} == {"a", None}
    entries = mix.queue_entries(df.select("row_id", "source", "weight"), 50, sizes, 7)
    wanted = {(r["source"], r["epoch"], r["position"]) for r in slots}
    assert wanted <= {(r["source"], r["epoch"], r["position"]) for r in entries.collect()}


CONTENTS = [(s, f"{s} text {i % 50}", "{}") for s in "ab" for i in range(70)] + [("a", "x", None), ("a", None, "x"), ("a", "x\u0001y", "z"), ("a", "x", "y\u0001z")] + [("b", "hot", "{}")] * 30


def test_ids_in_place_are_those_of_a_shuffle(spark):
    rows = spark.createDataFrame(CONTENTS, "source string, input_text string, annotation_json string").repartition(3)
    for some in (rows, rows.dropDuplicates()):  # with and without rows that come more than once
        wanted = sorted(map(str, corpus_build.with_row_ids(some).collect()))
        with corpus_build.identified(some) as (n, ids, numbered):
            assert n == len(wanted)
            assert sorted(map(str, numbered.collect())) == wanted
            assert sorted(r["row_id"] for r in ids.collect()) == sorted(r["row_id"] for r in numbered.collect())


def shuffled_bytes(spark):
    """Bytes of the shuffle files that the session holds just now."""
    found = 0
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for folder, _, names in os.walk(top.getPath()):
            for name in names:
                if name.startswith("shuffle_") and name.endswith(".data"):
                    with contextlib.suppress(FileNotFoundError):
                        found += os.path.getsize(f"{folder}/{name}")
    return found


class most_shuffled(threading.Thread):
    """The most bytes of new shuffle files at any time within the block."""

    def __init__(self, spark):
        super().__init__()
        spark.sparkContext._jvm.System.gc()
        self.spark, self.ended, self.first, self.most = spark, threading.Event(), shuffled_bytes(spark), 0

    def run(self):
        while not self.ended.wait(0.05):
            self.most = max(self.most, shuffled_bytes(self.spark) - self.first)

    def __enter__(self):
        self.start()
        return self

    def __exit__(self, *_):
        self.ended.set()
        self.join()
        self.most = max(self.most, shuffled_bytes(self.spark) - self.first)


def test_a_build_never_shuffles_all_its_texts_at_once(spark, tmp_path):
    # Random texts, which no codec makes much smaller.
    texts = [(base64.b64encode(random.Random(i).randbytes(3000)).decode(), "{}") for i in range(1500)]
    size = 3000 * len(texts)
    spark.createDataFrame(texts, "input_text string, annotation_json string").repartition(4).write.parquet(f"{tmp_path}/a")
    with most_shuffled(spark) as chat:
        card = corpus_build.format_chat(spark, f"{tmp_path}/a", {"a": f"{tmp_path}/a"}, f"{tmp_path}/chat").first()
    assert card["num_rows"]["total"] == 3000 and chat.most < size  # of 2 x size; all were shuffled twice before
    with most_shuffled(spark) as mixed:
        corpus_build.mix(spark, {"a": f"{tmp_path}/a"}, f"{tmp_path}/mixed", 1500, 0.1)
    assert spark.read.parquet(f"{tmp_path}/mixed").count() == 1500 and mixed.most < 3 * size  # of 3.8 x size, twice


def test_files_hold_the_rows_in_the_order_of_their_keys(spark, tmp_path):
    def saved(folder):
        names = sorted(n for n in os.listdir(folder) if n.startswith("part-"))
        return [r for n in names for r in pq.ParquetFile(f"{folder}/{n}").read().to_pylist()], len(names)

    df = spark.createDataFrame([(f"r{i}", f"t{i}", "train" if i % 5 else "validation") for i in range(3000)], "row_id string, text string, split string")
    keyed = df.withColumn("k", rank.uniform_key(7, "shuffle", F.col("row_id")))
    wanted = [(r["split"], r["text"]) for r in keyed.orderBy("k").collect()]
    held = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for _ in range(2):  # the second replaces the first, whatever the session says
            writers.save_splits(df, f"{tmp_path}/splits", 7, rows=3000)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", held)
    for name in ("train", "validation"):
        rows, files = saved(f"{tmp_path}/splits/split={name}")
        assert [r["text"] for r in rows] == [t for s, t in wanted if s == name] and files == 12  # of 250 rows
    assert sorted(os.listdir(f"{tmp_path}/splits"))[-3:] == ["_SUCCESS", "split=train", "split=validation"]
    for n in (None, 1000, 3):  # written over each other
        writers.save_shuffled(keyed.drop("row_id"), f"{tmp_path}/all", "k", n)
        assert [(r["split"], r["text"]) for r in saved(f"{tmp_path}/all")[0]] == wanted


def test_the_profile_of_a_build_is_that_of_its_mix(spark, tmp_path):
    rows = [(f"t{i}", '{"address": ["x", null, "y%d"]}' % (i % 7) if i % 3 else "{}") for i in range(60)]
    spark.createDataFrame(rows, "input_text string, annotation_json string").write.parquet(f"{tmp_path}/a")
    held = corpus_build.with_row_ids(readers.read_corpora(spark, {"a": f"{tmp_path}/a"}))
    held = held.withColumn("annotation", jsonx.decode_annotation(F.col("annotation_json")))
    wanted = profile.category_profile(mix.mix_corpus(held, 50, 0.1)).collect()
    assert corpus_build.mix(spark, {"a": f"{tmp_path}/a"}, f"{tmp_path}/mixed", 50, 0.1).collect() == wanted


def test_a_mix_from_written_ids_is_the_mix(spark):
    held = corpus(spark, [(str(i), "ab"[i % 2], f"t{i}", {"address": ["x"]} if i % 3 else {}) for i in range(60)])
    for n, ratio in ((40, 0.1), (40, 0.8), (40, 0.0)):  # fewer negatives than rows to take, more, and none
        with mix.drawn_rows(held, n, ratio, 42) as drawn:
            plain, given = (sorted(map(str, mix.mix_corpus(held, n, ratio, 42, d).collect())) for d in (None, drawn))
        assert plain == given and len(plain) == n


def test_raw_tables_go_once_the_corpora_are_made(spark, tmp_path):
    docs = [(i, f"mail t{i}@x.org", ["de", "fr", None][i % 3]) for i in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    before = set(os.listdir(session.shared_dir(spark).removeprefix("file:")))
    folder, paths = queries._built_corpus(spark, str(tmp_path))
    assert set(os.listdir(session.shared_dir(spark).removeprefix("file:"))) - before == {os.path.basename(folder)}
    assert sorted(os.listdir(folder.removeprefix("file:"))) == ["a", "b"]
    assert sorted(r["source"] for r in readers.read_corpora(spark, paths).collect()) == ["a"] * 10 + ["b"] * 20
