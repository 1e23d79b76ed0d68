import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from veilcorpus import schema as S
from veilcorpus.operators import compare, complete, tasks, validate
from veilcorpus.sources import readers, writers
from veilcorpus.sources.files import folders_in
from veilcorpus.streaming import incremental_generation as inc, running_profile as rp

POLICY = complete.CallPolicy(attempts=1)


def todo(spark, n, first=0):
    spec = {"system_config": {"description": "d", "subtypes": [{"name": "odd", "examples": ["e"]}], "situations": [f"s{i}" for i in range(first, first + n)]}}
    subtypes, situations = readers.spec_tables(spark, spec)
    made = tasks.expand_tasks(subtypes, situations, pools={"odd": ["pool value"]}).filter("positive")
    return made.withColumn("task_id", F.concat_ws("/", "task_id", F.lit(str(first))))


def logged(spark, path):
    return [r[0] for r in inc.log_or_empty(spark, path).select("_meta.task_id").collect()]


def test_a_batch_that_fails_after_its_write_is_replaced(spark, tmp_path, monkeypatch):
    folder, log, state = f"{tmp_path}/tasks", f"{tmp_path}/log", f"{tmp_path}/state"
    first = todo(spark, 5)
    first.write.parquet(folder)
    stream = spark.readStream.schema(first.schema).parquet(folder)
    reads = []
    real_read, real_write = inc.read_generation_log, inc.replace_log_part
    monkeypatch.setattr(inc, "read_generation_log", lambda *a: reads.append(1) or real_read(*a))

    def write_then_fail(rows, path):
        real_write(rows, path)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(inc, "replace_log_part", write_then_fail)
    with pytest.raises(Exception, match="lost after the write"):
        inc.start_generation(stream, log, state, policy=POLICY).awaitTermination()
    assert len(logged(spark, log)) == 5
    monkeypatch.setattr(inc, "replace_log_part", real_write)
    inc.start_generation(stream, log, state, policy=POLICY).awaitTermination()
    assert sorted(logged(spark, log)) == sorted(r["task_id"] for r in first.collect())
    # Later batches: new tasks, old ones again, repeated ones and one without an id; none reads the log.
    reads.clear()
    more = todo(spark, 3, 100)
    more.unionByName(more).unionByName(first).unionByName(more.limit(1).withColumn("task_id", F.lit(None).cast("string"))).write.mode("append").parquet(folder)
    inc.start_generation(stream, log, state, policy=POLICY).awaitTermination()
    ids = logged(spark, log)
    assert len(ids) == len(set(ids)) == 8 and len(reads) == 1  # the one of `logged`
    # A new stream resumes from the log, and a failed second batch is replaced like the first.
    todo(spark, 2, 200).write.mode("append").parquet(folder)
    for _ in range(2):
        inc.start_generation(stream, log, f"{tmp_path}/other", policy=POLICY).awaitTermination()
    ids = logged(spark, log)
    assert len(ids) == len(set(ids)) == 10
    assert spark.conf.get(inc.STATE_STORE, None) in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")


def test_a_second_run_of_a_later_batch_meets_no_half_log(spark, tmp_path, monkeypatch):
    folder, log, state = f"{tmp_path}/tasks", f"{tmp_path}/log", f"{tmp_path}/state"
    first = todo(spark, 2)
    first.write.parquet(folder)
    stream = spark.readStream.schema(first.schema).parquet(folder)
    inc.start_generation(stream, log, state, policy=POLICY).awaitTermination()
    todo(spark, 4, 50).write.mode("append").parquet(folder)
    real = inc.replace_log_part

    def half(rows, path):
        real(rows.limit(1), path)
        raise RuntimeError("half")

    monkeypatch.setattr(inc, "replace_log_part", half)
    with pytest.raises(Exception, match="half"):
        inc.start_generation(stream, log, state, policy=POLICY).awaitTermination()
    monkeypatch.setattr(inc, "replace_log_part", real)
    inc.start_generation(stream, log, state, policy=POLICY).awaitTermination()
    ids = logged(spark, log)
    assert len(ids) == len(set(ids)) == 6


def test_task_files_read_again_are_not_shuffled(spark, tmp_path, monkeypatch):
    folder, log, state = f"{tmp_path}/tasks of it", f"{tmp_path}/log", f"{tmp_path}/state"
    first = todo(spark, 9)
    first.unionByName(first.limit(4)).write.parquet(folder)
    batches, real = [], inc.place_bits
    monkeypatch.setattr(inc, "place_bits", lambda places: batches.append(places.columns) or real(places))

    def run(checkpoint):
        stream = spark.readStream.schema(first.schema).parquet(folder)
        inc.start_generation(stream, log, checkpoint, policy=POLICY, read_tasks=lambda: spark.read.schema(first.schema).parquet(folder)).awaitTermination()

    run(state)
    assert sorted(logged(spark, log)) == sorted(r["task_id"] for r in first.collect())
    # New tasks beside old ones and one without an id; then another stream over the same files.
    more = todo(spark, 3, 100)
    more.unionByName(first).unionByName(more.limit(1).withColumn("task_id", F.lit(None).cast("string"))).write.mode("append").parquet(folder)
    run(state)
    assert len(logged(spark, log)) == len(set(logged(spark, log))) == 12
    todo(spark, 2, 200).write.mode("append").parquet(folder)
    run(f"{tmp_path}/other")
    assert len(logged(spark, log)) == len(set(logged(spark, log))) == 14
    assert batches == [["task_id", "file", "row"]] * 3


def test_rows_at_places_of_long_files(spark, tmp_path):
    spark.range(0, 150_000, 1, 2).select("id").write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    places = rows.select("id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    wanted = "row % 32768 IN (0, 1, 7, 8, 32767) OR row % 1009 = 3"
    found = sorted(r["id"] for r in inc.rows_at(rows, inc.place_bits(places.filter(wanted))).collect())
    assert found == sorted(r["id"] for r in places.filter(wanted).collect()) and len(found) > 150
    assert inc.rows_at(rows, inc.place_bits(places.limit(0))).count() == 0


def test_an_answer_is_stored_once_and_the_log_is_compressed(spark, tmp_path):
    judged = complete.generate_and_validate(todo(spark, 5), policy=POLICY)
    assert all("input_text" not in spark.read.parquet(f).columns for f in judged.inputFiles())
    assert all(r["input_text"] == r["content"].strip() for r in judged.collect())
    writers.append_generation_log(validate.log_rows(judged), f"{tmp_path}/log")
    assert all(f.endswith(".json.gz") for f in readers.read_generation_log(spark, f"{tmp_path}/log", strict=True).inputFiles())
    assert len(logged(spark, f"{tmp_path}/log")) == 5


def test_a_reader_always_sees_a_whole_profile(spark, tmp_path, monkeypatch):
    log, table = f"{tmp_path}/log", f"{tmp_path}/profile"
    rows = spark.range(60).select(
        F.concat(F.lit("t"), "id").alias("input_text"), F.lit('{"address": ["a", "b"]}').alias("annotation_json"),
        F.expr(f"named_struct('task_id', string(id), 'category', 'c', 'subtype', 's', 'polarity', 'pos')").alias("_meta"),
    )
    for part in range(6):
        writers.append_generation_log(rows.filter(F.col("input_text").endswith(str(part))).coalesce(1), f"{log}/part{part}")
    with open(f"{log}/part0/broken.json", "w") as f:
        f.write('not json\n\n{"input_text": "x", "annotation_json": "{\\"address\\": [\\"c\\"]}"}\n')
    with pytest.raises(FileNotFoundError):
        rp.read_profile(spark, table)
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            try:
                found = rp.read_profile(spark, table).collect()
            except FileNotFoundError:
                continue
            seen.append((len(found), max(r["total_rows"] for r in found)))

    reader = threading.Thread(target=look)
    reader.start()
    real = rp.put_text
    monkeypatch.setattr(rp, "put_text", lambda *a: (time.sleep(0.5), real(*a)))
    query = rp.start_running_profile(rp.stream_log(spark, log, 1), table, f"{tmp_path}/state")
    query.awaitTermination()
    stop.set()
    reader.join()
    done = {r["category"]: (r["entity_count"], r["row_count"], r["total_rows"]) for r in rp.read_profile(spark, table).collect()}
    assert len(done) == 11 and done["address"] == (73, 37, 37) and done["human_name"] == (0, 0, 37)
    assert seen and {n for n, _ in seen} == {11} and len({t for _, t in seen}) > 2
    assert len(folders_in(table)) == rp.KEEP


def test_streamed_table_may_be_a_file_or_a_folder(spark, tmp_path):
    from veilcorpus.plans.queries import stream_profile

    docs = spark.createDataFrame([(i, f"mail a{i}@b.org", "de", "s", 9) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/made")
    (part,) = [n for n in os.listdir(f"{tmp_path}/made") if n.endswith(".parquet")]
    os.makedirs(f"{tmp_path}/one")
    os.rename(f"{tmp_path}/made/{part}", f"{tmp_path}/one/documents.parquet")
    docs.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    for folder in ("one", "many"):
        found = {r["category"]: (r["entity_count"], r["total_rows"]) for r in stream_profile(spark, f"{tmp_path}/{folder}").collect()}
        assert len(found) == 11 and found["email_address"] == (6, 6)


def test_a_saved_chat_dataset_leaves_no_table_behind(spark, tmp_path):
    from veilcorpus.plans import corpus_build
    from veilcorpus.session import shared_dir

    spark.createDataFrame([(f"t{i}", "{}") for i in range(20)], S.CORPUS).write.parquet(f"{tmp_path}/mixed")
    before = set(folders_in(shared_dir(spark)))
    corpus_build.format_chat(spark, f"{tmp_path}/mixed", {}, f"{tmp_path}/chat")
    assert set(folders_in(shared_dir(spark))) == before
    assert spark.read.parquet(f"{tmp_path}/chat/data").count() == 20


def test_counters_of_a_log_come_from_its_only_scan(spark, tmp_path, capsys):
    lines = ['{"input_text": "a", "annotation_json": "{}", "_meta": {"task_id": "1", "polarity": "pos"}}'] * 3
    lines += ['{"input_text": "b", "annotation_json": "{}", "_meta": {"task_id": "2", "polarity": "neg"}}', "", "   ", "broken", '{"input_text": "c"', "[1]"]
    lines += ['{"input_text": "d", "annotation_json": "{}", "_meta": null}', '{"input_text": "e", "_meta": {"task_id": ""}}']
    os.makedirs(f"{tmp_path}/log/batch=1")
    with open(f"{tmp_path}/log/batch=1/x.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    rows, counted = readers.read_counted_log(spark, f"{tmp_path}/log")
    kept = sorted(r["input_text"] for r in rows.collect())
    assert kept == ["a", "a", "a", "b", "d", "e"]
    assert counted.get == {"lines": 11, "blank": 2, "malformed": 3, "without_task_id": 2, "positive": 3, "negative": 1}
    lenient = readers.read_generation_log(spark, f"{tmp_path}/log")
    assert sorted(r["input_text"] for r in lenient.collect()) == kept and rows.columns == lenient.columns
    rows.explain()
    assert capsys.readouterr().out.count("FileScan") == 1
    os.makedirs(f"{tmp_path}/none")
    rows, counted = readers.read_counted_log(spark, f"{tmp_path}/none")
    assert rows.count() == 0 and counted.get["lines"] == 0


def test_metrics_are_written_once(spark, tmp_path):
    path = f"{tmp_path}/metrics"

    def rows(*found):
        return spark.createDataFrame(found, "run_id string, step long, metric string, value double, extra string")

    writers.save_metrics(rows(("007", 1, "f1", 0.5, "x"), ("007", 2, "f1", 0.6, "x"), ("b", 1, "f1", None, "x"), (None, None, "f1", 1.0, "x")), path)
    for _ in range(2):
        writers.save_metrics(rows(("007", 2, "f1", 0.7, "y"), ("007", 2, "recall", 0.1, "y"), ("c", 9, "f1", 0.9, "y")), path)
    writers.save_metrics(rows().limit(0) if False else spark.createDataFrame([], "run_id string, step long, metric string, value double"), path)
    got = sorted(map(tuple, readers.read_metrics(spark, path).collect()), key=str)
    wanted = [("007", 1, "f1", 0.5), ("007", 2, "f1", 0.7), ("007", 2, "recall", 0.1), ("b", 1, "f1", None), ("c", 9, "f1", 0.9), (None, None, "f1", 1.0)]
    assert got == sorted(wanted, key=str)
    with pytest.raises(ValueError, match="empty"):
        writers.save_metrics(rows(("", 1, "f1", 0.5, "x")), path)


def test_comparisons_are_replaced_by_name(spark, tmp_path):
    ddl = "prompt_id long, prompt string, content string"
    base = spark.createDataFrame([(1, "p1", "b1"), (2, "p2", "b2")], ddl)
    tuned = spark.createDataFrame([(2, "p2", "t2"), (3, "p3", "t|3")], ddl)
    both = compare.align_models(base, tuned)
    lines = {r["prompt_id"]: r["line"] for r in compare.markdown_rows(both).collect()}
    assert lines == {1: "| p1 | b1 |  |", 2: "| p2 | b2 | t2 |", 3: "| p3 |  | t\\|3 |"}
    for format in ("parquet", "json"):
        path = f"{tmp_path}/{format}"
        writers.save_comparison(both, path, "x", format)
        writers.save_comparison(both.limit(1), path, "y", format)
        writers.save_comparison(both.filter("prompt_id < 3"), path, "x", format)
        assert readers.read_comparison(spark, path, "x", format).count() == 2
        assert readers.read_comparison(spark, path, format=format).count() == 3


def test_models_of_bucketed_prompts_are_aligned_without_a_shuffle(spark, tmp_path, capsys):
    from veilcorpus.session import bucketed, shared_dir

    before = set(folders_in(shared_dir(spark)))
    items = spark.createDataFrame([(i, f"p{i}") for i in range(40)] + [(None, "none")], "prompt_id long, prompt string")
    with bucketed(items, "prompt_id") as held:
        tuned = held.filter("prompt_id % 4 <> 0").withColumn("content", F.upper("prompt"))
        both = compare.align_models(held.withColumn("content", F.col("prompt")), tuned)
        both.explain()
        assert "Exchange" not in capsys.readouterr().out
        writers.save_comparison(both, f"{tmp_path}/c", "x")
    got = {r["prompt"]: r["finetune"] for r in readers.read_comparison(spark, f"{tmp_path}/c").collect()}
    assert got == {"none": None} | {f"p{i}": f"P{i}" if i % 4 else None for i in range(40)}
    assert set(folders_in(shared_dir(spark))) == before and not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    assert all(f.endswith(".zstd.parquet") for f in readers.read_comparison(spark, f"{tmp_path}/c").inputFiles())


@pytest.mark.parametrize(("bound", "partitions"), [(1, None), (3, None), (7, None), (50, None), (3, 12)])
def test_requests_in_flight_stay_within_the_bound_in_total(spark, tmp_path, bound, partitions):
    folder = f"{tmp_path}/calls"
    os.makedirs(folder)

    def factory(options):
        import os as sys_os
        import uuid

        def call(messages):
            name = f"{folder}/{uuid.uuid4().hex}"
            open(name, "w").close()
            time.sleep(0.03)
            open(f"{folder}/seen", "a").write(f"{len([n for n in sys_os.listdir(folder) if n != 'seen'])}\n")
            sys_os.remove(name)
            return complete.Answer("x")

        return call

    df = spark.range(0, 60, 1, 12).select("id", F.expr("array(named_struct('role', 'user', 'content', string(id)))").alias("messages"))
    out = complete.complete_table(df, factory, complete.CallPolicy(attempts=1, in_flight=bound), partitions=partitions)
    assert sorted(r["id"] for r in out.filter("error IS NULL").collect()) == list(range(60))
    seen = [int(n) for n in open(f"{folder}/seen").read().split()]
    assert max(seen) <= bound and (bound < 3 or max(seen) > 1)
    with pytest.raises(ValueError, match="in_flight"):
        complete.complete_table(df, factory, complete.CallPolicy(in_flight=0))


def test_audio_spec_and_prompt_readers(spark, tmp_path):
    import json

    spec = {"c": {"description": "d", "subtypes": [{"name": "n", "description": "x", "examples": ["1"]}], "situations": ["s1", "s2"]}}
    with open(f"{tmp_path}/spec.json", "w") as f:
        json.dump(spec, f)
    subtypes, situations = readers.spec_tables(spark, readers.load_spec(spark, f"{tmp_path}/spec.json"))
    assert subtypes.first()["examples"] == ["1"] and [r["idx"] for r in situations.orderBy("idx").collect()] == [0, 1]
    spark.createDataFrame([("t", (b"ab", "p"))], S.AUDIO_ROWS).write.parquet(f"{tmp_path}/audio")
    assert readers.read_audio_rows(spark, f"{tmp_path}/audio").first()["audio"]["bytes"] == b"ab"
    five = readers.first_rows(spark.range(20), 5, "id")
    assert [r["id"] for r in five.collect()] == list(range(5)) and readers.first_rows(spark.range(3), 0).count() == 3
