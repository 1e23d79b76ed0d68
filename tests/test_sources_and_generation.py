import json
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veilcorpus import schema as S
from veilcorpus.functions.entities import add_entities
from veilcorpus.operators import audit, complete, tasks
from veilcorpus.sources import readers, writers
from veilcorpus.streaming.incremental_generation import generate_pending

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_generation_log_lenient_and_strict(spark, tmp_path):
    valid = {"input_text": "t", "annotation_json": "{}", "_meta": {"task_id": "t1", "category": "c", "subtype": "s", "polarity": "pos"}}
    path = write_lines(tmp_path / "log.json", [json.dumps(valid), "", "not json", '{"input_text": "t2', json.dumps(valid | {"_meta": None})])
    log = readers.read_generation_log(spark, path)
    assert log.count() == 2
    todo = spark.createDataFrame([("t1",), ("t2",)], "task_id string")
    assert [r["task_id"] for r in tasks.pending_tasks(todo, log).collect()] == ["t2"]
    assert readers.rejected_log_lines(spark, path).count() == 2
    with pytest.raises(Exception):
        readers.read_generation_log(spark, path, strict=True).collect()


def test_prompts_keep_repeats(spark, tmp_path):
    path = write_lines(tmp_path / "prompts.txt", ["a", " a ", "", "b"])
    rows = readers.read_prompts(spark, path).collect()
    assert sorted(r["prompt"] for r in rows) == ["a", "a", "b"] and len({r["prompt_id"] for r in rows}) == 3
    again = readers.read_prompts(spark, path).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_audio_folder_joins_on_the_whole_path(spark, tmp_path):
    for name in ("x/one.wav", "y/one.wav"):
        (tmp_path / "audio" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "audio" / name).write_bytes(name.encode())
    wanted = spark.createDataFrame([("x/one.wav", "first"), ("./y/one.wav", "second"), ("z.wav", "gone")], "path string, transcription string")
    got = {r["transcription"]: r for r in readers.read_audio_folder(spark, str(tmp_path / "audio"), wanted).collect()}
    assert len(got) == 3 and bytes(got["first"]["audio"]["bytes"]) == b"x/one.wav" and bytes(got["second"]["audio"]["bytes"]) == b"y/one.wav"
    assert got["gone"]["status"] == "missing" and got["first"]["status"] == "ok"


def test_spec_tables_and_unknown_subtypes(spark, tmp_path):
    spec = {"system_config": {"description": "d", "subtypes": [{"name": "odd", "examples": ["e"]}], "situations": ["s1", "s2"]}}
    path = write_lines(tmp_path / "spec.json", [json.dumps(spec)])
    subtypes, situations = readers.spec_tables(spark, readers.load_spec(spark, path))
    with pytest.raises(ValueError, match="odd"):
        tasks.expand_tasks(subtypes, situations)
    made = tasks.expand_tasks(subtypes, situations, pools={"odd": ["p", "q"]}).collect()
    assert len(made) == 4 and all(set(r["entities"]) <= {"p", "q"} for r in made if r["positive"])
    assert all(r["entities"] is None for r in made if not r["positive"])
    kept = add_entities(spark.createDataFrame([("k", "nobody knows")], "task_id string, subtype_name string"), "task_id").collect()
    assert len(kept) == 1 and kept[0]["entities"] is None


def test_synthesis_joins_shuffle_no_expanded_rows(spark, capsys):
    spec = {"system_config": {"description": "d", "subtypes": [{"name": "odd", "examples": ["e"]}], "situations": ["s1"]}}
    subtypes, situations = readers.spec_tables(spark, spec)
    tasks.expand_tasks(subtypes, situations, pools={"odd": ["p", "q"]}).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3


def test_a_second_value_differs_from_the_first(spark):
    rows = spark.range(400).select(F.col("id").cast("string").alias("task_id"), F.lit("odd").alias("subtype_name"))
    for pool, most in ((["p", "q"], 2), (["p"], 1)):
        made = add_entities(rows, "task_id", pools={"odd": pool}).select("entities").collect()
        sizes = {len(r["entities"]) for r in made}
        assert all(len(set(r["entities"])) == len(r["entities"]) for r in made) and max(sizes) == most and min(sizes) == 1


def test_corpora_that_are_missing(spark, tmp_path):
    spark.createDataFrame([("t", "{}")], S.CORPUS).write.parquet(f"{tmp_path}/a")
    both = readers.read_corpora(spark, {"a": f"{tmp_path}/a", "b": f"{tmp_path}/none"})
    assert [r["source"] for r in both.collect()] == ["a"]
    with pytest.raises(Exception):
        readers.read_corpus(spark, f"{tmp_path}/none").count()
    log = spark.createDataFrame([("x", "{}", None)], S.GENERATION_LOG)
    writers.export_log(log, f"{tmp_path}/export")
    assert readers.read_corpus(spark, f"{tmp_path}/export").select("input_text").first()[0] == "x"


def flaky(options):
    """Fails `options['fails']` times for each message, then answers."""
    tries: dict[str, int] = {}

    def answer(messages):
        text = messages[-1]["content"]
        tries[text] = tries.get(text, 0) + 1
        if tries[text] <= options["fails"]:
            raise RuntimeError("busy")
        if options.get("sleeps"):
            time.sleep(options["sleeps"])
        return complete.Answer(text)

    return answer


def ask(spark, **policy):
    df = spark.createDataFrame([([("user", f"q{i}")],) for i in range(4)], "messages array<struct<role:string,content:string>>").coalesce(1)
    return complete.complete_table(df, flaky, complete.CallPolicy(first_wait_s=0.01, **policy)).collect()


def test_calls_are_tried_again_and_failures_are_values(spark):
    assert all(r["error"] is None and r["content"] for r in ask(spark, attempts=3, options={"fails": 2}))
    failed = ask(spark, attempts=2, options={"fails": 2})
    assert all(r["content"] is None and "2 attempts failed" in r["error"] and "busy" in r["error"] for r in failed)
    late = ask(spark, attempts=1, deadline_s=0.2, options={"fails": 0, "sleeps": 5})
    assert all("TimeoutError" in r["error"] for r in late)


def test_no_more_than_the_limit_is_in_flight():
    import threading

    now, most, lock = [0], [0], threading.Lock()

    def busy(messages):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        return complete.Answer("x")

    from concurrent.futures import ThreadPoolExecutor

    policy = complete.CallPolicy(attempts=1, in_flight=3)
    with ThreadPoolExecutor(policy.in_flight) as pool:
        list(pool.map(lambda _: complete.ask(busy, [], policy), range(20)))
    assert most[0] <= 3


def test_value_pools(spark):
    row = lambda s: (s, [("user", "- v1\n- v2")])
    ddl = "subtype string, messages array<struct<role:string,content:string>>"
    assert complete.value_pools(spark.createDataFrame([row("a")], ddl), complete.echo_completer, allowed=("a",)) == {"a": ["v1", "v2"]}
    for bad in ([row("b")], [row("a"), row("a")]):
        with pytest.raises(ValueError):
            complete.value_pools(spark.createDataFrame(bad, ddl), complete.echo_completer, allowed=("a",))


def test_generation_resumes_and_logs_a_task_once(spark, tmp_path):
    spec = {"system_config": {"description": "d", "subtypes": [{"name": "odd", "examples": ["e"]}], "situations": ["s1", "s2"]}}
    subtypes, situations = readers.spec_tables(spark, spec)
    todo = tasks.expand_tasks(subtypes, situations, pools={"odd": ["pool value"]})
    log = f"{tmp_path}/log"
    generate_pending(todo.unionByName(todo), log)
    ids = [r[0] for r in readers.read_generation_log(spark, log).select("_meta.task_id").collect()]
    assert len(ids) == len(set(ids)) > 0
    generate_pending(todo, log)
    assert sorted(ids) == sorted(r[0] for r in readers.read_generation_log(spark, log).select("_meta.task_id").collect())


def test_metric_gate(spark):
    runs = spark.createDataFrame([("r", "name", "finished")], "run_id string, run_name string, state string")
    rows = [("r", 1, "train/loss", None), ("r", 2, "train/loss", 2.0), ("r", 3, "train/loss", 1.0), ("r", 1, "train/lr", None)]
    history = spark.createDataFrame(rows, "run_id string, step long, metric string, value double")
    got = {r["metric"]: r for r in audit.metric_gate(runs, history, ["train/loss", "train/lr", "gone"]).collect()}
    assert (got["train/loss"]["n"], got["train/loss"]["first"], got["train/loss"]["last"], got["train/loss"]["status"]) == (2, 2.0, 1.0, "ok")
    assert got["train/lr"]["status"] == "no samples" and got["gone"]["status"] == "missing"
    names = spark.createDataFrame([(f"gpu{i}",) for i in range(9)] + [("cpu",)], "metric string")
    assert audit.gpu_metric_names(names).count() == 9 and audit.gpu_metric_names(names, 5).count() == 5
    state = spark.createDataFrame([("running",), ("finished",), ("failed",)], "s string")
    assert [r["a"] for r in state.select(audit.state_allowed(F.col("s")).alias("a")).collect()] == [False, True, False]
