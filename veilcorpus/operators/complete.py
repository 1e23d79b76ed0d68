"""Text completion over a table, and generate-and-validate.

The completer is a Python callable that users supply. Spark partitions the requests, and the bound on
requests in flight is dealt out to the partitions: there are never more partitions than the bound, and
their shares of it add up to it, however many run at once.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from veilcorpus.fixed_values import POOLED_SUBTYPES
from veilcorpus.functions.prompts import task_messages
from veilcorpus.functions.text import clean_pool_lines
from veilcorpus.operators.chat import turn
from veilcorpus.operators.validate import ACCEPTED, answer_text, judge
from veilcorpus.schema import COMPLETION_FIELDS
from veilcorpus.session import materialize


@dataclass(frozen=True)
class CallPolicy:
    """How requests are sent. `options` goes to the completer as it is; the engine never looks into it."""

    attempts: int = 3
    first_wait_s: float = 1.0  # before the second attempt; doubled before each further one
    deadline_s: float | None = None  # for one attempt
    in_flight: int = 8  # requests at once, over all tasks of a stage
    options: Mapping[str, object] = field(default_factory=dict)

    def waits(self) -> list[float]:
        """Seconds to wait before each attempt."""
        return [0.0] * min(1, self.attempts) + [self.first_wait_s * 2**i for i in range(self.attempts - 1)]


@dataclass
class Answer:
    content: str
    prompt_tokens: int = 0
    completion_tokens: int = 0
    model: str = "offline"
    provider: str = "auto"


Completer = Callable[[list[dict]], Answer]
# Called once per partition with the policy's options; gives the function that answers one request.
CompleterFactory = Callable[[Mapping[str, object]], Completer]


def echo_completer(options: Mapping[str, object]) -> Completer:
    """Offline stand-in: answers with the last user turn, so results can be checked."""

    def complete(messages: list[dict]) -> Answer:
        last = [m["content"] for m in messages if m["role"] == "user"][-1]
        prompt = sum(len((m["content"] or "").split()) for m in messages)
        return Answer(last, prompt, len(last.split()))

    return complete


def _within(seconds: float | None, complete: Completer, messages: list[dict]) -> Answer:
    """The answer, or TimeoutError. A call that hangs is left behind in a thread of its own."""
    if seconds is None:
        return complete(messages)
    done: queue.SimpleQueue = queue.SimpleQueue()

    def call() -> None:
        try:
            done.put((complete(messages), None))
        except Exception as fault:
            done.put((None, fault))

    threading.Thread(target=call, daemon=True).start()
    try:
        answer, fault = done.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer within {seconds} s") from None
    if fault is not None:
        raise fault
    return answer


def ask(complete: Completer, messages: list[dict], policy: CallPolicy) -> dict:
    """One row of completion columns. Whatever a request raises becomes its `error`; the batch goes on."""
    row = dict.fromkeys(("content", "model", "provider", "usage", "latency_s", "error"))
    problem = "none was made"
    for wait in policy.waits():
        if wait:
            time.sleep(wait)
        began = time.monotonic()
        try:
            answer = _within(policy.deadline_s, complete, messages)
        except Exception as fault:
            problem = f"{type(fault).__name__}: {fault}"
            continue
        tokens = {"prompt_tokens": answer.prompt_tokens or 0, "completion_tokens": answer.completion_tokens or 0}
        return row | {
            "content": answer.content or "", "model": answer.model, "provider": answer.provider,
            "usage": tokens, "latency_s": time.monotonic() - began,
        }
    return row | {"error": f"{policy.attempts} attempts failed, last: {problem}"}


# Arrow types of the completion columns (see COMPLETION_FIELDS).
_ARROW = dict.fromkeys(("content", "model", "provider", "error"), pa.string())
_ARROW |= {"usage": pa.map_(pa.string(), pa.int32()), "latency_s": pa.float64()}


def _cell(value: object) -> object:
    """Arrow takes a map as pairs."""
    return list(value.items()) if isinstance(value, dict) else value


def complete_table(
    df: DataFrame,
    factory: CompleterFactory = echo_completer,
    policy: CallPolicy = CallPolicy(),
    messages: str = "messages",
    partitions: int | None = None,
) -> DataFrame:
    """Add the completion columns to every row; rows keep their own ids and columns.

    At most `policy.in_flight` requests are open at once in total. Without `partitions`, the rows'
    partitions are merged where they lie to as many tasks as the cluster runs at once (or the bound
    allows); `partitions` deals the rows evenly to so many tasks, for a shuffle of the rows. Calls that
    were given up after `deadline_s` no longer count, and a task that runs twice counts twice, so leave
    speculation off.
    """
    if policy.in_flight < 1:
        raise ValueError("in_flight must be at least 1")
    slots = partitions or df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(policy.in_flight, slots))
    df = df.repartition(tasks) if partitions else df.coalesce(tasks)
    extra = T.StructType.fromDDL(COMPLETION_FIELDS)
    schema = T.StructType(df.schema.fields + extra.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        complete = factory(policy.options)
        share = policy.in_flight // tasks + (TaskContext.get().partitionId() < policy.in_flight % tasks)
        with ThreadPoolExecutor(max_workers=share) as pool:
            each = pool.map if share > 1 else map  # one request at a time needs no other thread
            for batch in batches:
                requests = batch.column(messages).to_pylist()
                answers = list(each(lambda ms: ask(complete, ms, policy), requests))
                columns = [pa.array([_cell(a[name]) for a in answers], _ARROW[name]) for name in extra.names]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *extra.names])

    return df.mapInArrow(run, schema)


def prompt_batch(system_prompt: str, user_prompt: Column) -> Column:
    """Messages of one system prompt and a user prompt per row."""
    return F.array(turn("system", F.lit(system_prompt)), turn("user", user_prompt))


def usage_totals(completions: DataFrame) -> DataFrame:
    """Token sums, latency and failures over all completions."""
    prompt = F.coalesce(F.col("usage")["prompt_tokens"], F.lit(0)).cast("bigint")
    answer = F.coalesce(F.col("usage")["completion_tokens"], F.lit(0)).cast("bigint")
    return completions.agg(
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(F.sum(F.col("error").isNotNull().cast("bigint")), F.lit(0)).alias("failures"),
        F.coalesce(F.sum(prompt), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum(answer), F.lit(0)).alias("completion_tokens"),
        F.coalesce(F.sum(prompt + answer), F.lit(0)).alias("total_tokens"),
        F.avg("latency_s").alias("avg_latency_s"),
        F.percentile_approx("latency_s", 0.5).alias("median_latency_s"),
    )


def generate_and_validate(
    tasks: DataFrame,
    factory: CompleterFactory = echo_completer,
    policy: CallPolicy = CallPolicy(),
    max_attempts: int = 2,
    partitions: int | None = None,
) -> DataFrame:
    """Task rows with the answer of their last attempt, `status` and `attempt`; the messages follow from the task.

    Only rejected rows are tried again; an error ends a task. Each attempt is written to
    the shared folder before it is read, so no request is sent twice for one attempt,
    also when an executor is lost later. The cleaned text follows from the answer and is not written beside it.
    """
    asked, columns = tasks, tasks.columns
    finished: list[DataFrame] = []
    for attempt in range(1, max_attempts + 1):
        answered = complete_table(asked.withColumn("messages", task_messages()), factory, policy, partitions=partitions)
        judged = judge(answered.drop("messages")).withColumn("attempt", F.lit(attempt))
        held = materialize(judged.drop("input_text"), "zstd")
        judged = held.withColumn("input_text", answer_text(F.col("content"))).select(*judged.columns)
        if attempt == max_attempts:
            finished.append(judged)
        else:
            finished.append(judged.filter("status <> 'rejected'"))
            asked = judged.filter("status = 'rejected'").select(*columns)
            if asked.isEmpty():
                break
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("status") == ACCEPTED)


def value_pools(requests: DataFrame, factory: CompleterFactory, policy: CallPolicy = CallPolicy(),
                compat: bool = False, allowed: Sequence[str] = POOLED_SUBTYPES) -> dict[str, list[str]]:
    """Value pools per subtype from one request each (`subtype, messages`).

    Requests may only name subtypes of `allowed`, each once, so the result is small enough for
    the driver; anything else raises. A failed request gives no pool.
    """
    bad = requests.groupBy("subtype").count().filter(~F.col("subtype").isin(*allowed) | F.col("subtype").isNull() | (F.col("count") > 1))
    if found := [r["subtype"] for r in bad.limit(5).collect()]:
        raise ValueError(f"unknown or repeated subtypes: {found}")
    answers = complete_table(requests, factory, policy)
    pools = answers.filter("error is null").select(
        "subtype", clean_pool_lines(F.col("content"), compat).alias("pool")
    )
    return {r["subtype"]: r["pool"] for r in pools.collect() if r["pool"]}
