"""Gates over run metadata and metric histories.

`runs`: `run_id, run_name, state`; `history`: `run_id, step, metric, value` with nulls
where a step logged no sample. All gates fail closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def run_lookup(runs: DataFrame) -> DataFrame:
    """Per run name: how many runs carry it and, if exactly one does, its id.

    The candidates of an ambiguous name are rows of `run_candidates`; they are not
    gathered into a list, so a name that very many runs share costs nothing extra.
    """
    counted = runs.groupBy("run_name").agg(
        F.count_distinct("run_id").alias("matches"), F.min("run_id").alias("only")
    )
    unique = F.col("matches") == 1
    return counted.select(
        "run_name",
        "matches",
        F.when(unique, F.col("only")).alias("run_id"),
        F.when(unique, F.lit("found")).otherwise(F.lit("ambiguous")).alias("status"),
    )


def find_run(runs: DataFrame, run_id: str | None = None, run_name: str | None = None) -> DataFrame:
    """One row `(asked, matches, run_id, status)`; an id is exact, a name must be unique."""
    if not run_id and not run_name:
        raise ValueError("run_id or run_name is required")
    column, asked = ("run_id", run_id) if run_id else ("run_name", run_name)
    hits = runs.filter(F.col(column) == asked)
    counted = hits.agg(
        F.count_distinct("run_id").alias("matches"), F.min("run_id").alias("only")
    )
    status = (
        F.when(F.col("matches") == 0, F.lit("missing"))
        .when(F.col("matches") == 1, F.lit("found"))
        .otherwise(F.lit("ambiguous"))
    )
    return counted.select(
        F.lit(asked).alias("asked"), "matches", F.when(F.col("matches") == 1, F.col("only")).alias("run_id"),
        status.alias("status"),
    )


def run_candidates(runs: DataFrame, run_name: str) -> DataFrame:
    return runs.filter(F.col("run_name") == run_name).select("run_id", "run_name", "state")


def flatten_summary(df: DataFrame, summary: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Long rows `(keys, metric, value)` of a nested struct or map, named `a/b` over any depth; nulls give no row."""

    def entries(value: Column, kind: T.DataType, name: Column | None) -> Column:
        def below(key: Column) -> Column:
            return key if name is None else F.concat_ws("/", name, key)

        if isinstance(kind, T.StructType):
            return F.concat(*[entries(value.getField(f.name), f.dataType, below(F.lit(f.name))) for f in kind.fields])
        if isinstance(kind, T.MapType):
            pairs = F.coalesce(F.map_entries(value), F.array().cast(T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))))
            return F.flatten(F.transform(pairs, lambda e: entries(e["value"], kind.valueType, below(e["key"].cast("string")))))
        return F.array(F.struct(name.alias("metric"), value.cast("string").alias("value")))

    found = F.filter(entries(F.col(summary), df.schema[summary].dataType, None), lambda e: e["value"].isNotNull())
    return df.select(*keys, F.inline(found))


def state_allowed(state: Column, allow_running: bool = False) -> Column:
    allowed = ["finished", "running"] if allow_running else ["finished"]
    return F.coalesce(state.isin(*allowed), F.lit(False))


def _required(runs: DataFrame, required: list[str]) -> DataFrame:
    names = F.array(*[F.lit(m) for m in required])
    return runs.select("run_id", F.explode(names).alias("metric"))


def metric_gate(runs: DataFrame, history: DataFrame, required: list[str]) -> DataFrame:
    """Per run and required metric: samples, first and last value, `status`.

    `missing`: the run never logged the metric; `no samples`: only nulls; else `ok`.
    """
    wanted = history.filter(F.col("metric").isin(*required))
    value, has = F.col("value"), F.col("value").isNotNull()
    step = F.when(has, F.col("step"))
    seen = wanted.groupBy("run_id", "metric").agg(
        F.count("value").alias("n"),
        F.min_by(value, step).alias("first"),
        F.max_by(value, step).alias("last"),
        F.lit(True).alias("logged"),
    )
    joined = _required(runs, required).join(seen, ["run_id", "metric"], "left")
    status = (
        F.when(F.col("logged").isNull(), F.lit("missing"))
        .when(F.col("n") == 0, F.lit("no samples"))
        .otherwise(F.lit("ok"))
    )
    return joined.select(
        "run_id", "metric", F.coalesce("n", F.lit(0)).alias("n"), "first", "last", status.alias("status")
    )


def gpu_metric_names(system_history: DataFrame, shown: int | None = None) -> DataFrame:
    """Metric names that mention a GPU, or the first `shown` of them; for information, never a failure."""
    names = system_history.select("metric").distinct()
    found = names.filter(F.lower("metric").contains("gpu"))
    return found if shown is None else found.orderBy("metric").limit(shown)


def system_report(system_history: DataFrame) -> DataFrame:
    return system_history.groupBy("run_id").agg(
        F.count_distinct("step").alias("rows"), F.max(F.lower("metric").contains("gpu")).alias("has_gpu")
    )


def failures(
    runs: DataFrame, history: DataFrame, required: list[str], allow_running: bool = False
) -> DataFrame:
    """Long `(run_id, failure)`: bad states and failed metrics."""
    states = runs.filter(~state_allowed(F.col("state"), allow_running)).select(
        "run_id", F.concat(F.lit("state "), F.coalesce("state", F.lit("unknown"))).alias("failure")
    )
    if not required:
        return states
    metrics = metric_gate(runs, history, required).filter("status <> 'ok'").select(
        "run_id", F.concat_ws(" ", F.lit("metric"), "metric", "status").alias("failure")
    )
    return states.unionByName(metrics)


def verdict(
    runs: DataFrame, history: DataFrame, required: list[str], allow_running: bool = False
) -> DataFrame:
    """Per run: number of failures and `passed`. A run without failures passes."""
    counted = failures(runs, history, required, allow_running).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_failures")
    )
    return runs.select("run_id", "state").join(counted, "run_id", "left").select(
        "run_id",
        "state",
        F.coalesce("n_failures", F.lit(0)).alias("n_failures"),
        F.col("n_failures").isNull().alias("passed"),
    )
