"""Score extraction output: strict parse rate, per-category and micro P / R / F1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilcorpus.fixed_values import CATEGORIES
from veilcorpus.functions import jsonx
from veilcorpus.functions.frames import free_name
from veilcorpus.functions.text import let
from veilcorpus.schema import empty_annotation, strings_or_empty


def parse_columns(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """For each raw column add an annotation struct and an `is one JSON object` flag.

    `columns` maps a raw column to (annotation name, flag name). Each text is parsed once, in native
    expressions; elements that are no strings get the text that Python's `str` gives them.
    """
    for raw, (out, ok) in columns.items():
        read = let(
            F.col(raw),
            lambda text: let(jsonx.strict_annotation(text), lambda p: F.struct(p.isNotNull().alias("ok"), jsonx.native_annotation(p).alias("value"))),
        )
        held = free_name("_read", df)
        df = df.withColumn(held, read)
        value = F.when(F.col(held)["ok"], F.col(held)["value"]).otherwise(empty_annotation())
        df = df.withColumns({out: value, ok: F.coalesce(F.col(held)["ok"], F.lit(False))}).drop(held)
    return df


def parse_predictions(df: DataFrame, raw: str = "raw_output", gold: str = "gold_json") -> DataFrame:
    """Add `pred`, `parsed_ok`, `gold`, `gold_ok`; text that is not an object scores as empty."""
    return parse_columns(df, {raw: ("pred", "parsed_ok"), gold: ("gold", "gold_ok")})


def parse_rate(df: DataFrame, raw: str = "raw_output") -> DataFrame:
    """One row: `n_samples` and `json_parse_rate`, the share of texts that are one JSON object; 0 without any."""
    ok = jsonx.strict_object(F.col(raw), "_: STRING").isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_samples"), F.coalesce(F.avg(ok.cast("int")), F.lit(0.0)).alias("json_parse_rate"))


def _set_sizes(pred: Column, gold: Column) -> tuple[Column, Column, Column]:
    p, g = strings_or_empty(pred), strings_or_empty(gold)
    both = F.size(F.array_intersect(p, g))
    return both, F.size(F.array_distinct(p)) - both, F.size(F.array_distinct(g)) - both


def row_confusion(df: DataFrame, pred: str = "pred", gold: str = "gold", keys: tuple[str, ...] = ()) -> DataFrame:
    """Long form `(keys, category, tp, fp, fn)` per row: exact matches between sets."""
    cells = []
    for name in CATEGORIES:
        tp, fp, fn = _set_sizes(F.col(pred).getField(name), F.col(gold).getField(name))
        cells.append(
            F.struct(F.lit(name).alias("category"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
        )
    return df.select(*keys, F.inline(F.array(*cells)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def with_scores(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to tp / fp / fn columns; an empty denominator gives 0."""
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    scored = counts.withColumns({"precision": p, "recall": r})
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", _ratio(F.lit(2) * p * r, p + r))


def confusion_totals(df: DataFrame, pred: str = "pred", gold: str = "gold", ok: str = "parsed_ok") -> DataFrame:
    """One row: rows, parsed rows, and tp / fp / fn sums of each category. One pass, no explode."""
    sums = [
        F.count(F.lit(1)).alias("n_samples"),
        F.coalesce(F.sum(F.col(ok).cast("bigint")), F.lit(0)).alias("n_parsed"),
    ]
    for name in CATEGORIES:
        cell = _set_sizes(F.col(pred).getField(name), F.col(gold).getField(name))
        for kind, size in zip(("tp", "fp", "fn"), cell):
            sums.append(F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias(f"{kind}_{name}"))
    return df.agg(*sums)


def _cells(micro: bool) -> Column:
    def cell(i: int, label: str, names: tuple[str, ...]) -> Column:
        def total(kind: str) -> Column:
            out = F.col(f"{kind}_{names[0]}")
            for n in names[1:]:
                out = out + F.col(f"{kind}_{n}")
            return out.alias(kind)

        return F.struct(
            F.lit(i).alias("category_index"), F.lit(label).alias("category"), total("tp"), total("fp"), total("fn")
        )

    cells = [cell(i, name, (name,)) for i, name in enumerate(CATEGORIES)]
    if micro:
        cells.append(cell(len(CATEGORIES), "micro avg", CATEGORIES))
    return F.array(*cells)


def evaluation_table(parsed: DataFrame, micro: bool = True) -> DataFrame:
    """One row per category and a `micro avg` row, with the parse rate on each."""
    wide = confusion_totals(parsed)
    rate = _ratio(F.col("n_parsed"), F.col("n_samples"))
    long = wide.select("n_samples", rate.alias("json_parse_rate"), F.inline(_cells(micro)))
    return with_scores(long)


def weakest_first(table: DataFrame) -> DataFrame:
    """Categories by ascending F1, ties in category order, with report texts."""
    shown = {
        f"{c}_text": F.format_string("%.3f", F.col(c)) for c in ("f1", "precision", "recall")
    }
    return table.withColumns(shown).orderBy(
        (F.col("category") == "micro avg"), "f1", "category_index"
    )


def metric_rows(table: DataFrame, run_id: Column, step: Column, prefix: str = "eval") -> DataFrame:
    """Long metrics `(run_id, step, metric, value)` of an evaluation table."""
    micro = F.col("category") == "micro avg"
    per_category = [
        F.struct(F.concat_ws("/", F.lit(prefix), "category", F.lit(m)).alias("metric"), F.col(m).alias("value"))
        for m in ("f1", "precision", "recall")
    ]
    overall = [F.struct(F.lit(f"{prefix}/json_parse_rate").alias("metric"), F.col("json_parse_rate").alias("value"))]
    overall += [
        F.struct(F.lit(f"{prefix}/micro_{m}").alias("metric"), F.col(m).alias("value"))
        for m in ("precision", "recall", "f1")
    ]
    rows = F.when(micro, F.array(*overall)).otherwise(F.array(*per_category))
    return table.select(run_id.alias("run_id"), step.alias("step"), F.inline(rows))
