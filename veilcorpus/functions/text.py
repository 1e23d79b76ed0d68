"""String functions. Regexes use `(?U)` so that \\d, \\w, \\s and \\b cover all of Unicode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_BLANKS = "[\\s\\x1c-\\x1f]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once per row, however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any script; a text without any at its ends is not searched."""

    def trimmed(t: Column) -> Column:
        ends = F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1)))
        return F.when(ends.rlike(f"(?U){_BLANKS}"), F.regexp_replace(t, f"(?U)^{_BLANKS}+|{_BLANKS}+$", "")).otherwise(t)

    return let(text, trimmed)


def words(text: Column) -> Column:
    """Non-empty white-space separated tokens."""
    return F.filter(F.split(text, f"(?U){_BLANKS}+"), lambda w: w != "")


LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def truthy(text: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def clean_output(text: Column) -> Column:
    """Body of a model answer: drop a code fence, then one pair of quotes, then one 「」 pair."""

    def unfenced(out: Column) -> Column:
        body = F.regexp_replace(F.regexp_replace(out, "^```[a-zA-Z]*\\n?", ""), "\\n?```$", "")
        return F.when(out.startswith("```"), strip(body)).otherwise(out)

    def unquoted(out: Column) -> Column:
        first = F.left(out, F.lit(1))
        quoted = (F.length(out) >= 2) & first.isin('"', "'") & (first == F.right(out, F.lit(1)))
        return F.when(quoted, strip(_inner(out))).otherwise(out)

    def unbracketed(out: Column) -> Column:
        return F.when(out.startswith("「") & out.endswith("」"), strip(_inner(out))).otherwise(out)

    return let(let(let(strip(text), unfenced), unquoted), unbracketed)


def _inner(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text) - 2)


def clean_pool_lines(content: Column, compat: bool = False) -> Column:
    """Distinct values of a one-per-line answer, list markers removed, order kept.

    The default strips a marker (`-`, `•`, `・`, `*`, or a number with `.`/`)`/`、`)
    that a space follows, or `・`/`•` alone. `* ` before a digit, `*` or `/` is the start of a
    cron line and stays. `compat=True` strips any leading run of
    markers, digits and dots, which also eats the start of addresses and cron lines.
    """
    if compat:
        marker = "(?U)^[\\s\\-•・*\\d\\.）)）、]+"
    else:
        marker = "(?U)^\\s*(?:[•・]\\s*|-\\s+|\\*\\s+(?![*/\\d])|\\d+(?:\\.\\s+|[)）、]\\s*))"
    cleaned = F.transform(lines(content), lambda ln: strip(F.regexp_replace(ln, marker, "")))
    return F.array_distinct(F.filter(cleaned, lambda ln: ln != ""))


def task_id(
    category: Column, subtype: Column, situation_idx: Column, positive: Column, rep: Column
) -> Column:
    polarity = F.when(positive, F.lit("pos")).otherwise(F.lit("neg"))
    return F.concat_ws("/", category, subtype, situation_idx, polarity, rep)


def markdown_cell(text: Column, width: int | None, flatten: bool = True) -> Column:
    out = F.left(text, F.lit(width)) if width else text
    if flatten:
        out = F.replace(out, F.lit("\n"), F.lit(" "))
    return F.replace(out, F.lit("|"), F.lit("\\|"))
