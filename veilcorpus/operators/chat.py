"""Rows to chat messages: `ARRAY<STRUCT<role, content>>`.

Shapes are resolved from the schema before any job runs; everything else is a
projection.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veilcorpus.fixed_values import (
    EXTRACTION_PROMPT,
    SHAREGPT_ROLES,
    TEMPLATE_MARKERS,
    VOICE_PROMPT,
)
from veilcorpus.functions import jsonx
from veilcorpus.functions.text import let, truthy

ROLES = ("user", "assistant", "system")


def turn(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def extraction_chat(
    input_text: Column, annotation_json: Column, system_prompt: str = EXTRACTION_PROMPT
) -> Column:
    """System prompt, the text, and the annotation JSON as the answer."""
    return F.array(
        turn("system", F.lit(system_prompt)),
        turn("user", input_text),
        turn("assistant", annotation_json),
    )


#: A mapper is entries between commas, each blank or a word, `=` and a column name without `,`.
_ENTRY = re.compile(r"\s*(?:(?P<role>[^=,\s][^=,]*?)\s*=\s*(?P<column>[^,]*?))?\s*(?:,|$)")


def parse_mapper(raw: str | None) -> dict[str, str] | None:
    """`user=col,assistant=col[,system=col]` as a dict; None if unset. Blank entries don't count, the last of a role does."""
    if not raw:
        return None
    chosen: dict[str, str] = {}
    at = 0
    while at < len(raw):
        entry = _ENTRY.match(raw, at)
        if entry is None:
            raise ValueError(f"malformed mapper at {raw[at:]!r}: expected role=column")
        at = entry.end()
        if entry["role"]:
            chosen[entry["role"]] = entry["column"]
    unknown, lacking = chosen.keys() - set(ROLES), {"user", "assistant"} - chosen.keys()
    if unknown or lacking:
        raise ValueError(f"mapper {raw!r}: unknown role {sorted(unknown)}, missing {sorted(lacking)}; roles are {ROLES}")
    return chosen


def mapped_chat(df: DataFrame, mapper: dict[str, str]) -> Column:
    """Messages from named columns; the system turn is left out where it is empty."""
    missing = [c for c in mapper.values() if c not in df.columns]
    if missing:
        raise ValueError(f"mapper columns {missing} not found; columns are {sorted(df.columns)}")
    turns = F.array(
        turn("user", F.col(mapper["user"]).cast("string")),
        turn("assistant", F.col(mapper["assistant"]).cast("string")),
    )
    if "system" not in mapper:
        return turns
    system = F.col(mapper["system"]).cast("string")
    return F.when(truthy(system), F.concat(F.array(turn("system", system)), turns)).otherwise(turns)


def sharegpt_chat(conversations: Column) -> Column:
    """`from`/`value` turns; roles outside the table stay as they are."""

    def role(sender: Column) -> Column:
        out = sender
        for old, new in SHAREGPT_ROLES.items():
            out = F.when(sender == old, F.lit(new)).otherwise(out)
        return out

    return F.transform(conversations, lambda t: turn(role(t.getField("from")), t.getField("value")))


def instruction_chat(instruction: Column, extra: Column | None, answer: Column) -> Column:
    """User turn = instruction, with the extra text after a blank line where there is one."""
    user = instruction
    if extra is not None:
        user = F.when(truthy(extra), F.concat(instruction, F.lit("\n\n"), extra)).otherwise(user)
    return F.array(turn("user", user), turn("assistant", answer))


def resolve_chat(df: DataFrame, mapper: dict[str, str] | str | None = None) -> Column:
    """Messages column of a table in any of the known shapes.

    Order: mapper, `messages`, `conversations`, instruction/output,
    instruction/response, inputs/targets. A row whose list is null falls to the next
    shape that the table has, else it is null (a bad row).
    """
    if isinstance(mapper, str):
        mapper = parse_mapper(mapper)
    if mapper:
        return mapped_chat(df, mapper)
    types = {f.name: f.dataType for f in df.schema.fields}
    has = types.keys()
    shapes: list[Column] = []
    if isinstance(types.get("messages"), T.ArrayType):
        shapes.append(F.col("messages"))
    if isinstance(types.get("conversations"), T.ArrayType):
        shapes.append(sharegpt_chat(F.col("conversations")))
    if {"instruction", "output"} <= has:
        extra = F.col("input") if "input" in has else None
        shapes.append(instruction_chat(F.col("instruction"), extra, F.col("output")))
    elif {"instruction", "response"} <= has:
        extra = F.col("context") if "context" in has else None
        shapes.append(instruction_chat(F.col("instruction"), extra, F.col("response")))
    elif {"inputs", "targets"} <= has:
        shapes.append(instruction_chat(F.col("inputs"), None, F.col("targets")))
    if not shapes:
        raise ValueError(
            f"no known chat shape in columns {sorted(has)}; pass a mapper such as "
            "'user=<col>,assistant=<col>'"
        )
    return F.coalesce(*shapes) if len(shapes) > 1 else shapes[0]


def to_chat(df: DataFrame, mapper: dict[str, str] | str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, resolve_chat(df, mapper).alias("messages"))


def bad_chat_rows(df: DataFrame, mapper: dict[str, str] | str | None = None) -> DataFrame:
    """Preflight over the whole table: rows that have no messages, or a turn without role or content."""
    messages = resolve_chat(df, mapper)
    broken = F.exists(messages, lambda t: t.getField("role").isNull() | t.getField("content").isNull())
    return df.filter(messages.isNull() | (F.size(messages) == 0) | broken)


# --- Reading messages -------------------------------------------------------


def messages_with_role(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m.getField("role") == role)


def prompt_messages(messages: Column) -> Column:
    """All turns but the assistant's."""
    return F.filter(messages, lambda m: m.getField("role") != "assistant")


def gold_answer(messages: Column) -> Column:
    """Content of the first assistant turn, `{}` if there is none."""
    return F.coalesce(F.get(messages_with_role(messages, "assistant"), 0).getField("content"), F.lit("{}"))


def single_turn(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Add `user_text`, `reference_text` (first user and assistant turn) and `is_bad`."""
    user = F.get(messages_with_role(F.col(messages), "user"), 0).getField("content")
    answer = F.get(messages_with_role(F.col(messages), "assistant"), 0).getField("content")
    return df.withColumns(
        {"user_text": user, "reference_text": answer, "is_bad": user.isNull() | answer.isNull()}
    )


def single_turn_from_turns(
    turns: DataFrame, chat_id: str, turn_no: str, role: str = "role", content: str = "text"
) -> DataFrame:
    """The same reduction for a table with one row per turn.

    Two filtered `min_by` aggregates: partial results are combined before the shuffle,
    so a chat with very many turns is never gathered in one task.
    """
    order = F.col(turn_no)

    def first(name: str) -> Column:
        return F.min_by(
            F.when(F.col(role) == name, F.col(content)), F.when(F.col(role) == name, order)
        )

    return turns.groupBy(chat_id).agg(
        first("user").alias("user_text"), first("assistant").alias("reference_text")
    ).withColumn("is_bad", F.col("user_text").isNull() | F.col("reference_text").isNull())


# --- Chat template ----------------------------------------------------------


def _system_block(system: Column, tools: Column | None) -> Column:
    marks = TEMPLATE_MARKERS
    if tools is not None:
        listed = F.concat(
            F.lit("List of tools: " + marks["tool_list_start"] + "["),
            F.array_join(tools, ", "),
            F.lit("]" + marks["tool_list_end"]),
        )
        glue = F.when(truthy(system), F.lit("\n")).otherwise(F.lit(""))
        with_tools = F.concat(F.coalesce(system, F.lit("")), glue, listed)
        system = F.when(F.coalesce(F.size(tools), F.lit(0)) > 0, with_tools).otherwise(system)
    block = F.concat(F.lit(marks["turn_start"] + "system\n"), system, F.lit(marks["turn_end"] + "\n"))
    return F.when(truthy(system), block).otherwise(F.lit(""))


def render_turn(role: Column, content: Column) -> Column:
    """One turn's text; content that is missing is JSON's `null`, as any content that is no string is JSON text."""
    marks = TEMPLATE_MARKERS
    content = F.coalesce(content, F.lit("null"))
    wrapped = F.concat(
        F.lit(marks["tool_response_start"]), content, F.lit(marks["tool_response_end"])
    )
    body = F.when(role == "tool", wrapped).otherwise(content)
    return F.concat(F.lit(marks["turn_start"]), role, F.lit("\n"), body, F.lit(marks["turn_end"] + "\n"))


def render_chat(
    messages: Column,
    default_system: str = EXTRACTION_PROMPT,
    tools: Column | list | None = None,
    bos: str = "",
    generation_prompt: bool = False,
) -> Column:
    """Chat text. A leading system turn replaces the default system prompt.

    `tools` is an array-of-strings column or a Python list (dicts become JSON). With
    `bos=""` the text has no start token, as training text needs.
    """
    if isinstance(tools, list):
        texts = [t if isinstance(t, str) else json.dumps(t, ensure_ascii=False) for t in tools]
        tools = F.array(*[F.lit(t) for t in texts]) if texts else None
    leads = F.coalesce(F.get(messages, 0).getField("role") == "system", F.lit(False))
    system = F.when(leads, F.get(messages, 0).getField("content")).otherwise(F.lit(default_system))
    rest = F.when(leads, F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)
    body = F.array_join(
        F.transform(rest, lambda m: render_turn(m.getField("role"), m.getField("content"))), ""
    )
    tail = F.lit(TEMPLATE_MARKERS["turn_start"] + "assistant\n" if generation_prompt else "")
    return F.concat(F.lit(bos), _system_block(system, tools), body, tail)


def _content_text(value: Column) -> Column:
    """The template's text of a content: a string as it is, any other value as JSON; null stays null."""
    return F.when(value.isNotNull(), F.coalesce(jsonx.marked_string(value), jsonx.python_json(value, marked=True)))


def messages_from_json(text: Column) -> Column:
    """Messages of a JSON list of `{"role": ..., "content": ...}`, with the texts that the template shows.

    Content may be any JSON value. What is no string becomes JSON text as Python's `json.dumps` writes it without
    escapes: keys in their order, `, ` and `: ` between parts, floats in their shortest form, and `<` as it is.
    Null if the text is not one JSON list; a missing or null content is null, which is rendered as `null`.
    """

    def held(t: Column) -> Column:
        listed = jsonx.strict_object(F.concat(F.lit('{"m":'), jsonx.mark_strings(t), F.lit("}")), "m: ARRAY<STRUCT<role: STRING, content: STRING>>")
        return F.transform(listed.getField("m"), lambda m: turn(jsonx.marked_string(m["role"]), _content_text(m["content"])))

    return let(text, held)


def tools_from_json(text: Column) -> Column:
    """Texts of a JSON list of tools: names as they are, descriptions as JSON. Null if it is not one JSON list."""

    def held(t: Column) -> Column:
        listed = jsonx.strict_object(F.concat(F.lit('{"t":'), jsonx.mark_strings(t), F.lit("}")), "t: ARRAY<STRING>")
        return F.transform(listed.getField("t"), lambda x: F.coalesce(_content_text(x), F.lit("null")))

    return let(text, held)


def variant_text(content: Column) -> Column:
    """The template's text of VARIANT content. A VARIANT keeps an object's keys in alphabetical order."""
    return F.when(F.schema_of_variant(content) == "STRING", F.try_variant_get(content, "$", "string")).otherwise(jsonx.python_json(F.to_json(content)))


# --- Audio ------------------------------------------------------------------


def usable_audio(transcription: Column, audio: Column) -> Column:
    """A transcript and a non-empty payload; the inner bytes are what counts."""
    return truthy(transcription) & F.coalesce(F.length(audio.getField("bytes")) > 0, F.lit(False))


def audio_chat(transcription: Column, audio: Column, system_prompt: str = VOICE_PROMPT) -> Column:
    """Three turns with `text` or `audio` content."""

    def part(role: str, text: Column, payload: Column) -> Column:
        return F.struct(
            F.lit(role).alias("role"), text.cast("string").alias("text"), payload.cast("binary").alias("audio")
        )

    none = F.lit(None)
    return F.array(
        part("system", F.lit(system_prompt), none),
        part("user", transcription, none),
        part("assistant", none, audio.getField("bytes")),
    )


def within_context(df: DataFrame, length: Column, limit: int) -> DataFrame:
    """Drop samples longer than the limit; `length` is any length expression."""
    return df.filter(length <= limit)


