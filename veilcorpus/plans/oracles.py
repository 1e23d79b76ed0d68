"""DuckDB SQL that gives the same rows as each named query, written independently of it."""

from __future__ import annotations

from veilcorpus.fixed_values import (
    CATEGORIES,
    EXTRACTION_PROMPT,
    NEGATIVE_PROMPT,
    POOLED_SUBTYPES,
    POSITIVE_PROMPT,
    SYNTHETIC_CATEGORIES,
    VOICE_PROMPT,
    WRITER_PROMPT,
)
from veilcorpus.functions.detect import DETECTORS
from veilcorpus.functions.entities import FORMATS, format_rows

SEED = 42
FOUND = {
    "email_address": "EMAIL",
    "phone_number": "TELEPHONENUM",
    "financial_info": "CREDITCARDNUMBER",
    "network_identifier": "IPV4",
    "account_identifier": "TOKEN",
}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def draw(*keys: str) -> str:
    """52-bit integer of `seed:key:...`; keys are SQL expressions."""
    text = f"concat_ws(':', '{SEED}', {', '.join(f'({k})::VARCHAR' for k in keys)})"
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT)"


def unit(*keys: str) -> str:
    return f"(({draw(*keys)}::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"


def json_list(values: str) -> str:
    return f"('[' || coalesce(array_to_string(list_transform({values}, lambda v: to_json(v)::VARCHAR), ', '), '') || ']')"


def annotation_json(per_category: dict[str, str]) -> str:
    parts = [f"{lit(chr(34) + c + chr(34) + ': ')} || {per_category.get(c, lit('[]'))}" for c in CATEGORIES]
    return "('{' || " + " || ', ' || ".join(parts) + " || '}')"


def found_json() -> str:
    return annotation_json({c: json_list(c) for c in FOUND})


GOLD = "gold AS (SELECT doc_id AS row_id, lang AS source, text AS input_text, " + ", ".join(
    f"regexp_extract_all(text, {lit(DETECTORS[label][1])}) AS {c}" for c, label in FOUND.items()
) + " FROM documents)"

NO_ENTITIES = " AND ".join(f"len({c}) = 0" for c in FOUND)


def profile_of(table: str, keys: str = "", group: str = "") -> str:
    """Wide counts of a table with one list column per found category."""
    sums = ", ".join(
        f"coalesce(sum(len({c})), 0)::BIGINT AS e_{c}, coalesce(sum((len({c}) > 0)::INT), 0)::BIGINT AS r_{c}"
        for c in FOUND
    )
    return f"SELECT {keys} count(*) AS total_rows, {sums} FROM {table} {group}"


def long_profile(wide: str, keys: str = "") -> str:
    selects = []
    for c in CATEGORIES:
        e, r = (f"e_{c}", f"r_{c}") if c in FOUND else ("0", "0")
        selects.append(
            f"SELECT {keys} '{c}' AS category, total_rows, {e}::BIGINT AS entity_count, {r}::BIGINT AS row_count, "
            f"round(CASE WHEN total_rows > 0 THEN {r}::DOUBLE / total_rows * 100 ELSE 0 END, 9) AS coverage FROM {wide}"
        )
    return " UNION ALL ".join(selects)


SQL: dict[str, str] = {}

# --- Annotation and profile ---------------------------------------------------

SQL["category_profile"] = f"WITH {GOLD}, wide AS ({profile_of('gold')}) {long_profile('wide')}"
SQL["stream_profile"] = SQL["category_profile"]
SQL["log_running_profile"] = SQL["category_profile"]
SQL["log_line_counts"] = (
    "WITH kinds AS (SELECT CASE WHEN turn % 7 = 0 THEN 'blank' WHEN turn % 11 = 0 THEN 'malformed' WHEN turn % 13 = 0 THEN 'no id' "
    "WHEN conv_id % 2 = 0 THEN 'pos' ELSE 'neg' END AS kind FROM conversations) "
    "SELECT count(*) AS lines, count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'malformed') AS malformed, "
    "count(*) FILTER (kind = 'no id') AS without_task_id, count(*) FILTER (kind = 'pos') AS positive, "
    "count(*) FILTER (kind = 'neg') AS negative, count(*) FILTER (kind IN ('no id', 'pos', 'neg')) AS rows_written FROM kinds"
)
SQL["category_profile_rollup"] = (
    f"WITH {GOLD}, wide AS ({profile_of('gold', 'source,', 'GROUP BY source')} UNION ALL "
    f"{profile_of('gold', lit('(all)') + ' AS source,')}) {long_profile('wide', 'source,')}"
)
SQL["profile_report"] = (
    f"WITH {GOLD}, wide AS ({profile_of('gold')}), p AS ({long_profile('wide')}) "
    "SELECT category, format('{:,}', entity_count) AS entity_count_text, format('{:,}', row_count) AS row_count_text, "
    "printf('%.1f%%', coverage) AS coverage_text FROM p"
)
SQL["label_map_entities"] = f"WITH {GOLD} " + " UNION ALL ".join(
    f"SELECT row_id AS doc_id, '{label}' AS label, '{c}' AS category, unnest({c}) AS value FROM gold"
    for c, label in FOUND.items()
)
SQL["masked_corpus"] = (
    f"WITH {GOLD} SELECT md5(input_text) AS text_md5, "
    + annotation_json({c: json_list(c) for c in ("email_address", "phone_number", "financial_info")})
    + " AS annotation_json FROM gold WHERE source = 'fr'"
)
SQL["annotation_json"] = f"WITH {GOLD} SELECT row_id, {found_json()} AS annotation_json FROM gold"
SQL["arrow_corpus"] = (
    f"WITH {GOLD} SELECT row_id, {found_json()} AS annotation_json, CASE WHEN source = 'de' THEN 'a' ELSE 'b' END AS split FROM gold"
)
SQL["annotation_round_trip"] = f"WITH {GOLD} " + " UNION ALL ".join(
    f"SELECT row_id, '{c}' AS category, unnest(range(len({c}))) AS pos, unnest({c}) AS value FROM gold" for c in FOUND
)
SQL["json_strings"] = "SELECT conv_id, turn, md5(to_json(text)::VARCHAR) AS json_md5 FROM conversations"
SQL["negative_rows"] = f"WITH {GOLD} SELECT row_id, source FROM gold WHERE {NO_ENTITIES}"
SQL["document_frequency"] = (
    f"WITH {GOLD}, wide AS ({profile_of('gold')}), p AS ({long_profile('wide')}) "
    "SELECT category, row_count, total_rows FROM p WHERE row_count > 0"
)
SQL["union_with_originals"] = (
    "SELECT part, count(*) AS n, sum(length(text))::BIGINT AS characters FROM "
    "(SELECT 'mixed' AS part, text FROM conversations UNION ALL SELECT 'original', text FROM documents) GROUP BY part"
)

_BUILT = {"email_address": "EMAIL", "phone_number": "TELEPHONENUM", "financial_info": "CREDITCARDNUMBER"}
_BUILT_ROWS = (
    "built AS (SELECT " + ", ".join(f"regexp_extract_all(text, {lit(DETECTORS[label][1])}) AS {c}" for c, label in _BUILT.items())
    + ", []::VARCHAR[] AS human_name FROM documents WHERE lang = 'de' UNION ALL SELECT "
    + ", ".join("[]::VARCHAR[]" for _ in _BUILT)
    + ", [left(text, 4)] FROM documents WHERE lang IS DISTINCT FROM 'de')"
)
SQL["corpus_build_profile"] = f"WITH {_BUILT_ROWS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS category, count(*) AS total_rows, "
    + (
        f"coalesce(sum(len({c})), 0)::BIGINT AS entity_count, coalesce(sum((len({c}) > 0)::INT), 0)::BIGINT AS row_count, "
        f"round(coalesce(avg((len({c}) > 0)::INT), 0) * 100, 9) AS coverage"
        if c in _BUILT or c == "human_name"
        else "0::BIGINT AS entity_count, 0::BIGINT AS row_count, 0.0::DOUBLE AS coverage"
    )
    + " FROM built"
    for c in CATEGORIES
)
SQL["corpus_build_card"] = (
    "WITH n AS (SELECT count(*) AS n FROM documents), totals AS "
    "(SELECT true AS originals, 2 * n AS total FROM n UNION ALL SELECT false, n FROM n), "
    "cut AS (SELECT *, greatest(1, round_even(total * 0.05::DOUBLE, 0)::BIGINT) AS validation FROM totals) "
    "SELECT originals, total - validation AS train, validation, total, total AS written FROM cut"
)

# --- Evaluation ---------------------------------------------------------------

_CHANGED = {c: json_list(c) for c in FOUND}
_CHANGED["email_address"] = f"CASE WHEN row_id % 5 = 0 THEN '[]' ELSE {json_list('email_address')} END"
_CHANGED["address"] = "CASE WHEN row_id % 7 = 0 THEN '[\"spurious ' || row_id || '\"]' ELSE '[]' END"
_CHANGED = {c: f"({e})" for c, e in _CHANGED.items()}
_WITH_ODD = dict(_CHANGED, human_name="'[12, true, null, \"x\"]'")

PREDICTED = (
    f"{GOLD}, raw AS (SELECT *, CASE WHEN row_id % 11 = 0 THEN left({annotation_json(_CHANGED)}, -1) "
    f"WHEN row_id % 17 = 0 THEN {annotation_json(_CHANGED)} || ' end' "
    f"WHEN row_id % 13 = 0 THEN {annotation_json(_WITH_ODD)} ELSE {annotation_json(_CHANGED)} END AS raw_output FROM gold), "
    "checked AS (SELECT *, json_valid(raw_output) AS ok, CASE WHEN json_valid(raw_output) THEN raw_output ELSE '{}' END AS doc FROM raw), "
    "cells AS ("
    + " UNION ALL ".join(
        f"SELECT row_id, ok, {i} AS category_index, '{c}' AS category, "
        f"list_distinct(coalesce(json_extract(doc, '$.{c}[*]')::VARCHAR[], [])) AS p, "
        + (f"list_distinct(list_transform({c}, lambda v: to_json(v)::VARCHAR))" if c in FOUND else "[]::VARCHAR[]")
        + " AS g FROM checked"
        for i, c in enumerate(CATEGORIES)
    )
    + "), row_counts AS (SELECT row_id, ok, category_index, category, len(list_intersect(p, g)) AS tp, "
    "len(p) - len(list_intersect(p, g)) AS fp, len(g) - len(list_intersect(p, g)) AS fn FROM cells), "
    "totals AS (SELECT category_index, category, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn "
    "FROM row_counts GROUP BY ALL UNION ALL SELECT 11, 'micro avg', sum(tp)::BIGINT, sum(fp)::BIGINT, sum(fn)::BIGINT FROM row_counts), "
    "pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision, "
    "CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall FROM totals), "
    "scores AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pr)"
)
_ROUND3 = "round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1"
SQL["json_parse_rate"] = (
    f"WITH {PREDICTED} SELECT count(*) AS n_samples, round(avg(ok::INT), 9) AS json_parse_rate FROM checked"
)
SQL["eval_per_category"] = (
    f"WITH {PREDICTED} SELECT category, tp, fp, fn, {_ROUND3} FROM scores WHERE category <> 'micro avg'"
)
SQL["eval_micro"] = f"WITH {PREDICTED} SELECT tp, fp, fn, {_ROUND3} FROM scores WHERE category = 'micro avg'"
SQL["eval_weakest_first"] = (
    f"WITH {PREDICTED} SELECT category, printf('%.3f', f1) AS f1_text, printf('%.3f', precision) AS precision_text, "
    "printf('%.3f', recall) AS recall_text FROM scores WHERE category <> 'micro avg' ORDER BY f1, category_index"
)
SQL["eval_row_confusion"] = (
    f"WITH {PREDICTED} SELECT row_id, category, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn FROM row_counts WHERE tp + fp + fn > 0"
)
_METRIC_ROWS = "SELECT '{run}' AS run_id, {step}::BIGINT AS step, metric, round(value, 9) AS value FROM named"
_NAMED = (
    "named AS ("
    + " UNION ALL ".join(
        f"SELECT CASE WHEN category = 'micro avg' THEN 'eval/micro_{m}' ELSE 'eval/' || category || '/{m}' END AS metric, {m} AS value FROM scores"
        for m in ("f1", "precision", "recall")
    )
    + " UNION ALL SELECT 'eval/json_parse_rate', avg(ok::INT) FROM checked)"
)
SQL["metric_table"] = (
    f"WITH {PREDICTED}, {_NAMED} {_METRIC_ROWS.format(run='007', step=100)} UNION ALL {_METRIC_ROWS.format(run='007', step=200)} "
    f"UNION ALL {_METRIC_ROWS.format(run='run-1', step=200)}"
)
SQL["eval_metric_rows"] = (
    f"WITH {PREDICTED}, named AS ("
    + " UNION ALL ".join(
        f"SELECT CASE WHEN category = 'micro avg' THEN 'eval/micro_{m}' ELSE 'eval/' || category || '/{m}' END AS metric, {m} AS value FROM scores"
        for m in ("f1", "precision", "recall")
    )
    + " UNION ALL SELECT 'eval/json_parse_rate', avg(ok::INT) FROM checked) "
    "SELECT 'run-1' AS run_id, 200::BIGINT AS step, metric, round(value, 9) AS value FROM named"
)

# --- Ranks, weights and splits ------------------------------------------------

WEIGHTS = (
    f"{GOLD}, df AS ({profile_of('gold')}), weights AS (SELECT row_id, source, greatest(0.0::DOUBLE"
    + "".join(
        f" + CASE WHEN len({c}) > 0 THEN ln(total_rows::DOUBLE / r_{c}) ELSE 0 END"
        for c in CATEGORIES
        if c in FOUND
    )
    + ", 1e-9) AS weight FROM gold, df)"
)
SQL["idf_weights"] = f"WITH {WEIGHTS} SELECT row_id, source, round(weight, 9) AS weight FROM weights"
SHUFFLED = (
    f"shuffled AS (SELECT doc_id, row_number() OVER (ORDER BY {unit(lit('shuffle'), 'doc_id')}, doc_id) - 1 AS position, "
    "count(*) OVER () AS n FROM documents)"
)
SQL["shuffle_rank"] = f"WITH {SHUFFLED} SELECT doc_id, position FROM shuffled"
SQL["weighted_shuffle_rank"] = (
    f"WITH {WEIGHTS} SELECT row_id, source, row_number() OVER (PARTITION BY source ORDER BY "
    f"-ln({unit(lit('weighted'), 'row_id')}) / weight, row_id) - 1 AS position FROM weights"
)
SQL["train_val_split"] = (
    f"WITH {SHUFFLED} SELECT doc_id, CASE WHEN position >= n - greatest(1, round_even(n * 0.05::DOUBLE, 0)) "
    "THEN 'validation' ELSE 'train' END AS split FROM shuffled"
)
SQL["split_counts"] = (
    f"WITH s AS ({SQL['train_val_split']}) SELECT split, count(*) AS rows FROM s GROUP BY split "
    "UNION ALL SELECT 'total', count(*) FROM s"
)
SQL["dataset_card"] = (
    f"WITH s AS ({SQL['train_val_split']}) SELECT 'documents chat' AS dataset_name, 'ja' AS language, "
    "'named-entity-recognition' AS task, sum((split = 'train')::INT)::BIGINT AS train, "
    "sum((split = 'validation')::INT)::BIGINT AS validation, count(*) AS total FROM s"
)


def _ranked(salt: str, source: str) -> str:
    key = unit(lit(salt), "doc_id")
    return (
        f"SELECT doc_id, row_number() OVER (ORDER BY {key}, doc_id) - 1 AS position, count(*) OVER () AS n FROM {source}"
    )


SQL["carve_out_split"] = (
    f"SELECT doc_id, CASE WHEN position < ceil(n * 0.1::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM ({_ranked('carve', 'documents')})"
)
SQL["three_way_split"] = (
    f"WITH outer_rank AS ({_ranked('test', 'documents')}), rest AS (SELECT doc_id FROM outer_rank WHERE position >= ceil(n * 0.2::DOUBLE)), "
    f"inner_rank AS ({_ranked('validation', 'rest')}) "
    "SELECT doc_id, 'test' AS split FROM outer_rank WHERE position < ceil(n * 0.2::DOUBLE) UNION ALL "
    "SELECT doc_id, CASE WHEN position < ceil(n * 0.1::DOUBLE) THEN 'validation' ELSE 'train' END FROM inner_rank"
)
SQL["evaluation_subset"] = f"SELECT doc_id FROM ({_ranked('evaluation', 'documents')}) WHERE position < 50"

# --- Mixing -------------------------------------------------------------------


def slots(n_rows: str) -> str:
    """CTEs up to `slots(i, j, source, epoch, position)`; sources are the languages."""
    return (
        "sizes AS (SELECT source, n, sum(n) OVER (ORDER BY source NULLS FIRST) AS upto, sum(n) OVER () AS total FROM "
        "(SELECT lang AS source, count(*) AS n FROM documents GROUP BY lang)), "
        f"outputs AS (SELECT range AS i, 2 + {draw(lit('size'), 'range')} % 3 AS k FROM range({n_rows})), "
        "raw_slots AS (SELECT i, unnest(range(k)) AS j FROM outputs), "
        f"tickets AS (SELECT i, j, {draw(lit('source'), 'i', 'j')} % (SELECT max(total) FROM sizes)::BIGINT AS ticket FROM raw_slots), "
        "sourced AS (SELECT i, j, source, n FROM tickets JOIN sizes ON ticket < upto AND ticket >= upto - n), "
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY i, j) - 1 AS slot FROM sourced), "
        "slots AS (SELECT i, j, source, slot // n AS epoch, slot % n AS position FROM numbered)"
    )


_N_DOCS = "(SELECT count(*) FROM documents)"
SQL["augment_slots"] = (
    f"WITH {slots(_N_DOCS)} SELECT i, j::INTEGER AS j, source, epoch::BIGINT AS epoch, position::BIGINT AS position FROM slots"
)


def mixed(n_rows: str) -> str:
    """CTEs up to `picked(i, j, h, row_id)` and `merged(i, category, value, ord)`."""
    return (
        f"{WEIGHTS}, {slots(n_rows)}, "
        "epochs AS (SELECT source, max(epoch) AS last_epoch FROM slots GROUP BY source), "
        "repeated AS (SELECT row_id, weights.source, weight, unnest(range(last_epoch + 1)) AS epoch FROM weights JOIN epochs e ON e.source IS NOT DISTINCT FROM weights.source), "
        "queue AS (SELECT row_id, source, epoch, row_number() OVER (PARTITION BY source, epoch ORDER BY "
        f"-ln({unit(lit('queue'), 'epoch', 'row_id')}) / weight, row_id) - 1 AS position FROM repeated), "
        f"picked AS (SELECT i, j, {draw(lit('order'), 'i', 'j')} AS h, row_id FROM slots JOIN queue q ON q.source IS NOT DISTINCT FROM slots.source AND q.epoch = slots.epoch AND q.position = slots.position), "
        "placed AS (SELECT i, row_id, row_number() OVER (PARTITION BY i ORDER BY h, j) AS place FROM picked), "
        "vals AS ("
        + " UNION ALL ".join(
            f"SELECT i, '{c}' AS category, place, unnest({c}) AS value, unnest(range(len({c}))) AS pos "
            "FROM placed JOIN gold USING (row_id)"
            for c in FOUND
        )
        + "), firsts AS (SELECT i, category, value, min(place * 1000000 + pos) AS ord FROM vals GROUP BY ALL), "
        "lists AS (SELECT i, category, list(value ORDER BY ord) AS vs FROM firsts GROUP BY ALL), "
        "wide AS (SELECT i"
        + "".join(f", any_value(vs) FILTER (category = '{c}') AS {c}" for c in FOUND)
        + " FROM lists GROUP BY i)"
    )


_TEXT_JOINED = f"CASE WHEN {draw(lit('delimiter'), 'i')} % 2 = 0 THEN array_to_string(ts, '。') ELSE array_to_string(ts, chr(10)) END"
SQL["augment_mixed"] = (
    f"WITH {mixed(_N_DOCS)}, texts AS (SELECT i, count(*) AS n_rows, list(input_text ORDER BY place) AS ts "
    "FROM placed JOIN gold USING (row_id) GROUP BY i) "
    f"SELECT i, n_rows, md5({_TEXT_JOINED}) AS text_md5, {found_json()} AS annotation_json "
    "FROM texts LEFT JOIN wide USING (i)"
)

def _unnamed(sql: str) -> str:
    """The same over a corpus in which one language has no name."""
    return sql.replace("lang AS source", "nullif(lang, 'es') AS source").replace("GROUP BY lang", "GROUP BY ALL")


SQL["augment_slots_unnamed"] = _unnamed(SQL["augment_slots"])
SQL["augment_mixed_unnamed"] = _unnamed(SQL["augment_mixed"])
SQL["weighted_shuffle_rank_unnamed"] = _unnamed(SQL["weighted_shuffle_rank"])
_NEGATIVE_RANK = (
    f"pool AS (SELECT row_id, source FROM gold WHERE {NO_ENTITIES}), "
    f"ranked AS (SELECT row_id, source, row_number() OVER (ORDER BY {unit(lit('negative'), 'row_id')}, row_id) - 1 AS position FROM pool)"
)
SQL["negative_sample"] = (
    f"WITH {GOLD}, {_NEGATIVE_RANK} SELECT row_id, source FROM ranked WHERE position < round_even({_N_DOCS} * 0.1::DOUBLE, 0)"
)
SQL["negative_sample_repeated"] = (
    f"WITH {GOLD}, {_NEGATIVE_RANK}, draws AS (SELECT range AS draw_no, {draw(lit('negative draw'), 'range')} % "
    f"(SELECT count(*) FROM pool) AS position FROM range(2 * {_N_DOCS})) "
    "SELECT draw_no, row_id FROM draws JOIN ranked USING (position)"
)
_N_NEG = f"round_even({_N_DOCS} * 0.1::DOUBLE, 0)::BIGINT"
SQL["mixed_profile"] = (
    f"WITH {mixed(f'{_N_DOCS} - {_N_NEG}')}, everything AS (SELECT "
    + ", ".join(f"coalesce({c}, []) AS {c}" for c in FOUND)
    + " FROM (SELECT DISTINCT i FROM slots) LEFT JOIN wide USING (i) UNION ALL SELECT "
    + ", ".join("[]::VARCHAR[]" for _ in FOUND)
    + f" FROM range({_N_NEG})), sums AS ({profile_of('everything')}) {long_profile('sums')}"
)

# --- Chat ---------------------------------------------------------------------

PAIRS = (
    "pairs AS (SELECT concat_ws(':', a.conv_id::VARCHAR, a.turn::VARCHAR) AS pair_id, a.turn, s.text AS system, a.text AS question, "
    "b.text AS answer FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' "
    "LEFT JOIN conversations s ON s.conv_id = a.conv_id AND s.turn = a.turn - 1 AND s.role = 'system' WHERE a.role = 'user')"
)


def turns(*pairs: tuple[str, str]) -> str:
    """Messages as text; a turn without content is its role alone."""
    return " || ';' || ".join(f"'{role}' || coalesce('=' || md5({content}), '')" for role, content in pairs)


def _chat(expr: str) -> str:
    return f"WITH {PAIRS} SELECT pair_id, {expr} AS chat FROM pairs"


def _with_extra(extra: str) -> str:
    return f"CASE WHEN coalesce({extra}, '') <> '' THEN question || chr(10) || chr(10) || {extra} ELSE question END"


_QA = turns(("user", "question"), ("assistant", "answer"))
_SYSTEM_FIRST = f"CASE WHEN system IS NOT NULL AND system <> '' THEN 'system=' || md5(system) || ';' ELSE '' END || {_QA}"
SQL["chat_three_turn"] = (
    f"WITH {GOLD} SELECT row_id, {turns(('system', lit(EXTRACTION_PROMPT)), ('user', 'input_text'), ('assistant', found_json()))} AS chat FROM gold"
)
SQL["chat_mapper"] = _chat(_SYSTEM_FIRST)
SQL["chat_messages"] = _chat(
    f"CASE WHEN turn % 4 <> 0 THEN {turns(('user', 'question'), ('tool', 'answer'))} ELSE {_QA} END"
)
SQL["chat_from_sharegpt"] = _chat(turns(("user", "question"), ("assistant", "answer"), ("tool", "question")))
SQL["chat_from_alpaca"] = _chat(
    turns(("user", _with_extra("CASE WHEN turn % 4 = 0 THEN '' ELSE system END")), ("assistant", "answer"))
)
SQL["chat_from_dolly"] = _chat(turns(("user", _with_extra("system")), ("assistant", "answer")))
SQL["chat_from_inputs_targets"] = _chat(_QA)
SQL["chat_bad_rows"] = "SELECT conv_id, turn FROM conversations WHERE role <> 'user' OR turn % 3 = 0"
SQL["chat_single_turn"] = (
    "SELECT conv_id, md5(u) AS user_md5, md5(a) AS reference_md5, u IS NULL OR a IS NULL AS is_bad FROM ("
    "SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS u, arg_min(text, turn) FILTER (role = 'assistant') AS a "
    "FROM conversations GROUP BY conv_id)"
)
SQL["chat_prompt_and_gold"] = (
    f"WITH {PAIRS} SELECT pair_id, CASE WHEN system IS NOT NULL THEN 'system=' || md5(system) || ';' ELSE '' END || "
    "'user=' || md5(question) AS prompt, md5(CASE WHEN turn % 4 = 0 THEN '{}' ELSE coalesce(answer, '{}') END) AS gold_md5, 1::BIGINT AS n_user FROM pairs"
)


def _block(role: str, content: str) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10)"


_TOOLS = "'List of tools: <|tool_list_start|>[search, {\"name\": \"sum\"}]<|tool_list_end|>'"
SQL["chat_template_render"] = (
    f"WITH {PAIRS} SELECT pair_id, md5({_block('system', f'coalesce(system, {lit(EXTRACTION_PROMPT)})')} || "
    f"{_block('user', 'question')} || {_block('assistant', f'coalesce(answer, {lit("null")})')}) AS training_md5, "
    f"md5('<s>' || {_block('system', f'CASE WHEN coalesce(system, {lit('')}) <> {lit('')} THEN system || chr(10) ELSE {lit('')} END || {_TOOLS}')} || "
    f"{_block('user', 'question')} || '<|im_start|>assistant' || chr(10)) AS asking_md5 FROM pairs"
)
_CONTENT = (
    "CASE turn % 5 WHEN 0 THEN text WHEN 1 THEN '{\"query\": ' || to_json(text)::VARCHAR || ', \"n\": 1.5, \"<at>\": [' || turn || ']}' "
    "WHEN 2 THEN '[' || to_json(text)::VARCHAR || ', null, true, 1000.0]' WHEN 3 THEN turn::VARCHAR ELSE 'null' END"
)
SQL["chat_json_content"] = (
    "WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'tool' ELSE role END AS role, "
    f"{_CONTENT} AS content FROM conversations) SELECT conv_id, turn, md5("
    + _block("system", "'List of tools: <|tool_list_start|>[search, {\"name\": \"sum\", \"max\": ' || turn || '.0}]<|tool_list_end|>'")
    + " || " + _block("user", "'ask'")
    + " || '<|im_start|>' || role || chr(10) || CASE WHEN role = 'tool' THEN '<|tool_response_start|>' || content || '<|tool_response_end|>' "
    "ELSE content END || '<|im_end|>' || chr(10)) AS rendered_md5 FROM c"
)
_WORDS = "list_filter(regexp_split_to_array({}, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]+'), lambda w: w <> '')"
SQL["context_filter"] = f"SELECT conv_id, turn FROM conversations WHERE len({_WORDS.format('text')}) <= 256"
SQL["audio_length_filter"] = (
    "SELECT conv_id, turn, CASE WHEN turn % 5 <> 0 THEN strlen(text) / 100.0::DOUBLE END AS seconds, "
    "CASE WHEN turn % 5 = 0 THEN 'broken header' ELSE 'ok' END AS status FROM conversations WHERE turn % 5 = 0 OR strlen(text) <= 300"
)
SQL["audio_manifest"] = (
    "SELECT conv_id, turn, 'system,user,assistant' AS roles, md5(text) AS text_md5, md5(text) AS audio_md5 FROM conversations "
    "WHERE role <> 'system' AND text <> '' AND turn % 5 <> 0 AND turn % 7 <> 0"
)

# --- Validation ---------------------------------------------------------------

# The leak patterns without look-ahead and with Unicode classes spelled out; each matches
# somewhere in a text exactly when the original does.
_D, _W, _S = "\\p{Nd}", "[\\p{L}\\p{M}\\p{Nd}\\p{Pc}]", "[\\s\\x0b\\x85\\p{Z}]"
_START, _END = f"(?:^|[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}])", f"(?:$|[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}])"
LEAKS = {
    "network_identifier": (
        f"(?:{_D}{{1,3}}\\.){{3}}{_D}{{1,3}}|[0-9A-Fa-f]{{2}}(?::[0-9A-Fa-f]{{2}}){{5}}|[0-9A-Fa-f]{{2}}(?:-[0-9A-Fa-f]{{2}}){{5}}"
        f"|(?:{_W}|-)\\.(?:local|internal|intranet){_END}"
        "|https?://[^\\s\\x0b\\x85\\p{Z}]|\\\\\\\\[^\\s\\x0b\\x85\\p{Z}]|smb://[^\\s\\x0b\\x85\\p{Z}]"
    ),
    "system_config": (
        f"/(?:var|etc|opt|home|srv|usr)/|[A-Za-z]:\\\\|\\.(?:log|ya?ml|conf|json|java|py|ini){_END}"
        f"|{_W}\\.{_W}+{_S}+(?:カラム|テーブル)"
        f"|\\*/?{_D}+{_S}+\\*{_S}+\\*{_S}+\\*"
    ),
    "financial_info": f"[¥$]{_S}?{_D}|{_D}[\\p{{Nd}},]*{_S}*(?:円|万円|億)|{_D}+(?:\\.{_D}+)?{_S}*%",
    "transaction_id": f"[A-Z]{{2,}}[-_]?{_D}{{2,}}|#{_D}{{3,}}|{_START}{_D}{{3,}}-{_D}{{2,}}",
}


def leak(text: str, category: str) -> str:
    return f"regexp_matches({text}, {lit(LEAKS[category])})"


SQL["leak_scan"] = "SELECT doc_id, " + ", ".join(f"{leak('text', c)} AS {c}" for c in LEAKS) + " FROM documents"
SQL["leak_scan_pages"] = "SELECT page_id, " + ", ".join(f"{leak('html', c)} AS {c}" for c in LEAKS) + " FROM pages"


def _contains_all(text: str) -> str:
    return f"len(list_filter(entities, lambda e: NOT contains({text}, e))) = 0"


SQL["verbatim_check"] = (
    f"WITH {GOLD}, e AS (SELECT row_id, input_text, replace(input_text, '7', '') AS shown, {' || '.join(FOUND)} AS entities FROM gold) "
    f"SELECT row_id, {_contains_all('input_text')} AS in_text, {_contains_all('shown')} AS in_changed_text FROM e"
)
SQL["clean_output"] = (
    "WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 3 THEN '''' || text || '\"' ELSE regexp_replace(regexp_replace("
    "text, '^[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+', ''), '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+$', '') END AS t FROM conversations) "
    "SELECT conv_id, turn, md5(t) AS clean_md5 FROM c"
)
SQL["pool_lines"] = (
    "WITH raw AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\x{2028}\\x{2029}]', chr(10), 'g'), chr(10))) AS ln, "
    "unnest(range(len(string_split(regexp_replace(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\x{2028}\\x{2029}]', chr(10), 'g'), chr(10))))) AS pos FROM documents), "
    "bare AS (SELECT doc_id, pos, regexp_replace(regexp_replace(ln, '^[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+', ''), '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+$', '') AS v FROM raw), "
    "firsts AS (SELECT doc_id, v, min(pos) AS pos FROM bare WHERE v <> '' GROUP BY ALL) "
    "SELECT doc_id, count(v) AS n, md5(coalesce(string_agg(v, chr(10) ORDER BY pos), '')) AS pool_md5 "
    "FROM documents LEFT JOIN firsts USING (doc_id) GROUP BY doc_id"
)

# --- Synthesis ----------------------------------------------------------------

_SUBTYPES = "subtypes(category, subtype) AS (VALUES " + ", ".join(
    f"('{c}', '{s}')" for c, subs in FORMATS.items() for s in subs
) + ")"
_SITUATIONS = (
    "situations AS (SELECT ["
    + ", ".join(lit(c) for c in SYNTHETIC_CATEGORIES)
    + "][conv_id % 4 + 1] AS category, conv_id * 1000000 + turn AS idx, text AS situation FROM conversations)"
)


def tasks(reps: int) -> str:
    return (
        f"{_SUBTYPES}, {_SITUATIONS}, tasks AS (SELECT concat_ws('/', category, subtype, idx::VARCHAR, "
        "CASE WHEN positive THEN 'pos' ELSE 'neg' END, rep::VARCHAR) AS task_id, category, subtype, idx, positive, situation "
        f"FROM subtypes JOIN situations USING (category), (VALUES (true), (false)) p(positive), (SELECT range AS rep FROM range({reps})) r)"
    )


SQL["synthesis_tasks"] = (
    f"WITH {tasks(2)} SELECT task_id, category AS category_key, subtype AS subtype_name, positive, md5(situation) AS situation_md5 FROM tasks"
)
SQL["synthesis_resume"] = f"WITH {tasks(1)} SELECT task_id FROM tasks WHERE NOT (positive AND idx % 3 = 0)"


def _part_sql(part: tuple) -> str:
    texts, low, n, scale, pad, commas, base = part
    listed = "NULL::VARCHAR[]" if texts is None else "[" + ", ".join(lit(t) for t in texts) + "]"
    return (
        f"{{'texts': {listed}, 'low': {low}::BIGINT, 'n': {n}::BIGINT, 'scale': {scale}::BIGINT, "
        f"'pad': {pad}, 'commas': {str(commas).lower()}, 'base': '{base}'}}"
    )


def _formats_cte() -> str:
    rows = []
    for _, subtype, cells, total in format_rows():
        below = 0
        for upto, parts in cells:
            rows.append(f"('{subtype}', {below}, {upto}, {total}, [{', '.join(_part_sql(p) for p in parts)}])")
            below = upto
    return "formats(subtype, low_ticket, upto, total, parts) AS (VALUES " + ", ".join(rows) + ")"


_NUMBER = f"((p.low + {draw(lit('part'), 'try_key', 'k - 1')} % p.n) * p.scale)"
_DIGITS = (
    f"CASE WHEN p.base = 'x' THEN lower(to_hex({_NUMBER})) WHEN p.base = 'X' THEN upper(to_hex({_NUMBER})) "
    f"WHEN p.commas THEN format('{{:,}}', {_NUMBER}) ELSE {_NUMBER}::VARCHAR END"
)
_PART_TEXT = (
    f"CASE WHEN p.base = 't' THEN p.texts[{draw(lit('part'), 'try_key', 'k - 1')} % p.n + 1] "
    f"WHEN length({_DIGITS}) < p.pad THEN lpad({_DIGITS}, p.pad, '0') ELSE {_DIGITS} END"
)


def entities(pooled: bool = False) -> str:
    """CTEs up to `made(task_id, entities)`."""
    in_pool = "subtype IN (" + ", ".join(lit(s) for s in POOLED_SUBTYPES) + ")" if pooled else "false"
    from_pool = f"subtype || '-' || {draw(lit('pool'), 'try_key')} % 30"
    values = (
        f"drawn AS (SELECT tries.*, parts FROM tries JOIN formats f ON f.subtype = tries.subtype "
        f"AND {draw(lit('format'), 'try_key')} % f.total >= f.low_ticket AND {draw(lit('format'), 'try_key')} % f.total < f.upto), "
        "pieces AS (SELECT task_id, t, wanted, subtype, try_key, unnest(parts) AS p, unnest(range(1, len(parts) + 1)) AS k FROM drawn), "
        f"written AS (SELECT task_id, t, wanted, subtype, try_key, string_agg({_PART_TEXT}, '' ORDER BY k) AS value FROM pieces GROUP BY ALL), "
        f"tried AS (SELECT task_id, t, wanted, CASE WHEN {in_pool} THEN {from_pool} ELSE value END AS value FROM written)"
    )
    return (
        f"{_formats_cte()}, {tasks(1)}, counted AS (SELECT task_id, subtype, positive, CASE WHEN {draw(lit('count'), 'task_id')} % 10 < 7 THEN 1 ELSE 2 END AS wanted "
        f"FROM tasks), numbered_tries AS (SELECT *, unnest(range(wanted * 2)) AS t FROM counted), "
        f"tries AS (SELECT *, task_id || ':' || t AS try_key FROM numbered_tries), {values}, "
        "firsts AS (SELECT task_id, wanted, value, min(t) AS t FROM tried GROUP BY ALL), "
        "kept AS (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY t) AS r FROM firsts), "
        "made AS (SELECT task_id, list(value ORDER BY t) AS entities FROM kept WHERE r <= wanted GROUP BY task_id)"
    )


SQL["synth_entities"] = (
    f"WITH {entities()} SELECT task_id, {json_list('entities')} AS entities FROM made WHERE task_id LIKE '%/pos/%'"
)
SQL["synth_entities_pooled"] = f"WITH {entities(pooled=True)} SELECT task_id, {json_list('entities')} AS entities FROM made"




def _joined_fill(template: str, **values: str) -> str:
    """Concatenation, so that braces inside a value are not filled again."""
    import re

    pieces = re.split(r"\{(\w+)\}", template)
    return " || ".join(values[p] if i % 2 else lit(p) for i, p in enumerate(pieces))


_EXAMPLES = " || chr(10) || ".join(f"'- ' || subtype || ' example {i}'" for i in range(4))
_PROMPT = (
    "CASE WHEN positive THEN "
    + _joined_fill(
        POSITIVE_PROMPT,
        situation="situation",
        description="replace(subtype, '_', ' ')",
        bullets="array_to_string(list_transform(entities, lambda v: '- ' || v), chr(10))",
    )
    + " ELSE "
    + _joined_fill(
        NEGATIVE_PROMPT, situation="situation", description="replace(subtype, '_', ' ')", bullets=_EXAMPLES
    )
    + " END"
)
PROMPTED = (
    f"{entities()}, prompted AS (SELECT tasks.*, entities, {_PROMPT} AS prompt FROM tasks JOIN made USING (task_id))"
)
SQL["task_prompts"] = (
    f"WITH {PROMPTED} SELECT task_id, {turns(('system', lit(WRITER_PROMPT)), ('user', 'prompt'))} AS chat FROM prompted"
)
_LEAKY = "CASE category " + " ".join(f"WHEN '{c}' THEN {leak('answer', c)}" for c in LEAKS) + " END"
JUDGED = (
    f"{PROMPTED}, answered AS (SELECT *, replace(prompt, '7', '') AS answer, length(prompt) % 13 = 0 AS failed FROM prompted), "
    f"reasoned AS (SELECT *, CASE WHEN positive AND {_contains_all('answer')} IS NOT TRUE THEN 'entity missing' "
    f"WHEN NOT positive AND {_LEAKY} THEN 'leak' END AS reason FROM answered), "
    "judged AS (SELECT task_id, category, subtype, positive, entities, answer, reason, CASE WHEN failed THEN 'error' WHEN reason IS NOT NULL THEN 'rejected' ELSE 'ok' END AS status, "
    "CASE WHEN positive THEN 'pos' ELSE 'neg' END AS polarity FROM reasoned)"
)
SQL["generate_validate"] = (
    f"WITH {JUDGED} SELECT task_id, status, polarity, CASE WHEN status = 'rejected' THEN reason END AS reason, "
    "CASE WHEN status = 'rejected' THEN 2 ELSE 1 END::BIGINT AS attempt FROM judged"
)
SQL["generation_outcomes"] = f"WITH {JUDGED} SELECT status, polarity, count(*) AS n FROM judged GROUP BY ALL"
_TASK_JSON = annotation_json(
    {c: f"CASE WHEN positive AND category = '{c}' THEN {json_list('entities')} ELSE '[]' END" for c in SYNTHETIC_CATEGORIES}
)
SQL["generation_log"] = (
    f"WITH {JUDGED} SELECT task_id, category, subtype, polarity, {_TASK_JSON} AS annotation_json, md5(answer) AS text_md5 "
    "FROM judged WHERE status = 'ok'"
)
SQL["incremental_generation"] = (
    f"WITH {JUDGED} SELECT category, polarity, count(*) AS n FROM judged WHERE status = 'ok' GROUP BY ALL"
)
SQL["batch_complete_stub"] = (
    f"SELECT item_id, md5(text) AS content_md5, 'offline' AS model, 'auto' AS provider, "
    f"(len({_WORDS.format('text')}) + 2)::BIGINT AS prompt_tokens, len({_WORDS.format('text')})::BIGINT AS completion_tokens, "
    "NULL::VARCHAR AS error FROM benchmark"
)
SQL["usage_totals"] = (
    "WITH t AS (SELECT length(text) AS n, length(text) % 13 = 0 AS failed FROM conversations) "
    "SELECT count(*) AS requests, sum(failed::INT)::BIGINT AS failures, sum(CASE WHEN failed THEN 0 ELSE n END)::BIGINT AS prompt_tokens, "
    "sum((NOT failed)::INT)::BIGINT AS completion_tokens, sum(CASE WHEN failed THEN 0 ELSE n + 1 END)::BIGINT AS total_tokens FROM t"
)

# --- Scorers and comparison ---------------------------------------------------

_N_WORDS = f"len({_WORDS.format('text')})"
LENGTH_SCORE = f"greatest(0.0::DOUBLE, 1 - abs({_N_WORDS} - 100)::DOUBLE / 100)"
_LOWER = _WORDS.format("lower(text)")
DIVERSITY_SCORE = f"CASE WHEN {_N_WORDS} > 0 THEN len(list_distinct({_LOWER}))::DOUBLE / {_N_WORDS} ELSE 0 END"


def coherence(table: str, key: str) -> str:
    """CTEs up to `coherence(key, score)`, comparing every pair of sentences."""
    return (
        f"sentences AS (SELECT {key}, unnest(range(len(parts))) AS s, list_distinct({_WORDS.format('lower(unnest(parts))')}) AS ws "
        f"FROM (SELECT {key}, string_split(text, '.') AS parts FROM {table})), "
        f"filled AS (SELECT {key}, s, ws, len(ws) AS n FROM sentences WHERE len(ws) > 0), "
        f"shared AS (SELECT a.{key}, avg(len(list_intersect(a.ws, b.ws))::DOUBLE / least(a.n, b.n)) AS mean "
        f"FROM filled a JOIN filled b ON a.{key} = b.{key} AND a.s < b.s GROUP BY a.{key}), "
        f"coherence AS (SELECT t.{key}, CASE WHEN contains(text, '.') AND mean IS NOT NULL THEN least(1.0, mean * 2) ELSE 0.5 END AS score "
        f"FROM {table} t LEFT JOIN shared o ON o.{key} = t.{key})"
    )


SQL["score_length"] = f"SELECT doc_id, round({LENGTH_SCORE}, 9) AS score FROM documents"
SQL["score_diversity"] = f"SELECT doc_id, round({DIVERSITY_SCORE}, 9) AS score FROM documents"
SQL["score_coherence"] = f"WITH {coherence('documents', 'doc_id')} SELECT doc_id, round(score, 9) AS score FROM coherence"
SQL["score_summary"] = (
    "WITH said AS (SELECT concat_ws(':', conv_id::VARCHAR, turn::VARCHAR) AS id, text FROM conversations), "
    f"{coherence('said', 'id')} SELECT 'response_length' AS metric, round(avg({LENGTH_SCORE}), 9) AS mean FROM said UNION ALL "
    f"SELECT 'diversity', round(avg({DIVERSITY_SCORE}), 9) FROM said UNION ALL SELECT 'coherence', round(avg(score), 9) FROM coherence"
)
SQL["comparison_markdown"] = (
    "SELECT doc_id AS prompt_id, '| ' || replace(text, '|', '\\|') || ' | ' || "
    "replace(replace(replace(text, 'e', 'E'), chr(10), ' '), '|', '\\|') || ' | ' || "
    "CASE WHEN doc_id % 10 = 0 THEN '' ELSE replace(replace(replace(text, ' ', '|'), chr(10), ' '), '|', '\\|') END || ' |' AS line FROM documents"
)
SQL["comparison_table"] = (
    "SELECT comparison, count(*) AS n, count(finetune) AS n_finetune, sum(length(coalesce(base, '')))::BIGINT AS base_characters FROM ("
    "SELECT 'second' AS comparison, replace(text, 'e', 'EE') AS base, CASE WHEN doc_id % 10 <> 0 THEN text END AS finetune FROM documents "
    "UNION ALL SELECT 'first', text, CASE WHEN doc_id % 10 <> 0 THEN text END FROM documents) GROUP BY comparison"
)
SQL["improvement_rate"] = (
    "WITH daily AS (SELECT user_id AS run_id, date_diff('day', DATE '2024-01-01', ts::DATE) AS step, event_type AS metric, "
    "round(avg(value), 6) AS value FROM events GROUP BY ALL), "
    "bounds AS (SELECT run_id, min(step) AS lo, max(step) AS hi FROM daily GROUP BY run_id) "
    "SELECT a.run_id, a.metric, a.value AS \"first\", b.value AS \"last\", round(CASE WHEN a.value <> 0 THEN "
    "(b.value - a.value) / abs(a.value) * 100 ELSE 0 END, 6) AS improvement FROM bounds "
    "JOIN daily a ON a.run_id = bounds.run_id AND a.step = lo JOIN daily b ON b.run_id = bounds.run_id AND b.step = hi "
    "AND b.metric = a.metric WHERE lo < hi"
)

# --- Audit --------------------------------------------------------------------

AUDIT = (
    "history AS (SELECT user_id AS run_id, event_id AS step, event_type AS metric, "
    "CASE WHEN event_type = 'purchase' AND value < 1 THEN NULL ELSE value END AS value FROM events), "
    "runs AS (SELECT user_id AS run_id, 'run ' || count(*) % 40 AS run_name, CASE arg_max(event_type, event_id) WHEN 'error' THEN 'failed' "
    "WHEN 'signup' THEN 'running' ELSE 'finished' END AS state FROM events GROUP BY user_id)"
)


def gate(required: list[str]) -> str:
    names = ", ".join(f"('{m}')" for m in required)
    return (
        f"gate AS (SELECT runs.run_id, q.metric, count(value) AS n, arg_min(value, step) FILTER (value IS NOT NULL) AS \"first\", "
        "arg_max(value, step) FILTER (value IS NOT NULL) AS \"last\", CASE WHEN count(history.step) = 0 THEN 'missing' "
        "WHEN count(value) = 0 THEN 'no samples' ELSE 'ok' END AS status "
        f"FROM runs CROSS JOIN (VALUES {names}) q(metric) LEFT JOIN history ON history.run_id = runs.run_id AND history.metric = q.metric "
        "GROUP BY runs.run_id, q.metric)"
    )


_THREE = ["click", "purchase", "refund"]
SQL["metric_gate"] = f"WITH {AUDIT}, {gate(_THREE)} SELECT * FROM gate"
SQL["metric_quantiles"] = (
    "SELECT event_type AS metric, count(*) AS n, min(value) AS least, max(value) AS most, true AS median_is_close FROM events "
    "WHERE NOT (event_type = 'purchase' AND value < 1) AND value IS NOT NULL GROUP BY event_type"
)
SQL["run_lookup"] = (
    f"WITH {AUDIT} SELECT run_name, count(*) AS matches, CASE WHEN count(*) = 1 THEN min(run_id) END AS run_id, "
    "CASE WHEN count(*) = 1 THEN 'found' ELSE 'ambiguous' END AS status FROM runs GROUP BY run_name"
)
SQL["run_verdict"] = (
    f"WITH {AUDIT}, {gate(_THREE[:2])}, bad AS (SELECT run_id FROM gate WHERE status <> 'ok' UNION ALL "
    "SELECT run_id FROM runs WHERE state NOT IN ('finished', 'running')), counts AS (SELECT run_id, count(*) AS n FROM bad GROUP BY run_id) "
    "SELECT run_id, state, coalesce(n, 0)::BIGINT AS n_failures, n IS NULL AS passed FROM runs LEFT JOIN counts USING (run_id)"
)
SQL["run_failures"] = (
    f"WITH {AUDIT}, {gate(_THREE)} SELECT run_id, 'metric ' || metric || ' ' || status AS failure FROM gate WHERE status <> 'ok' "
    "UNION ALL SELECT run_id, 'state ' || state FROM runs WHERE state <> 'finished'"
)
SQL["system_report"] = (
    "SELECT user_id AS run_id, count(DISTINCT event_id) AS rows, max((event_type = 'click')::INT) = 1 AS has_gpu FROM events GROUP BY user_id"
)
SQL["summary_flatten"] = (
    "SELECT event_id, 'meta/type' AS metric, event_type AS value FROM events WHERE event_type IS NOT NULL "
    "UNION ALL SELECT event_id, 'meta/user/id', user_id::VARCHAR FROM events WHERE user_id IS NOT NULL "
    "UNION ALL SELECT event_id, 'ids/event', event_id::VARCHAR FROM events WHERE event_id IS NOT NULL "
    "UNION ALL SELECT event_id, 'ids/user', user_id::VARCHAR FROM events WHERE user_id IS NOT NULL"
)
_LAST_STATE = "CASE arg_max(event_type, event_id) WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'finished' END"
_RUNS = f"r AS (SELECT user_id AS run_id, 'run ' || (count(*) % 40) AS run_name, {_LAST_STATE} AS state FROM events GROUP BY user_id)"
SQL["run_candidates"] = f"WITH {_RUNS} SELECT run_id, run_name, state FROM r WHERE run_name = 'run 0'"
SQL["run_found"] = f"WITH {_RUNS}, asked(asked, is_id) AS (VALUES ('1', true), ('-1', true), ('run 0', false), ('no such run', false)), " + (
    "hits AS (SELECT asked, count(DISTINCT run_id) AS matches, min(run_id::VARCHAR) AS only_id FROM asked LEFT JOIN r "
    "ON CASE WHEN is_id THEN run_id::VARCHAR = asked ELSE run_name = asked END GROUP BY asked) "
    "SELECT asked, matches, CASE WHEN matches = 1 THEN only_id END AS run_id, "
    "CASE matches WHEN 0 THEN 'missing' WHEN 1 THEN 'found' ELSE 'ambiguous' END AS status FROM hits"
)
SQL["gpu_metric_names"] = "SELECT DISTINCT 'gpu/' || user_id AS metric FROM events"
SQL["summary_values"] = (
    "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN json_extract_string(props, '$.k') END AS k FROM events"
)


def all_sql() -> dict[str, str]:
    return dict(SQL)
