"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH item AS (
    SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark
), pattern AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS m,
        unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
            lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS window_text
    FROM item WHERE len(w) > 0
), doc AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS}, []) AS w FROM documents
), length AS (
    SELECT DISTINCT m FROM pattern
), place AS (
    SELECT r, m, unnest(range(1, (len(w) - m + 2)::BIGINT)) AS i, w FROM doc, length WHERE len(w) >= m
), found AS (
    SELECT r, i, place.m, item_id FROM place JOIN pattern
    ON pattern.m = place.m AND pattern.window_text = array_to_string(w[i : i + place.m - 1], ' ')
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, i, m FROM found)) GROUP BY r
), item_list AS (
    SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN item_list USING (r)
"""


_CLASSES = (r"[^a-z]+", r"[^\p{Lu}]+", r"[\x00-\x7F\p{Lu}]+", r"[^0-9]+", r"[^\x20\x09-\x0D]+", r"""[^.,;:!?''"()-]+""")
_COUNTS = ", ".join(f"length(regexp_replace(t, '{p}', '', 'g')) AS c{i}" for i, p in enumerate(_CLASSES))
_N = len(_CLASSES)
_REST = "length(t) - " + " - ".join(f"c{i}" for i in range(_N))


def _part(a: str, b: str) -> str:
    return f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({a} + {b})) ELSE 0 END"


def _both(a: str, b: str) -> str:
    return f"({_part(a, b)} + {_part(b, a)}) / 2"


OP9 = rf"""
WITH d0 AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), large AS (
    SELECT lang FROM (
        SELECT lang, lower(trim(x, '.,;:!?()[]{{}}#*$%&|<>-')) AS f
        FROM (SELECT lang, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS x FROM d0 WHERE lang IS NOT NULL)
    ) WHERE f <> '' GROUP BY lang HAVING count(*) >= 2000
), d AS (
    SELECT r, doc_id, CASE WHEN lang IN (SELECT lang FROM large) THEN lang END AS ref, t FROM d0
), counted AS (
    SELECT r, doc_id, ref, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, {_COUNTS},
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM d
), rows_ AS (SELECT *, {_REST} AS c{_N}, length(t)::DOUBLE AS chars, len(ws) AS n FROM counted
), tok AS (
    SELECT r, ref, lower(trim(x, '.,;:!?()[]{{}}#*$%&|<>-')) AS f
    FROM (SELECT r, ref, unnest(ws) AS x FROM rows_)
), cnt AS (
    SELECT ref, f, count(*)::DOUBLE AS n FROM tok WHERE f <> '' AND ref IS NOT NULL GROUP BY ALL
    UNION ALL SELECT NULL, f, count(*)::DOUBLE FROM tok WHERE f <> '' GROUP BY ALL
), tot AS (SELECT ref, sum(n) AS total FROM cnt GROUP BY ref
), common AS (
    SELECT cnt.ref, f, n / total AS q FROM cnt JOIN tot ON cnt.ref IS NOT DISTINCT FROM tot.ref WHERE n >= 0.005 * total
), refs AS (
    SELECT *, 0.85 * sqrt(greatest(0, q_all / 2 + {_both('1.0::DOUBLE', '(1 - q_all)')})) AS word_limit
    FROM (SELECT ref, sum(q) AS q_all FROM common GROUP BY ref)
), present AS (
    SELECT r, sum(c) AS c_all, sum(q) AS q_seen, sum({_both('(c / n)', 'q')}) AS js
    FROM (SELECT tok.r, tok.ref, tok.f, count(*)::DOUBLE AS c FROM tok GROUP BY ALL) x
    JOIN common ON common.ref IS NOT DISTINCT FROM x.ref AND common.f = x.f JOIN (SELECT r, n FROM rows_) USING (r) GROUP BY r
), by_word AS (
    SELECT r, coalesce(js, 0) + (q_all - coalesce(q_seen, 0)) / 2
        + {_both('((n - coalesce(c_all, 0)) / n)', 'greatest(0, 1 - q_all)')} AS js, word_limit
    FROM rows_ JOIN refs ON refs.ref IS NOT DISTINCT FROM rows_.ref LEFT JOIN present USING (r) WHERE n > 0
), class_refs AS (
    SELECT ref, {', '.join(f'sum(c{i}) / sum(chars) AS q{i}' for i in range(_N + 1))} FROM rows_ WHERE ref IS NOT NULL GROUP BY ref
    UNION ALL SELECT NULL, {', '.join(f'sum(c{i}) / sum(chars)' for i in range(_N + 1))} FROM rows_
), by_class AS (
    SELECT r, {' + '.join(_both(f'(c{i} / chars)', f'q{i}') for i in range(_N + 1))} AS js
    FROM rows_ JOIN class_refs ON class_refs.ref IS NOT DISTINCT FROM rows_.ref WHERE chars > 0
), win AS (
    SELECT r, i, ws[i : i + 2] AS w FROM (SELECT r, ws, unnest(range(1, (n - 1)::BIGINT)) AS i FROM rows_ WHERE n >= 3)
), twin AS (SELECT r, w FROM win GROUP BY r, w HAVING count(*) > 1
), again AS (
    SELECT r, count(DISTINCT p) AS n_repeat FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM win JOIN twin USING (r, w)) GROUP BY r
), base AS (
    SELECT r, doc_id, n, chars, len(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat
    FROM rows_ LEFT JOIN again USING (r)
)
SELECT doc_id, n::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
    n_repeat::BIGINT AS n_repeat_words, n < 50 OR 100 * n_repeat > 50 * n AS base_failed,
    NOT (n < 50 OR 100 * n_repeat > 50 * n) AND NOT (n >= 100 AND coalesce(sqrt(greatest(0, by_word.js)), 0) > word_limit)
        AND NOT (chars >= 400 AND coalesce(sqrt(greatest(0, by_class.js)), 0) > 0.3) AS kept
FROM base LEFT JOIN by_word USING (r) LEFT JOIN by_class USING (r)
"""



def _round(i: int) -> str:
    """Clusters of all vectors for the centroids c<i>, and, as c<i+1>, their floored means."""
    return f"""
d{i} AS MATERIALIZED (
    SELECT r, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM vec, c{i}
), a{i} AS MATERIALIZED (
    SELECT r, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
), s{i} AS (
    SELECT c, j, sum(x) AS s, count(*)::HUGEINT AS n
    FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS j FROM a{i} JOIN vec USING (r)) GROUP BY c, j
), c{i + 1} AS MATERIALIZED (
    SELECT c{i}.c, coalesce(m, w) AS w FROM c{i} LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS m FROM s{i} GROUP BY c) t ON t.c = c{i}.c
)"""


OP11 = f"""
WITH vec AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS w
    FROM (SELECT sha256(concat('2:', vec_id)) AS h, v FROM vec ORDER BY h, v LIMIT 40)
), {", ".join(_round(i) for i in range(6))}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a5 JOIN vec USING (r) JOIN c5 USING (c)
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(strlen({value}::VARCHAR), ':', {value}) END"


def _leaf(n_chars: str) -> str:
    return f"sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))}))"


_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _levels(name: str, leaves: str) -> str:
    """Nodes (g, level, pos, n, h) of all levels over `leaves` (g, pos, n, h)."""
    return f"""{name} AS (
    SELECT g, 0 AS level, pos, n, h FROM {leaves}
    UNION ALL
    SELECT g, level + 1, pos // 2, (n + 1) // 2, sha256(concat(h, after))
    FROM (SELECT *, lead(h) OVER (PARTITION BY g ORDER BY pos) AS after FROM {name} WHERE n > 1) WHERE pos % 2 = 0
)"""


def _folded(name: str, start: str, nodes: str) -> str:
    """Rows of `start` (r, g, pos, h, proof) with their siblings in `nodes`, one row a level climbed."""
    return f"""{name} AS (
    SELECT r, g, 0 AS level, pos, h, proof FROM {start}
    UNION ALL
    SELECT r, f.g, f.level + 1, f.pos // 2, sha256(CASE WHEN f.pos % 2 = 0 THEN concat(f.h, s.h) ELSE concat(s.h, f.h) END), concat(proof, s.h)
    FROM {name} f JOIN {nodes} own ON own.g = f.g AND own.level = f.level AND own.pos = f.pos AND own.n > 1
    LEFT JOIN {nodes} s ON s.g = f.g AND s.level = f.level AND s.pos = xor(f.pos, 1)
)"""


OP13 = f"""
WITH RECURSIVE leaf AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_leaf("n_chars")} AS leaf,
        CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS altered
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaf
), {_levels("tree", "placed")}, sub AS MATERIALIZED (
    SELECT 0 AS g, g AS pos, count(*) OVER () AS n, h FROM tree WHERE n = 1
), {_levels("upper", "sub")}, top AS MATERIALIZED (SELECT h AS root FROM upper WHERE n = 1
), start AS (SELECT r, g, pos, altered AS h, '' AS proof FROM placed
), {_folded("climbed", "start", "tree")}, done AS MATERIALIZED (
    SELECT r, 0 AS g, g AS pos, h, proof FROM climbed QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1
), {_folded("climbed_on", "done", "upper")}, ended AS MATERIALIZED (
    SELECT r, h, proof FROM climbed_on QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256, ended.h AS folded_root, ended.h = root AS verified
FROM placed JOIN ended USING (r) JOIN sub ON sub.pos = placed.g CROSS JOIN top
"""


OP12 = rf"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, {_CRC32} % 10 = 0 AS held_out,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), token AS MATERIALIZED (
    SELECT r, held_out, unnest(list_concat(ws, [' end'])) AS w, unnest(list_concat([' begin'], ws)) AS u FROM d
), uni AS MATERIALIZED (SELECT w, count(*) AS c FROM token WHERE NOT held_out GROUP BY w
), size AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM uni
), pair AS MATERIALIZED (SELECT u, w, count(*) AS c FROM token WHERE NOT held_out GROUP BY u, w
), disc AS (
    SELECT coalesce(n1 / nullif(n1 + 2 * n2, 0), 0.5) AS d
    FROM (SELECT count(*) FILTER (c = 1) AS n1, CASE WHEN count(*) FILTER (c = 1) = 0 THEN NULL ELSE count(*) FILTER (c = 2) END AS n2 FROM pair)
), ctx AS MATERIALIZED (SELECT u, sum(c)::BIGINT AS total, count(*) AS followers FROM pair GROUP BY u
), event AS (
    SELECT r, uni.c AS c, (coalesce(uni.c, 0) + 0.1::DOUBLE) / (size.n + 0.1::DOUBLE * (size.v + 1)) AS p1, pair.c AS pc, total, followers, d
    FROM token CROSS JOIN size CROSS JOIN disc LEFT JOIN uni USING (w) LEFT JOIN pair ON pair.u = token.u AND pair.w = token.w
    LEFT JOIN ctx ON ctx.u = token.u
), coded AS (
    SELECT r, c, round(-log10(p1) * 4294967296)::BIGINT AS base, CASE
        WHEN pc IS NOT NULL THEN least(65535, round_even(-log10((pc - d) / total + d * followers / total * p1) * 4096, 0))
        ELSE least(65535, round_even(-log10(p1) * 4096, 0))
            + CASE WHEN total IS NULL THEN 0 ELSE least(65535, round_even(-log10(d * followers / total) * 4096, 0)) END END::BIGINT AS code
    FROM event
), added AS (
    SELECT r, count(*) AS n_tokens, count(c) AS n_known, -sum(base)::DOUBLE / 4294967296 AS base_score, -sum(code)::DOUBLE / 4096 AS score
    FROM coded GROUP BY r
)
SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, base_score, score FROM d JOIN added USING (r) CROSS JOIN size
"""

SQL = {
    "op1_benchmark_decontamination": OP1,
    "op9_quality_divergence": OP9,
    "op11_subvector_clusters": OP11,
    "op12_trie_scores": OP12,
    "op13_merkle_manifest": OP13,
}
