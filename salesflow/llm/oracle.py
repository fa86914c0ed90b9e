"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from salesflow.llm.licenses import PHRASES, TEMPLATES, needed, THRESHOLD
from salesflow.llm.queries import CONTROL_CHAT, SHARDS, SLOTS

_SHARD_NAMES = ", ".join(f"'{name}'" for name in SHARDS)

ORACLE: dict[str, str] = {}

ORACLE["op1_sharding"] = f"""
WITH RECURSIVE names AS (
  SELECT i - 1 AS shard, [{_SHARD_NAMES}][i] AS shard_name FROM range(1, {len(SHARDS) + 1}) t(i)),
start AS (
  SELECT list(('0x' || substr(md5(shard_name || '/offset'), 1, 15))::BIGINT % {SLOTS} ORDER BY shard) AS firsts,
         list(('0x' || substr(md5(shard_name || '/skip'), 1, 15))::BIGINT % ({SLOTS} - 1) + 1 ORDER BY shard) AS steps
  FROM names),
fill AS (
  SELECT 0 AS turn, list_transform(range({SLOTS}), lambda x: -1) AS owner, -1::BIGINT AS slot FROM start
  UNION ALL
  SELECT turn + 1,
         list_concat(list_concat(owner[1:s.slot], [turn % {len(SHARDS)}]), owner[s.slot + 2:]), s.slot
  FROM fill, start, LATERAL (
    SELECT (firsts[turn % {len(SHARDS)} + 1] + j * steps[turn % {len(SHARDS)} + 1]) % {SLOTS} AS slot
    FROM range({SLOTS}) r(j)
    WHERE owner[(firsts[turn % {len(SHARDS)} + 1] + j * steps[turn % {len(SHARDS)} + 1]) % {SLOTS} + 1] = -1
    ORDER BY j LIMIT 1) s
  WHERE turn < {SLOTS}),
owners AS (SELECT slot, ((turn - 1) % {len(SHARDS)})::INTEGER AS shard FROM fill WHERE turn > 0)
SELECT d.doc_id, o.slot::INTEGER AS slot, o.shard, n.shard_name
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot
      FROM documents) d
JOIN owners o USING (slot) JOIN names n ON n.shard = o.shard
"""

_ESCAPED = "replace(%s, '\\', '\\\\')"
for _mark in ("<s>", "</s>", "[INST]", "[/INST]"):
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '{_mark[0]}\\{_mark[1:]}')"

ORACLE["op9_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_CHAT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_CHAT}'),
numbered AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length('<s>[INST] ') + length({_ESCAPED % 'role'}) + length(' [/INST] ')
             + length({_ESCAPED % 'text'}) + length('</s>')) OVER w AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM numbered GROUP BY conv_id
"""

_TEMPLATE_ROWS = ", ".join(
    f"('{label}', {sorted(set(text.split()))!r}, {needed(len(set(text.split())), THRESHOLD)})"
    for label, text in TEMPLATES)
_REACH = max(len(text.split()) for _, text in TEMPLATES) - 1  # words of a block beyond its line
_PHRASE_ROWS = ", ".join(f"({text.split()!r}, '{label}')" for text, label in PHRASES)
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

ORACLE["op5_licenses"] = f"""
WITH templates(label, words, least) AS (VALUES {_TEMPLATE_ROWS}),
phrases(words, label) AS (VALUES {_PHRASE_ROWS}),
lowered AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
worded AS (SELECT r, doc_id, regexp_extract_all(text, '{_WORD}') AS words FROM lowered),
places AS (
  SELECT r, p.label, unnest(list_filter(range(len(w.words)), lambda i: w.words[i + 1] = p.words[1]
                              AND w.words[i + 1:i + len(p.words)] = p.words)) AS place
  FROM worded w, phrases p WHERE list_has_all(w.words, p.words)),
base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         list(DISTINCT label) AS labels FROM places GROUP BY r),
counted AS (
  SELECT r, i, len(regexp_extract_all(string_split(text, chr(10))[i], '{_WORD}')) AS n
  FROM lowered, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i)),
begun AS (SELECT r, n, sum(n) OVER (PARTITION BY r ORDER BY i) - n AS start FROM counted WHERE n > 0),
blocks AS (SELECT r, words[start + 1:start + n + {_REACH}] AS words FROM begun JOIN worded USING (r)),
met AS (
  SELECT r, max(len(list_intersect(l.words, t.words)) / len(t.words)) AS score, list(DISTINCT label) AS labels
  FROM blocks l, templates t WHERE len(list_intersect(l.words, t.words)) >= t.least GROUP BY r)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
           list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(met.score, 0.0) END::DOUBLE AS score
FROM worded w LEFT JOIN base USING (r) LEFT JOIN met USING (r)
"""

ORACLE["op6_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
numbered AS (
  SELECT doc_id, i, lines[i] AS line FROM split, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)),
spans AS (
  SELECT doc_id, i AS first, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS last
  FROM numbered WHERE trim(line) <> ''),
ranked AS (
  SELECT doc_id, first, last,
         row_number() OVER (PARTITION BY array_to_string(lines[first:last], chr(10)) ORDER BY doc_id, first) AS place
  FROM spans JOIN split USING (doc_id) WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM ranked WHERE place > 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS lines
  FROM numbered n ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(len(string_split(d.text, chr(10))) - coalesce(k.lines, 0), 0)::BIGINT AS n_removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda c: NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
       positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""
