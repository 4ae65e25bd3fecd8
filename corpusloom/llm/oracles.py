"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_chat_prefix_targets"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
sized AS (
  SELECT *, length('<|im_start|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 1
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|im_end|>') + 1 AS size
  FROM said
),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS upto,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

ORACLES["op3_token_count_rollups"] = r"""
WITH kept AS (
  SELECT *, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS copy FROM documents
)
SELECT source, lang, 'pieces' AS tokenizer, count(*) AS n_docs,
  CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r]'))) AS BIGINT) AS n_tokens
FROM kept WHERE copy = 1 GROUP BY source, lang
"""

ORACLES["op8_benchmark_decontamination"] = r"""
WITH ascii AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, list_aggregate(words[i : i + least(len(words), 10) - 1], 'string_agg', ' ') AS said,
    least(len(words), 10) AS width
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM items WHERE len(words) > 0)
),
places AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos, w.width
  FROM ascii, (SELECT DISTINCT width FROM windows) w
),
spans AS (
  SELECT doc_id, pos, width, list_aggregate(words[pos : pos + width - 1], 'string_agg', ' ') AS said
  FROM places WHERE pos + width - 1 <= len(words)
),
hits AS (SELECT doc_id, pos, s.width, item_id FROM spans s JOIN windows USING (said)),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + width)) AS word FROM (SELECT DISTINCT doc_id, pos, width FROM hits))
  GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT a.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM ascii a LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


ORACLES["op11_hard_negatives"] = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
