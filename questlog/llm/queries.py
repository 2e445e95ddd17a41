"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .html import op4_html
from .language import op5_language
from .negatives import op11_negatives
from .ngrams import op13_ngrams
from .packing import op6_packing
from .pieces import op3_pieces
from .privacy import op9_privacy
from .quality import op10_quality
from .simhash import op1_simhash
from .sketch import op8_sketch
from .spelling import op12_spelling
from .toolcalls import op7_toolcalls
from .topk import op2_topk

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_topk": op2_topk,
    "op3_pieces": op3_pieces,
    "op4_html": op4_html,
    "op5_language": op5_language,
    "op6_packing": op6_packing,
    "op7_toolcalls": op7_toolcalls,
    "op8_sketch": op8_sketch,
    "op9_privacy": op9_privacy,
    "op10_quality": op10_quality,
    "op11_negatives": op11_negatives,
    "op12_spelling": op12_spelling,
    "op13_ngrams": op13_ngrams,
}

# Trained models, hashes, tokenizers and HTML are beyond DuckDB's SQL: those queries are tested against brute force.
ORACLE: dict[str, str] = {
    "op2_topk": """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.row <> q.row),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5""",
    "op11_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.w, c.w) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.row <> a.row),
positives AS (
  SELECT anchor, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same QUALIFY place <= 5)
SELECT s.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5""",
    "op7_toolcalls": """
WITH m AS (SELECT conv_id, turn, role, text, count(*) AS copies FROM conversations GROUP BY ALL),
r AS (SELECT * FROM m WHERE role = 'assistant' AND turn > 0),
u AS (SELECT * FROM m WHERE role = 'user'),
every AS (
  SELECT u.conv_id, u.turn, CASE WHEN r.turn IS NULL THEN 'no_result' ELSE 'linked' END AS status, u.text IS NOT NULL AS valid, u.copies,
    '{"arguments":{"text":' || coalesce(CAST(to_json(u.text) AS VARCHAR), 'null') || ',"turn":' || u.turn || '},"depends_on":' ||
    CASE WHEN u.turn > 1 THEN '["' || u.conv_id || ':' || (u.turn - 2) || '"]' ELSE '[]' END ||
    ',"id":"' || u.conv_id || ':' || u.turn || '","name":"reply","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS json
  FROM u LEFT JOIN r ON u.conv_id = r.conv_id AND r.turn = u.turn + 1
  UNION ALL
  SELECT conv_id, turn, CASE WHEN role = 'assistant' AND turn > 0 THEN 'orphan_result' ELSE 'message' END, NULL, copies,
    '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}'
  FROM m WHERE role <> 'user' AND NOT (role = 'assistant' AND turn > 0
    AND EXISTS (SELECT 1 FROM u WHERE u.conv_id = m.conv_id AND u.turn = m.turn - 1)))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, turn,
  conv_id || ':' || (turn - CASE WHEN status = 'orphan_result' THEN 1 ELSE 0 END) AS id, status, valid, copies, json
FROM every""",
}
