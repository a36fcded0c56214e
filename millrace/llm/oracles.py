"""DuckDB SQL for the queries of this folder that SQL can state and run on whole tables."""

from __future__ import annotations

EXACT_DEDUP = """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS content FROM documents),
grouped AS (
    SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY content
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY content, doc_id) AS copy FROM hashed)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AND n.copy = 1 AS kept, n.text_sha256
FROM numbered n JOIN grouped g USING (content)
"""

WARC = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM payloads GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id != first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id != first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (payload_digest)
"""

TOPK = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT vec_id, generate_subscripts(v, 1) AS at, unnest(v) AS x, len(v) AS n FROM whole),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
    FROM parts q JOIN parts c ON q.at = c.at AND q.n = c.n AND q.vec_id != c.vec_id
    WHERE q.vec_id % 50 = 0
    GROUP BY q.vec_id, c.vec_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

LINES = r"""
WITH texts AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
parts AS (SELECT rn, doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM texts),
keyed AS (
    SELECT *, translate(trim(line, E' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM parts
),
firsts AS (SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key),
told AS (SELECT k.*, f.key IS NULL OR k.doc_id IS NOT DISTINCT FROM f.first_id AS stays FROM keyed k LEFT JOIN firsts f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM told GROUP BY rn
"""

FILL_IN_MIDDLE = r"""
WITH cut_up AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
),
drawn AS (
    SELECT *, len(tokens) AS n, ('0x' || h[1:8])::UBIGINT % (len(tokens) + 1) AS c1, ('0x' || h[9:16])::UBIGINT % (len(tokens) + 1) AS c2,
           ('0x' || h[17:24])::UBIGINT % 100 AS r3, ('0x' || h[25:32])::UBIGINT % 100 AS r4
    FROM cut_up
),
parts AS (
    SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r3 >= 90 THEN 'plain'
                   WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(tokens[1:least(c1, c2)], '') AS prefix,
           array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(tokens[greatest(c1, c2) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form != 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form != 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {
    "op5_exact_dedup": EXACT_DEDUP,
    "op8_arc_to_warc": WARC,
    "op9_topk": TOPK,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_line_dedup": LINES,
}
