"""The corpus queries that SQL can express, over the whole table, for DuckDB.

Both ask, for every window of a text, which is the least doc_id with the same window, and cut what
windows of a smaller id cover. No index: every window is a row, which small tables allow.
"""

from __future__ import annotations

OP2 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents
), windows AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)
), least_ids AS (
    SELECT s, min(doc_id) AS least_id FROM windows GROUP BY s
), removed AS (
    SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM windows JOIN least_ids USING (s) WHERE least_id < doc_id
), words AS (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM docs
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY j) AS k FROM words ANTI JOIN removed USING (r, j) GROUP BY r
), counts AS (
    SELECT r, count(*) AS n FROM removed GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM docs LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)
"""

# bytes are two hex digits each; a text is first cut to parts, since a place in a long string is slow to find
OP10 = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), parts AS (
    SELECT r, doc_id, 512 * c AS base, substring(h, 1024 * c + 1, 1122) AS p FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 1024 + 1)) AS c FROM docs)
), windows AS (
    SELECT r, doc_id, base + i AS i, substring(p, 2 * i + 1, 100) AS s FROM (SELECT r, doc_id, base, p, unnest(range(0, least(512, length(p) // 2 - 49))) AS i FROM parts)
), least_ids AS (
    SELECT s, min(doc_id) AS least_id FROM windows GROUP BY s
), hits AS (
    SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step FROM windows JOIN least_ids USING (s) WHERE least_id < doc_id
), numbered AS (
    SELECT r, i, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS span FROM hits
), spans AS (
    SELECT r, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, span
), counts AS (
    SELECT r, count(*) AS spans, sum(b - a) AS n FROM spans GROUP BY r
), gaps AS (
    SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL SELECT r, coalesce(max(b), 0), max(length(h) // 2) FROM docs LEFT JOIN spans USING (r) GROUP BY r
), kept AS (
    SELECT r, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gaps JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM docs JOIN kept USING (r) LEFT JOIN counts USING (r)
"""

ORACLES = {"op2_fm_substring_dedup": OP2, "op10_suffix_array_dedup": OP10}
