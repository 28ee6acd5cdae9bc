"""Results of operators as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from newsloom.llm import filter_audit, hard_negatives, line_dedup

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

SQL: dict[str, str] = {}

_WHOLE = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"
_USABLE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
SQL["op11_hard_negatives"] = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         {_WHOLE} AS vector
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_USABLE}
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {hard_negatives.POSITIVES}
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER nearest AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {hard_negatives.LOW} * positive_score <= 100 * score
  AND 100 * score <= {hard_negatives.HIGH} * positive_score
WINDOW nearest AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER nearest <= {hard_negatives.NEGATIVES}"""

SQL["op12_line_dedup"] = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS position FROM split
), keyed AS (
  SELECT *, translate(trim(line, {BLANK}), {UPPER}, {LOWER}) AS key FROM placed
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= {line_dedup.LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS}
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (f.key IS NULL), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON f.key = k.key GROUP BY doc_id"""

_WORDS = (
    "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
)
_LETTERS = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"
SQL["op13_filter_audit"] = f"""
WITH said AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), failed AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < {filter_audit.LEAST_WORDS} THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < {filter_audit.LEAST_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(translate(text, {UPPER}, '')))
           > {filter_audit.MOST_CAPITALS_PERCENT} * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM said
), marked AS (
  SELECT part, mask, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM failed LEFT JOIN labels l USING (doc_id)
), counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marked GROUP BY ALL
), letters(letter, bit) AS {_LETTERS},
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit,
         CAST(list_sum(list_concat([0], bits[1:s - 1])) AS INTEGER) AS before
  FROM orders, range(1, 6) AS r(s)
), totals AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM totals"""
