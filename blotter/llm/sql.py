"""Oracle SQL (DuckDB) of the numbered operators that SQL can express."""

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

QUALITY_RULES = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM split WHERE len(w) >= 3
), grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM windows
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id
), full_lines AS (
  SELECT doc_id, unnest(lines) AS line FROM split
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM full_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT s.doc_id,
         CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM split s LEFT JOIN dup d USING (doc_id) LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 AS r1, 100 * n_repeat_words > 50 * n_words AS r2, 10 * n_symbols > n_words AS r3,
         100 * n_dup_lines > 30 * n_lines AS r4, word_chars > 15 * n_words AS r5,
         10 * word_chars < 25 * n_words AS r6
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       r1 OR r2 AS base_failed,
       NOT (r1 OR r2 OR r3 OR r5) AS kept,
       CAST(r1::INT + 2 * r2::INT + 4 * r3::INT + 8 * r4::INT + 16 * r5::INT + 32 * r6::INT AS BIGINT) AS fail_bits
FROM judged
"""

FILTER_AUDIT = r"""
WITH RECURSIVE letters(f, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), walks(filter_order) AS (
  SELECT ''
  UNION ALL
  SELECT filter_order || f FROM walks, letters WHERE NOT contains(filter_order, f)
), orders AS (
  SELECT filter_order FROM walks WHERE length(filter_order) = 5
), texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), counted AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
         min(doc_id) OVER (PARTITION BY t) AS first_id
  FROM texts
), flags AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
), masks AS (
  SELECT part,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
           + 4 * (100 * capitals > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > first_id, false)::INT AS mask,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM counted LEFT JOIN flags USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masks GROUP BY part, mask
), steps AS (
  SELECT filter_order, CAST(k AS INT) AS step, bit,
         (SELECT CAST(coalesce(sum(l.bit), 0) AS INT) FROM letters l
          WHERE contains(substr(filter_order, 1, k - 1), l.f)) AS before
  FROM orders, range(1, 6) r(k), letters WHERE f = substr(filter_order, k, 1)
), counts AS (
  SELECT part, filter_order, step, bit,
         CAST(sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counts
"""

ORACLE_SQL: dict[str, str] = {
    "op11_filter_audit": FILTER_AUDIT,
    "op1_exact_dedup": EXACT_DEDUP,
    "op7_quality_rules": QUALITY_RULES,
}
