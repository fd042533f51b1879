"""DuckDB SQL for the operators that SQL can express.

Patterns and thresholds are stated here a second time, on purpose.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g
          FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) t(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
judged AS (
  SELECT r, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n, len(regexp_extract_all(x, '[#*$%&|<>]')) AS symbols,
         len(regexp_extract_all(x, '[!?]{2,}')) AS shouts,
         len(regexp_extract_all(x, ' [|»›·] |^[|»›·] | [|»›·]$')) AS bars,
         regexp_matches(x, '(?i)(lorem ipsum|enable javascript|javascript is (?:disabled|required)|uses cookies|cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|click here to|subscribe to our newsletter|sign up for our|share on (?:facebook|twitter))') AS stock
  FROM lines),
by_line AS (
  SELECT r, count(*) FILTER (WHERE n > 0) - count(DISTINCT x) FILTER (WHERE n > 0) AS dups, sum(length(x)) AS chars,
         coalesce(sum(length(x)) FILTER (WHERE n > 0 AND ((n >= 2 AND (3 * symbols >= 2 * n OR 2 * shouts >= n))
                                                          OR bars >= 2 OR stock)), 0) AS lost
  FROM judged GROUP BY r),
counted AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, dups AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
         chars, lost
  FROM d JOIN w USING (r) JOIN by_line USING (r) LEFT JOIN repeats USING (r)),
failing AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 30 * chars AS kept, CAST(lost AS BIGINT) AS lost_chars
FROM failing"""

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
             regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
sized AS (SELECT *, least(13, len(ws)) AS m FROM b WHERE len(ws) > 0),
patterns AS (SELECT DISTINCT item, m, array_to_string(ws[i:i + m - 1], ' ') AS g
             FROM (SELECT item, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM sized)),
widths AS (SELECT DISTINCT m FROM patterns),
places AS (SELECT r, i, m, array_to_string(ws[i:i + m - 1], ' ') AS g
           FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, widths WHERE len(ws) >= m)),
hits AS (SELECT r, i, m, item FROM places JOIN patterns USING (m, g)),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
             FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS common FROM shingles x JOIN shingles y USING (g)
          WHERE x.doc_id != y.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
          WHERE 100 * common >= 75 * (a.n + b.n - common)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.other),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (SELECT doc_id, t, ls, len(ls) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                  CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS m FROM hashed),
parts AS (SELECT *, array_to_string(ls[1:p], '') AS pre, array_to_string(ls[p + 1:m], '') AS mid,
                 array_to_string(ls[m + 1:n], '') AS suf FROM cuts),
formed AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                          WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM parts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM formed"""

ORACLE = {"op4_decontamination": DECONTAMINATION, "op6_odd_sketch": NEAR_DUPLICATES, "op10_quality_rules": QUALITY,
          "op11_fill_in_middle": FILL_IN_MIDDLE}
