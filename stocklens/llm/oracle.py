"""SQL that gives the rows of the queries which SQL can express."""

from __future__ import annotations

from stocklens.llm.quality_rules import BASE_RULES, BLOCK, CURRENT, RULES, mask

_FAILURES = " + ".join(
    f"CASE WHEN {condition} THEN {1 << i} ELSE 0 END" for i, condition in enumerate(RULES.values())
)

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), places AS (
  SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d
), repeated AS (
  SELECT r, i FROM places
  QUALIFY count(*) OVER (PARTITION BY r, array_to_string(w[i:i + 7], ' ')) > 1
), covered AS (
  SELECT r, sum(n) AS n FROM (
    SELECT r, least(8, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -8)) AS n FROM repeated
  ) GROUP BY r
), lines AS (
  SELECT r, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d
), m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(list_sum(list_transform(range(0, CAST(ceil(len(w) / {BLOCK}.0) AS BIGINT)), lambda b: len(list_distinct(w[b * {BLOCK} + 1:b * {BLOCK} + {BLOCK}])))), 0) AS BIGINT) AS n_distinct_words,
         length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations
  FROM d JOIN lines USING (r) LEFT JOIN covered USING (r)
), f AS (SELECT *, CAST({_FAILURES} AS INTEGER) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & {mask(*BASE_RULES)} <> 0 AS base_failed,
       failures & {mask(*BASE_RULES)} = 0 AND bit_count(failures & {mask(*CURRENT.rules)}) <= {CURRENT.tolerated} AS kept,
       failures
FROM f
"""

MERKLE_MANIFEST = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
         coalesce(xor(list_reduce(
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
           CAST(4294967295 AS BIGINT)), 4294967295) % 5 = 0, false) AS hit
  FROM documents
), h AS (
  SELECT r, doc_id, source, hit,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS front,
         coalesce(strlen(text) || ':' || text, '-') AS behind,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered
  FROM d
), l AS (
  SELECT r, doc_id, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS s, leaf, v,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
  FROM (SELECT *, sha256(front || behind) AS leaf, sha256(front || CASE WHEN hit THEN lowered ELSE behind END) AS v FROM h)
), up(tier, s, p, d) AS (
  SELECT 0, s, p, leaf FROM l
  UNION ALL
  SELECT tier + 1, s, p // 16, sha256(string_agg(d, '' ORDER BY p))
  FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM up) WHERE n > 1 GROUP BY tier, s, p // 16
), sub AS (
  SELECT s AS p, arg_max(d, tier) AS d FROM up GROUP BY s
), over_(tier, p, d) AS (
  SELECT 0, p, d FROM sub
  UNION ALL
  SELECT tier + 1, p // 16, sha256(string_agg(d, '' ORDER BY p))
  FROM (SELECT *, count(*) OVER () AS n FROM over_) WHERE n > 1 GROUP BY tier, p // 16
), fold(r, tier, s, p, v, beside) AS (
  SELECT r, 0, s, p, v, '' FROM l
  UNION ALL
  SELECT f.r, f.tier + 1, f.s, f.p // 16, sha256(string_agg(CASE WHEN u.p = f.p THEN f.v ELSE u.d END, '' ORDER BY u.p)),
         f.beside || coalesce(string_agg(u.d, '' ORDER BY u.p) FILTER (WHERE u.p <> f.p), '')
  FROM fold f JOIN up u ON u.tier = f.tier AND u.s = f.s AND u.p // 16 = f.p // 16
  WHERE EXISTS (SELECT 1 FROM up q WHERE q.tier = f.tier + 1 AND q.s = f.s)
  GROUP BY f.r, f.tier, f.s, f.p, f.v, f.beside
), folded(r, tier, p, v, beside) AS (
  SELECT r, 0, s, arg_max(v, tier), arg_max(beside, tier) FROM fold GROUP BY r, s
  UNION ALL
  SELECT f.r, f.tier + 1, f.p // 16, sha256(string_agg(CASE WHEN u.p = f.p THEN f.v ELSE u.d END, '' ORDER BY u.p)),
         f.beside || coalesce(string_agg(u.d, '' ORDER BY u.p) FILTER (WHERE u.p <> f.p), '')
  FROM folded f JOIN over_ u ON u.tier = f.tier AND u.p // 16 = f.p // 16
  WHERE EXISTS (SELECT 1 FROM over_ q WHERE q.tier = f.tier + 1)
  GROUP BY f.r, f.tier, f.p, f.v, f.beside
), ends AS (
  SELECT r, arg_max(v, tier) AS v, arg_max(beside, tier) AS beside FROM folded GROUP BY r
), top AS (SELECT arg_max(d, tier) AS root FROM over_)
SELECT l.doc_id, l.leaf, sub.d AS subroot, root, sha256(ends.beside) AS proof_sha256,
       ends.v AS folded_root, ends.v = root AS verified
FROM l JOIN ends USING (r) JOIN sub ON sub.p = l.s CROSS JOIN top
"""
