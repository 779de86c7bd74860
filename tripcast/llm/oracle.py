"""DuckDB SQL of the operators' queries that SQL expresses, over the same tables.

The other queries (tokens, profiles, splitters, tool calls) are tested against
plain Python in tests/llm.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = f"""
texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lists AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM texts),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i, len(ws) AS n FROM lists)"""

OP1 = f"""WITH {_WORDS},
windows AS (SELECT doc_id, i, w, n, CASE WHEN i + 13 <= n THEN string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) END AS win FROM words),
firsts AS (SELECT win, min(doc_id) AS first FROM windows WHERE win IS NOT NULL GROUP BY win),
judged AS (SELECT doc_id, i, w, coalesce(first < doc_id, false) AS bad FROM windows LEFT JOIN firsts USING (win)),
covered AS (SELECT doc_id, i, w, bool_or(bad) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM judged),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT gone), '') AS k FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (doc_id)"""

_BOILER = "cookie policy|privacy policy|terms of use|terms of service|all rights reserved|javascript|lorem ipsum|sign up for|subscribe to our|click here|log in to|powered by|follow us on"

OP3 = rf"""WITH {_WORDS},
grams AS (SELECT doc_id, i, n, CASE WHEN i + 5 <= n THEN string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) END AS g FROM words),
many AS (SELECT doc_id, i, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM grams),
cover AS (SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM many),
repeats AS (SELECT doc_id, count(*) FILTER (c) AS n_repeat_words FROM cover GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS p FROM texts),
parts AS (SELECT doc_id, l, p, regexp_extract_all(l, '{_WORD}') AS ws, row_number() OVER (PARTITION BY doc_id, l ORDER BY p) AS turn FROM lines),
rules AS (SELECT *, len(ws) AS n,
  100 * (length(l) - length(regexp_replace(l, '[!?#*$%&|<>=_~^@{{}}\[\]\\/+]', '', 'g'))) >= 30 * len(ws) AS marks,
  len(ws) >= 10 AND NOT regexp_matches(ws[-1], '([.!?"'')\]:;]|[^\x00-\x7F])$') AS open,
  100 * len(list_filter(ws, lambda x: x IN ('|', '>', '-', '*', '/'))) >= 20 * len(ws) AS menu,
  regexp_matches(l, '(?i){_BOILER}') AS boiler FROM parts),
failed AS (SELECT *, n > 0 AND (marks OR open OR menu OR boiler) AS bad FROM rules),
sums AS (SELECT doc_id, count(*) FILTER (n > 0 AND turn > 1) AS n_dup_lines, coalesce(sum(n) FILTER (bad), 0)::BIGINT AS n_lost_words,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (NOT bad), '')) AS clean_sha256 FROM failed GROUP BY doc_id),
base AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols FROM lists),
whole AS (SELECT *, coalesce(n_repeat_words, 0) AS r FROM base LEFT JOIN repeats USING (doc_id) LEFT JOIN sums USING (doc_id)),
verdict AS (SELECT *, n_words < 10 OR 100 * r > 20 * n_words AS failed FROM whole)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, r AS n_repeat_words, failed AS base_failed,
  NOT failed AND 100 * n_lost_words <= 30 * n_words AS kept, n_lost_words, clean_sha256 FROM verdict"""

OP4 = f"""WITH RECURSIVE {_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")},
grams AS (SELECT doc_id, i, n, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g FROM words),
sets AS (SELECT DISTINCT doc_id, g FROM grams WHERE i + 5 <= n OR (n < 5 AND i = 0)),
sizes AS (SELECT doc_id, count(*) AS s FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 85 * (p.s + q.s - shared)),
ways AS MATERIALIZED (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(node, low) AS (SELECT x, x FROM ways UNION SELECT w.y, r.low FROM reach r JOIN ways w ON w.x = r.node WHERE r.low < w.y),
least AS (SELECT node AS doc_id, min(low) AS low FROM reach GROUP BY node)
SELECT doc_id, coalesce(s, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""

OP6 = f"""WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p FROM documents),
keys AS (SELECT *, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM lines),
often AS (SELECT k FROM keys WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, l, p, k IN (SELECT k FROM often) AS gone FROM keys)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

OP7 = """WITH RECURSIVE good AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x),
reach(node, low) AS (SELECT x, x FROM links UNION SELECT w.y, r.low FROM reach r JOIN links w ON w.x = r.node WHERE r.low < w.y),
least AS (SELECT node AS vec_id, min(low) AS low FROM reach GROUP BY node)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)"""

OP12 = f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
lists AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
  + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT
  + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(first < l.doc_id, false)::INT AS fails FROM lists l LEFT JOIN known USING (doc_id)),
counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM docs GROUP BY part, fails),
letters AS (SELECT chr(65 + i::INT) AS c, (1 << i::INT) AS bit FROM range(5) r(i)),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT filter_order, s::INT AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before FROM orders, range(1, 6) r(s)),
sums AS (SELECT part, filter_order, step, bit,
  sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN fails & before <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN g ELSE 0 END) AS good_lost,
  sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN x ELSE 0 END) AS toxic_lost FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM sums"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1, "op3_quality_rules": OP3, "op4_minhash_dedup": OP4, "op6_line_dedup": OP6, "op7_embedding_dedup": OP7,
            "op12_filter_audit": OP12}
