"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS window_text
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
copies AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY window_text ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM copies),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS window_text
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS window_text
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, item, n, i FROM doc_windows JOIN item_windows USING (n, window_text)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles),
sets AS (SELECT doc_id, list(s ORDER BY s) AS set, count(*) AS n FROM numbered GROUP BY doc_id),
classes AS (SELECT set, min(doc_id) AS rep, min(n) AS n FROM sets GROUP BY set),
members AS (SELECT doc_id, rep, sets.n FROM sets JOIN classes USING (set)),
rep_shingles AS (SELECT doc_id, s, n FROM numbered JOIN classes ON doc_id = rep),
ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r
  FROM (SELECT doc_id, s, n, count(*) OVER (PARTITION BY s) AS f FROM rep_shingles)),
prefixes AS (SELECT doc_id, s, n FROM ranked WHERE r <= n - (85 * n + 99) // 100 + 1),
candidates AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b
  FROM prefixes x JOIN prefixes y ON x.s = y.s AND x.doc_id < y.doc_id
  WHERE 100 * x.n >= 85 * y.n AND 100 * y.n >= 85 * x.n),
links AS (
  SELECT a, b
  FROM (SELECT a, b, ca.n AS na, cb.n AS nb, len(list_intersect(ca.set, cb.set)) AS shared
        FROM candidates JOIN classes ca ON ca.rep = a JOIN classes cb ON cb.rep = b)
  WHERE 100 * shared >= 85 * (na + nb - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (
  SELECT rep, rep FROM classes
  UNION
  SELECT node, b FROM reach JOIN edges ON other = a),
roots AS (SELECT node AS rep, min(other) AS root FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(members.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id,
       coalesce(root, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN members USING (doc_id) LEFT JOIN roots USING (rep)
"""

OP11 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
    WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
whole AS (SELECT 1.5::DOUBLE * sum(source_size) AS wanted, sum(weight) AS weight FROM s),
rounds(i, level) AS (
  SELECT 0, wanted / weight FROM whole
  UNION ALL
  SELECT i + 1, (SELECT (max(wanted) - coalesce(sum(CASE WHEN level * s.weight >= 2 * source_size THEN 2.0::DOUBLE * source_size END), 0))
                   / sum(CASE WHEN level * s.weight < 2 * source_size THEN s.weight END) FROM s, whole)
  FROM rounds WHERE i < (SELECT count(*) FROM s)),
levels AS (SELECT max(level) AS level FROM rounds),
targets AS (
  SELECT source, source_size, least(level * weight, 2.0::DOUBLE * source_size) AS target FROM s, levels),
chances AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST(('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')), 1, 13))
              AS UBIGINT) / 4503599627370496.0::DOUBLE AS chance
  FROM d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM chances
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN first < d.doc_id THEN 16 ELSE 0 END) AS mask
  FROM d JOIN firsts USING (t) LEFT JOIN l USING (doc_id)),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM masked GROUP BY part, mask),
f(name, own) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.name || b.name || c.name || x.name || e.name AS filter_order, [a.own, b.own, c.own, x.own, e.own] AS owns
  FROM f a JOIN f b ON b.own <> a.own JOIN f c ON c.own NOT IN (a.own, b.own)
    JOIN f x ON x.own NOT IN (a.own, b.own, c.own) JOIN f e ON e.own NOT IN (a.own, b.own, c.own, x.own)),
steps AS (
  SELECT filter_order, step, owns[step] AS own, CAST(coalesce(list_sum(owns[1 : step - 1]), 0) AS INTEGER) AS before
  FROM (SELECT filter_order, owns, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
audit AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own),
shapley AS (SELECT part, own, sum(removed) AS shapley FROM audit GROUP BY part, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM audit JOIN shapley USING (part, own)
"""

ORACLE = {"op1_substring_dedup": OP1, "op7_decontamination": OP7, "op9_minhash_dedup": OP9,
          "op11_source_mix": OP11, "op13_filter_audit": OP13}
