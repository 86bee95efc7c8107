"""The same results as SQL for DuckDB, where SQL can express an operator on whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), named AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM parts
), rules(rule, host, start, verdict) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
         ('com/de/', 'com', '/de/', 'block')
), ranked AS (
  SELECT n.page_id, n.host, n.path, r.rule, r.verdict,
         row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.host) DESC NULLS LAST, length(r.start) DESC) AS place
  FROM named n LEFT JOIN rules r
    ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.start)
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM ranked WHERE place = 1
"""

_REACH = """
, reach(a, b) AS (
  SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
"""

ORACLES["op3_ngram_jaccard_join"] = (
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
           ELSE list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), linked AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)
)"""
    + _REACH
    + """
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""
)

ORACLES["op8_embedding_near_dedup"] = (
    """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
    ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9
)"""
    + _REACH
    + """, counts AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
       least(v.vec_id, coalesce(l.b, v.vec_id)) = v.vec_id AS kept
FROM embeddings v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least l ON l.a = v.vec_id
"""
)

ORACLES["op11_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), steps AS (
  -- A source stays below its cap once the level of all with a greater cap per weight does.
  SELECT *, sum(words) OVER () - coalesce(sum(3 * words) OVER before, 0) AS share,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest
  FROM sources
  WINDOW before AS (ORDER BY words / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT share, rest FROM steps WHERE share * weight <= 3 * words * rest ORDER BY rest DESC LIMIT 1
), targets AS (
  SELECT s.source, s.words, CAST(CASE WHEN l.share * s.weight > 3 * s.words * l.rest THEN 3 * s.words
              ELSE (2 * l.share * s.weight + l.rest) // (2 * l.rest) END AS BIGINT) AS goal,
         CASE WHEN l.share * s.weight > 3 * s.words * l.rest THEN CAST(3 * s.words AS DOUBLE)
              ELSE CAST(l.share * s.weight AS DOUBLE) / CAST(l.rest AS DOUBLE) END AS target
  FROM sources s, level l
), placed AS (
  SELECT d.doc_id, d.size, t.words AS source_size, t.target,
         CASE WHEN t.words = 0 THEN 0 ELSE least(t.goal, 3 * t.words) // t.words END AS whole,
         CASE WHEN t.words = 0 THEN 0 ELSE least(t.goal, 3 * t.words) % t.words END AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""

ORACLES["op12_merkle_manifest"] = r"""
WITH RECURSIVE checked AS (
  -- CRC-32 of the decimal id, bit by bit.
  SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
              string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda k: (CAST(ascii(c) AS BIGINT) >> k) & 1)))),
              lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1)))) AS crc
  FROM documents
), written AS (
  SELECT doc_id, lang, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found
  FROM checked
), leaves AS (
  SELECT doc_id, coalesce('s' || lang, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(found) || ':' || found, '-')) AS now
  FROM written
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS width
  FROM leaves
), nodes(tree, level, pos, width, digest) AS (
  SELECT tree, 0, pos, width, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 8, (width + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE width > 1 GROUP BY tree, level, pos // 8, width
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM nodes WHERE width = 1
), top(level, pos, width, digest) AS (
  SELECT 0, place, trees, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (width + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE width > 1 GROUP BY level, pos // 8, width
), sides AS (
  SELECT tree, level, n.pos, coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos < n.pos), '') AS before,
         coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos > n.pos), '') AS behind
  FROM nodes n JOIN nodes m USING (tree, level) WHERE n.pos // 8 = m.pos // 8 AND n.width > 1 GROUP BY ALL
), top_sides AS (
  SELECT level, n.pos, coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos < n.pos), '') AS before,
         coalesce(string_agg(m.digest, '' ORDER BY m.pos) FILTER (m.pos > n.pos), '') AS behind
  FROM top n JOIN top m USING (level) WHERE n.pos // 8 = m.pos // 8 AND n.width > 1 GROUP BY ALL
), up(doc_id, leaf, first, tree, level, pos, digest, proof) AS (
  SELECT doc_id, leaf, now, tree, 0, pos, now, '' FROM placed
  UNION ALL
  SELECT u.doc_id, u.leaf, u.first, u.tree, u.level + 1, u.pos // 8, sha256(s.before || u.digest || s.behind), u.proof || s.before || s.behind
  FROM up u JOIN sides s ON s.tree = u.tree AND s.level = u.level AND s.pos = u.pos
), risen AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, leaf, first, tree ORDER BY level DESC) AS last FROM up
), over(doc_id, leaf, subroot, level, pos, digest, proof) AS (
  SELECT r.doc_id, r.leaf, s.digest, 0, s.place, r.digest, r.proof FROM risen r JOIN subroots s USING (tree) WHERE r.last = 1
  UNION ALL
  SELECT o.doc_id, o.leaf, o.subroot, o.level + 1, o.pos // 8, sha256(t.before || o.digest || t.behind), o.proof || t.before || t.behind
  FROM over o JOIN top_sides t ON t.level = o.level AND t.pos = o.pos
)
SELECT o.doc_id, o.leaf, o.subroot, r.digest AS root, sha256(o.proof) AS proof_sha256, o.digest AS folded_root, o.digest = r.digest AS verified
FROM over o, (SELECT level, digest FROM top WHERE width = 1) r
WHERE o.level = r.level
"""
