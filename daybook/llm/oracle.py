"""DuckDB statements whose rows the corpus queries must return."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH RECURSIVE cut AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM cut
), one AS MATERIALIZED (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) + any_value(y.n) AS both_n, count(*) AS c
  FROM one x JOIN one y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b FROM shared WHERE 100 * c >= 85 * (both_n - c)
), edge AS MATERIALIZED (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(d, r) AS (
  SELECT DISTINCT a, a FROM edge UNION SELECT reach.d, edge.b FROM reach JOIN edge ON edge.a = reach.r
)
SELECT sets.doc_id, len(s) AS n_shingles, least(sets.doc_id, coalesce(m.r, sets.doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT d, min(r) AS r FROM reach GROUP BY d) m ON m.d = sets.doc_id
"""

_OP2 = """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages
), told AS (
  SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM page
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM told
"""

_OP10 = r"""
WITH cut AS MATERIALIZED (
  SELECT doc_id, lang, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols
  FROM documents
), window3 AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut)
), again AS (
  SELECT doc_id, i FROM window3 QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + shift) AS n FROM again, (SELECT unnest([0, 1, 2]) AS shift) GROUP BY doc_id
), measured AS MATERIALIZED (
  SELECT cut.doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (doc_id)
), ratios AS MATERIALIZED (
  SELECT doc_id, lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) AS ratio, unnest([400, 300, 250, 400]) AS margin,
         unnest([n_symbols * 1000 // n_words, n_dup_lines * 1000 // n_lines, n_repeat_words * 1000 // n_words, word_chars * 100 // n_words]) AS x
  FROM measured WHERE n_words > 0
), sketch AS MATERIALIZED (
  SELECT lang, source, ratio, CASE WHEN x < 64 THEN x ELSE x - x % (1 << (length(ltrim(bin(x), '0')) - 6)) END AS bucket, count(*) AS n FROM ratios GROUP BY ALL
), top AS (
  SELECT ratio, bucket, sum(n) AS n FROM sketch GROUP BY ALL
), all_share AS (
  SELECT ratio, bucket, CAST(sum(n) OVER (PARTITION BY ratio ORDER BY bucket) AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY ratio) AS DOUBLE) AS share FROM top
), lang_n AS (
  SELECT lang, ratio, bucket, sum(n) AS n FROM sketch GROUP BY ALL
), lang_share AS (
  SELECT g.lang, g.ratio, a.bucket,
         (CAST(sum(coalesce(l.n, 0)) OVER (PARTITION BY g.lang, g.ratio ORDER BY a.bucket) AS DOUBLE) + 200 * a.share) / (CAST(g.texts AS DOUBLE) + 200) AS share
  FROM (SELECT lang, ratio, sum(n) AS texts FROM lang_n GROUP BY ALL) g JOIN all_share a ON a.ratio = g.ratio
  LEFT JOIN lang_n l ON l.lang IS NOT DISTINCT FROM g.lang AND l.ratio = g.ratio AND l.bucket = a.bucket
), own_share AS (
  SELECT g.lang, g.source, g.ratio, a.bucket,
         (CAST(sum(coalesce(s.n, 0)) OVER (PARTITION BY g.lang, g.source, g.ratio ORDER BY a.bucket) AS DOUBLE) + 200 * a.share) / (CAST(g.texts AS DOUBLE) + 200) AS share
  FROM (SELECT lang, source, ratio, sum(n) AS texts FROM sketch GROUP BY ALL) g JOIN lang_share a ON a.ratio = g.ratio AND a.lang IS NOT DISTINCT FROM g.lang
  LEFT JOIN sketch s ON s.lang IS NOT DISTINCT FROM g.lang AND s.source IS NOT DISTINCT FROM g.source AND s.ratio = g.ratio AND s.bucket = a.bucket
), quartile AS (
  SELECT lang, source, ratio, min(bucket) FILTER (share >= 0.25) AS q1, min(bucket) FILTER (share >= 0.75) AS q3 FROM own_share GROUP BY ALL
), beyond AS (
  SELECT DISTINCT r.doc_id FROM ratios r JOIN quartile q ON q.ratio = r.ratio AND q.lang IS NOT DISTINCT FROM r.lang AND q.source IS NOT DISTINCT FROM r.source
  WHERE r.x > q3 + greatest(4 * (q3 - q1), margin) OR r.ratio = 'word_length' AND r.x < q1 - greatest(4 * (q3 - q1), margin)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (FROM beyond) AS kept
FROM measured
"""

_OP12 = """
WITH sound AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), row AS (
  SELECT DISTINCT * FROM sound
), pair AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM row a JOIN row b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, vec_id, score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

_OP13 = r"""
WITH hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                         lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS h
  FROM documents
), cut AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed
), text AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
         ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS v
  FROM cut
), gram AS MATERIALIZED (
  SELECT doc_id, i, sha256(array_to_string(v[i + 1:i + 16], ' ')) AS g FROM (SELECT doc_id, v, unnest(range(n - 15)) AS i FROM text WHERE n >= 24)
), diagonal AS (
  SELECT y.doc_id, y.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i
), stretch AS MATERIALIZED (
  SELECT doc_id, q, min(i) - q AS s, count(*) + 15 + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM diagonal) GROUP BY doc_id, q, k
), run AS MATERIALIZED (
  SELECT * FROM stretch x WHERE l >= greatest(24, 3 * q)
  AND NOT EXISTS (FROM stretch y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)
), best AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DECIMAL(38, 20)) / q DESC, s, q) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM run GROUP BY doc_id
), word AS (
  SELECT doc_id, i, v[i + 1] AS x FROM (SELECT doc_id, v, unnest(range(n)) AS i FROM text)
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS c FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT text.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period, 1000 * best.l // best.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM text LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": _OP1,
    "op2_warc": _OP2,
    "op10_quality_rules": _OP10,
    "op12_hard_negatives": _OP12,
    "op13_periodic_runs": _OP13,
}
