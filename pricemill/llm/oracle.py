"""SQL of the corpus queries that SQL can express, each written from the query's contract."""

from __future__ import annotations

_OP3 = r"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS run
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS run
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM words, sizes WHERE len(w) >= size)
), found AS (
  SELECT p.doc_id, p.i, p.size, x.item FROM places p JOIN windows x ON p.size = x.size AND p.run = x.run
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS j FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP4 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS run
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM words WHERE len(w) >= 50)
), firsts AS (
  SELECT run, min(doc_id) AS first_id FROM places GROUP BY run
), gone AS (
  SELECT DISTINCT p.doc_id, unnest(generate_series(p.i, p.i + 49)) AS j
  FROM places p JOIN firsts f USING (run) WHERE f.first_id < p.doc_id
), each_word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM words
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.j) AS text, count(*) AS n
  FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

_OP8 = """
WITH parts AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_OP12 = """
WITH parts AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

_OP13 = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM words GROUP BY text
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(first_id < words.doc_id, false) AS e
  FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), failed AS (
  SELECT part, good, toxic, concat(CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
    CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END) AS fails, count(*) AS n
  FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letters a JOIN letters b ON a.x <> b.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1 : step - 1] AS before
  FROM orders, unnest(generate_series(1, 5)) AS s(step)
), met AS (
  SELECT *, contains(fails, own) AS hit, length(translate(fails, before, '')) < length(fails) AS gone FROM failed, steps
), found AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (NOT gone AND NOT hit) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
    sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (fails = own) AS unique_fails,
    sum(n) FILTER (hit AND NOT gone AND good) AS good_lost, sum(n) FILTER (hit AND NOT gone AND toxic) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM found
"""

_OP11_RULED = r"""
WITH hosts AS MATERIALIZED (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), ruled AS MATERIALIZED (
  SELECT page_id, host, path, CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM hosts
), urls AS MATERIALIZED (
  SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS verdict,
    CASE WHEN path IN ('', '/') THEN ['$'] WHEN len(s) > 8 THEN list_append(s[1:8], '**') ELSE list_append(s, '$') END AS shape
  FROM (SELECT *, string_split(regexp_replace(replace(replace(regexp_replace(path, '^/', ''), '$', '%24'), '*', '%2A'), '[0-9]+', '#', 'g'), '/') AS s FROM ruled)
), w0 AS MATERIALIZED (
  SELECT host, shape, count(*) AS n, count(*) FILTER (verdict = 'block') AS bad, count(*) FILTER (verdict = 'allow') AS good, '' AS template
  FROM urls GROUP BY host, shape
)"""

_OP11_LEVEL = r""", h{l} AS MATERIALIZED (
  SELECT *, shape[{next}] AS child, substr(md5(array_to_string(list_transform(shape[{next} + 1 :], lambda x: regexp_replace(x, '[^#$*]+', 'w', 'g')), ' ')), 1, 1) AS follows
  FROM w{l}
), x{l} AS MATERIALIZED (
  SELECT host, template, child, 'shape' AS kind, follows AS class, sum(n) AS x FROM h{l} WHERE child NOT IN ('$', '**') GROUP BY ALL
  UNION ALL SELECT host, template, child, 'label', 'bad', sum(bad) FROM h{l} WHERE child NOT IN ('$', '**') GROUP BY ALL
  UNION ALL SELECT host, template, child, 'label', 'good', sum(good) FROM h{l} WHERE child NOT IN ('$', '**') GROUP BY ALL
), c{l} AS MATERIALIZED (
  SELECT host, template, child, sum(x) AS n, count(*) OVER (PARTITION BY host, template) AS children, sum(sum(x)) OVER (PARTITION BY host, template) AS whole
  FROM x{l} WHERE kind = 'shape' GROUP BY host, template, child
), p{l} AS MATERIALIZED (
  SELECT host, template, kind, class, sum(x) AS whole FROM x{l} GROUP BY ALL
), d{l} AS MATERIALIZED (
  SELECT c.host, c.template, c.child, p.kind, CAST(coalesce(x.x, 0) AS DOUBLE) AS x, CAST(p.whole - coalesce(x.x, 0) AS DOUBLE) AS y,
    sum(CAST(coalesce(x.x, 0) AS DOUBLE)) OVER (PARTITION BY c.host, c.template, c.child, p.kind) AS a,
    sum(CAST(p.whole - coalesce(x.x, 0) AS DOUBLE)) OVER (PARTITION BY c.host, c.template, c.child, p.kind) AS b
  FROM c{l} c JOIN p{l} p ON c.host = p.host AND c.template = p.template
  LEFT JOIN x{l} x ON x.host = c.host AND x.template = c.template AND x.child = c.child AND x.kind = p.kind AND x.class = p.class
), t{l} AS MATERIALIZED (
  SELECT host, template, child, sum(abs(x / a - y / b)) / 2 AS distance, sum((x * b - y * a) * (x * b - y * a) / (x + y)) / any_value(a * b) AS chi,
    CAST(greatest(count(*) - 1, 1) AS DOUBLE) AS df
  FROM d{l} WHERE a > 0 AND b > 0 AND x + y > 0 GROUP BY host, template, child, kind
), n{l} AS MATERIALIZED (
  SELECT c.host, c.template, c.child, true AS named FROM c{l} c LEFT JOIN t{l} t ON t.host = c.host AND t.template = c.template AND t.child = c.child
  GROUP BY c.host, c.template, c.child, n, children, whole
  HAVING children = 1 OR 64 * n >= whole AND coalesce(bool_or(distance > 0.1 AND chi > df * pow(1 - 2 / (9 * df) + 3.09 * sqrt(2 / (9 * df)), 3)), false)
), w{next} AS MATERIALIZED (
  SELECT h.host, shape, n, bad, good, CASE WHEN h.child IS NULL THEN h.template
    ELSE h.template || '/' || CASE WHEN h.child IN ('$', '**') OR named THEN h.child ELSE '*' END END AS template
  FROM h{l} h LEFT JOIN n{l} k ON k.host = h.host AND k.template = h.template AND k.child = h.child
)"""

_OP11_JUDGED = r""", judged AS (
  SELECT host, template, sum(bad) AS blocked, sum(good) AS allowed FROM w{last} GROUP BY host, template
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN 100 * (blocked + 1) >= 80 * (blocked + allowed + 2) THEN 'block' ELSE 'allow' END) AS verdict,
  template, CAST(blocked AS BIGINT) AS blocked, CAST(allowed AS BIGINT) AS allowed
FROM urls JOIN w{last} USING (host, shape) JOIN judged USING (host, template)
"""

#: A level of the tree after the other: eight segments and the end.
_OP11 = _OP11_RULED + "".join(_OP11_LEVEL.replace("{l}", str(k)).replace("{next}", str(k + 1)) for k in range(9)) + _OP11_JUDGED.replace("{last}", "9")

ORACLES: dict[str, str] = {
    "op3_decontamination": _OP3,
    "op4_substrings": _OP4,
    "op8_topk": _OP8,
    "op11_urls": _OP11,
    "op12_negatives": _OP12,
    "op13_audit": _OP13,
}
