"""The same queries in DuckDB SQL, in the plain form, where SQL can state them."""

OP9 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.w, d.w), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.r <> q.r
), r AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
"""

OP2 = """
WITH a AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), c AS (
  SELECT *, regexp_replace(regexp_replace(host, '^(?:www|m)\\.', ''), ':(?:80|443)$', '')
    || regexp_replace(regexp_replace(path, '/{2,}', '/', 'g'), '(?:\\.html)?/?$', '') AS page,
    len(list_intersect(string_split(host, '.'),
      ['ads-track', 'free-bets', 'cheap-pills', 'spam-farm', 'casino-win', 'adult-x'])) > 0 AS bad
  FROM a
), r(action, rule, name, start) AS (
  VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
    ('block', 'net/fr/', 'net', '/fr/')
)
SELECT page_id, host, path, m.rule, coalesce(m.action, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM (
  SELECT c.*, page IN (SELECT page FROM c WHERE bad) AS listed,
    (SELECT max_by({'rule': rule, 'action': action}, length(rule)) FROM r
     WHERE (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)) AS m
  FROM c
)
"""

OP7 = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS position
  FROM conversations WHERE conv_id IS NOT NULL
), a AS (  -- the last two answers of each conversation
  SELECT conv_id, position AS last, lead(text) OVER w AS stale, row_number() OVER w AS n
  FROM t WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY position DESC)
), p AS (
  SELECT t.*, last, stale FROM t JOIN a USING (conv_id) WHERE n = 1 AND stale IS NOT NULL AND position <= last
), f AS (  -- both sides differ in the last answer alone, if at all
  SELECT *, '<|' || role || '|>' || chr(10) AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body,
    replace(stale, '<|', '< |') || '<|end|>' || chr(10) AS other
  FROM p
)
SELECT conv_id AS pair_id, CAST(max(last) - 1 AS INTEGER) AS prompt_turns,
  coalesce(string_agg(head || body, '' ORDER BY position) FILTER (position < last), '') AS prompt,
  max(head || body) FILTER (position = last) AS chosen,
  max(head || other) FILTER (position = last) AS rejected,
  max(length(head) || ':' || (length(head || body) - 1)) FILTER (position = last) AS chosen_mask,
  max(length(head) || ':' || (length(head || other) - 1)) FILTER (position = last) AS rejected_mask
FROM f GROUP BY conv_id HAVING max(text <> stale) FILTER (position = last)
"""

OP11 = """
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), d AS (
  SELECT *, len(terms) AS n, count(*) OVER () AS total, CAST(sum(len(terms)) OVER () AS BIGINT) AS length FROM t WHERE len(terms) > 0
), p AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(total) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM p JOIN d USING (r) GROUP BY term
), i AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), s AS (
  SELECT item_id, i.text, r, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * total) // length)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN d USING (r) GROUP BY item_id, i.text, r
), o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50
"""

OP13 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x,
    embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fine
  FROM embeddings
), u AS (
  SELECT r, vec_id, x, sqrt(list_sum(list_transform(x, lambda a: a * a))) AS length FROM v WHERE fine
), links AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r
    AND list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) / (a.length * b.length) >= 0.95
), reached AS (
  SELECT r, r AS other FROM v UNION SELECT reached.r, links.b FROM reached JOIN links ON reached.other = links.a
), c AS (
  SELECT reached.r, min(v.vec_id) AS component_id FROM reached JOIN v ON reached.other = v.r GROUP BY reached.r
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = v.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN c USING (r)
"""
