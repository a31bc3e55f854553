"""DuckDB statements for the operators that SQL can express."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS t
  FROM (SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, s, dw.n, item_id FROM dw JOIN win ON dw.t = win.t AND dw.n = win.n),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN ids USING (rid)
"""

OP3 = """
WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, sqrt(n) / sum(sqrt(n)) OVER () * CAST(sum(n) OVER () AS DOUBLE) / n AS rate FROM s),
cdf AS (
  SELECT source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM r, (SELECT unnest(generate_series(0, 200)) AS k)),
u AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
         (CAST(('0x' || substr(md5('20240501|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|1'), 1, 13)) AS BIGINT) + 0.5)
           / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents),
n AS (SELECT rid, count(*) AS copies FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= u.u GROUP BY rid)
SELECT doc_id, u.source, round(rate, 6) AS rate, CAST(copies AS INTEGER) AS copies, copy,
       md5('20240501:order|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || copy) AS shuffle_key, text
FROM (SELECT rid, copies, CAST(unnest(generate_series(1, copies)) AS INTEGER) AS copy FROM n)
JOIN u USING (rid) JOIN r ON r.source IS NOT DISTINCT FROM u.source
"""

OP6 = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH d AS (SELECT * FROM (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS HUGEINT) AS n_docs, CAST(sum(len(w)) AS HUGEINT) AS n_terms FROM d),
m AS (SELECT rid, doc_id, 75 + (25 * CAST(len(w) AS HUGEINT) * n_docs) // n_terms AS m FROM d, s),
q AS (SELECT row_number() OVER () AS q, item_id, w FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text, {_TERMS} AS w FROM benchmark)),
qt AS (SELECT q, t, count(*) AS c FROM (SELECT q, unnest(w) AS t FROM q) GROUP BY q, t),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY rid, t),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS HUGEINT) AS w
       FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
sc AS (SELECT q, rid, doc_id, CAST(sum(c * w * ((CAST(1000000000 AS HUGEINT) * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
       FROM tf JOIN m USING (rid) JOIN wt USING (t) JOIN qt USING (t) GROUP BY q, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) JOIN q USING (q)
WHERE rank <= 20
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
each AS (SELECT rid, lang, source, unnest(w) AS t FROM d),
k AS (SELECT lang, t, CAST(count(*) AS HUGEINT) AS n FROM each GROUP BY lang, t HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, t, CAST(count(*) AS HUGEINT) AS n FROM each JOIN k USING (lang, t) GROUP BY lang, source, t),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS c, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (gn.n + 5 * v.v) AS p,
             1 + (1000000000 * (k.n + 5)) // (v.n + 5 * v.v) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN gn USING (lang, source) LEFT JOIN c USING (lang, source, t)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, sum(abs(x.p - y.p)) AS f
             FROM p x JOIN p y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY ALL) z
  ON z.lang = a.lang AND z.s = a.source AND z.o = b.source),
terms AS (SELECT lang, source, t AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms) WHERE rank <= 50
"""
