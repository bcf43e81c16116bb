"""DuckDB SQL of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKING = rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms)) AS words FROM d),
tf AS (SELECT u, term, count(*) AS tf FROM (SELECT u, unnest(terms) AS term FROM d) GROUP BY ALL),
i AS (
  SELECT u, item_id, unnest(list_distinct(terms)) AS term
  FROM (
    SELECT row_number() OVER () AS u, item_id,
           regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark
  )
),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total WHERE term IN (SELECT term FROM i) GROUP BY term, docs
),
m AS (SELECT u, doc_id, 10 + (90::HUGEINT * len(terms) * docs) // words AS m FROM d, total WHERE words > 0),
scored AS (
  SELECT i.u, i.item_id, m.u AS v, m.doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.u = tf.u
  GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score
FROM (
  SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
WHERE rank <= 10
"""

SOURCES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
words AS (SELECT u, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT u) >= 30),
whole AS (SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS n FROM seen GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 5)) // (coalesce(t.n, 0) + 5 * w.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (w.n + 5 * w.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN whole w USING (lang)
  LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(g.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
