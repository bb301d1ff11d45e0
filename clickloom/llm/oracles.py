"""SQL twins of this subpackage's queries, for DuckDB. The others are tested against brute force."""

from __future__ import annotations

_PARTS = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?(?:/([^/?#]*))?"

_OP3 = f"""
WITH parsed AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 13 % 365 AS INTEGER) AS fetched,
         NULLIF(regexp_extract(lower(url), '{_PARTS}', 1), '') AS host,
         regexp_extract(lower(url), '{_PARTS}', 2) AS section
  FROM pages
), p AS (
  SELECT * REPLACE (CASE WHEN length(host) <= 253 THEN host END AS host) FROM parsed
), entries AS (
  SELECT 'blocked' AS list, 'domain:' || host AS pattern, DATE '2024-01-01' + CAST(page_id * 29 % 365 AS INTEGER) AS day,
         (page_id // 5) % 3 <> 0 AS added
  FROM p WHERE page_id % 5 = 0 AND host IS NOT NULL
  UNION ALL
  SELECT 'spam', 'section:' || host || '/' || section, DATE '2024-01-01' + CAST(page_id * 29 % 365 AS INTEGER), (page_id // 7) % 2 = 0
  FROM p WHERE page_id % 7 = 0 AND host IS NOT NULL AND section <> ''
), daily AS (
  SELECT list, pattern, day, max(CAST(added AS INTEGER)) AS listed FROM entries GROUP BY ALL
), marked AS (
  SELECT *, coalesce(lag(listed) OVER w, 0) AS before FROM daily WINDOW w AS (PARTITION BY list, pattern ORDER BY day)
), spans AS (
  SELECT list, pattern, listed, day AS valid_from, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS valid_to
  FROM marked WHERE before <> listed
), labelled AS (
  SELECT *, string_split(host, '.') AS labels, row_number() OVER () AS capture FROM p
), candidates AS (
  SELECT capture, fetched, unnest(list_concat(
           list_transform(range(1, len(labels) + 1), lambda i: 'domain:' || array_to_string(labels[i:], '.')),
           CASE WHEN section <> '' THEN ['section:' || host || '/' || section] ELSE CAST([] AS VARCHAR[]) END)) AS pattern
  FROM labelled WHERE host IS NOT NULL
), hits AS (
  SELECT c.capture, s.list, s.pattern, s.valid_from,
         row_number() OVER (PARTITION BY c.capture ORDER BY s.list, s.pattern, s.valid_from) AS place, count(*) OVER (PARTITION BY c.capture) AS n
  FROM candidates c JOIN spans s ON s.listed = 1 AND s.pattern = c.pattern
   AND s.valid_from <= c.fetched AND (s.valid_to IS NULL OR c.fetched < s.valid_to)
)
SELECT l.page_id, l.url, CAST(l.fetched AS VARCHAR) AS fetched, l.host, coalesce(h.n, 0) AS n_matches, h.list || ' ' || h.pattern AS matched,
       CAST(h.valid_from AS VARCHAR) AS listed_since, h.n IS NOT NULL AS blocked
FROM labelled l LEFT JOIN hits h ON h.capture = l.capture AND h.place = 1
"""



_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP12 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), tokens AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), counts AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL
), terms AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), own AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), groups AS (
  SELECT lang, source, term, n,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p
  FROM own JOIN terms USING (lang)
), langs AS (
  SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (m + 2)) // (sum(m) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS m FROM counts GROUP BY lang, term) JOIN terms USING (lang)
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), ahead AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM groups JOIN langs USING (lang, term) WHERE n > 0 AND p > q
), every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM ahead
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""

_KEPT_VECTORS = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS (
  SELECT r, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x FROM kept, range(16) t(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, v) - 1 AS e, x FROM parts JOIN kept USING (r)
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id, v) <= 64
)"""


def _assigned(i: int) -> str:
    """Every part with its nearest entry; distance and index in one number, so the lower index wins a tie."""
    return f""", near{i} AS (
  SELECT s.r, s.p, min(list_sum(list_transform(s.x, lambda a, j: (a - b.x[j]) * (a - b.x[j]))) * 64 + b.e) AS best
  FROM parts s JOIN book{i} b ON b.p = s.p GROUP BY s.r, s.p
)"""


def _moved(i: int) -> str:
    """The entries as floored means of their parts; unused ones stay."""
    return f""", sums{i} AS (
  SELECT s.p, n.best % 64 AS e, j, sum(s.x[j]) AS total, count(*) AS n
  FROM near{i - 1} n JOIN parts s ON s.r = n.r AND s.p = n.p, unnest(range(1, len(s.x) + 1)) t(j) GROUP BY ALL
), means{i} AS (
  SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY j) AS x FROM sums{i} GROUP BY p, e
), book{i} AS (
  SELECT b.p, b.e, coalesce(CAST(m.x AS BIGINT[]), b.x) AS x FROM book{i - 1} b LEFT JOIN means{i} m ON m.p = b.p AND m.e = b.e
)"""


_OP13 = (
    _KEPT_VECTORS + _assigned(0) + _moved(1) + _assigned(1) + _moved(2) + _assigned(2)
    + """, coded AS (
  SELECT r, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error
  FROM near2 GROUP BY r
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded c JOIN kept k ON k.r = c.r
"""
)


def sql() -> dict[str, str]:
    return {"op3_url_filters": _OP3, "op12_source_divergence": _OP12, "op13_vector_codes": _OP13}
