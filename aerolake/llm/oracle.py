"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+?)\.?(?:[:/?#]|$)', 1))"
_REST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1)"


def _hex(column: str, start: int, size: int) -> str:
    return f"('0x' || substr(md5({column}), {start}, {size}))::BIGINT"


_ROWS = f"""
WITH cap AS (
  SELECT row_number() OVER () AS r, page_id, {_HOST} AS host, {_REST} AS rest,
         TIMESTAMP '2024-01-01' + to_hours(CAST({_hex("coalesce(CAST(page_id AS VARCHAR), '')", 1, 7)} % 8784 AS INT)) AS t
  FROM pages),
hosts AS (SELECT DISTINCT host AS p FROM cap WHERE host != ''),
urls AS (SELECT DISTINCT host || rest AS p FROM cap WHERE host != ''),
domains AS (SELECT DISTINCT regexp_extract(p, '([^.]+\\.)?[^.]+$') AS p FROM hosts),
h AS (SELECT p, {_hex('p', 2, 3)} % 200 AS a, {_hex('p', 5, 3)} % 60 + 20 AS b, {_hex('p', 8, 3)} % 90 + 10 AS c
      FROM hosts WHERE {_hex('p', 1, 1)} < 10),
spans AS (
  SELECT 'hosts' AS l, 'host' AS k, p, a AS lo, a + b AS hi FROM h
  UNION ALL SELECT 'hosts', 'host', p, a + b + c, 100000 FROM h
  UNION ALL SELECT 'urls', 'url', p, {_hex('p', 2, 3)} % 366, 100000 FROM urls WHERE {_hex('p', 1, 1)} = 0
  UNION ALL SELECT 'domains', 'domain', p, {_hex('p', 1, 3)} % 300, {_hex('p', 1, 3)} % 300 + 7 FROM domains),
keys AS (
  SELECT r, t, 'url' AS k, host || rest AS p FROM cap WHERE host != ''
  UNION ALL SELECT r, t, 'host', host FROM cap WHERE host != ''
  UNION ALL SELECT r, t, 'domain', array_to_string(string_split(host, '.')[i:], '.')
  FROM cap, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i) WHERE host != ''),
hits AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT l, ',' ORDER BY l) AS lists, min(lo) AS since
  FROM keys JOIN spans USING (k, p)
  WHERE t >= TIMESTAMP '2024-01-01' + to_days(CAST(lo AS INT)) AND t < TIMESTAMP '2024-01-01' + to_days(CAST(hi AS INT))
  GROUP BY r)
SELECT page_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS fetched_at, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_active,
       coalesce(lists, '') AS lists, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(since AS INT)), '%Y-%m-%d') AS listed_since
FROM cap LEFT JOIN hits USING (r)
"""

_AUDIT = r"""
WITH d AS (SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT part, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
label AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN coalesce(doc_id > least, false) THEN 16 ELSE 0 END AS mask,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN label USING (doc_id)),
n AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (
  SELECT filter_order, step, 1 << (strpos('ABCDE', filter_order[step]) - 1) AS bit,
         list_sum([1 << (strpos('ABCDE', x) - 1) FOR x IN string_split(filter_order[1:step - 1], '') IF x != '']) AS done
  FROM o, (SELECT unnest(range(1, 6)) AS step))
SELECT part, filter_order, CAST(step AS INT) AS step,
       CAST(coalesce(sum(n) FILTER (mask & (bit | coalesce(done, 0)) = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (mask & bit != 0 AND mask & coalesce(done, 0) = 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (mask & bit != 0 AND mask & coalesce(done, 0) != 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(good) FILTER (mask & bit != 0 AND mask & coalesce(done, 0) = 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(toxic) FILTER (mask & bit != 0 AND mask & coalesce(done, 0) = 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & bit != 0), 0) AS BIGINT) AS shapley
FROM n, s GROUP BY part, filter_order, step
"""

ORACLE_SQL: dict[str, str] = {"op3_url_temporal_lists": _ROWS, "op11_filter_audit": _AUDIT}
