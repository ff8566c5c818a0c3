"""SQL equivalents of the queries that SQL can express."""

from __future__ import annotations

from gaugeline.llm.line_dedup import ALONE, WINDOW
from gaugeline.llm.url_filter import LIMIT, UPPER, UrlRules


def _weight(vocabulary: dict[str, float]) -> str:
    """The weights of the different terms in ``low``, added up."""
    listed = ", ".join(f"{{t: '{t}', w: {w}}}" for t, w in sorted(vocabulary.items()))
    found = "regexp_matches(low, '(^|[^a-z0-9])' || x.t || '($|[^a-z0-9])')"
    met = f"list_filter([{listed}], lambda x: {found})"
    return f"coalesce(list_sum(list_transform({met}, lambda x: CAST(x.w AS DOUBLE))), 0)"


def url_filter_sql(spec: UrlRules) -> str:
    """Of the fixed rules of the query, with a vocabulary."""
    return _URL_FILTER.replace("{weight}", _weight(spec.vocabulary()))


_URL_FILTER = f"""
WITH rests AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(url, '{UPPER}', '{UPPER.lower()}') AS low
  FROM rests),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                       AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(fits.verdict, CASE WHEN {{weight}} >= {LIMIT} - 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""


LINE_DEDUP_SQL = f"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
numbered AS (
  SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS line FROM split),
lines AS (
  SELECT doc_id, line, trim(raw, ' ' || chr(9) || chr(13)) AS l FROM numbered
  WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''),
slid AS (
  SELECT doc_id, line, list(l) OVER following AS run, list(line) OVER following AS numbers,
         count(*) OVER (PARTITION BY doc_id) AS n
  FROM lines
  WINDOW following AS (PARTITION BY doc_id ORDER BY line
                       ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
sized AS (
  SELECT doc_id, line, n, unnest(range(1, len(run) + 1)) AS size, run[:size] AS run, numbers[:size] AS numbers,
         len(list_filter(run[:size], lambda x: length(x) >= {ALONE})) > 0 AS long
  FROM slid),
windows AS (
  SELECT *, n = 2 AND NOT long AS whole FROM sized WHERE long OR size = {WINDOW} OR n = 2 AND size = 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run, whole ORDER BY doc_id, line) AS met FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(numbers) AS line FROM ranked WHERE met > 1)
SELECT split.doc_id, any_value(len(parts)) AS n_lines, count(gone.line) AS n_removed,
       coalesce(string_agg(raw, chr(10) ORDER BY numbered.line) FILTER (gone.line IS NULL), '') AS text
FROM split JOIN numbered USING (doc_id) LEFT JOIN gone USING (doc_id, line)
GROUP BY split.doc_id
"""
