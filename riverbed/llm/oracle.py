"""DuckDB SQL for the queries that SQL can express; the others are tested
against brute force in ``tests/llm``."""

OP5 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""

# Water filling in closed form: sources ordered by limit / weight; the first k are at their
# limit for the smallest k that leaves no other source above its own.
OP8 = r"""
WITH s AS (
  SELECT doc_id, source, md5(coalesce(cast(doc_id AS VARCHAR), 'null'))[1:24] AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
p AS (
  SELECT source, sum(size) AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
           WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM s GROUP BY source),
o AS (
  SELECT *, row_number() OVER w AS k,
         sum(2 * source_size) OVER (w ROWS UNBOUNDED PRECEDING) - 2 * source_size AS full_before,
         sum(weight) OVER () - sum(weight) OVER (w ROWS UNBOUNDED PRECEDING) + weight AS rest
  FROM p WINDOW w AS (ORDER BY 2.0 * source_size / weight, source)),
v AS (
  SELECT (1.5::DOUBLE * (SELECT sum(size) FROM s) - full_before) / rest AS level
  FROM o
  WHERE weight * ((1.5::DOUBLE * (SELECT sum(size) FROM s) - full_before) / rest)
        <= 2 * source_size
  ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size, least(weight * level, CAST(2 * source_size AS DOUBLE)) AS target
  FROM p, v),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM t),
c AS (
  SELECT s.*, source_size, target, whole, target - whole * source_size AS budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY s.source, h) AS own
  FROM s JOIN b ON s.source IS NOT DISTINCT FROM b.source),
e AS (
  SELECT *, CASE WHEN upto <= budget THEN 1
                 WHEN upto - own > budget THEN 0
                 WHEN upto - budget < budget - (upto - own) THEN 1 ELSE 0 END AS extra
  FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + extra) AS BIGINT) AS taken, source,
       CAST(whole + extra AS BIGINT) AS copies
FROM e
"""

OP11 = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                       ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
r AS (
  SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
                        ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'),
                        ('com', '/de/', 'block')) v(rule_host, rule_path, verdict))
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM (SELECT *, (SELECT arg_max({'rule': rule_host || rule_path, 'verdict': r.verdict},
                                length(rule_host || rule_path))
                 FROM r WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
                          AND starts_with(path, rule_path)) AS best
      FROM h)
"""

SQL = {"op11_url_rules": OP11, "op5_exact_dedup": OP5, "op8_mix": OP8}
