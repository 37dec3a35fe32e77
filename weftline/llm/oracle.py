"""SQL twins of the registered queries that SQL can express.

They state their own constants and formulas.
"""

_URL_FILTERS = """WITH RECURSIVE
u AS (SELECT page_id,
        coalesce(translate(regexp_extract(url, '^[\\s\\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
s AS (SELECT *, regexp_replace(regexp_replace(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9]+', '#', 'g'), '[^/#]*#[^/#]+#[^/]*', '{id}', 'g') AS shape,
        try_cast(nullif(regexp_extract(path, '([0-9]{1,18})[^0-9]*$', 1), '') AS BIGINT) AS number FROM u),
l AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels
        WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY doc_id),
c AS (SELECT host, shape, count(*) AS pages, count(l.bad) AS labelled, coalesce(sum(l.bad), 0) AS rejected
        FROM s LEFT JOIN l ON l.doc_id = s.number GROUP BY host, shape),
prior AS (SELECT coalesce(1 - sum(rejected)::DOUBLE / nullif(sum(labelled), 0), 1.0) AS p FROM c),
t0 AS (SELECT host, shape, '' AS template, 0 AS level, false AS done, pages, labelled, rejected FROM c
  UNION ALL
  SELECT host, shape, CASE WHEN segment = '?' THEN template ELSE template || CASE WHEN level > 0 THEN '/' ELSE '' END ||
    CASE WHEN kids = 1 OR coalesce(NOT (kids > 32 AND k < 0.05 * pp) AND n > 0 AND nn - n > 0 AND bb > 0 AND bb < nn
        AND abs(b / nullif(n, 0) - (bb - b) / nullif(nn - n, 0))
          > 2.58 * sqrt((bb / nullif(nn, 0)) * (1 - bb / nullif(nn, 0)) * (1 / nullif(n, 0) + 1 / nullif(nn - n, 0))), false)
      THEN segment ELSE '*' END END, level + 1, segment = '?', pages, labelled, rejected
  FROM (SELECT *, count(DISTINCT segment) OVER node AS kids, sum(pages::DOUBLE) OVER child AS k, sum(pages::DOUBLE) OVER node AS pp,
      sum(labelled::DOUBLE) OVER child AS n, sum(labelled::DOUBLE) OVER node AS nn, sum(rejected::DOUBLE) OVER child AS b, sum(rejected::DOUBLE) OVER node AS bb
    FROM (SELECT *, coalesce(string_split(shape, '/')[level + 1], '?') AS segment FROM t0 WHERE NOT done)
    WINDOW node AS (PARTITION BY host, template), child AS (PARTITION BY host, template, segment))),
t AS (SELECT host, shape, template, labelled, rejected FROM t0 WHERE done),
j AS (SELECT host, template, (sum(labelled) - sum(rejected) + 8.0 * (SELECT p FROM prior)) / (sum(labelled) + 8.0) AS purity FROM t GROUP BY ALL),
r AS (SELECT * FROM (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
        ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) v(domain, start, rule, says)),
f AS (SELECT host, path, arg_max(rule, len(rule)) AS rule, arg_max(says, len(rule)) AS says
        FROM (SELECT DISTINCT host, path FROM s) JOIN r ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start) GROUP BY ALL)
SELECT page_id, s.host, s.path, f.rule, coalesce(f.says, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, t.template, purity::DOUBLE AS purity
FROM s JOIN t ON t.host = s.host AND t.shape = s.shape JOIN j ON j.host = t.host AND j.template = t.template
LEFT JOIN f ON f.host = s.host AND f.path = s.path"""


_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, e AS qe FROM v WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, list_inner_product(qe::DOUBLE[], e::DOUBLE[])::BIGINT AS score FROM q JOIN v ON vec_id <> query_id AND len(e) = len(qe)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""

_FILL_IN_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce("text", '') AS x, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
t AS (SELECT doc_id, x, regexp_extract_all(x, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
  ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 50 THEN 'plain'
       WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS y FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars, sha256(y) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN y
    WHEN 'psm' THEN split_part(substr(y, 4), '<S>', 1) || split_part(y, '<M>', 2) || split_part(split_part(y, '<M>', 1), '<S>', 2)
    ELSE split_part(split_part(y, '<M>', 1), '<P>', 2) || split_part(y, '<M>', 2) || split_part(substr(y, 4), '<P>', 1) END) AS restored_sha256
FROM o"""

ORACLE: dict[str, str] = {"op6_exact_top_k": _TOP_K, "op10_url_filters": _URL_FILTERS, "op13_fill_in_middle": _FILL_IN_MIDDLE}
