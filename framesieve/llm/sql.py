"""DuckDB counterparts of the corpus queries that SQL can express."""

OP6 = "SELECT doc_id, n_chars, sha256(text) AS text_sha256, true AS sharded FROM documents"

OP7 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, CAST('0x' || substr(md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR), source)), 1, 15) AS BIGINT) AS h FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap FROM per),
o AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total, coalesce(sum(cap) OVER before, 0) AS capped, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS nth, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest FROM w
      WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((total - capped) / rest, nth) FILTER (cap >= weight * ((total - capped) / rest)) AS level FROM o),
t AS (SELECT source, source_size, least(cap, weight * level) AS target FROM w, l),
q AS (SELECT d.*, t.source_size, t.target, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, (r * source_size + running) / target AS v FROM q, (SELECT unnest([0, 1]) AS r) WHERE size > 0 AND target > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY v, h, doc_id, r ROWS UNBOUNDED PRECEDING) AS upto FROM e WHERE v < 2),
n AS (SELECT doc_id, count(*) AS n FROM c WHERE upto <= (SELECT sum(target) FROM t) GROUP BY doc_id)
SELECT q.doc_id, size, source_size, target, CAST(size * coalesce(n.n, 0) AS BIGINT) AS taken FROM q LEFT JOIN n ON n.doc_id = q.doc_id
"""

OP8 = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, i AS pos, array_to_string(lines[i:i+2], chr(10)) AS run
      FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines) - 2)) AS i FROM l WHERE len(lines) >= 3)),
f AS (SELECT run, min((doc_id, pos)) AS first FROM w GROUP BY run HAVING count(*) > 1),
later AS (SELECT w.doc_id, CASE WHEN first[1] = w.doc_id THEN greatest(w.pos, first[2] + 3) ELSE w.pos END AS a, w.pos + 2 AS b
          FROM w JOIN f USING (run) WHERE (w.doc_id, w.pos) > first),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS i FROM later),
n AS (SELECT doc_id, count(*) AS c, list(i) AS g FROM gone GROUP BY doc_id)
SELECT l.doc_id, CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines, CAST(coalesce(n.c, 0) AS INTEGER) AS n_removed,
       CASE WHEN n.c IS NULL THEN text ELSE array_to_string([lines[i] FOR i IN generate_series(1, len(lines)) IF NOT list_contains(n.g, i)], chr(10)) END AS clean_text
FROM l LEFT JOIN n USING (doc_id)
"""

OP9 = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP10 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
both_ AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(a, b) AS (SELECT a, b FROM both_ UNION SELECT r.a, both_.b FROM r JOIN both_ ON both_.a = r.b),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) AS component_id, coalesce(c.b, d.doc_id) >= d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

ORACLES = {"op6_sharding": OP6, "op7_mixing": OP7, "op8_line_dedup": OP8, "op9_topk": OP9, "op10_near_dedup": OP10}
