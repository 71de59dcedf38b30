"""The queries that SQL can express, for DuckDB. Written for small tables, unlike the operators."""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

STATEMENTS: dict[str, str] = {}

STATEMENTS["op2_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
k AS (
  SELECT *, CASE WHEN pos + 49 <= n THEN md5(string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS seq FROM w),
y AS (SELECT *, seq IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY seq) AS later FROM k),
z AS (SELECT *, bool_or(later) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
      FROM y),
r AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
        string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM z GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

STATEMENTS["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY body) AS first_id,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((
    CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS UBIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS BIGINT), 1)),
    'string_agg', '') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q
"""

STATEMENTS["op5_chat_format"] = """
WITH u AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM u),
r AS (SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, list(struct_pack(r := role, x := text) ORDER BY place) AS turns FROM t GROUP BY conv_id),
p AS (SELECT c.conv_id, i AS n_turns, turns[1:i] AS turns FROM c, unnest(range(1, n_turns)) AS _(i)),
kept AS (SELECT min(conv_id) AS conv_id, n_turns FROM c
         WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n_turns = c.n_turns AND p.turns = c.turns)
         GROUP BY n_turns, turns)
SELECT r.conv_id, (place - 1) // 512 AS part, kept.n_turns, string_agg(piece, '' ORDER BY place) AS text
FROM r JOIN kept ON r.conv_id = kept.conv_id
GROUP BY r.conv_id, (place - 1) // 512, kept.n_turns
"""

STATEMENTS["op8_ngram_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
k AS (SELECT *, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s
      FROM w),
g AS (SELECT DISTINCT doc_id, hash(s) AS s FROM k WHERE pos + 4 <= n OR (n < 5 AND pos = 1)),
z AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id
      GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM o JOIN z p ON p.doc_id = a JOIN z q ON q.doc_id = b WHERE 100 * o.n >= 75 * (p.n + q.n - o.n)),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = d.doc_id), d.doc_id)) AS component_id
FROM d LEFT JOIN z ON z.doc_id = d.doc_id
"""

_PLACE = (
    "lower(regexp_extract({0}, '^.*?://([^/?#]*)', 1)) || "
    "CASE WHEN regexp_extract({0}, '^.*?://[^/?#]*([^?#]*)', 1) = '' THEN '/' "
    "ELSE regexp_extract({0}, '^.*?://[^/?#]*([^?#]*)', 1) END || "
    "regexp_extract({0}, '^.*?://[^/?#]*[^?#]*([?][^#]*)?', 1)"
)

STATEMENTS["op9_url_filter"] = f"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
t AS (SELECT page_id, url, coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)), '') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
        {_PLACE.format("url")} AS place, html FROM pages),
links AS (SELECT place, unnest([
    regexp_extract(regexp_extract(html, '<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>', 0, 'i'),
      '\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'i'),
    regexp_extract(regexp_extract(html, '<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>', 0, 'i'),
      '\\burl\\s*=\\s*["'']?([^"''>\\s;]+)', 1, 'i')]) AS target,
    regexp_extract(url, '^(.*?)://', 1) AS scheme, host FROM t),
a AS (SELECT place, CASE WHEN contains(target, '://') THEN target WHEN target LIKE '//%' THEN scheme || ':' || target
        WHEN target LIKE '/%' THEN scheme || '://' || host || target END AS target FROM links WHERE target <> ''),
e1 AS (SELECT place AS x, {_PLACE.format("target")} AS y FROM a WHERE target IS NOT NULL),
e AS (SELECT x, y FROM e1 UNION SELECT y, x FROM e1),
reach AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
bad AS (SELECT DISTINCT x FROM reach r WHERE (
  SELECT arg_max(verdict, length(h || p)) FROM rules
  WHERE (split_part(r.y, '/', 1) = h OR ends_with(split_part(r.y, '/', 1), '.' || h))
    AND starts_with(split_part(substr(r.y, strpos(r.y, '/')), '?', 1), p)) = 'block'),
m AS (SELECT t.page_id, t.host, t.path, t.place, (SELECT arg_max(h || p, length(h || p)) FROM rules
        WHERE (t.host = h OR ends_with(t.host, '.' || h)) AND starts_with(t.path, p)) AS rule FROM t)
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN (SELECT verdict FROM rules WHERE h || p = rule)
  WHEN place IN (SELECT x FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""

STATEMENTS["op10_embedding_neardup"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a, ok b
      WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links,
        least(vec_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = vec_id), vec_id)) AS component_id FROM v)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM c
"""


def _nearest(book: str) -> str:
    """Per part its nearest entry, distance and index in one number."""
    terms = " + ".join(f"(x.{k} - y.{k}) * (x.{k} - y.{k})" for k in "abcd")
    return f"SELECT r, x.p, min(({terms}) * 64 + y.e) AS best FROM parts x JOIN {book} y ON x.p = y.p GROUP BY r, x.p"


def _round(n: int) -> str:
    means = ", ".join(f"CAST(coalesce(floor(m.{k} / m.n), b.{k}) AS BIGINT) AS {k}" for k in "abcd")
    sums = ", ".join(f"sum({k}) AS {k}" for k in "abcd")
    return f"""
near{n} AS MATERIALIZED ({_nearest(f"book{n}")}),
mean{n} AS (SELECT p, best % 64 AS e, count(*) AS n, {sums} FROM near{n} JOIN parts USING (r, p) GROUP BY 1, 2),
book{n + 1} AS MATERIALIZED (
  SELECT b.p, b.e, {means} FROM book{n} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e),"""


STATEMENTS["op11_vector_codes"] = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (
  SELECT r, p, v[4 * p + 1] AS a, v[4 * p + 2] AS b, v[4 * p + 3] AS c, v[4 * p + 4] AS d FROM kept, range(16) AS _(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, a, b, c, d FROM parts WHERE r <= 64),{_round(0)}{_round(1)}
near2 AS ({_nearest("book2")}),
coded AS (
  SELECT r, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error
  FROM near2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
