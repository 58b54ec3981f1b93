"""DuckDB SQL for the corpus queries that SQL can express."""

_HOST = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)"
_LOWER = f"translate({_HOST}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (SELECT page_id, {_LOWER} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, path,
  (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
   WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS rule,
  coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
   WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)), 'allow') AS verdict
FROM p
"""

_G, _W = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
_PHRASE = rf"{_G}*(?:{_W}+{_G}+){{2,11}}?{_W}*[sty](?:{_G}+|\z)|{_G}*(?:{_W}+{_G}*){{1,12}}|{_G}+"


def _tree(text: str, name: str) -> str:
    return f"""
{name}_t AS (SELECT doc_id, list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
  lambda p: list_transform(regexp_extract_all(p, '{_PHRASE}'), lambda w: left(sha256(w), 16)))) AS t FROM base),
{name}_p AS (SELECT doc_id, t, list_transform(t, lambda x: list_transform(x, lambda y: left(sha256(array_to_string(y, '')), 16))) AS p FROM {name}_t),
{name}_s AS (SELECT doc_id, t, p, list_transform(p, lambda x: left(sha256(array_to_string(x, ',')), 16)) AS s FROM {name}_p),
{name} AS (SELECT doc_id, p, s, sha256(array_to_string(s, '/')) AS root,
  list_distinct(s) AS l1, list_distinct(flatten(p)) AS l2, list_distinct(list_transform(flatten(flatten(t)), lambda w: left(w, 8))) AS l3,
  sha256(array_to_string(s, '/')) || ':' || array_to_string(list_transform(range(1, len(s) + 1), lambda i: s[i] || '=' ||
    array_to_string(list_transform(range(1, len(p[i]) + 1), lambda j: p[i][j] || '-' ||
      array_to_string(list_transform(t[i][j], lambda w: left(w, 8)), '')), ',')), '/') AS fp FROM {name}_s)"""


def _like(a: str, b: str) -> str:
    def share(weight: float, level: str) -> str:
        both = f"(len({a}.{level}) + len({b}.{level}))"
        return f"{weight}::DOUBLE * CASE WHEN {both} = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({a}.{level}, {b}.{level})) * 2.0::DOUBLE / {both} END"

    return f"CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE ELSE 0.0::DOUBLE + {share(0.05, 'l1')} + {share(0.15, 'l2')} + {share(0.8, 'l3')} END"


OP7 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
nx AS (SELECT doc_id, text, n, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS nxt FROM d),
base AS (SELECT doc_id, text, n, nxt, text[1:n - n // 3] || nxt[1:n // 3] AS edited FROM nx),
{_tree("text", "own")},
{_tree("edited", "new")},
{_tree("nxt", "nex")}
SELECT base.doc_id, n::BIGINT AS n_chars, sha256(edited) AS edited_sha256, own.fp AS fingerprint, new.fp AS edited_fingerprint,
  {_like("own", "new")} AS near_edited, {_like("own", "nex")} AS near_next,
  array_to_string(flatten(list_transform(range(1, len(new.s) + 1), lambda i: CASE WHEN list_contains(own.l1, new.s[i]) THEN []::VARCHAR[] ELSE
    list_transform(list_filter(range(1, len(new.p[i]) + 1), lambda j: NOT list_contains(own.l2, new.p[i][j])), lambda j: (i - 1)::VARCHAR || '.' || (j - 1)::VARCHAR) END)), ',') AS edited_at
FROM base JOIN own USING (doc_id) JOIN new USING (doc_id) JOIN nex USING (doc_id)
"""

OP1 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

_CRC = """list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, k: xor(c // 2, 3988292384 * (c % 2))))"""

OP13 = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS nth,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS root, xor({_CRC}, 4294967295) % 6 AS h FROM t),
m AS (SELECT c.conv_id, 0 AS part, nth, role, text FROM c JOIN t ON t.conv_id = c.root AND nth < h
  UNION ALL SELECT c.conv_id, 1, nth, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND nth >= h),
r AS (SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY part, nth) FILTER (nth IS NOT NULL), []) AS s FROM c LEFT JOIN m USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, len(s) AS n, d, s[1:d] AS prefix FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM r)),
x AS (SELECT *, min(conv_id) OVER (PARTITION BY d, prefix) AS rep FROM p),
nodes AS (SELECT rep, d, count(*) AS n, any_value(coalesce(length(prefix[-1].text), 0)) AS chars, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
  FROM x GROUP BY rep, d),
kids AS (SELECT par.rep, par.d, count(*) AS kids FROM nodes k JOIN x par ON par.conv_id = k.rep AND par.d = k.d - 1 GROUP BY ALL),
below AS (SELECT x.rep, x.d, sum((n.n - 1) * n.chars) AS saved, count(*) FILTER (kids IS NULL) AS leaves
  FROM nodes n LEFT JOIN kids USING (rep, d) JOIN x ON x.conv_id = n.rep AND x.d <= n.d GROUP BY ALL)
SELECT nodes.rep::BIGINT AS conv_id, nodes.d::BIGINT AS depth, par.rep::BIGINT AS parent_conv_id, nodes.n::BIGINT AS n_convs, coalesce(kids, 0)::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM nodes JOIN below USING (rep, d) LEFT JOIN kids USING (rep, d) LEFT JOIN x par ON par.conv_id = nodes.rep AND par.d = nodes.d - 1
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT doc, lang, source, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
n AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS size FROM k GROUP BY ALL),
g AS (SELECT lang, source, coalesce(size, 0) AS size FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS size FROM n GROUP BY ALL) USING (lang, source)),
p AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (g.size + v.v))::BIGINT AS p,
  (1 + (1000000000::HUGEINT * (total + 1)) // (v.size + v.v))::BIGINT AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 200
"""
