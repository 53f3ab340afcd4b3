"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate({{0}}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op1_benchmark_decontamination"] = f"""
WITH items AS (
  SELECT item_id, w FROM (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark) WHERE len(w) > 0
), grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents
), sizes AS (SELECT DISTINCT n FROM grams),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, i, item_id FROM windows JOIN grams USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLE["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

ORACLE["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT payload, max(page_id) AS owner FROM p GROUP BY payload),
b AS (SELECT page_id, payload, owner, CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS bits FROM p JOIN d USING (payload))
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INTEGER) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INTEGER)
      + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INTEGER) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INTEGER)
      + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM b
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_QUOTE = "[\"'']?"
_HEAD = rf"(?:{_KEYWORDS}){_QUOTE}\x20*[:=]\x20*{_QUOTE}"
# Kind, pattern, and the condition on a match that counts.
_KINDS = [
    ("assign", rf"{_HEAD}[A-Za-z0-9+/_.=-]+", rf"len(regexp_replace(m, '^{_HEAD}', '')) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "len(m) >= 20"),
    ("hex", "[0-9a-f]+", "len(m) >= 24"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "len(m) >= 40"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", "len(m) >= 15"),
    ("google", "AIza[A-Za-z0-9_-]+", "len(m) >= 39"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "len(m) >= 36"),
    ("key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", "true"),
]
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, {n} AS k, '{kind}' AS kind, pos, pos + len(m) AS stop FROM (
  SELECT doc_id, m, list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS pos
  FROM (SELECT doc_id, ms, gaps, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM docs))) WHERE {keep}"""
    for n, (kind, pattern, keep) in enumerate(_KINDS)
)
_LISTED = "string_agg(kind || ':' || CAST(pos AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY pos, k)"
ORACLE["op8_secret_scan"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ({_FOUND})
SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex, sha256(coalesce({_LISTED} FILTER (WHERE k < 3), '')) AS base_sha256,
  coalesce({_LISTED}, '') AS spans
FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id GROUP BY d.doc_id
"""

ORACLE["op9_url_filter"] = rf"""
WITH p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), listed AS (
  SELECT host FROM p WHERE host <> '' GROUP BY host HAVING NOT bool_or(starts_with(lower(url), 'https://'))
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

ORACLE["op11_fill_in_middle"] = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), d AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (SELECT *, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS y, substr(t, b + 1) AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
    ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def _lloyd(rounds: int) -> str:
    """Rounds of assignment and means as a chain of tables."""
    parts = ["""WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
), x AS MATERIALIZED (
  SELECT r, p, s, list_dot_product(s, s) AS ss FROM (
    SELECT r, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS s FROM v, range(4) t(p))
), c0 AS MATERIALIZED (SELECT p, r - 1 AS e, s AS c FROM x WHERE r <= 256)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, p, best[1] AS d, best[2] AS e FROM (
    SELECT r, x.p, min([ss - 2 * list_dot_product(s, c) + list_dot_product(c, c), CAST(e AS DOUBLE)]) AS best
    FROM x JOIN c{i} ON x.p = c{i}.p GROUP BY r, x.p))""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.p, c{i}.e, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT p, e, list(floor(total / n) ORDER BY k) AS c FROM (
      SELECT p, e, k, sum(y) AS total, count(*) AS n FROM (
        SELECT x.p, CAST(e AS BIGINT) AS e, unnest(s) AS y, unnest(range(len(s))) AS k FROM x JOIN a{i} ON x.r = a{i}.r AND x.p = a{i}.p)
      GROUP BY p, e, k) GROUP BY p, e) m ON c{i}.p = m.p AND c{i}.e = m.e)""")
    return ",\n".join(parts) + f""",
named AS (
  SELECT r, string_agg(lower(format('{{:02x}}', CAST(e AS BIGINT))), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r
), books AS (
  SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS h
  FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS k FROM c{rounds})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN named USING (r), books
"""


ORACLE["op13_dual_tree_lloyd"] = _lloyd(4)

ORACLE["op12_group_join"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - least(4, len(w)) + 2), lambda i: array_to_string(w[i:i + least(4, len(w)) - 1], ' ')))) AS s
  FROM w WHERE len(w) > 0
), copies AS MATERIALIZED (SELECT min(doc_id) AS node, s, list(doc_id) AS ids FROM s GROUP BY s),
x AS MATERIALIZED (SELECT node, len(s) AS n, unnest(s) AS g FROM copies),
f AS MATERIALIZED (SELECT g, count(*) AS df FROM x GROUP BY g HAVING count(*) > 1),
prefix AS MATERIALIZED (
  SELECT node, n, g FROM (SELECT node, n, x.g, coalesce(df, 1) AS df, row_number() OVER (PARTITION BY node ORDER BY coalesce(df, 1), x.g) AS k
    FROM x LEFT JOIN f USING (g)) WHERE k <= n - (85 * n + 99) // 100 + 1 AND df > 1
), pairs AS MATERIALIZED (
  SELECT DISTINCT a.node AS a, b.node AS b FROM prefix a JOIN prefix b ON a.g = b.g AND a.node < b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT a, b, len(list_intersect(x.s, y.s)) AS o, len(x.s) AS n, len(y.s) AS m
    FROM pairs JOIN copies x ON a = x.node JOIN copies y ON b = y.node) WHERE 100 * o >= 85 * (n + m - o)
), edges AS MATERIALIZED (
  SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT node, unnest(ids) FROM copies UNION SELECT unnest(ids), node FROM copies
), reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT d.doc_id, coalesce(any_value(len(s.s)), 0) AS n_shingles, coalesce(min(other), d.doc_id) AS component_id
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id LEFT JOIN reach r ON d.doc_id = r.doc_id GROUP BY d.doc_id
"""
