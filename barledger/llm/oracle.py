"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)
),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, y FROM reach r JOIN sides ON r.other = x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {PLAIN} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {PLAIN} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
wins AS (SELECT item, n, unnest([array_to_string(w[i : i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS g FROM sized),
widths AS (SELECT DISTINCT n FROM wins),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths),
grams AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM starts),
hits AS (SELECT doc_id, n, i, item FROM grams JOIN wins USING (n, g)),
places AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits)),
marked AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
owned AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN owned USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, strlen(payload) AS size, sha256(payload) AS digest FROM p),
r AS (SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS original FROM q)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM r
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {SPACED} AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1),
reps AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
counted AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(dups.n, 0) AS n_dup_lines, coalesce(reps.n, 0) AS n_repeat_words
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN reps USING (doc_id)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS failed FROM judged WHERE source IS NOT NULL GROUP BY source
),
totals AS (
  SELECT least(greatest(sum(failed) / sum(n), 1e-4), 1 - 1e-4) AS mean, sum(n) AS docs, count(*) AS h FROM hosts
),
moments AS (
  SELECT any_value(mean) AS mean, any_value(h / docs) AS per, sum(n * (failed / n - mean) * (failed / n - mean)) / any_value(docs) AS var
  FROM hosts, totals
),
spread AS (SELECT *, mean * (1 - mean) AS s FROM moments),
prior AS (SELECT mean, greatest(s / greatest(var - s * per, s / 1001) - 1, 4.0) AS weight FROM spread),
rates AS (SELECT source, (failed + mean * weight) / (n + weight) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  round(host_rate, 9) AS host_rate, NOT base_failed AND NOT coalesce(host_rate > 0.6, false) AS kept
FROM judged LEFT JOIN rates USING (source)
"""

URL_FILTER = f"""
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
u AS (
  SELECT page_id, url, row_number() OVER () AS i,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
fits AS (
  SELECT i, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY i
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fits USING (i)
"""



def crc32(bits: str) -> str:
    """crc32 of a list of bits, the lowest of each byte first."""
    step = "xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {bits}), lambda c, b: {step}), 4294967295::UBIGINT)::BIGINT"


DECIMAL_BITS = crc32("flatten([[((ord(c) >> k) & 1)::UBIGINT FOR k IN range(8)] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')])")

PREFIX_TRIE = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
facts AS (
  SELECT c.conv_id, h, c.conv_id - c.conv_id % 5 AS lender, least(h, coalesce(l.n, 0)) AS taken
  FROM (SELECT conv_id, {DECIMAL_BITS} % 9 AS h FROM sizes) c LEFT JOIN sizes l ON l.conv_id = c.conv_id - c.conv_id % 5
),
rebuilt AS (
  SELECT f.conv_id, pos, role, text FROM facts f JOIN turns t ON t.conv_id = lender WHERE pos < taken
  UNION ALL
  SELECT f.conv_id, pos - h + taken, role, text FROM facts f JOIN turns t ON t.conv_id = f.conv_id WHERE pos >= h
),
path(conv_id, depth, key, above, bytes) AS (
  SELECT conv_id, 0::BIGINT, '', NULL::VARCHAR, 0::BIGINT FROM sizes
  UNION ALL
  SELECT conv_id, depth + 1, sha256(key || '/' || strlen(role) || '/' || role || text), key, strlen(text)
  FROM path JOIN rebuilt USING (conv_id) WHERE pos = depth
),
nodes AS (
  SELECT depth, key, any_value(above) AS above, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs
  FROM path GROUP BY depth, key
),
kids AS (SELECT above AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (key)),
trees AS (
  SELECT p.key, sum((n_convs - 1) * u.bytes) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM counted u JOIN path p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.key
),
ends AS (
  SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(key, depth) AS key FROM path GROUP BY conv_id) GROUP BY key
)
SELECT c.conv_id, c.depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM counted c JOIN trees USING (key) LEFT JOIN ends USING (key) LEFT JOIN nodes up ON up.key = c.above
"""


#: UTF-8 of the letters up to U+00FF, as bits.
LATIN_BITS = crc32(
    "flatten([[((b >> k) & 1)::UBIGINT FOR k IN range(8)] "
    "FOR b IN flatten([CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END FOR c IN string_split(s, '')])])"
)

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run
  FROM documents
),
met AS (SELECT id || ':' || run AS s, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, n, {LATIN_BITS} AS h FROM met),
cut AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed
),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
dels AS (
  SELECT word, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM dels a JOIN dels b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, v.word FROM dels d JOIN v ON d.rest = v.word
  UNION SELECT v.word, d.word FROM dels d JOIN v ON d.rest = v.word
),
ranked AS (
  SELECT x, y, v.n, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY v.n DESC, y) AS r
  FROM pairs JOIN v ON v.word = y
),
found AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 5 * v.n THEN y END AS form,
    CASE WHEN r.n >= 5 * v.n THEN r.n END AS form_n
  FROM v LEFT JOIN ranked r ON r.x = v.word AND r.r = 1
),
ways AS (SELECT word, word AS last FROM found UNION ALL SELECT w.word, f.form FROM ways w JOIN found f ON f.word = w.last AND f.form IS NOT NULL),
ends AS (SELECT w.word, last AS root FROM ways w JOIN found f ON f.word = w.last AND f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM found JOIN ends USING (word)
"""

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def matches(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Leftmost matches of a pattern with what lies before each; the lengths up to one are its place."""
    return (
        f"SELECT doc_id, {order} AS ord, '{kind}' AS kind, {least} AS least, unnest(range(len(m))) AS i, unnest(m) AS hit, unnest(v) AS val, "
        f"unnest(g[1 : len(m)]) AS gap FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, "
        f"regexp_extract_all(t, '{pattern}', {group}) AS v, string_split_regex(t, '{pattern}') AS g FROM d)"
    )


SECRET_SCAN = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS (
  {matches(0, 'assign', ASSIGN, 2, 12)}
  UNION ALL {matches(1, 'access', 'AKIA[A-Z0-9]+', 0, 18)}
  UNION ALL {matches(2, 'hex', '[0-9a-f]{16,}', 0, 16)}
),
placed AS (
  SELECT doc_id, ord, kind, length(val) >= least AS kept, length(hit) AS size,
    sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, ord ORDER BY i) AS stop FROM hits
),
spans AS (
  SELECT doc_id, count(*) FILTER (ord = 0) AS a, count(*) FILTER (ord = 1) AS k, count(*) FILTER (ord = 2) AS x,
    string_agg(kind || ':' || CAST(stop - size AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY stop - size, ord) AS joined
  FROM placed WHERE kept GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(x, 0) AS n_hex,
  sha256(coalesce(joined, '')) AS base_sha256, coalesce(joined, '') AS spans
FROM d LEFT JOIN spans USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op2_near_dedup": NEAR_DEDUP,
    "op3_secret_scan": SECRET_SCAN,
    "op6_decontamination": DECONTAMINATION,
    "op8_warc": WARC,
    "op9_quality_rules": QUALITY_RULES,
    "op11_url_filter": URL_FILTER,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_spelling": SPELLING,
}
