"""The queries' results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from replyloom.llm.mixing import SEED, WEIGHTS
from replyloom.llm.packing import BUCKETS, MAX_LENGTH, TOKEN_BUDGET, WORD
from replyloom.llm.secret_scan import (
    ACCESS,
    ALLOWED,
    ALNUM_BITS,
    ASSIGN,
    CANDIDATE,
    HEX_BITS,
    LETTER_BITS,
    MIN_ACCESS,
    MIN_ASSIGNED,
    MIN_HEX,
    MIXED_BITS,
    UPPER_BITS,
    WINDOW,
    _APART,
    most_weight,
    weight,
)
from replyloom.llm.url_filter import RULES

OP1 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
   + (CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END) + (CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END)
   + (CASE WHEN 100 * n_symbols > 25 * n_words THEN 16 ELSE 0 END)
   + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END) AS failures
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, (failures & 3) <> 0 AS base_failed,
       failures = 0 AS kept, failures::BIGINT AS failures
FROM f
"""

_NORMAL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = rf"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
h AS (SELECT doc_id, item_id, i, m FROM dw JOIN bw USING (m, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def _positions(name: str, pattern: str, group: int, keep: str, number: int) -> str:
    """(doc_id, b, e, k, value) of one pattern's matches: pieces and matches add up to the text."""
    return rf"""
{name}0 AS (
  SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS f, regexp_extract_all(text, '{pattern}', {group}) AS v,
         regexp_split_to_array(text, '{pattern}') AS p
  FROM d WHERE regexp_matches(text, '{pattern}')),
{name}1 AS (SELECT doc_id, i, length(p[i]) AS gap, length(f[i]) AS size, v[i] AS value
  FROM (SELECT doc_id, f, v, p, unnest(range(1, len(f) + 1)) AS i FROM {name}0)),
{name} AS (
  SELECT doc_id, sum(gap) OVER w + coalesce(sum(size) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
         sum(gap + size) OVER w AS e, {number} AS k, value
  FROM {name}1 WINDOW w AS (PARTITION BY doc_id ORDER BY i)
  QUALIFY {keep})"""


def _op2() -> str:
    quoted = ASSIGN.replace("'", "''")
    weights = "[" + ", ".join(str(weight(c)) for c in range(1, WINDOW + 1)) + "]"
    worth = "regexp_matches(value, '[0-9]') OR regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]')"
    parts = [
        _positions("assign", quoted, 2, f"length(value) >= {MIN_ASSIGNED}", 0),
        _positions("access", ACCESS, 0, f"length(value) >= {MIN_ACCESS}", 1),
        _positions("hex", f"[0-9a-f]{{{MIN_HEX},}}", 0, "true", 2),
        _positions("candidate", CANDIDATE, 0, f"({worth}) AND NOT regexp_matches(value, '{ALLOWED[0]}')", 3),
    ]
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),{",".join(parts)},
pieces AS (SELECT doc_id, b, e, k, p.i, p.piece FROM (
  SELECT *, unnest(list_transform(regexp_split_to_array(value, '{_APART}'), lambda v, i: {{'i': i, 'piece': v}})) AS p FROM candidate)),
windows AS (
  SELECT doc_id, b, e, k, i, x, substr(piece, x, {WINDOW}) AS w
  FROM (SELECT *, unnest(range(1, length(piece) - {WINDOW} + 2)) AS x FROM pieces)),
chars AS (
  SELECT doc_id, b, e, k, i, x, c, count(*) AS n
  FROM (SELECT *, unnest(string_split(w, '')) AS c FROM windows) GROUP BY ALL),
counted AS (
  SELECT doc_id, b, e, k, i, x, sum(({weights})[n]) AS t,
         coalesce(sum(n) FILTER (regexp_matches(c, '[0-9a-fA-F]')), 0) AS hexes, coalesce(sum(n) FILTER (regexp_matches(c, '[0-9]')), 0) AS digits,
         coalesce(sum(n) FILTER (regexp_matches(c, '[a-z]')), 0) AS lowers, coalesce(sum(n) FILTER (regexp_matches(c, '[A-Z]')), 0) AS uppers
  FROM chars GROUP BY doc_id, b, e, k, i, x),
entropy AS (
  SELECT DISTINCT doc_id, b, e, k FROM counted
  WHERE hexes = {WINDOW} AND digits BETWEEN 1 AND {WINDOW - 1} AND t <= {most_weight(HEX_BITS)}
     OR lowers + digits = {WINDOW} AND digits BETWEEN 4 AND {WINDOW - 4} AND t <= {most_weight(ALNUM_BITS)}
     OR lowers > 0 AND uppers > 0 AND digits > 0 AND t <= {most_weight(MIXED_BITS)}
     OR uppers + digits = {WINDOW} AND digits BETWEEN 1 AND {WINDOW - 1} AND t <= {most_weight(UPPER_BITS)}
     OR lowers + uppers = {WINDOW} AND uppers BETWEEN 4 AND {WINDOW - 4} AND t <= {most_weight(LETTER_BITS)}),
s AS (
  SELECT doc_id, b, e, k, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || b::BIGINT || ':' || e::BIGINT AS span
  FROM (SELECT doc_id, b, e, k FROM assign UNION ALL SELECT doc_id, b, e, k FROM access
        UNION ALL SELECT doc_id, b, e, k FROM hex UNION ALL SELECT doc_id, b, e, k FROM entropy)),
t AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3,
         string_agg(span, ',' ORDER BY b, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY b, k) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       coalesce(n3, 0)::BIGINT AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN t USING (doc_id)
"""


def _op5() -> str:
    """One step per bucket: the least padding of the first j lengths, and where the last bucket begins."""
    steps = ["k1 AS MATERIALIZED (SELECT j, v * c - s AS cost, 0 AS origin FROM h)"]
    for k in range(2, BUCKETS + 1):
        steps.append(
            f"k{k} AS MATERIALIZED (SELECT j, min(cost) AS cost, arg_min(i, (cost, i)) AS origin FROM ("
            f"SELECT h.j, p.j AS i, p.cost + h.v * (h.c - g.c) - (h.s - g.s) AS cost FROM h JOIN k{k - 1} p ON p.j < h.j JOIN h g ON g.j = p.j"
            " UNION ALL SELECT j, 0, v * c - s FROM h) GROUP BY j)"
        )
    steps.append(f"b{BUCKETS} AS MATERIALIZED (SELECT max(j) AS j FROM h)")
    for k in range(BUCKETS - 1, 0, -1):
        steps.append(f"b{k} AS MATERIALIZED (SELECT origin AS j FROM k{k + 1} JOIN b{k + 1} USING (j))")
    bounds = " UNION ".join(f"SELECT j FROM b{k}" for k in range(1, BUCKETS + 1))
    return rf"""
WITH n AS (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n FROM documents),
q AS (
  SELECT doc_id, chunk, chunk * {MAX_LENGTH} AS start, least({MAX_LENGTH}, n - chunk * {MAX_LENGTH}) AS n_tokens
  FROM (SELECT doc_id, n, unnest(range(0, greatest(1, (n + {MAX_LENGTH - 1}) // {MAX_LENGTH}))) AS chunk FROM n)),
h AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY n_tokens) AS j, n_tokens::HUGEINT AS v, sum(count(*)) OVER (ORDER BY n_tokens) AS c,
         sum(count(*) * n_tokens) OVER (ORDER BY n_tokens) AS s
  FROM q GROUP BY n_tokens),
{", ".join(steps)},
bounds AS (SELECT v::BIGINT AS pad_to, coalesce(lag(v) OVER (ORDER BY v), -1) AS low FROM h WHERE j IN ({bounds})),
r AS (
  SELECT q.*, pad_to, row_number() OVER (PARTITION BY pad_to ORDER BY doc_id, chunk) - 1 AS r,
         greatest(1, {TOKEN_BUDGET} // greatest(pad_to, 1)) AS capacity
  FROM q JOIN bounds ON n_tokens > low AND n_tokens <= pad_to)
SELECT doc_id, chunk::BIGINT AS chunk, start::BIGINT AS start, n_tokens::BIGINT AS n_tokens, pad_to,
       (r // capacity)::BIGINT AS batch, (r % capacity)::BIGINT AS slot
FROM r
"""


_UPPER_TO_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _sql_path(url: str) -> str:
    return rf"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _sql_origin(url: str) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*')"


def _sql_without_dots(path: str) -> str:
    """A fold over one-element lists; the first, empty, segment stays as the root."""
    left = f"""list_reduce(list_transform(string_split({path}, '/'), lambda s: [s]), lambda a, s:
      CASE WHEN s[1] = '..' THEN a[:greatest(len(a) - 1, 1)] WHEN s[1] = '.' THEN a ELSE list_concat(a, s) END)"""
    folder = f"list_contains(['.', '..'], string_split({path}, '/')[-1])"
    return rf"""CASE WHEN NOT regexp_matches({path}, '/\.\.?(/|$)') THEN {path}
      ELSE '/' || array_to_string(({left})[2:], '/') || CASE WHEN {folder} AND len({left}) > 1 THEN '/' ELSE '' END END"""


def _sql_link_key(url: str) -> str:
    query = rf"regexp_extract({url}, '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1)"
    return f"""CASE WHEN {_sql_origin(url)} = '' THEN {url}
      ELSE translate({_sql_origin(url)}, {_UPPER_TO_LOWER}) || ({_sql_without_dots(_sql_path(url))}) || {query} END"""


def _sql_decoded(value: str) -> str:
    reference = "&(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
    code = "CASE WHEN r[3] IN ('x', 'X') THEN ('0x' || r[4:-2])::INT ELSE r[3:-2]::INT END"
    character = f"""CASE r WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' WHEN '&quot;' THEN '"' WHEN '&apos;' THEN chr(39)
      ELSE CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}) ELSE chr(65533) END END"""
    return f"""array_to_string(list_transform(list_zip(regexp_split_to_array({value}, '{reference}'),
      list_append(list_transform(regexp_extract_all({value}, '{reference}'), lambda r: {character}), '')), lambda p: p[1] || p[2]), '')"""


def _op6() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
    path = _sql_path("url")
    return rf"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES {rules}),
tags AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '<[Ll][Ii][Nn][Kk]\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b')),
      lambda t: regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '<[Mm][Ee][Tt][Aa]\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
      lambda t: regexp_extract(t, '(?i)url\s*=\s*["'']?([^"''\s>]+)', 1)))) AS raw
  FROM pages WHERE contains(url, '://')),
decoded AS (SELECT url, {_sql_decoded("raw")} AS t FROM tags),
completed AS (
  SELECT url, CASE WHEN t = '' OR starts_with(t, '#') THEN NULL
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN {_sql_origin("url")} || t
    WHEN starts_with(t, '?') THEN {_sql_origin("url")} || {path} || t
    ELSE {_sql_origin("url")} || regexp_replace(CASE WHEN {path} = '' THEN '/' ELSE {path} END, '[^/]*$', '') || t END AS target FROM decoded),
ends AS (SELECT {_sql_link_key("url")} AS url, {_sql_link_key("target")} AS target FROM completed WHERE target IS NOT NULL),
links AS (SELECT DISTINCT url, target FROM ends WHERE target <> url),
both_ways AS (SELECT url AS a, target AS b FROM links UNION SELECT target, url FROM links),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
urls AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM both_ways),
parts AS (
  SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM urls),
hits AS (
  SELECT url, r.host || r.path AS rule, r.verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(r.host || r.path) DESC, r.verdict, r.host || r.path DESC) = 1),
spelled AS (SELECT url, {_sql_link_key("url")} AS node FROM urls),
judged AS (SELECT node, verdict FROM hits JOIN spelled USING (url)),
spread AS (SELECT a AS node, min(verdict) AS class_verdict FROM reach JOIN judged ON judged.node = reach.b GROUP BY a),
classes AS (SELECT url, class_verdict FROM spelled JOIN spread USING (node))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, class_verdict, 'allow') AS verdict
FROM pages LEFT JOIN parts USING (url) LEFT JOIN hits USING (url) LEFT JOIN classes USING (url)
"""


OP9 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS n, upper(sha1(html)) AS x, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, i * 5 + 1, 5))::BIGINT) >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""


#: Sources in the order of size by weight: each is closed while the level of those not yet closed would exceed its stop.
OP12 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (
  SELECT *, {list(WEIGHTS)}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::BIGINT] AS w,
         sum(source_size) OVER () AS total
  FROM s),
o AS (
  SELECT *, sum(w) OVER () AS all_w, coalesce(sum(source_size) OVER b, 0) AS size_before, coalesce(sum(w) OVER b, 0) AS w_before
  FROM p WINDOW b AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (3 * total - 4 * size_before) * w > 4 * source_size * (all_w - w_before) AS closed FROM o),
l AS (
  SELECT *, 3 * total - 4 * sum(CASE WHEN closed THEN source_size ELSE 0 END) OVER () AS spread,
         2 * sum(CASE WHEN closed THEN 0 ELSE w END) OVER () AS open_w
  FROM c),
t AS (
  SELECT source, source_size, CASE WHEN closed OR open_w = 0 THEN (2 * source_size)::DOUBLE
           ELSE least((spread * w)::DOUBLE / open_w::DOUBLE, (2 * source_size)::DOUBLE) END AS target
  FROM l),
r AS (
  SELECT d.*, source_size, target, floor(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, floor(budget / greatest(source_size, 1))::BIGINT AS epochs FROM r)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(budget - epochs * source_size - seen, size)))::BIGINT AS taken
FROM e
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op2_secret_scan": _op2(),
    "op5_length_buckets": _op5(),
    "op6_url_filter": _op6(),
    "op7_benchmark_decontamination": OP7,
    "op9_warc": OP9,
    "op12_source_mixing": OP12,
}
