"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def quality_sql(docs: str = "documents") -> str:
    """Rows of op1 over ``docs``, keyed by an added row number so that ids may repeat."""
    lengths = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
    grams = ", ".join(f"array_to_string(ws[i:i+{n - 1}], ' ') AS g{n}" for n in lengths)
    covered = " UNION ALL ".join(
        f"SELECT rid, {n} AS n, unnest(range(i, i + {n})) AS i, later FROM ("
        f"SELECT rid, i, row_number() OVER (PARTITION BY rid, g{n} ORDER BY i) > 1 AS later,"
        f" count(*) OVER (PARTITION BY rid, g{n}) AS c FROM grams WHERE i + {n - 1} <= nw)"
        " WHERE c > 1" for n in lengths)
    chars = ", ".join(
        f"coalesce(sum(len) FILTER (n = {n} AND later), 0)::BIGINT AS dup_chars_{n}"
        for n in lengths)
    fails = " OR ".join(f"100 * dup_chars_{n} > {p} * word_chars" for n, p in lengths.items())
    dup = ", ".join(f"coalesce(dup_chars_{n}, 0)::BIGINT AS dup_chars_{n}" for n in lengths)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {docs}),
w AS MATERIALIZED (SELECT rid, doc_id, text, regexp_extract_all(text, '{WORD}') AS ws FROM t),
pos AS MATERIALIZED (SELECT rid, ws, len(ws) AS nw, unnest(range(1, len(ws) + 1)) AS i FROM w),
grams AS MATERIALIZED (SELECT rid, nw, i, {grams} FROM pos),
marks AS (SELECT rid, n, i, bool_or(later) AS later FROM ({covered}) GROUP BY ALL),
cover AS (SELECT m.rid, count(*) FILTER (n = 5)::BIGINT AS n_repeat_words, {chars}
  FROM (SELECT marks.*, length(pos.ws[marks.i]) AS len FROM marks JOIN pos USING (rid, i)) m
  GROUP BY m.rid),
lines AS (SELECT rid, k, unnest(parts) AS line, unnest(range(len(parts))) AS o FROM (
  SELECT rid, 0 AS k, string_split(text, chr(10)) AS parts FROM w)),
seen AS (SELECT rid, length(line) AS len, row_number() OVER (PARTITION BY rid, line ORDER BY o) > 1
  AS again FROM lines WHERE regexp_matches(line, '{WORD}')),
per AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines,
  sum(len)::BIGINT AS line_chars, coalesce(sum(len) FILTER (again), 0)::BIGINT AS dup_line_chars
  FROM seen GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
  length(array_to_string(ws, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars,
  coalesce(line_chars, 0)::BIGINT AS line_chars,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, {dup}
  FROM w LEFT JOIN cover USING (rid) LEFT JOIN per USING (rid))
SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR {fails}
    OR 100 * dup_line_chars > 20 * line_chars) AS kept
FROM m"""


def mixing_sql(docs: str = "documents") -> str:
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT
    AS size, md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '') || '|' ||
    row_number() OVER (PARTITION BY doc_id, source, text) - 1) AS h FROM {docs}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nr FROM s),
v AS (SELECT *, [3, 1, 2][nr % 3 + 1] AS weight, [-0.5, 0.0, 0.5][nr % 3 + 1]::DOUBLE AS slope,
    2 * source_size AS cap FROM r),
q AS (SELECT *, cap::DOUBLE / weight::DOUBLE AS ratio,
    (sum(source_size) OVER ())::DOUBLE * 150 / 100 AS budget FROM v),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY ratio, nr ROWS BETWEEN UNBOUNDED
    PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / (sum(weight) OVER (ORDER BY ratio, nr ROWS BETWEEN
    CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM q),
t AS (SELECT source, source_size, slope, CASE WHEN level >= ratio THEN cap::DOUBLE ELSE
    (max(level) FILTER (level < ratio) OVER ()) * weight END AS target FROM l),
g AS (SELECT *, floor(target + 0.5)::BIGINT AS goal, CASE WHEN source_size > 0
    THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS passes FROM t),
p AS (SELECT d.*, source_size, slope, target, goal, passes, coalesce(sum(size) OVER (PARTITION BY
    d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
    AS start FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
k AS (SELECT *, (passes * size + greatest(0, least(size, goal - passes * source_size - start)))
    ::BIGINT AS taken, least(1.0::DOUBLE, (2 * start + size)::DOUBLE / (2.0::DOUBLE * goal)) AS u
    FROM p)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN CASE WHEN slope = 0
    THEN u ELSE (sqrt((1.0::DOUBLE - slope) * (1.0::DOUBLE - slope) + 4.0::DOUBLE * slope * u)
    - (1.0::DOUBLE - slope)) / (2.0::DOUBLE * slope) END END AS position FROM k"""


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: kind, expression (without case folding, so that only ASCII letters meet), group, least size
SECRET_KINDS = (
    ("assign", "(" + _any_case("password|passwd|secret|token|api_?key")
     + r""")["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 20),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 26),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("cloud", "AIza[0-9A-Za-z_-]{35}", 0, 39),
    ("bearer", "(" + _any_case("bearer") + ") +[A-Za-z0-9+/_.=-]{20,}", 0, 27),
    ("login", r"[a-z]{2,10}://[^/\x20:@\x22\x27]+:[^/\x20:@\x22\x27]+@", 0, 10),
)


def secrets_sql(docs: str = "documents") -> str:
    found = " UNION ALL ".join(
        f"SELECT rid, {rank} AS rank, '{kind}' AS kind, unnest(string_split_regex(text, '{p}')) AS"
        f" gap, unnest(regexp_extract_all(text, '{p}', 0)) AS hit, unnest(regexp_extract_all(text,"
        f" '{p}', {group})) AS own, unnest(range(len(regexp_extract_all(text, '{p}')))) AS i, {least}"
        f" AS least FROM t WHERE regexp_matches(text, '{p}')"
        for rank, (kind, p, group, least) in enumerate(SECRET_KINDS))
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {docs}),
f AS ({found}),
s AS (SELECT rid, rank, kind, least, length(own) AS own, length(hit) AS size, sum(length(gap)
  + length(hit)) OVER (PARTITION BY rid, rank ORDER BY i) - length(hit) AS start
  FROM f WHERE hit IS NOT NULL),
k AS (SELECT rid, rank, kind, start, concat(kind, ':', start::BIGINT, ':', (start + size)::BIGINT)
  AS span FROM s WHERE own >= least),
a AS (SELECT rid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
  count(*) FILTER (rank = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
  string_agg(span, ',' ORDER BY start, rank) AS spans FROM k GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM t LEFT JOIN a USING (rid)"""


def urls_sql(pages: str = "pages") -> str:
    """Tags from splitting at ``<``, attributes from splitting at their names, hosts and paths by
    position, dot segments by a fold over a list."""
    rules = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    table = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    quote = chr(39) * 2  # as it stands in a literal

    def parts(source: str, url: str) -> str:
        """host, path and query of ``url`` in every row of ``source``."""
        end = ", ".join(f"coalesce(nullif(strpos(rest, '{c}'), 0), length(rest) + 1)" for c in "/?#")
        return f"""
    (SELECT * EXCLUDE (rest, cut, tail), translate(left(rest, cut), '{upper}', '{lower}') AS host,
       split_part(tail, '?', 1) AS path,
       substr(tail, 1 + length(split_part(tail, '?', 1))) AS query
     FROM (SELECT *, split_part(substr(rest, cut + 1), '#', 1) AS tail
       FROM (SELECT *, least({end}) - 1 AS cut
         FROM (SELECT *, CASE WHEN strpos({url}, '://') > 0
           THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END AS rest FROM {source}))))"""

    solved = """'/' || array_to_string(list_concat(list_reduce(
        list_transform(string_split(path, '/')[2:], lambda s: [s]),
        lambda held, s: CASE s[1] WHEN '.' THEN held WHEN '..' THEN held[:len(held) - 1]
          ELSE list_concat(held, s) END, []::VARCHAR[]),
        CASE WHEN list_contains(['.', '..'], string_split(path, '/')[-1]) THEN [''] ELSE [] END),
        '/')"""
    node = f"host || CASE WHEN path = '' THEN '/' ELSE {solved} END || query"

    def attribute(name: str) -> str:
        value = f"ltrim(substr(body, strpos(lower(body), '{name}=') + {len(name) + 1}))"
        bare = (f"CASE WHEN strpos(lower(body), '{name}=') = 0 THEN '' "
                f"WHEN left({value}, 1) = '\"' THEN split_part({value}, '\"', 2) "
                f"WHEN left({value}, 1) = '{quote}' THEN split_part({value}, '{quote}', 2) "
                f"ELSE split_part({value}, ' ', 1) END")
        for entity, char in (("&quot;", '"'), ("&apos;", quote), ("&#39;", quote), ("&lt;", "<"),
                             ("&gt;", ">"), ("&#47;", "/"), ("&#x2F;", "/"), ("&#38;", "&"),
                             ("&amp;", "&")):
            bare = f"replace({bare}, '{entity}', '{char}')"
        return f"trim({bare})"

    numbered = f"(SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url, html FROM {pages})"
    linked = "(SELECT a AS node, a_url AS u FROM z UNION SELECT b, b_url FROM z)"
    return f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {table}),
t AS MATERIALIZED (SELECT *, CASE WHEN host <> '' THEN {node} END AS node
  FROM {parts(numbered, 'url')}),
tags AS (SELECT rid, lower(left(piece, 4)) AS kind, regexp_replace(replace(replace(
    split_part(substr(piece, 5), '>', 1), chr(10), ' '), chr(9), ' '), ' *= *', '=', 'g') AS body
  FROM (SELECT rid, unnest(string_split(html, '<')) AS piece FROM t)
  WHERE lower(left(piece, 4)) IN ('link', 'meta') AND contains(piece, '>')),
x AS (SELECT rid, CASE WHEN kind = 'link' THEN
    CASE WHEN list_contains(string_split(lower({attribute('rel')}), ' '), 'canonical')
      THEN {attribute('href')} END
  WHEN lower({attribute('http-equiv')}) = 'refresh' THEN trim(split_part(regexp_replace(ltrim(
    split_part(replace({attribute('content')}, ',', ';'), ';', 2)), '^(?i)url *= *', ''), ' ', 1),
    '"{quote}') END AS to_url FROM tags),
y AS (SELECT t.node AS a, t.url AS a_url, CASE
  WHEN regexp_matches(to_url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN to_url
  WHEN starts_with(to_url, '//') THEN 'http:' || to_url
  WHEN starts_with(to_url, '/') THEN 'http://' || host || to_url
  WHEN starts_with(to_url, '?') THEN 'http://' || host || path || to_url
  ELSE 'http://' || host || CASE WHEN path = '' THEN '/' ELSE
    left(path, length(path) - length(string_split(path, '/')[-1])) END || to_url END AS b_url
  FROM x JOIN t USING (rid) WHERE to_url <> '' AND NOT starts_with(to_url, '#') AND host <> ''),
z AS (SELECT a, a_url, b_url, {node} AS b FROM {parts('y', 'b_url')} WHERE host <> ''),
e AS (SELECT DISTINCT a, b FROM z UNION SELECT b, a FROM z),
reach(n, m) AS (SELECT a, a FROM e UNION SELECT reach.n, e.b FROM reach JOIN e ON e.a = reach.m),
comp AS (SELECT n, min(m) AS component FROM reach GROUP BY n HAVING count(DISTINCT m) > 1),
v AS (SELECT * FROM {parts(linked, 'u')}),
best AS (SELECT node, u, arg_max(verdict, length(rhost || rpath)) AS verdict FROM v JOIN rules ON
  (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY node, u),
said AS (SELECT component, bool_or(verdict = 'allow') AS allows, bool_or(verdict = 'block') AS
  blocks FROM comp JOIN best ON node = n GROUP BY component),
hit AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
  arg_max(verdict, length(rhost || rpath)) AS verdict FROM t JOIN rules ON
  (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, hit.rule AS rule, coalesce(hit.verdict, CASE WHEN allows THEN 'allow'
  WHEN blocks THEN 'block' END, 'allow') AS verdict, component AS aliases
FROM t LEFT JOIN hit USING (rid) LEFT JOIN comp ON n = t.node LEFT JOIN said USING (component)"""


def jaccard_sql(docs: str = "documents", words_each: int = 4, percent: int = 85) -> str:
    k = words_each - 1
    return rf"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(
  coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
  FROM {docs}),
s AS MATERIALIZED (SELECT DISTINCT rid, CASE WHEN len(ws) <= {k} THEN array_to_string(ws, ' ')
  ELSE array_to_string(ws[i:i+{k}], ' ') END AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(2, len(ws) - {k - 1}))) AS i FROM t
        WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.rid < b.rid
  GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON a = x.rid JOIN n y ON b = y.rid
  WHERE 100 * i >= {percent} * (x.n + y.n - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT r.a AS rid, min(doc_id) AS component_id FROM r JOIN t ON t.rid = r.b GROUP BY r.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN c.rid IS NULL THEN doc_id
  ELSE component_id END AS component_id FROM t LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)"""


def vectors_sql(table: str = "embeddings", least: float = 0.93) -> str:
    """Exact over all pairs of a label, for small tables."""
    return f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, vec_id, label,
  list_transform(embedding, lambda x: x::DOUBLE) AS v FROM {table}),
s AS MATERIALIZED (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM t
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x)))
  = 0 AND list_sum(list_transform(v, lambda x: abs(x))) > 0),
e AS MATERIALIZED (SELECT a.rid AS a, b.rid AS b FROM s a JOIN s b ON a.label = b.label
  AND a.rid <> b.rid AND len(a.v) = len(b.v)
  AND list_inner_product(a.v, b.v) >= {least} * a.norm * b.norm),
n AS (SELECT a AS rid, count(*) AS n FROM e GROUP BY a),
r(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT r.a AS rid, min(vec_id) AS component_id FROM r JOIN t ON t.rid = r.b GROUP BY r.a),
o AS (SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, CASE WHEN c.rid IS NULL THEN vec_id ELSE
  component_id END AS component_id FROM t LEFT JOIN n USING (rid) LEFT JOIN c USING (rid))
SELECT *, coalesce(vec_id = component_id, false) AS kept FROM o"""


def warc_sql(pages: str = "pages") -> str:
    """Exact where page_ids are neither null nor repeated."""
    five = "substr(hex, 5 * j + 1, 5)"
    value = " + ".join(
        f"(strpos('0123456789abcdef', substr({five}, {k}, 1)) - 1) * {16 ** (5 - k)}"
        for k in range(1, 6))
    chars = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
                        f"(({value}) // {1 << shift}) % 32 + 1, 1)" for shift in (15, 10, 5, 0))
    return f"""
WITH t AS (SELECT page_id, coalesce(html, '') AS payload FROM {pages}),
s AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex,
  max(page_id) OVER (PARTITION BY payload) AS top FROM t)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda j: {chars}), '')
  AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM s"""


def conversations_sql(table: str = "conversations") -> str:
    """Row by row from the left, the least cost and audit of each place in the pattern, as one
    string of twelve digits and the audit."""
    plus = lambda x, cost, edit: (
        f"lpad((left({x}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({x}, 13) || '{edit}'")
    least = lambda *of: f"least({', '.join(of)})"
    opened = f"""SELECT conv_id, i, a, b, {least("c", *(plus(x, 5, "I") for x in "abd"))} AS c,
      {least("d", plus("c", 5, "I"), plus("a", 10, "II"), plus("b", 10, "II"))} AS d"""
    stay = lambda frm, initial: (
        f"CASE WHEN kind < 2 AND initial = '{initial}' THEN {plus(frm, '5 * kind', 'K')} END")
    turn = lambda frm: f"CASE WHEN kind < 2 THEN {plus(frm, '1 + 5 * kind', 'R')} END"
    crc = """list_reduce(list_transform(range(1, strlen(s) + 1), lambda k: ord(s[k])::BIGINT),
      lambda c, x: list_reduce(range(8), lambda y, z: CASE WHEN y % 2 = 1
        THEN xor(y // 2, 3988292384) ELSE y // 2 END, xor(c, x)), 4294967295)"""
    return f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM {table}),
h AS (SELECT *, xor({crc}, 4294967295) % 20 AS f FROM t),
r AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN ''
  WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE f <> 0),
n AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM r),
q AS (SELECT *, NOT regexp_matches(text, '{WORD}') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM n),
k AS MATERIALIZED (SELECT *, CASE WHEN blank OR again THEN 2 WHEN cut THEN 1 ELSE 0 END AS kind
  FROM q),
ids AS MATERIALIZED (SELECT DISTINCT conv_id FROM {table}),
v AS (SELECT conv_id, 0::BIGINT AS i, repeat('0', 12) AS a, NULL::VARCHAR AS b, NULL::VARCHAR AS c,
    NULL::VARCHAR AS d FROM ids
  UNION ALL SELECT o.conv_id, k.i, {plus("a", 2, "D")},
    {least(plus("b", 2, "D"), stay("a", "s"))},
    {least(plus("c", 2, "D"), *(f(x) for x in "abd" for f in (lambda y: stay(y, "u"), turn)))},
    {least(plus("d", 2, "D"), stay("c", "a"), turn("c"))}
  FROM ({opened} FROM v) o JOIN k ON k.conv_id IS NOT DISTINCT FROM o.conv_id AND k.i = o.i + 1),
e AS MATERIALIZED (SELECT conv_id, left(least(a, d), 12)::BIGINT AS cost,
  substr(least(a, d), 13) AS audit FROM ({opened} FROM v)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
l AS (SELECT conv_id, unnest(range(1, strlen(audit) + 1)) AS pos, audit FROM e),
m AS (SELECT conv_id, pos, audit[pos] AS edit, count(*) FILTER (audit[pos] <> 'I') OVER w AS i,
  count(*) FILTER (audit[pos] <> 'D') OVER w AS place FROM l
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
z AS (SELECT m.conv_id, m.pos, m.edit, m.place, k.role, k.text, bool_or(m.place = 1
  AND m.edit = 'K' AND k.initial = 's') OVER (PARTITION BY m.conv_id)::INT AS lead FROM m
  LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM m.conv_id AND k.i = m.i AND m.edit <> 'I'
  WHERE m.edit <> 'D'),
y AS (SELECT conv_id, string_agg(CASE edit WHEN 'K' THEN role ELSE
  CASE (place - lead) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END || ':' || coalesce(text, ''),
  chr(10) ORDER BY pos) AS whole FROM z GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
  count(*) FILTER (kind = 1) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM k GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, e.cost, e.audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM ids LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM ids.conv_id"""


ORACLE_SQL = {
    "op2_ngram_jaccard": jaccard_sql(),
    "op1_quality_rules": quality_sql(),
    "op3_url_filters": urls_sql(),
    "op4_secret_scans": secrets_sql(),
    "op8_embedding_dedup": vectors_sql(),
    "op10_mixing": mixing_sql(),
    "op12_warc": warc_sql(),
    "op13_conversations": conversations_sql(),
}
