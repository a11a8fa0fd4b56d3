"""DuckDB SQL of the queries that SQL can express, written without the operators' methods.

They run over whole tables and texts: set intersections by a join on shingles, windows of bytes
as strings, spans from the pieces between matches. The trained, tokenizing and graphical
queries have none; tests/llm holds them against brute force.
"""

from shelfspark.llm import quality, secrets
from shelfspark.llm.url_filter import LOWER, SQL as URL_SQL, UPPER

_SPACE = r"[\x20\x09-\x0D]+"

NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_SPACE}'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT u, v FROM (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL) p
  JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * c >= 85 * (nu.n + nv.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, link.v FROM reach JOIN link ON link.u = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id, n.n"""


def _found(kind: int, pattern: str, least: int, group: int = 0) -> str:
    """Spans of one kind: the pieces between the matches give the positions."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {kind} AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
      'lo': list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0),
      'size': length(m[i]), 'value': length(g[i]), 'text': m[i]}}), recursive := true)
  FROM (SELECT doc_id, regexp_split_to_array(t, '{p}') AS p, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS g
        FROM t WHERE regexp_matches(t, '{p}')) x"""


_ALLOWED = " OR ".join(f"regexp_matches(c.text, '{p}')" for p in secrets.ALLOWED if "\\1" not in p)
_JOIN = "string_agg(kind_name || ':' || lo || ':' || hi, ',' ORDER BY lo, kind)"
SECRETS = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  SELECT doc_id, kind, lo, lo + size AS hi FROM ({_found(0, secrets.ASSIGN, 8, 2)}) a WHERE value >= {secrets.LEAST_VALUE}
  UNION ALL SELECT doc_id, kind, lo, lo + size FROM ({_found(1, secrets.ACCESS, 16)}) a WHERE size >= {secrets.LEAST_ACCESS}
  UNION ALL SELECT doc_id, kind, lo, lo + size FROM ({_found(2, "[0-9a-f]{32,}", 32)}) a),
found AS (SELECT * FROM ({_found(3, secrets.CANDIDATE, 20)}) c),
met AS (
  SELECT c.doc_id, c.kind, c.lo, c.text, b.lo AS b_lo, b.hi AS b_hi FROM found c JOIN base b ON b.doc_id = c.doc_id AND b.lo < c.lo + c.size AND c.lo < b.hi
  UNION ALL SELECT doc_id, kind, lo, text, lo + size, lo + size FROM found),
cut AS (
  SELECT doc_id, kind, lo AS whole, text, b_lo, greatest(lo, coalesce(max(b_hi) OVER (
      PARTITION BY doc_id, lo ORDER BY b_lo, b_hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)) AS lo FROM met),
c AS (
  SELECT * FROM (SELECT doc_id, kind, lo, CAST(b_lo - lo AS BIGINT) AS size, substr(text, CAST(lo - whole + 1 AS BIGINT), CAST(b_lo - lo AS BIGINT)) AS text FROM cut WHERE b_lo - lo >= {secrets.SHORTEST}) c
  WHERE NOT ({_ALLOWED} OR len(list_distinct(string_split(c.text, ''))) = 1)),
windows AS (
  SELECT doc_id, kind, lo, size, i, if(regexp_matches(text, '^[0-9a-fA-F]+$'), {secrets.LEAST_BITS['hex']}, {secrets.LEAST_BITS['mixed']}) AS least,
         string_split(substr(text, i, {secrets.WINDOW}), '') AS w
  FROM (SELECT *, unnest(range(1, size - {secrets.WINDOW} + 2)) AS i FROM c) x),
added AS (
  SELECT doc_id, kind, lo + min(i) - 1 AS lo, lo + max(i) - 1 + {secrets.WINDOW} AS hi FROM windows
  WHERE log2({secrets.WINDOW}) - list_sum(list_transform(list_distinct(w), lambda x: len(list_filter(w, lambda y: y = x)) * log2(len(list_filter(w, lambda y: y = x)))))
        / {secrets.WINDOW} >= least - 1e-9
  GROUP BY doc_id, kind, windows.lo, size),
every AS (
  SELECT *, ['{"', '".join(secrets.KINDS)}'][kind + 1] AS kind_name FROM (FROM base UNION ALL FROM added) u)
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce({_JOIN} FILTER (kind < 3), '')) AS base_sha256, coalesce({_JOIN}, '') AS spans
FROM t LEFT JOIN every ON every.doc_id = t.doc_id
GROUP BY t.doc_id"""

_SHARES = {"symbol_share": "n_symbols / greatest(word_chars, 1)", "upper_share": "n_upper / greatest(word_chars, 1)",
           "bang_share": "n_bang / greatest(word_chars, 1)", "repeat_share": "n_repeat_words / greatest(n_words, 1)",
           "dup_line_share": "n_dup_lines / greatest(n_lines, 1)"}
_GRID = ", ".join(f"{{'feature': '{f}', 'cutoff': CAST({c} AS DOUBLE), 'hit': {_SHARES[f]} >= {c}}}"
                  for f, cuts in quality.CUTOFFS.items() for c in cuts)
_ANY = " OR ".join(f"coalesce({e} >= max(cutoff) FILTER (feature = '{f}'), false)" for f, e in _SHARES.items())
QUALITY = rf"""
WITH t AS (SELECT row_number() OVER () AS id, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS k
      FROM (SELECT id, unnest(range(1, len(w) - 6)) AS i, array_to_string(w[i:i + 7], ' ') AS g FROM w WHERE len(w) >= 8) x),
r AS (SELECT id, count(DISTINCT p) AS n_repeat_words FROM (SELECT id, unnest(range(i, i + 8)) AS p FROM g WHERE k > 1) x GROUP BY id),
f AS (
  SELECT id, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper,
         CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bang, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (id)),
b AS (SELECT *, n_words < {quality.FEWEST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed FROM f),
tested AS (
  SELECT stratum, feature, cutoff, count(*) FILTER (held AND good) AS n, count(*) FILTER (held AND good AND hit) AS k,
         count(*) FILTER (NOT held AND good AND hit) AS good_hits, count(*) FILTER (NOT held AND NOT good AND hit) AS bad_hits
  FROM (SELECT stratum, good > 0 AS good, md5(CAST(doc_id AS VARCHAR))[1] < '8' AS held, unnest([{_GRID}], recursive := true)
        FROM b JOIN (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l USING (doc_id)
        WHERE NOT base_failed) x
  GROUP BY ALL),
useful AS (SELECT * FROM tested WHERE bad_hits > 0 AND bad_hits >= {quality.PRECISION} * good_hits),
shared AS (
  SELECT *, {quality.LIMIT} / (SELECT count(DISTINCT feature) FROM useful o WHERE o.stratum = useful.stratum) AS alpha,
         {quality.DELTA} / (SELECT count(*) FROM (SELECT DISTINCT stratum, feature FROM useful) o) AS level FROM useful),
tail AS (
  SELECT *, if(k > n * alpha, 1, list_sum(list_transform(range(0, k + 1), lambda j: exp(
             lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(alpha) + (n - j) * ln(1 - alpha))))) AS p
  FROM shared),
cuts AS (
  SELECT stratum, feature, min(cutoff) AS cutoff
  FROM (SELECT *, max(p) OVER (PARTITION BY stratum, feature ORDER BY cutoff DESC) AS worst FROM tail) x
  WHERE worst <= level
  GROUP BY stratum, feature)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({_ANY}) AS kept
FROM b LEFT JOIN cuts USING (stratum)
GROUP BY id, doc_id, stratum, n_words, word_chars, n_lines, n_dup_lines, n_symbols, n_upper, n_bang, n_repeat_words, base_failed"""

SUBSTRINGS = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, n - 49)) AS i FROM h) x),
gone AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win) x WHERE first < doc_id),
runs AS (
  SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi
  FROM (SELECT doc_id, i, sum(CAST(i > last + 50 AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i) AS last FROM gone) y) x
  GROUP BY doc_id, run),
listed AS (SELECT doc_id, list({'lo': lo, 'hi': hi} ORDER BY lo) AS r FROM runs GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(list_sum(list_transform(r, lambda x: x.hi - x.lo)), 0) AS BIGINT) AS n_removed,
       CAST(coalesce(len(r), 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN r IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(r) + 1), lambda k: substr(
           h, 2 * (if(k = 0, 0, r[k].hi)) + 1, 2 * (if(k = len(r), n, r[k + 1].lo) - if(k = 0, 0, r[k].hi)))), '') END)) AS kept_sha256
FROM h LEFT JOIN listed USING (doc_id)"""

TRIE = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS n, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS t
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'t': t, 'n': n} ORDER BY turn NULLS FIRST, role, t) AS own FROM turns GROUP BY conv_id),
taken AS (
  SELECT conv_id, own, CAST(xor(list_reduce(string_split(CAST(conv_id AS VARCHAR), ''), lambda a, c: list_reduce(
      list_prepend(xor(a, ord(c)), range(8)), lambda x, k: if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1)), 4294967295), 4294967295) % 6 AS INTEGER) AS h
  FROM (SELECT conv_id, own FROM own) x),
r AS (
  SELECT a.conv_id, list_concat(coalesce(b.own[:a.h], []), a.own[a.h + 1:]) AS r
  FROM taken a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
d AS (SELECT conv_id, r, unnest(range(0, len(r) + 1)) AS depth FROM r),
node AS (
  SELECT r[:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(r[depth].n), 0) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(r) = depth), '')) AS ends_sha256
  FROM d GROUP BY r[:depth], depth),
child AS (SELECT p[:depth - 1] AS p, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
every AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (p, depth)),
under AS (
  SELECT p[:up] AS p, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM every) x GROUP BY ALL)
SELECT every.conv_id, every.depth, above.conv_id AS parent_conv_id, every.n_convs, every.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, every.ends_sha256
FROM every JOIN under USING (p, depth) LEFT JOIN every above ON above.depth = every.depth - 1 AND above.p = every.p[:every.depth - 1]"""

AUDIT = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
s AS (SELECT lang, source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT k.lang, s.source, k.term, coalesce(c.n, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n::HUGEINT + v.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (v.n::HUGEINT + v.v) AS q
  FROM k JOIN s USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = k.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every) x
WHERE part = 'pair' OR rank <= 200"""

SQL = {"op12_conversation_trie": TRIE, "op13_source_audit": AUDIT, **URL_SQL, "op2_near_dedup": NEAR, "op3_secrets": SECRETS, "op4_quality": QUALITY, "op9_substring_dedup": SUBSTRINGS}
