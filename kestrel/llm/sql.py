"""DuckDB SQL of the queries that SQL can express, written from what they return and not from how
the operators compute it: pairs come from plain joins on shared words, alias classes and groups
from recursive reachability, water levels from a self-join of the sources.

Left out: op2 (a parser), op8 (a trained filter), op10 (sequential best fit) and op11 (runs by their crc32 tails).
"""

from __future__ import annotations

import string

from kestrel.llm import licenses, urls

_WS = r"[\x20\x09-\x0D]"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lower(text: str) -> str:
    return f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(text: str, separators: str = _WS + "+") -> str:
    return f"[w for w in regexp_split_to_array({text}, {_quote(separators)}) if w <> '']"


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(t, {_quote(pattern)}))"


def _dots(path: str) -> str:
    fold = (f"list_reduce(string_split(substr({path}, 2), '/'), lambda a, s: CASE WHEN s = '..' THEN "
            f"regexp_replace(a, '/[^/]*\\z', '') WHEN s = '.' THEN a ELSE a || '/' || s END, '')")
    return (f"CASE WHEN regexp_matches({path}, '/\\.\\.?\\z') THEN {fold} || '/' "
            f"WHEN regexp_matches({path}, '/\\.\\.?/') THEN {fold} ELSE {path} END")


def _address(value: str) -> str:
    """A URL as an attribute holds it, without white space around it and line ends in it."""
    return f"translate(trim({value}, chr(32) || chr(9) || chr(10) || chr(12) || chr(13)), chr(9) || chr(10) || chr(13), '')"


def _attribute(tag: str, pattern: str) -> str:
    names = ", ".join(f"{_quote(k)}: {_quote(v)}" for k, v in urls.NAMED.items() if v not in "\t\n")
    code = ("CAST(CASE WHEN lower(p[3]) = 'x' THEN '0x' || p[4:length(p) - 1] ELSE p[3:length(p) - 1] END AS BIGINT)")
    return (f"array_to_string([CASE WHEN starts_with(p, '&#') THEN CASE WHEN {code} BETWEEN 1 AND 1114111 "
            f"AND {code} NOT BETWEEN 55296 AND 57343 THEN chr(CAST({code} AS INT)) ELSE chr(65533) END "
            f"WHEN p = '&Tab;' THEN chr(9) WHEN p = '&NewLine;' THEN chr(10) ELSE coalesce(MAP {{{names}}}[p], p) END "
            f"FOR p IN regexp_extract_all(trim(regexp_extract({tag}, {_quote(pattern)}, 1), chr(34) || chr(39)), {_quote(urls.PIECES)})], '')")


def _resolved(source: str, base: str, target: str, to: str) -> str:
    scheme, origin = _quote(urls.SCHEME), _quote(urls.ORIGIN)
    return rf"""SELECT * EXCLUDE (hit, hit_path), CASE WHEN regexp_extract(hit, {origin}, 1) <> '' THEN
      regexp_extract(hit, {origin}, 1) || {_dots('hit_path')} || regexp_extract(hit, '(?s)^[^?#]*(.*)', 1) END AS {to}
    FROM (SELECT *, regexp_extract(hit, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS hit_path
      FROM (SELECT *, CASE WHEN regexp_matches({target}, {scheme} || '//') THEN {target} WHEN regexp_matches({target}, {scheme}) THEN NULL
          WHEN {target} LIKE '//%' THEN regexp_extract({base}, '^([^:/?#]+):', 1) || ':' || {target}
          WHEN {target} LIKE '/%' THEN regexp_extract({base}, {origin}, 1) || {target}
          WHEN {target} LIKE '?%' THEN regexp_extract({base}, '^([^?#]*)', 1) || {target}
          WHEN {target} = '' OR {target} LIKE '#%' THEN regexp_extract({base}, '^([^#]*)', 1)
          WHEN regexp_matches({base}, {_quote(urls.FOLDER)}) THEN regexp_extract({base}, {_quote(urls.FOLDER)}, 1) || {target}
          ELSE regexp_extract({base}, {origin}, 1) || '/' || {target} END AS hit FROM {source}))"""


def _split_url(source: str, url: str) -> str:
    return rf"""SELECT * EXCLUDE (rest, query, params), CASE WHEN host <> '' THEN
      regexp_replace(host, ':(80|443)$', '') || regexp_replace({_dots('path')}, '/+$', '')
      || CASE WHEN params <> '' THEN '?' || params ELSE '' END END AS key
    FROM (SELECT *, array_to_string([p for p in string_split(query, '&')
            if p <> '' AND NOT regexp_matches(p, '(?i)^({urls.TRACKING})(=|$)')], '&') AS params
      FROM (SELECT *, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
              regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query
        FROM (SELECT *, CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3)
                ELSE '' END AS rest FROM {source})))"""


_RULES = ", ".join(f"({_quote(h)}, {_quote(p)}, {_quote(v)})" for h, p, v in urls.RULES)

URLS = rf"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES {_RULES}),
judged AS ({_split_url('(SELECT page_id, url FROM pages)', 'url')}),
markup AS (SELECT url, regexp_replace(html, {_quote(urls.UNREAD)}, ' ', 'g') AS m
  FROM pages WHERE html IS NOT NULL AND url LIKE '%://%'),
tags AS (SELECT url, regexp_extract(m, {_quote(urls.BASE)}) AS b, unnest(regexp_extract_all(m, {_quote(urls.CANONICAL)})) AS l, false AS meta FROM markup
  UNION ALL SELECT url, regexp_extract(m, {_quote(urls.BASE)}), unnest(regexp_extract_all(m, {_quote(urls.REFRESH)})), true FROM markup),
targets AS (SELECT DISTINCT url, {_address(_attribute('b', urls.HREF))} AS base_href, CASE WHEN meta THEN
  {_address(f"regexp_extract({_attribute('l', urls.CONTENT)}, {_quote(urls.REFRESH_URL)}, 1)")}
  ELSE {_address(_attribute('l', urls.HREF))} END AS t FROM tags),
based AS (SELECT url, t, coalesce(base, url) AS base FROM ({_resolved("(SELECT * FROM targets WHERE t <> '')", 'url', 'base_href', 'base')})),
absolute AS (SELECT url, target FROM ({_resolved('based', 'base', 't', 'target')}) WHERE target IS NOT NULL),
origin AS (SELECT target, key AS a FROM ({_split_url('absolute', 'url')})),
linked AS ({_split_url('origin', 'target')}),
edges AS (SELECT a, key AS b FROM linked WHERE a IS NOT NULL AND key IS NOT NULL
  UNION SELECT key, a FROM linked WHERE a IS NOT NULL AND key IS NOT NULL),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
class AS (SELECT a AS node, least(a, min(b)) AS component FROM reach GROUP BY a),
known AS (SELECT host, path, key FROM judged UNION SELECT host, path, key FROM linked),
fit AS (SELECT host, path, key, max({{'n': length(rh || rp), 'rule': rh || rp, 'v': rv}}) AS best
  FROM known JOIN rules ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp) GROUP BY ALL),
ruled AS (SELECT k.*, best, coalesce(component, k.key) AS alias FROM known k
  LEFT JOIN fit ON k.host = fit.host AND k.path = fit.path AND k.key IS NOT DISTINCT FROM fit.key
  LEFT JOIN class ON node = k.key),
spread AS (SELECT alias, bool_or(best.v = 'allow') AS allowed FROM ruled WHERE best IS NOT NULL AND alias IS NOT NULL GROUP BY alias)
SELECT j.page_id, j.url, j.host, j.path, r.best.rule AS rule,
  coalesce(r.best.v, CASE WHEN allowed = false THEN 'block' ELSE 'allow' END) AS verdict, r.alias AS alias
FROM judged j LEFT JOIN ruled r ON j.host = r.host AND j.path = r.path AND j.key IS NOT DISTINCT FROM r.key
LEFT JOIN spread s ON s.alias = r.alias
"""

def _near(words: int, columns: str) -> str:
    """Components of links at 85 percent over ``words``-word shingles; ``component`` is each one's id."""
    later = ", ".join(f"lead(w, {i}) OVER o" for i in range(1, words))
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_lower("coalesce(text, '')"))} AS ws FROM documents),
word AS (SELECT doc_id, len(ws) AS n, unnest(range(len(ws))) AS p, unnest(ws) AS w FROM w),
five AS (SELECT doc_id, n, p, hash([w, {later}]) AS sh
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
found AS (SELECT DISTINCT doc_id, sh FROM five WHERE p < greatest(1, n - {words - 1})),
sets AS (SELECT w.doc_id, coalesce(list(sh ORDER BY sh) FILTER (WHERE sh IS NOT NULL), []) AS s
  FROM w LEFT JOIN found ON found.doc_id = w.doc_id GROUP BY w.doc_id),
class AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT c, n, unnest(s) AS sh FROM class),
links AS (SELECT a.c AS x, b.c AS y FROM items a JOIN items b
    ON a.sh = b.sh AND a.c <> b.c AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
groups AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
placed AS (SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(least(c, y), c, doc_id) AS component
  FROM sets LEFT JOIN class ON sets.s = class.s LEFT JOIN groups ON x = c)
SELECT {columns} FROM placed
"""


NEAR_DUPLICATES = _near(5, "doc_id, n_shingles, component AS component_id, doc_id = component AS kept")
NGRAM_JOIN = _near(4, "doc_id, n_shingles, component AS component_id")

LINES = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS t FROM d WHERE text IS NOT NULL),
k AS (SELECT rid, doc_id, line, list_sort(list_distinct({_words(_lower('t'))})) AS s FROM l),
u AS (SELECT * FROM k WHERE len(s) > 0),
f AS MATERIALIZED (SELECT s, len(s) AS n, min({{'d': doc_id, 'l': line}}) AS first, row_number() OVER () AS c FROM u GROUP BY s),
token AS (SELECT c, n, first, unnest(s) AS w FROM f),
often AS (SELECT w, count(*) AS q FROM token GROUP BY w),
head AS (SELECT c, n, first, w FROM token JOIN often USING (w)
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY q, w) <= n - (90 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT a.c AS x, b.c AS y FROM head a JOIN head b
  ON a.w = b.w AND a.first > b.first AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n),
alike AS (SELECT DISTINCT x FROM pairs JOIN f fa ON fa.c = x JOIN f fb ON fb.c = y
  WHERE 100 * len(list_intersect(fa.s, fb.s)) >= 90 * (fa.n + fb.n - len(list_intersect(fa.s, fb.s)))),
gone AS (SELECT rid, list_sort(list(CAST(line AS INTEGER))) AS removed FROM u JOIN f USING (s) LEFT JOIN alike ON x = c
  WHERE x IS NOT NULL OR doc_id <> first.d OR line <> first.l GROUP BY rid)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(removed), 0) AS INTEGER) AS n_removed,
  coalesce(removed, CAST([] AS INTEGER[])) AS removed,
  CAST(coalesce(CASE WHEN removed IS NULL THEN length(text) ELSE length(array_to_string(
    [ls[i + 1] for i in range(len(ls)) if NOT list_contains(removed, CAST(i AS INTEGER))], chr(10))) END, 0) AS INTEGER) AS n_chars
FROM d LEFT JOIN gone USING (rid)
"""

QUALITY = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_words('t')} AS ws, string_split(t, chr(10)) AS ls FROM d),
word AS (SELECT rid, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM w),
windows AS (SELECT rid, i, w, lead(w, 1) OVER o AS x, lead(w, 2) OVER o AS y FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)),
again AS (SELECT rid, i FROM windows WHERE y IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w, x, y) > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM again, (VALUES (0), (1), (2)) AS offsets(o) GROUP BY rid),
s AS (SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
    CAST({_count('[#*$%&|<>]')} AS BIGINT) AS n_symbols,
    CAST(len([x for x in ls if regexp_matches(x, '[^\x20\x09-\x0D]')])
      - len(list_distinct([x for x in ls if regexp_matches(x, '[^\x20\x09-\x0D]')])) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
    {_count('!')} AS n_calls, {_count(r'[^\p{L}\p{M}\x20\x09-\x0D]')} AS n_other, {_count(r'\p{Lu}')} AS n_upper
  FROM w LEFT JOIN covered ON covered.rid = w.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines
    OR 2 * n_calls > n_words OR 2 * n_upper > word_chars - n_other OR 2 * n_other > word_chars) AS kept
FROM s
"""

_TEMPLATES = ", ".join(
    f"({_quote(t.label)}, [{', '.join(map(_quote, t.words))}], {t.at}, {t.size}, {str(t.base).lower()})"
    for t in licenses.TEMPLATES)

LICENCES = rf"""
WITH template(label, words, begin_at, size, base) AS (VALUES {_TEMPLATES}),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
  {_words(_lower("coalesce(text, '')"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS ws FROM documents),
place AS (SELECT rid, ws, unnest(range(len(ws))) AS p FROM d),
found AS (SELECT rid, p, label, base, len([i for i in range(len(words)) if p - begin_at + i >= 0 AND ws[p - begin_at + i + 1] = words[i + 1]])
    / CAST(len(words) AS DOUBLE) AS share
  FROM place JOIN template ON ws[p + 1] = words[begin_at + 1] AND ws[p + 1:p + size] = words[begin_at + 1:begin_at + size]),
good AS (SELECT rid, count(*) FILTER (WHERE base) AS n, min(p) FILTER (WHERE base) AS lo, max(p) FILTER (WHERE base) AS hi,
    list_sort(list_distinct(list(label) FILTER (WHERE base))) AS b, list_sort(list_distinct(list(label))) AS a, max(share) AS score
  FROM found WHERE base OR share >= {licenses.NEEDED} GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
  CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
  coalesce(array_to_string(b, ','), '') AS base_labels, coalesce(array_to_string(a, ','), '') AS labels,
  coalesce(score, 0.0) AS score
FROM d LEFT JOIN good USING (rid)
"""

TOP_K = """
WITH v AS (SELECT vec_id, [floor(CAST(x AS DOUBLE) * 1024) for x in embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

HARD_NEGATIVES = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(CAST(x AS DOUBLE) * 256) for x in embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.vec, c.vec) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size,
    len(regexp_extract_all(t, '[#*$%&|<>!]')) AS symbols,
    (CAST('0x' || substr(md5('mix|' || CAST(doc_id AS VARCHAR) || '|' || md5(t)), 1, 13) AS BIGINT) + 0.5) / CAST(16 AS DOUBLE) ** 13 AS u
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
k AS (SELECT *, -ln(u) / CASE WHEN size > 0 THEN greatest(0.05, 1 - symbols / CAST(size AS DOUBLE)) ELSE 0.05 END AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS total,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
goal AS (SELECT 1.5 * sum(total) AS words FROM s),
-- The shared words at the level where source j is just full; the first level that reaches the goal ends the search.
filled AS (SELECT 2 * j.total / CAST(j.weight AS DOUBLE) AS level,
    sum(least(2 * i.total, i.weight * 2 * j.total / CAST(j.weight AS DOUBLE))) AS words FROM s j, s i GROUP BY j.source, j.total, j.weight),
edge AS (SELECT min(level) AS level FROM filled, goal WHERE filled.words >= goal.words - 1e-6),
water AS (SELECT (max(goal.words) - sum(CASE WHEN 2 * total / CAST(weight AS DOUBLE) < level THEN 2 * total ELSE 0 END))
    / sum(CASE WHEN 2 * total / CAST(weight AS DOUBLE) < level THEN 0 ELSE weight END) AS level FROM s, goal, edge),
share AS (SELECT source, total, CAST(least(2 * total, weight * level) AS DOUBLE) AS target FROM s, water),
p AS (SELECT k.*, total, target, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN share ON k.source IS NOT DISTINCT FROM share.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, total AS source_size, target,
  CAST(size * (epochs + CASE WHEN upto + upto - size <= 2 * greatest(0, target - epochs * total) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

ORACLE: dict[str, str] = {
    "op1_url_filter": URLS,
    "op3_minhash_dedup": NEAR_DUPLICATES,
    "op4_line_dedup": LINES,
    "op5_quality_rules": QUALITY,
    "op6_license_scan": LICENCES,
    "op7_topk_search": TOP_K,
    "op9_source_mixing": MIX,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_ngram_jaccard_join": NGRAM_JOIN,
}
