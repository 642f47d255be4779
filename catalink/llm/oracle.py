"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from catalink.llm import chat, secrets

_KEY = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"


def _literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for i, r in enumerate(secrets.RULES):
        pattern = f"""({_KEY})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""" if r.kind == "assign" else r.pattern
        p = _literal(pattern)
        parts.append(f"""
  SELECT rid, {i} AS rule, '{r.kind}' AS kind, i, {r.least} AS least, len(parts[i]) AS n,
         list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: len(x))), 0) AS start,
         len(whole[i]) AS size
  FROM (SELECT rid, regexp_split_to_array(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS whole,
               regexp_extract_all(text, {p}, {r.group}) AS parts FROM d) g, unnest(range(1, len(whole) + 1)) u(i)""")
    spans = " UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({spans}),
k AS (SELECT rid, rule, kind, start, kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS span FROM s WHERE n >= least),
a AS (SELECT rid, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
             string_agg(span, ',' ORDER BY start, rule) FILTER (rule < 3) AS base, string_agg(span, ',' ORDER BY start, rule) AS spans
      FROM k GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)"""


_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT rid, doc_id, len(sh) AS n, hash(list_sort(sh)) AS h, list_sort(sh) AS sh FROM s),
c AS (SELECT min(rid) AS cls, h, n, min(doc_id) AS first, any_value(sh) AS sh FROM n WHERE n > 0 GROUP BY h, n),
t AS (SELECT cls, n, unnest(sh) AS x FROM c),
p AS (SELECT a.cls AS u, b.cls AS v FROM t a JOIN t b ON a.x = b.x AND a.cls <> b.cls
      GROUP BY a.cls, b.cls, a.n, b.n HAVING count(*) * 100 >= 80 * (a.n + b.n - count(*))),
r AS (SELECT cls AS u, cls AS v FROM c UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
m AS (SELECT r.u AS cls, min(c.first) AS component_id FROM r JOIN c ON c.cls = r.v GROUP BY r.u)
SELECT n.doc_id, n.n AS n_shingles, CASE WHEN n.n = 0 THEN n.doc_id ELSE m.component_id END AS component_id
FROM n LEFT JOIN c ON c.h = n.h AND c.n = n.n LEFT JOIN m ON m.cls = c.cls"""

_HOST = "translate(regexp_extract(substr(url, instr(url, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_URLS = rf"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN {_HOST} ELSE '' END AS host,
                  CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
                  CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*\?([^#]*)', 1) ELSE '' END AS query
           FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
k AS (SELECT *, CASE WHEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') <> '' OR host <> '' THEN
        regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') ||
        CASE WHEN len(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) > 0
             THEN '?' || array_to_string(list_sort(list_filter(string_split(query, '&'),
                  lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&') ELSE '' END END AS canon FROM p),
l AS (SELECT DISTINCT canon FROM k WHERE regexp_matches(host, '(^|\.)spam')),
f AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                     WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM k)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN canon IN (SELECT canon FROM l WHERE canon IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM f"""

_B32 = ", ".join(f"translate(to_base(('0x' || d[{1 + 10 * i}:{10 + 10 * i}])::BIGINT, 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', "
                 "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for i in range(4))
_WARC = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT d, min(page_id) AS first FROM p GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, concat({_B32}) AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN m USING (d)"""


def _chat() -> str:
    t = chat.INSTRUCT
    control = _literal(r"\\|" + "|".join("".join("\\" + c if c in "[]/<>" else c for c in w) for w in t.controls()))
    marks = " ".join(f"WHEN '{r}' THEN {len(x.before) + len(x.behind)}" for r, x in t.turns.items())
    other = sum(map(len, t.other))
    moves = ", ".join(f"('{a}', '{b}')" for a, b in t.moves)
    esc = lambda c: f"(len({c}) + len(regexp_extract_all({c}, {control})))"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, lag(role, 1, 'start') OVER w AS before, lead(role) OVER w IS NULL AS ends FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
x AS (SELECT *, (before, role) IN ({moves}) AND (NOT ends OR role = 'assistant') AS good,
             {esc('text')} + CASE role {marks} ELSE {other} + {esc('role')} END AS size FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars, bool_and(good) AS valid
FROM x GROUP BY conv_id"""


_WORDS = (r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
_DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(13, len(ws)) AS size, array_to_string(ws[s:s + least(13, len(ws)) - 1], ' ') AS win
      FROM b, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) u(s) WHERE len(ws) > 0),
z AS (SELECT DISTINCT size FROM i),
o AS (SELECT rid, s, size, array_to_string(ws[s:s + size - 1], ' ') AS win FROM d, z, unnest(range(1, len(ws) - size + 2)) u(s)),
h AS (SELECT o.rid, o.s, o.size, i.item_id FROM o JOIN i ON o.win = i.win AND o.size = i.size),
p AS (SELECT rid, count(DISTINCT x) AS n_hit FROM h, unnest(range(s, s + size)) u(x) GROUP BY rid),
q AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN q USING (rid)"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*)::BIGINT AS n_all, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
c AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, n_all),
i AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)),
h AS (SELECT item, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.ts) * n_all) // l))))::BIGINT AS score
      FROM (SELECT item, unnest(ts) AS term FROM i) JOIN c USING (term) JOIN f USING (term) JOIN d USING (rid), s GROUP BY item, rid),
r AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM h JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r JOIN i USING (item) WHERE rank <= 50"""

_SUFFIX = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS o, encode(coalesce(text, '')) AS x FROM documents),
g AS (SELECT rid, o, i, x[i + 1:i + 50] AS s FROM d, unnest(range(0, octet_length(x) - 49)) u(i)),
m AS (SELECT s, min(o) AS least FROM g GROUP BY s HAVING min(o) <> max(o)),
p AS (SELECT rid, i FROM g JOIN m USING (s) WHERE o > least),
q AS (SELECT rid, i, i - coalesce(lag(i) OVER w, -51) > 50 AS starts FROM p WINDOW w AS (PARTITION BY rid ORDER BY i)),
z AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(starts::INT) OVER (PARTITION BY rid ORDER BY i) AS k FROM q) GROUP BY rid, k),
k AS (SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS la, list(b ORDER BY a) AS lb FROM z GROUP BY rid)
SELECT doc_id, octet_length(x)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN x ELSE
         unhex(array_to_string(list_transform(range(0, n_spans + 1), lambda j: hex(
           x[CASE WHEN j = 0 THEN 0 ELSE lb[j] END + 1:CASE WHEN j = n_spans THEN octet_length(x) ELSE la[j + 1] END])), '')) END) AS kept_sha256
FROM d LEFT JOIN k USING (rid)"""

ORACLE = {
    "op3_secrets": _secrets(),
    "op4_jaccard_join": _JACCARD,
    "op5_url_filter": _URLS,
    "op7_warc": _WARC,
    "op9_chat_format": _chat(),
    "op10_decontaminate": _DECONTAMINATE,
    "op12_ranked_search": _SEARCH,
    "op13_suffix_dedup": _SUFFIX,
}
