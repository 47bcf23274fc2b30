"""SQL (DuckDB) for the text queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINES = f"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (SELECT *, translate(trim(line, {_SPACE}), {_UP}, {_LOW}) AS k FROM split),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT y.*, o.owner IS NULL OR o.owner = y.doc_id AS kept
           FROM keyed y LEFT JOIN owners o ON o.k = y.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE kept), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id"""

COPIES = f"""
WITH norm AS (SELECT doc_id, translate(coalesce(text, ''), {_SPACE}, '') AS t,
                     length(coalesce(text, '')) AS n FROM documents),
best AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
                count(*) OVER (PARTITION BY t) AS group_size FROM norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM best"""

PASSAGES = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h,
                  octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS win
      FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50) x),
least AS (SELECT win, min(doc_id) AS m FROM w GROUP BY win),
gone AS (SELECT w.doc_id, w.i FROM w JOIN least l ON l.win = w.win WHERE l.m < w.doc_id),
runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
    SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END
              AS fresh FROM gone) x),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS rest FROM spans
        GROUP BY doc_id),
parts AS (SELECT s.doc_id, s.a, substr(d.h, CAST(2 * coalesce(lag(s.b) OVER (
              PARTITION BY s.doc_id ORDER BY s.a), 0) + 1 AS BIGINT), CAST(2 * (s.a - coalesce(
              lag(s.b) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0)) AS BIGINT)) AS part
          FROM spans s JOIN d USING (doc_id)),
heads AS (SELECT doc_id, string_agg(part, '' ORDER BY a) AS head FROM parts GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(c.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(p.head || substr(d.h, CAST(2 * c.rest + 1 AS BIGINT)), d.h)))
           AS kept_sha256
FROM d LEFT JOIN cut c ON c.doc_id = d.doc_id LEFT JOIN heads p ON p.doc_id = d.doc_id"""


def _part(url: str, i: int) -> str:
    return f"regexp_extract({url}, '(?s)^.*?://([^/?#]*)([^?#]*)(\\??[^#]*)', {i})"


def _judged(url: str) -> str:
    """Host, path, rule and action of a URL column, as a select list."""
    host, path = f"translate(coalesce({_part(url, 1)}, ''), {_UP}, {_LOW})", f"coalesce({_part(url, 2)}, '')"

    def fits(target: str) -> str:
        rule_host, _, rule_path = target.partition("/")
        return (f"(({host}) = '{rule_host}' OR ends_with({host}, '.{rule_host}')) "
                f"AND starts_with({path}, '/{rule_path}')")

    longest = ["example.net/en/", "example.com/de/", "org/fr/", "net/"]
    rule = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{t}'" for t in longest) + " END"
    return f"{host} AS host, {path} AS path, {rule} AS rule"


def _key(url: str) -> str:
    host = f"regexp_replace(translate({_part(url, 1)}, {_UP}, {_LOW}), '^.*@|:[0-9]*$', '', 'g')"
    return (f"CASE WHEN {host} <> '' THEN {host} || CASE WHEN {_part(url, 2)} = '' THEN '/' "
            f"ELSE {_part(url, 2)} END || {_part(url, 3)} END")


def _attribute(name: str) -> str:
    value = (rf"(?is)[\s''\"]{name}\s*=\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\s\"''>]+))")
    parts = " || ".join(f"regexp_extract(tag, '{value}', {i})" for i in (1, 2, 3))
    return f"replace(trim({parts}), '&amp;', '&')"


URLS = f"""
WITH RECURSIVE bare AS (
    SELECT url, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'),
        '(?is)<script\\b.*?</script\\s*>', '', 'g'), '(?is)<style\\b.*?</style\\s*>', '', 'g') AS html
    FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh')),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag
         FROM bare),
found AS (SELECT url, CASE
        WHEN regexp_matches(tag, '(?i)^<link')
             AND list_contains(string_split_regex(lower({_attribute('rel')}), '\\s+'), 'canonical')
            THEN {_attribute('href')}
        WHEN regexp_matches(tag, '(?i)^<meta') AND lower({_attribute('http-equiv')}) = 'refresh'
            THEN trim(regexp_extract({_attribute('content')}, '(?is)url\\s*=\\s*[''"]?([^''"]*)', 1))
        END AS t FROM tags),
links AS (SELECT url, CASE
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN starts_with(t, '//') THEN 'http:' || t
        WHEN starts_with(t, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || t
        WHEN starts_with(t, '?') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || {_part('url', 2)} || t
        WHEN starts_with(t, '#') OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
        ELSE regexp_extract(url, '(?s)^.*?://[^/?#]*')
             || coalesce(nullif(regexp_replace({_part('url', 2)}, '[^/]*$', ''), ''), '/') || t END AS target
    FROM found WHERE t <> ''),
edges AS (SELECT {_key('url')} AS a, {_key('target')} AS b, url, target FROM links),
twoway AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, b FROM twoway UNION SELECT r.a, e.b FROM reach r JOIN twoway e ON e.a = r.b),
urls AS (SELECT url FROM edges WHERE a <> b UNION SELECT target FROM edges WHERE a <> b),
judged AS (SELECT {_key('url')} AS k, {_judged('url')} FROM urls),
verdicts AS (SELECT r.a AS k,
        bool_or(coalesce(j.rule IN ('net/', 'example.com/de/'), FALSE))
        AND NOT bool_or(coalesce(j.rule IN ('example.net/en/', 'org/fr/'), FALSE)) AS blocked
    FROM reach r JOIN judged j ON j.k = r.b GROUP BY r.a),
rows AS (SELECT page_id, {_key('url')} AS k, {_judged('url')} FROM pages)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN v.blocked THEN 'block' ELSE 'allow' END AS verdict
FROM rows LEFT JOIN verdicts v ON v.k = rows.k"""

# list_reduce goes through the bits of each decimal digit: the checksum 0xEDB88320, reflected.
TRIE = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
            octet_length(encode(role)) || ':' || role || text)) AS d
        FROM t),
convs AS (SELECT DISTINCT conv_id FROM t),
taken AS (SELECT conv_id, conv_id - conv_id % 5 AS family, xor(4294967295, list_reduce(
              list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                      lambda x: CAST(ascii(x) AS BIGINT))),
              lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, i:
                  xor(c >> 1, 3988292384 * (c & 1))))) % 9 AS h FROM convs),
built AS (SELECT k.conv_id, 0 AS part, o.d, o.role, o.text
          FROM taken k JOIN own o ON o.conv_id = k.family AND o.d <= k.h
          UNION ALL SELECT o.conv_id, 1, o.d, o.role, o.text
          FROM own o JOIN taken k ON k.conv_id = o.conv_id AND o.d > k.h),
seq AS (SELECT conv_id, row_number() OVER w AS depth, octet_length(encode(text)) AS size,
               sha256(string_agg(octet_length(encode(role)) || ':' || octet_length(encode(text))
                      || ':' || role || text, '') OVER w) AS k
        FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY part, d)),
path AS (SELECT conv_id, depth, size, k, lag(k, 1, '') OVER (PARTITION BY conv_id ORDER BY depth)
                AS parent FROM seq
         UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
node AS (SELECT k, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent,
                count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved FROM path GROUP BY k),
child AS (SELECT parent AS k, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY 1),
below AS (SELECT p.k, count(*) FILTER (WHERE c.k IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
          FROM node n JOIN path p ON p.conv_id = n.conv_id AND p.depth <= n.depth
          LEFT JOIN child c ON c.k = n.k GROUP BY p.k),
finish AS (SELECT arg_max(k, depth) AS k, conv_id FROM path GROUP BY conv_id),
ended AS (SELECT k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
          FROM finish GROUP BY k)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n LEFT JOIN node p ON p.k = n.parent LEFT JOIN child c ON c.k = n.k
JOIN below b ON b.k = n.k LEFT JOIN ended e ON e.k = n.k"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": URLS, "op3_line_dedup": LINES, "op4_exact_dedup": COPIES,
            "op7_suffix_dedup": PASSAGES, "op11_prefix_trie": TRIE}
