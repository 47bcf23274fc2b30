"""URL rules whose decisions follow redirects and canonical links.

A rule allows or blocks a host with all its subdomains below a path; the longest fitting rule
decides.  Pages without a rule of their own are judged by what they are aliases of: redirects
(meta refresh in a page, or a table of crawled redirects) and canonical links are edges between
URLs, and URLs connected by edges are one resource.  A component in which a rule blocks some URL
is blocked as a whole, unless a rule explicitly allows one of its URLs: an explicit allow takes
precedence.  Targets count even where they are not pages of the table.  Components are found
with joins and least-neighbour aggregates, so a URL with very many aliases stays in no one task.

The key of a URL is its host, path and query; scheme, user, port and fragment do not matter.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and
has no alias; a null html has no edges; repeated rows are judged alike; an empty table gives an
empty result; columns other than id, url and html are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.components import components
from basketry.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``target`` is a host and a path, as ``example.net/en/``."""

    action: str
    target: str

    @property
    def host(self) -> str:
        return self.target.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.target.partition("/")[2]


RULES = (Rule(BLOCK, "net/"), Rule(ALLOW, "example.net/en/"), Rule(BLOCK, "example.com/de/"),
         Rule(ALLOW, "org/fr/"))

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|textarea)\b.*?</\1\s*>"
_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def url_key(url: Column) -> Column:
    """Host, path and query; null where there is no host."""
    host = F.regexp_replace(host_of(url), r"^.*@|:[0-9]*$", "")
    path = path_of(url)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path),
                                       F.regexp_extract(url, _PARTS, 3)))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct ``(rule, action)`` of the longest fitting rule, else null; allow wins a tie."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.target), r.action == ALLOW)):
        fits = (((host == rule.host) | host.endswith("." + rule.host))
                & path.startswith(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.target).alias("rule"),
                                      F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    parts = [F.regexp_extract(tag, rf"(?is)[\s\"']{name}{_VALUE}", i) for i in (1, 2, 3)]
    return F.replace(F.trim(F.concat(*parts)), F.lit("&amp;"), F.lit("&"))


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and new columns.  The generator keeps later expressions from being merged with
    these, which would repeat each pattern wherever its result is used."""
    made = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select(*keep, F.inline(F.array(made)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, target)`` of canonical links and meta refreshes, targets made absolute."""
    html = F.col(f"`{html_col}`").cast("string")
    tags = (pages.select(F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html"))
            .where(F.col("html").rlike(r"(?i)canonical|refresh"))
            .select("url", F.explode(F.regexp_extract_all(
                F.regexp_replace("html", _HIDDEN, ""), F.lit(_TAGS), 0)).alias("tag")))
    tag = F.col("tag")
    parts = _once(tags, ["url", "tag"], rel=_attribute(tag, "rel"), href=_attribute(tag, "href"),
                  equiv=_attribute(tag, "http-equiv"), content=_attribute(tag, "content"))
    canonical = tag.rlike(r"(?i)^<link") & F.array_contains(
        F.split(F.lower("rel"), r"\s+"), "canonical")
    refresh = tag.rlike(r"(?i)^<meta") & (F.lower("equiv") == "refresh")
    moved = F.trim(F.regexp_extract("content", r"(?is)url\s*=\s*['\"]?([^'\"]*)", 1))
    found = _once(parts, ["url"], to=F.when(canonical, F.col("href")).when(refresh, moved))
    url = F.col("url")
    found = _once(found.where("to <> ''"), ["url", "to"], path=path_of(url),
                  root=F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0))
    to, root, path = F.col("to"), F.col("root"), F.col("path")
    folder = F.regexp_replace(path, r"[^/]*$", "")
    target = (F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
              .when(to.startswith("//"), F.concat(F.lit("http:"), to))
              .when(to.startswith("/"), F.concat(root, to))
              .when(to.startswith("?"), F.concat(root, path, to))
              .when(to.startswith("#") | to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
              .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), to)))
    return _once(found, ["url"], target=target)


def alias_verdicts(links: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(key, blocked)`` for every URL that has an alias, from ``(url, target)`` links."""
    edges = _once(links, [], a=url_key(F.col("url")), b=url_key(F.col("target")),
                  urls=F.array("url", "target"))
    edges = materialise(edges.where("a <> b"), "aliases")
    roots = components(edges)
    judged = edges.select(F.explode("urls").alias("url")).select(
        url_key(F.col("url")).alias("node"),
        fitting_rule(host_of(F.col("url")), path_of(F.col("url")), rules)["action"]
        .alias("action")).distinct()
    groups = (roots.join(judged, "node").groupBy("root").agg(
        (F.coalesce(F.bool_or(F.col("action") == BLOCK), F.lit(False))
         & ~F.coalesce(F.bool_or(F.col("action") == ALLOW), F.lit(False))).alias("blocked")))
    return roots.join(groups, "root").select(F.col("node").alias("key"), "blocked")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", *, rules: tuple[Rule, ...] = RULES,
          redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row.

    ``redirects``: crawled redirects ``(url, target)`` beside what the pages themselves say.
    """
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionAll(redirects.select("url", "target"))
    url = F.col(f"`{url_col}`").cast("string")
    rows = _once(pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url")),
                 ["page_id"], host=host_of(F.col("url")), path=path_of(F.col("url")),
                 key=url_key(F.col("url")))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    return (rows.join(alias_verdicts(links, rules), "key", "left")
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.action", F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
                    .alias("verdict")))
