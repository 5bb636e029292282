"""URL filters with redirect equivalence.

A URL is judged by the longest rule (host and path) that fits it. URLs that no rule
fits are judged through their aliases: redirects (``meta http-equiv=refresh`` and a table
of redirects, if given) and canonical links (``link rel=canonical``) are edges between
URLs, the connected components of the edges are classes of aliases, and a class in which
a rule blocks one URL is blocked. An explicit allow has precedence: a URL whose own rule
allows it is allowed, whatever its aliases are; likewise a rule that allows wins over one
of the same length that blocks. What neither a rule nor an alias decides is allowed.

The nodes of the graph are URLs without fragment, with lower-case scheme and host (their
SHA-256, so that the width of a row is bounded). Link targets are judged by the rules too,
whether they are pages or not.

Rules are a list known when the query is planned (a filter over a literal table). Only URLs
are read to judge; the html column is read once, for the links, and only tags of pages that
name a canonical link or refresh are looked at. Comments, scripts and styles hold no
links; a tag ends at the next ``<`` or ``>``; relative addresses are resolved against the
page's URL (``<base>`` and dot segments are not).

Odd rows: a null URL, or one without ``://``, has an empty host and path, no rule and no
aliases: allowed. A null html has no links. Repeated rows and repeated URLs are judged
alike, each row comes out; other columns pass through (the four new ones replace columns of
their names). An empty table gives no rows; no rules: all allowed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stage
from parley.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SCHEME = r"(?s)^(.*?)://"
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)|<style\b.*?(?:</style|\z)"
TAG = r"(?i)<(?:link|meta)[ \t\n\f\r/][^<>]*"
ATTRIBUTE = "([^ \\t\\n\\f\\r\"'/=<>]+)[ \\t\\n\\f\\r]*=[ \\t\\n\\f\\r]*(\"[^\"]*\"|'[^']*'|[^ \\t\\n\\f\\r\"'=<>`]+)"
REFRESH = r"(?is)^[ \t\n\f\r]*[0-9.]*[ \t\n\f\r;,]*url[ \t\n\f\r]*=[ \t\n\f\r]*[\"']?([^\"']*)"
LINKED = "(?i)canonical|refresh"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z), path; both empty for a null URL and one without ``://``."""
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, PARTS, 1), UPPER, LOWER), F.regexp_extract(known, PARTS, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits, or null."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    known = F.array(*[F.struct(F.lit(len(h + p)).alias("size"), F.lit(verdict == "allow").alias("allows"), F.lit(h + p).alias("rule"),
                               F.lit(verdict).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for verdict, h, p in rules])
    fits = F.filter(known, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def node(url: Column) -> Column:
    """A URL as a node: no fragment, scheme and host in lower case, ``/`` for no path; null without ``://``."""
    host, path = host_and_path(url)
    scheme = F.translate(F.regexp_extract(url, SCHEME, 1), UPPER, LOWER)
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host, F.when(path == "", F.lit("/")).otherwise(path), query))


def resolve(url: Column, target: Column) -> Column:
    """The address ``target`` as seen from the page ``url``."""
    host, path = host_and_path(url)
    scheme = F.regexp_extract(url, SCHEME, 1)
    origin = F.concat(scheme, F.lit("://"), host)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
            .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
            .when(F.startswith(target, F.lit("/")), F.concat(origin, target))
            .when(target.rlike(r"^[?#]") | (target == ""), F.concat(origin, path, target))
            .otherwise(F.concat(origin, F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1)), target)))


def attribute(tag: Column, name: str) -> Column:
    """The first value of an attribute, without its quotes; null if there is none."""
    pairs = F.arrays_zip(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)).alias("name"), F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2)).alias("value"))
    found = F.get(F.filter(pairs, lambda p: F.lower(p["name"]) == name), F.lit(0))["value"]
    return F.when(found.rlike("^[\"']"), F.substring(found, F.lit(2), F.length(found) - 2)).otherwise(found)


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) URLs of the canonical links and refresh redirects of ``pages``."""
    seen = pages.filter((F.instr(url_col, "://") > 0) & F.col(html_col).rlike(LINKED)).select(
        F.col(url_col).alias("source"), F.explode(F.regexp_extract_all(F.regexp_replace(html_col, UNSEEN, " "), F.lit(TAG), F.lit(0))).alias("tag"))
    rel = F.concat(F.lit(" "), F.regexp_replace(F.lower(attribute(F.col("tag"), "rel")), r"[\t\n\f\r]", " "), F.lit(" "))
    canonical = F.when(F.col("tag").rlike("(?i)^<link") & F.contains(rel, F.lit(" canonical ")), attribute(F.col("tag"), "href"))
    refresh = F.when(F.col("tag").rlike("(?i)^<meta") & (F.lower(F.trim(attribute(F.col("tag"), "http-equiv"))) == "refresh"),
                     F.nullif(F.regexp_extract(attribute(F.col("tag"), "content"), REFRESH, 1), F.lit("")))
    named = seen.select("source", F.trim(F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&"))).alias("target"))
    return named.filter("target IS NOT NULL").select("source", resolve(F.col("source"), F.col("target")).alias("target"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], redirects: DataFrame | None = None,
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without html, with host, path, rule and verdict. ``rules``: (allow or
    block, host, path); ``redirects``: further edges (source, target), such as a crawler's log."""
    def ruled(url: Column) -> Column:
        return longest_rule(*host_and_path(url), rules)

    def key(url: Column) -> Column:
        return F.unhex(F.sha2(node(url), 256))

    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionAll(redirects.select("source", "target"))
    ends = stage(links.select(key(F.col("source")).alias("a"), key(F.col("target")).alias("b"), ruled(F.col("source"))["verdict"].alias("a_rule"),
                              ruled(F.col("target"))["verdict"].alias("b_rule")).filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "url-links")
    classes = stage(connected_components(ends.select("a", "b")), "url-classes")
    barred = ends.filter("a_rule = 'block'").select(F.col("a").alias("id")).unionAll(ends.filter("b_rule = 'block'").select(F.col("b").alias("id"))).distinct()
    bad = classes.join(barred, "id", "semi").select("component").distinct()
    aliases = classes.join(bad, "component", "semi").select(F.col("id").alias("alias key"), F.lit(True).alias("alias blocked"))

    host, path = host_and_path(F.col(url_col))
    new = ("host", "path", "rule", "verdict")
    judged = (pages.select(*[c for c in pages.columns if c not in (html_col, *new)], host.alias("host"), path.alias("path"), ruled(F.col(url_col)).alias("found rule"))
              .withColumn("url key", F.when(F.col("found rule").isNull(), key(F.col(url_col)))))
    return (judged.join(aliases, F.col("url key") == F.col("alias key"), "left")
            .withColumn("rule", F.col("found rule.rule"))
            .withColumn("verdict", F.coalesce("found rule.verdict", F.when(F.col("alias blocked"), F.lit("block")), F.lit("allow")))
            .drop("found rule", "url key", "alias key", "alias blocked"))


def oracle_sql(rules: Sequence[tuple[str, str, str]]) -> str:
    """DuckDB SQL of ``judge`` over ``pages``, with page_id, host, path, rule, verdict."""
    def q(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def attr(name: str) -> str:
        return (f"list_filter(list_zip(regexp_extract_all(tag, {q(ATTRIBUTE)}, 1), regexp_extract_all(tag, {q(ATTRIBUTE)}, 2)), lambda z: lower(z[1]) = {q(name)})[1][2]")

    def bare(value: str) -> str:
        return f"CASE WHEN regexp_matches({value}, '^[\"'']') THEN {value}[2:-2] ELSE {value} END"

    def lowered(text: str) -> str:
        return f"translate({text}, {q(UPPER)}, {q(LOWER)})"

    def part(url: str, k: int) -> str:
        return f"regexp_extract({url}, {q(PARTS)}, {k})"

    host, path, scheme = lowered(part("u", 1)), part("u", 2), f"regexp_extract(u, {q(SCHEME)}, 1)"
    node_sql = f"{lowered(scheme)} || '://' || {host} || CASE WHEN {path} = '' THEN '/' ELSE {path} END || regexp_extract(u, '(?s)^[^?#]*(\\?[^#]*)', 1)"
    origin = f"regexp_extract(source, {q(SCHEME)}, 1) || '://' || {lowered(part('source', 1))}"
    return f"""
WITH RECURSIVE
rules(verdict, host, path) AS (VALUES {', '.join('(' + ', '.join(map(q, r)) + ')' for r in rules)}),
seen AS (SELECT url AS source, unnest(regexp_extract_all(regexp_replace(html, {q(UNSEEN)}, ' ', 'g'), {q(TAG)})) AS tag
         FROM pages WHERE contains(url, '://') AND regexp_matches(html, {q(LINKED)})),
read AS (SELECT source, tag, {bare(attr('rel'))} AS rel, {bare(attr('href'))} AS href, {bare(attr('http-equiv'))} AS kind, {bare(attr('content'))} AS content FROM seen),
named AS (SELECT source, trim(replace(CASE
            WHEN regexp_matches(tag, '(?i)^<link') AND contains(' ' || regexp_replace(lower(rel), '[\\t\\n\\f\\r]', ' ', 'g') || ' ', ' canonical ') THEN href
            WHEN regexp_matches(tag, '(?i)^<meta') AND lower(trim(kind)) = 'refresh' THEN nullif(regexp_extract(content, {q(REFRESH)}, 1), '') END, '&amp;', '&')) AS target FROM read),
links AS (SELECT source, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN target
            WHEN starts_with(target, '//') THEN regexp_extract(source, {q(SCHEME)}, 1) || ':' || target
            WHEN starts_with(target, '/') THEN {origin} || target
            WHEN regexp_matches(target, '^[?#]') OR target = '' THEN {origin} || {part('source', 2)} || target
            ELSE {origin} || CASE WHEN {part('source', 2)} = '' THEN '/' ELSE regexp_extract({part('source', 2)}, '(?s)^(.*/)', 1) END || target END AS target
          FROM named WHERE target IS NOT NULL),
urls AS (SELECT DISTINCT url AS u FROM pages UNION SELECT target FROM links),
nodes AS (SELECT u, CASE WHEN contains(u, '://') THEN {node_sql} END AS node, coalesce({host}, '') AS host, coalesce({path}, '') AS path FROM urls),
fits AS (SELECT n.u, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict), struct_pack(size := strlen(r.host || r.path), allows := r.verdict = 'allow', rule := r.host || r.path)) AS best
         FROM nodes n JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path) GROUP BY n.u),
edges AS (SELECT a.node AS a, b.node AS b FROM links JOIN nodes a ON a.u = source JOIN nodes b ON b.u = target WHERE a.node IS NOT NULL AND b.node IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
barred AS (SELECT n.node FROM nodes n JOIN fits f ON f.u = n.u WHERE f.best.verdict = 'block' AND n.node IN (SELECT a FROM both_ways)),
reach AS (SELECT node FROM barred UNION SELECT w.b FROM reach JOIN both_ways w ON w.a = reach.node)
SELECT p.page_id, n.host, n.path, f.best.rule AS rule,
       coalesce(f.best.verdict, CASE WHEN n.node IN (SELECT node FROM reach) THEN 'block' END, 'allow') AS verdict
FROM pages p JOIN nodes n ON n.u IS NOT DISTINCT FROM p.url LEFT JOIN fits f ON f.u = n.u
"""
