"""URL rules over redirect equivalence classes, in DataFrame operations only.

Redirects and canonical links join URLs into classes (connected components). A
URL that a rule fits takes the longest rule's verdict. A URL without a rule takes
its class's: allow if any member is allowed by a rule, else block if any member
is blocked by one, else allow. So an explicit allow always has precedence over a
block that only spreads from an alias.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, ascii_lower, connected_components, table


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, a path prefix, and allow or block."""

    host: str
    path: str
    verdict: str


#: Fixed values of the query.
RULES = (
    Rule("com", "/en/", "block"),
    Rule("example.com", "/en/7", "allow"),
    Rule("net", "/de/", "allow"),
    Rule("example.net", "/de/8", "block"),
    Rule("org", "/es/", "block"),
)


def host_of(url: Column) -> Column:
    """Host after the first ``://``, A-Z lower-cased; empty without one."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Path up to the query or fragment; empty without a ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null.

    A rule set is a short configured list, so it becomes one CASE expression:
    the rules in falling order of length, the first that fits wins.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.host, r.path))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(ordered):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


#: Entities that may stand in a URL; an ampersand comes last, so that nothing is decoded twice.
_ENTITIES = ((r"&quot;|&#0*34;|&#[xX]0*22;", '"'), (r"&apos;|&#0*39;|&#[xX]0*27;", "'"), (r"&#0*47;|&#[xX]0*2[fF];|&sol;", "/"), (r"&amp;|&#0*38;|&#[xX]0*26;", "&"))


def _resolved(base: Column, target: Column) -> Column:
    """An absolute URL for a target that a page of the given URL names; a whole URL stays to the letter."""
    origin = F.regexp_extract(base, r"\A[^/?#]*://[^/?#]*", 0)
    path = F.regexp_extract(base, r"\A[^/?#]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)\A.*/", 0))
    tail = F.regexp_extract(target, r"(?s)\A[^?#]*(.*)", 1)
    own = F.regexp_extract(target, r"\A[^?#]*", 0)

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.array_append(done, part))

    parts = F.split(F.regexp_replace(F.concat(folder, own), r"\A/", ""), "/")
    # A path that ends in a dot segment ends with a slash.
    parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(parts, F.lit(""))).otherwise(parts)
    walked = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))
    return (
        F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(origin, r"\A[^/]*:", 0), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(origin == "", F.lit(""))
        .when(target.startswith("#"), F.concat(F.regexp_extract(base, r"\A[^#]*", 0), target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .otherwise(F.concat(origin, walked, tail))
    )


def declared_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) that pages declare: all canonical links and immediate redirects outside of comments.

    Targets have their entities decoded; relative ones are resolved against the
    page. Targets without ``://``, such as mail addresses, give no edge.
    """
    # A comment without an end goes on to the end.
    head = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?s)<!--.*?(?:-->|\z)", " ")
    tags = F.regexp_extract_all(head, F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), 0)
    refreshes = F.regexp_extract_all(head, F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), 0)
    targets = F.concat(
        F.transform(tags, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)),
        F.transform(refreshes, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?((?:&#?\w+;|[^\"'\s>;])+)", 1)),
    )
    target = F.col("t")
    for pattern, sign in _ENTITIES:
        target = F.regexp_replace(target, pattern, sign)
    found = pages.filter(F.col(url).isNotNull()).select(F.col(url).alias("a"), F.explode(targets).alias("t")).filter("t <> ''").select("a", target.alias("t"))
    return found.select("a", _resolved(F.col("a"), F.col("t")).alias("b")).filter("b like '%://%'")


def node_of(url: Column) -> Column:
    """What tells URLs apart as nodes: all but the fragment, with the host's A-Z lower-cased."""
    plain = F.regexp_replace(url, r"(?s)#.*", "")
    host = F.regexp_extract(plain, r"(?s)\A.*?://[^/?#]*", 0)
    return F.concat(ascii_lower(host), F.substr(plain, F.length(host) + 1))


def judge(pages: DataFrame, edges: DataFrame, scratch: Scratch, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: page_id, host, path, rule, verdict.

    ``edges`` (a, b) may name URLs that are no pages; their rules count for the
    class too. URLs that differ in the fragment or the case of the host are one.
    Null URLs have no host, path, rule or alias and are allowed. Repeated rows and
    edges change nothing. An empty table gives no rows.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    nodes = edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"))
    classes = scratch.save(connected_components(nodes, scratch), "classes")
    member = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"]
    votes = (
        classes.withColumn("v", member)
        .groupBy("component")
        .agg(F.max(F.when(F.col("v") == "allow", 2).when(F.col("v") == "block", 1).otherwise(0)).alias("vote"))
    )
    spread = classes.join(votes.filter("vote > 0"), "component").select("node", "vote")
    plain = rows.filter("hit is not null or url is null")
    asked = rows.filter("hit is null and url is not null").withColumn("node", node_of(F.col("url"))).join(spread, "node", "left")
    of_class = F.when(F.col("vote") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return plain.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit("allow")).alias("verdict")).unionByName(
        asked.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), of_class.alias("verdict"))
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts for every row of ``pages``, over the links that the pages declare."""
    scratch = Scratch(spark, "op8")
    pages = table(spark, sf_dir, "pages")
    return judge(pages, declared_links(pages), scratch)


SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path, html
  FROM pages
),
r(rh, rp, rv) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
shown AS (SELECT url, regexp_replace(html, '(?s)<!--.*?(?:-->|\z)', ' ', 'g') AS html FROM p WHERE url IS NOT NULL AND html IS NOT NULL),
links AS (
  SELECT url AS a, unnest(list_concat(
    list_transform(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), lambda x: regexp_extract(x, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)))) AS t,
    regexp_extract(url, '\A[^/?#]*://[^/?#]*', 0) AS o
  FROM shown
),
e AS (
  SELECT a, CASE WHEN t LIKE '//%' THEN regexp_extract(o, '\A[^/]*:', 0) || t WHEN t LIKE '/%' THEN o || t ELSE t END AS b FROM links
),
s AS (SELECT a, b FROM e WHERE b LIKE '%://%' UNION SELECT b, a FROM e WHERE b LIKE '%://%'),
reach(n, m) AS (SELECT a, a FROM s UNION SELECT reach.n, s.b FROM reach JOIN s ON s.a = reach.m),
u AS (
  SELECT url, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT url FROM pages UNION SELECT n FROM reach)
),
j AS (
  SELECT u.url, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict
  FROM u JOIN r ON (u.host = rh OR u.host LIKE '%.' || rh) AND starts_with(u.path, rp) GROUP BY u.url
),
c AS (
  SELECT n, max(CASE j.verdict WHEN 'allow' THEN 2 WHEN 'block' THEN 1 ELSE 0 END) AS vote
  FROM reach LEFT JOIN j ON j.url = reach.m GROUP BY n
)
SELECT p.page_id, p.host, p.path, j.rule,
       coalesce(j.verdict, CASE WHEN c.vote = 1 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN j ON j.url = p.url LEFT JOIN c ON c.n = p.url
"""
