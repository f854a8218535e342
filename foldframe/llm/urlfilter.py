"""URL filter with redirect equivalence.

A URL is judged by the longest rule whose host covers it and whose path is a
prefix of its path. Pages that redirect to one another or name one another as
canonical are aliases: their connected components carry block decisions to the
members that no rule fits, and an explicit allow in the component goes first.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .components import connected_components

LINK_TAG = r"(?is)<link\b[^>]*>"
META_TAG = r"(?is)<meta\b[^>]*>"
# the link's href, or the redirect's content
ATTRIBUTE = r"""(?is)\b(href|content)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# what a browser doesn't read as markup
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<textarea\b.*?</textarea\s*>"


# up to the first `://`
HEAD = r"(?s)^.*?://"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, HEAD + r"([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, HEAD + r"[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """Identity of a URL among the links: host, path and query, without scheme and
    fragment; null if it has no `://`."""
    tail = F.regexp_extract(url, HEAD + r"[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))))


def with_targets(tags: DataFrame) -> DataFrame:
    """Adds `target`: the column `href` as found on the page at `url`, made absolute."""
    clean = F.replace(F.trim("href"), F.lit("&amp;"), F.lit("&"))
    d = (tags.withColumn("clean", clean)
         .withColumn("site", F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*", 0))
         .withColumn("folder", F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*(/([^?#]*/)?)?", 0)))
    c = F.col("clean")
    target = (F.when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), c)
              .when(c.startswith("//"), F.concat(F.regexp_extract("site", r"^[^:]+:", 0), c))
              .when(c.startswith("/"), F.concat("site", c))
              .when((c == "") | c.startswith("#"), F.col("url"))
              .otherwise(F.concat(F.regexp_replace("folder", "/$", ""), F.lit("/"), c)))
    return d.withColumn("target", target).drop("clean", "site", "folder")


def page_links(pages: DataFrame) -> DataFrame:
    """(u, v): edges between URL nodes that canonical links and refresh redirects
    of the pages (page_id, url, html) make. A page whose URL has no `://` is the
    node `page:<page_id>`."""
    some = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv\s*=\s*[\"']?refresh"))
    markup = some.withColumn("markup", F.regexp_replace("html", NOT_MARKUP, " "))
    tags = F.concat(
        F.filter(F.regexp_extract_all("markup", F.lit(LINK_TAG), F.lit(0)),
                 lambda t: t.rlike(r"""(?i)\brel\s*=\s*["']?([^"'>]*\s)?canonical\b""")),
        F.filter(F.regexp_extract_all("markup", F.lit(META_TAG), F.lit(0)),
                 lambda t: t.rlike(r"""(?i)http-equiv\s*=\s*["']?refresh\b""")))
    tag = markup.select("page_id", "url", F.explode(tags).alias("tag"))
    attribute = F.regexp_extract("tag", ATTRIBUTE, 2)
    bare = tag.withColumn("quoted", attribute).withColumn("value", F.regexp_replace("quoted", r"^[\"']|[\"']$", ""))
    href = F.when(F.col("tag").rlike(r"(?i)^<link"), F.col("value")).otherwise(
        F.regexp_extract("value", r"(?is)url\s*=\s*[\"']?([^\"']*)", 1))
    # written in between: one stage with all the patterns is too long to be compiled
    links = saved(bare.select("page_id", "url", href.alias("href")).where(F.col("href") != ""), "url-links")
    found = saved(with_targets(links), "url-targets")
    return found.select(page_node().alias("u"), node_of(F.col("target")).alias("v")).where("v is not null and u != v").distinct()


def page_node() -> Column:
    return F.coalesce(node_of(F.col("url")), F.concat(F.lit("page:"), F.col("page_id").cast("string")))


def fitting_rule(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest fitting rule of each distinct (host, path): host, path, rule, rule_verdict;
    places that none fits are absent. `rules`: host, path, verdict. Of equally long
    rules an allow wins, then the smaller one."""
    parts = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(parts)),
                         lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    spread = places.select("host", "path", F.explode(suffix).alias("suffix"))
    r = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), F.col("verdict").alias("rule_verdict"))
    hit = spread.join(r, "suffix").where(F.col("path").startswith(F.col("prefix")))
    rule = F.concat("suffix", "prefix")
    best = F.min(F.struct((-F.length(rule)).alias("n"), F.col("rule_verdict"), rule.alias("rule")))
    return hit.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", "b.rule_verdict")


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """Verdict of every page: page_id, host, path, rule, verdict, alias_rule.

    `pages` needs page_id, url, html; `rules` host, path, verdict (allow or block);
    `links` may add edges (source_url, target_url), such as a crawler's redirect
    log. The page's own rule decides. Without one, the rules that fit the members
    of its alias component decide, targets outside `pages` included: any allow,
    else any block, else `default`; `alias_rule` says whether they did.

    As a member of a component an address without a path is its host's root, so a rule
    on `/` fits it there; as a page it has an empty path, which no rule's path begins. A
    null url or html gives empty host and path or no links. Repeated rows are judged
    alike; of equally long rules an allow wins. Empty tables give empty results; rules may be empty."""
    base = pages.select("page_id", "url", "html")
    edges = page_links(base)
    if links is not None:
        edges = edges.unionByName(links.select(node_of(F.col("source_url")).alias("u"), node_of(F.col("target_url")).alias("v")))
    placed = base.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), page_node().alias("node"))
    component = saved(connected_components(edges), "url-components")
    inside = lambda pattern: F.regexp_extract("node", pattern, 1)
    member = component.select("node", "component", inside(r"^(?!page:)([^/]*)").alias("host"), inside(r"^(?!page:)[^/]*([^?]*)").alias("path"))
    places = placed.select("host", "path").unionByName(member.select("host", "path")).distinct()
    fits = saved(fitting_rule(places, rules), "url-rules")
    f = fits.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "rule", "rule_verdict")
    own = lambda d: d.join(f, (F.col("host") == F.col("r_host")) & (F.col("path") == F.col("r_path")), "left").drop("r_host", "r_path")
    # "allow" sorts before "block", so the least verdict of a component is its decision
    decided = own(member).groupBy("component").agg(F.min("rule_verdict").alias("alias_verdict"))
    alias = component.join(decided, "component").where("alias_verdict is not null").select(F.col("node").alias("a_node"), "alias_verdict")
    out = own(placed).join(alias, F.col("node") == F.col("a_node"), "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("rule_verdict", "alias_verdict", F.lit(default)).alias("verdict"),
                      (F.col("rule").isNull() & F.col("alias_verdict").isNotNull()).alias("alias_rule"))
