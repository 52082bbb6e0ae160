"""URL filters with redirect equivalence, in DataFrame operations only.

A rule names a host and a path prefix and fits that host with all subdomains;
the longest rule wins. URLs that redirect to each other or share a canonical
link are aliases: the components of these edges are computed distributed, and
a block decision reaches every alias without a rule of its own. An explicit
allow rule of a URL always stands.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, NULL without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Node of a URL: host without a default port, path without trailing
    slashes, query without campaign parameters; scheme and fragment play no
    part. NULL without ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[a-z]+|gclid|fbclid)=[^&]*", ""), "^&", "")
    return F.when(_rest(url).isNotNull(), F.concat(
        F.regexp_replace(host(url), ":(80|443)$", ""), F.regexp_replace(path(url), "/+$", ""),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def unescaped(text: Column) -> Column:
    """``text`` with HTML's character references decoded, once."""
    names = F.from_json(F.lit(json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")

    def decoded(x: Column) -> Column:
        number = F.coalesce(F.conv(F.nullif(F.regexp_extract(x, "^&#[xX]([0-9a-fA-F]+)", 1), F.lit("")), 16, 10),
                            F.nullif(F.regexp_extract(x, "^&#([0-9]+)", 1), F.lit(""))).cast("long")
        point = F.when((number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF), number).otherwise(0xFFFD)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        return F.when(x.startswith("&#") & number.isNotNull(), char).when(
            x.startswith("&"), F.coalesce(F.element_at(names, F.regexp_extract(x, "^&([A-Za-z0-9]+);$", 1)), x)).otherwise(x)

    parts = F.regexp_extract_all(text, F.lit("(&#[xX][0-9a-fA-F]{1,8};?|&#[0-9]{1,9};?|&[A-Za-z0-9]+;|&|[^&]+)"), F.lit(1))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, decoded), "")).otherwise(text)


def without_dots(url: Column) -> Column:
    """``url`` with the segments ``.`` and ``..`` of its path resolved."""
    site, p = F.regexp_extract(url, "^(.*?://[^/?#]*)", 1), path(url)
    one, two = (".", "%2e"), ("..", ".%2e", "%2e.", "%2e%2e")
    parts = F.split(F.substring(p, 2, F.length(p)), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, x: F.when(F.lower(x).isin(*one), a).when(
        F.lower(x).isin(*two), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, x)))
    last = F.when(F.lower(F.element_at(parts, -1)).isin(*one, *two) & (F.size(kept) > 0), "/").otherwise("")
    return F.when(p.rlike(r"(?i)/(?:\.|%2e){1,2}(/|$)"), F.concat(
        site, F.lit("/"), F.array_join(kept, "/"), last,
        F.substring(url, F.length(site) + F.length(p) + 1, F.length(url)))).otherwise(url)


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``url, target`` of every canonical link and refresh redirect in the
    pages; targets may be absolute, ``//host``, ``/path``, ``?query``,
    ``#fragment`` or relative. Character references are decoded and dot
    segments resolved."""
    page = F.col("u")
    tag = pages.select(F.col(url_col).alias("u"), F.explode(
        F.regexp_extract_all(F.col(html_col), F.lit(r"(?i)(<(?:link|meta)\b[^>]*>)"), F.lit(1))).alias("t"))
    t = F.col("t")
    link = t.rlike(r"(?i)^<link") & t.rlike(r"""(?i)\brel\s*=\s*["']?canonical\b""")
    jump = t.rlike(r"(?i)^<meta") & t.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b""")
    to = F.when(link, F.regexp_extract(t, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)).when(
        jump, F.regexp_extract(t, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1))
    got = tag.select(page, unescaped(to).alias("to")).where("to <> ''").where(F.locate("://", page) > 0)
    to, scheme, site = F.col("to"), F.regexp_extract(page, "^(.*?)://", 1), F.regexp_extract(page, "^(.*?://[^/?#]*)", 1)
    folder = F.concat(site, F.coalesce(F.nullif(F.regexp_extract(path(page), "^(.*/)", 1), F.lit("")), F.lit("/")))
    target = F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), to).when(
        to.startswith("//"), F.concat(scheme, F.lit(":"), to)).when(
        to.startswith("/"), F.concat(site, to)).when(
        to.startswith("?"), F.concat(site, path(page), to)).when(
        to.startswith("#"), F.concat(F.regexp_extract(page, "^([^#]*)", 1), to)).otherwise(F.concat(folder, to))
    return got.select(F.col("u").alias("url"), without_dots(target).alias("target"))


def match_rules(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """``url, rule, verdict`` for each distinct URL that a rule fits.

    ``rules`` holds ``host, path, verdict``. The keys a URL may match are its
    host's suffixes with those prefixes of its path that have the length of
    some rule's path; one equality join with the rules finds all. Of equal
    rules allow counts, of fitting ones the longest."""
    rules = rules.groupBy(F.concat("host", "path").alias("rule"), "host", "path").agg(F.min("verdict").alias("verdict"))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    u = urls.select(F.col(url_col).alias("url")).where(F.col(url_col).isNotNull()).distinct().select(
        "url", host(F.col("url")).alias("h"), path(F.col("url")).alias("p")).where("h <> ''")
    labels = F.split("h", r"\.")
    u = u.select("url", "p", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("host"))
    prefixes = F.filter(F.array(*[F.when(F.length("p") >= n, F.substring("p", 1, n)) for n in lengths]).cast("array<string>"),
                        lambda x: x.isNotNull())
    keys = u.select("url", "host", F.explode(prefixes).alias("path"))
    return keys.join(rules, ["host", "path"]).groupBy("url").agg(
        F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "allow").alias("a"), "rule", "verdict")).alias("x")
    ).select("url", "x.rule", "x.verdict")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """``id_col, host, path, rule, verdict, reason, alias_of`` per page row.

    ``verdict`` is the rule's if one fits (``reason`` rule); else block if an
    alias, a page or link target in the URL's component, is blocked by its rule
    (alias); else allow (default). ``edges`` (``url, target``) adds redirects
    known from elsewhere, a crawl log for instance, to those in the pages.
    ``alias_of`` is the least canonical URL of the component.

    A NULL URL or one without ``://`` has empty host and path, no alias and is
    allowed; a NULL html has no links. Repeated rows are judged each; other
    columns are not read; an empty table gives no rows."""
    page = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html"))
    links = link_edges(page, "__url", "__html")
    if edges is not None:
        links = links.unionByName(edges.select("url", "target"))
    links = store(links, "url-links")
    urls = page.select(F.col("__url").alias("url")).unionByName(links.select(F.col("target").alias("url"))).distinct()
    fits = store(urls.where("url is not null").join(match_rules(urls, rules), "url", "left").select(
        "url", "rule", "verdict", canonical(F.col("url")).alias("node")), "url-rules")
    comp = connected_components(links.select(
        canonical(F.col("url")).alias("src"), canonical(F.col("target")).alias("dst")), native=True)
    nodes = fits.join(comp, "node", "left").select(
        "url", "rule", "verdict", F.coalesce("component", "node").alias("alias_of"))
    nodes = store(nodes, "url-nodes")
    blocked = nodes.where("verdict = 'block' and alias_of is not null").select("alias_of").distinct().select(
        "alias_of", F.lit(True).alias("blocked"))
    judged = nodes.join(blocked, "alias_of", "left").select(
        F.col("url").alias("__u"), "rule", "alias_of",
        F.coalesce("verdict", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").when(F.col("blocked"), "alias").otherwise("default").alias("reason"))
    out = page.drop("__html").join(judged, F.col("__url") == F.col("__u"), "left")
    return out.select(
        F.col("__id").alias(id_col), host(F.col("__url")).alias("host"), path(F.col("__url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.coalesce("reason", F.lit("default")).alias("reason"),
        "alias_of")
