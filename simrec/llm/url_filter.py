"""URL filters with redirect equivalence.

An allow or block rule is a (host, path) pair. It fits its host and all subdomains
when the URL's path starts with the rule's; the longest rule wins (at equal
length allow, then the last in code point order).

Pages that redirect (``<meta http-equiv=refresh>``) or name a canonical address
(``<link rel=canonical>``) are aliases of their target. Components over these edges
propagate block decisions to aliases that no rule fits; an explicit allow of any
member takes precedence over propagated blocks, and a URL's own rule over both.
A node is an address without scheme and fragment. Every such tag of a page counts; in its
address ``&amp;`` stands for ``&``, and the segments ``.`` and ``..`` are resolved. Pages'
own addresses are taken as they are.

Edge cases: a null URL, or one without ``://``, has empty host and path, fits no
rule and has no alias, so it is allowed; a null page body has no edge; repeated
URLs are one node; an empty table gives an empty result; extra columns are never
read.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, small_side
from .components import connected_components


class UrlRule(NamedTuple):
    verdict: str            # "allow" or "block"
    host: str
    path: str


_AFTER_SCHEME = r"://([^/?#]*)([^?#]*)(\?[^#]*)?"
_CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def host_of(url: Column) -> Column:
    return _lower_ascii(F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 2), F.lit(""))


def query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER_SCHEME, 3), F.lit(""))


def node_of(host: Column, path: Column, query: Column) -> Column:
    """Host, path and query as one text; null without a host."""
    return F.when(host != "", F.concat(host, path, query))


def best_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """struct(length, allow, rule) of the rule that wins, or null."""
    fits = []
    for r in rules:
        at_host = (host == r.host) | host.endswith("." + r.host)
        win = F.struct(F.lit(len(r.host + r.path)).alias("length"),
                       F.lit(int(r.verdict == "allow")).alias("allow"),
                       F.lit(r.host + r.path).alias("rule"))
        fits.append(F.when(at_host & path.startswith(r.path), win))
    if not fits:
        return F.lit(None).cast("struct<length:int,allow:int,rule:string>")
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def _target(scheme: Column, host: Column, path: Column, href: Column) -> Column:
    """``href`` made absolute against a page's address; null where it stays on the page."""
    base = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return (F.when((href == "") | href.startswith("#"), None).when(href.contains("://"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(base, href))
            .when(href.startswith("?"), F.concat(base, path, href))
            .otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), href)))


def _without_dots(path: Column) -> Column:
    """``path`` with its segments ``.`` and ``..`` resolved."""
    parts = F.slice(F.split(path, "/"), F.lit(2), F.size(F.split(path, "/")))
    joined = F.aggregate(parts, F.lit(""), lambda done, part: (
        F.when(part == ".", done).when(part == "..", F.regexp_replace(done, "/[^/]*$", ""))
        .otherwise(F.concat(done, F.lit("/"), part))))
    end = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(joined, end)).otherwise(path)


def alias_edges(pages: DataFrame) -> DataFrame:
    """``(a, b)``: a page's node and the node it redirects to or names as canonical."""
    rows = pick(pages, "url", "html").where("url is not null and html is not null")
    url = F.col("url")
    # The parts of an address are columns of their own, one step after the other: nested in one
    # expression they would be repeated until the generated code no longer compiles.
    rows = rows.select("html", F.regexp_extract(url, r"^([^:/?#]*)://", 1).alias("scheme"),
                       host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    tags = F.concat(*[F.regexp_extract_all("html", F.lit(rx), F.lit(1)) for rx in (_CANONICAL, _REFRESH)])
    hrefs = rows.select(node_of(F.col("host"), F.col("path"), F.col("query")).alias("a"),
                        "scheme", "host", "path", F.explode(F.array_distinct(tags)).alias("href"))
    href = F.regexp_replace("href", "(?i)&(amp|#38|#x26);", "&")
    to = hrefs.select("a", _target(*map(F.col, ("scheme", "host", "path")), href).alias("to"))
    to = to.where("a is not null and to is not null")
    parts = to.select("a", host_of(F.col("to")).alias("host"), path_of(F.col("to")).alias("path"),
                      query_of(F.col("to")).alias("query"))
    edges = parts.select("a", node_of(F.col("host"), _without_dots(F.col("path")), F.col("query")).alias("b"))
    return edges.where("b is not null and a != b")


def judge_pages(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page."""
    comp = connected_components(alias_edges(pages))
    # a node holds a host and what follows it; judge it like a page's address
    as_url = F.concat(F.lit("://"), F.col("node"))
    own = comp.select("node", "component",
                      best_rule(host_of(as_url), path_of(as_url), rules)["allow"].alias("allow"))
    decided = own.groupBy(F.col("component").alias("c")).agg(F.max("allow").alias("any_allow"))
    # any_allow: 1 some member is allowed, 0 only blocks, null no rule fits
    blocked = (own.join(decided, F.col("component") == F.col("c")).where("any_allow = 0")
               .select(F.col("node").alias("_node")))
    url = F.col("url")
    rows = pick(pages, "page_id", "url").select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    rows = rows.withColumn("node", node_of(F.col("host"), F.col("path"), F.col("query")))
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    rows = rows.join(small_side(blocked), F.col("node") == F.col("_node"), "left")
    verdict = (F.when(F.col("best").isNotNull(), F.col("best.allow") == 1)
               .otherwise(F.col("_node").isNull()))
    return rows.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.when(verdict, "allow").otherwise("block").alias("verdict"))
