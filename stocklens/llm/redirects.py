"""URL verdicts by host and path rules, carried over to aliases by redirects and canonical links.

Edges run from a page's url to the target of its canonical link and of its meta refresh, and
from an optional table of redirects. Connected components of these edges are one
resource under several addresses. A url with a rule of its own has that rule's verdict; any
other is allowed when its component holds an explicitly allowed url, else blocked when it
holds a blocked one, else allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.components import connected_components

Rule = tuple[str, str, str]  # verdict, host, path
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def address(url: Column) -> Column:
    """The url that stands for a resource: host lower-cased, without fragment; null without a host."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = F.lower(F.substring_index(plain, "://", 1))
    rest = F.regexp_extract(plain, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), rest))


def absolute(target: Column, base: Column) -> Column:
    """A link's target as a full url, seen from the page ``base``."""
    scheme = F.substring_index(base, "://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract(base, r"(?s)^(.*?://[^?#]*)", 1), r"(://[^/]*)?[^/]*$", "$1")
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(folder, F.when(folder == site, "/").otherwise(F.when(~folder.endswith("/"), "/").otherwise("")), target))
    )


def rule_column(host: Column, path: Column, rules: Sequence[Rule], part: int | None = None) -> Column:
    """The longest rule that fits, as ``host + path`` text, or its verdict where part is 0; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        found = F.when(fits, rule[1] + rule[2] if part is None else rule[part]).otherwise(found)
    return found


def links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between addresses, from canonical links and meta refreshes of the html."""
    canonical = F.regexp_extract(F.regexp_extract("html", LINK, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract("html", REFRESH, 0), REFRESH_URL, 1)
    targets = pages.select("url", F.explode(F.array(canonical, refresh)).alias("target"))
    return targets.filter("target <> ''").select(
        address(F.col("url")).alias("a"), address(absolute(F.col("target"), F.col("url"))).alias("b")
    )


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict.

    ``redirects`` has columns a and b, two urls of one resource. A null url, or one without
    ``://``, has empty host and path, no rule, no alias, and is allowed; null html has no links.
    Repeated rows each keep a row; other columns are ignored.
    """
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b"))
        )
    members = connected_components(edges)
    verdict = rule_column(host_of(F.col("node")), path_of(F.col("node")), rules, 0)
    groups = (
        members.groupBy("component")
        .agg(F.max(verdict == "allow").alias("allowed"), F.max(verdict == "block").alias("blocked"))
        .filter("blocked and not coalesce(allowed, false)")
    )
    blocked = members.join(groups, "component", "left_semi").select(
        "node", F.lit("block").alias("carried")
    )
    host, path = F.col("host"), F.col("path")
    judged = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        address(F.col("url")).alias("address"),
    ).select(
        "*", rule_column(host, path, rules).alias("rule"), rule_column(host, path, rules, 0).alias("own")
    )
    return judged.join(blocked, F.col("address") == F.col("node"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "carried", F.lit("allow")).alias("verdict")
    )
