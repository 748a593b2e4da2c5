"""URL filter with redirect equivalence.

A rule names a host and the start of a path. A URL that no rule fits takes the decision of its aliases: canonical
links and redirects of the pages are edges between URLs, and connected components of them are one resource.
Aliases of a blocked URL are blocked, unless an allow rule fits any URL of the component.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

# Action, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)\bcontent\s*=\s*["']?\s*\d*\s*[;,]\s*url\s*=\s*["']?([^"'>\s]+)"""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL without scheme and fragment; null where it has no ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path_of(url), query))


def _rest(url: Column) -> Column:
    after = F.instr(url, "://") + 3
    return F.when(after > 3, F.substr(url, after))


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): the node of a page and that of its canonical link or refresh target."""
    html = F.col("html")
    canonical = F.filter(
        F.regexp_extract_all(html, F.lit(_LINK), F.lit(0)),
        lambda tag: tag.rlike(r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""),
    )
    refresh = F.filter(
        F.regexp_extract_all(html, F.lit(_META), F.lit(0)),
        lambda tag: tag.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""),
    )
    targets = F.concat(
        F.transform(canonical, lambda tag: F.regexp_extract(tag, _HREF, 1)),
        F.transform(refresh, lambda tag: F.regexp_extract(tag, _REFRESH, 1)),
    )
    low = F.lower(html)
    found = (
        pages.where(low.contains("canonical") | low.contains("refresh"))
        .select(F.col("url").alias("__url"), F.explode(targets).alias("__target"))
        .where("__target <> ''")
        .withColumn("__target", F.replace("__target", F.lit("&amp;"), F.lit("&")))
    )
    return found.select(
        node_of(F.col("__url")).alias("a"),
        node_of(_absolute(F.col("__target"), F.col("__url"))).alias("b"),
    )


def _absolute(target: Column, url: Column) -> Column:
    root = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)?", 0)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .otherwise(F.concat(root, folder, target))
    )


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of the longest fitting rule, for those that one fits.

    A URL is looked up under each of its host suffixes and each path length that the rules have, so the join is on
    equal values and no rule list is scanned. Of rules of equal length an allow wins, then the smaller rule.
    """
    lengths = [row[0] for row in rules.select(F.length("rule_path")).distinct().collect()]
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.filter(
        F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
        lambda n: n <= F.length("path"),
    )
    keys = urls.select("host", "path", F.explode(suffixes).alias("rule_host")).select(
        "host", "path", "rule_host", F.explode(starts).alias("__n")
    )
    keys = keys.withColumn("rule_path", F.substr("path", F.lit(1), F.col("__n")))
    fits = keys.join(rules, ["rule_host", "rule_path"]).withColumn(
        "rule", F.concat("rule_host", "rule_path")
    )
    best = F.min(F.struct(-F.length("rule"), "action", "rule")).alias("__best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "__best.rule", "__best.action")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url, html).

    ``redirects`` (url, target) adds edges to those of the pages. A null url, or one without ``://``, has
    empty host and path, fits no rule and has no aliases: it is allowed. A null html has no links. Repeated
    rows keep one result each; no rows give none; other columns are ignored.
    """
    spark = pages.sparkSession
    named = spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")
    urls = pages.select("page_id", "url").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        node_of(F.col("url")).alias("node"),
    )
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        ends = [node_of(F.col(c)).alias(to) for c, to in (("url", "a"), ("target", "b"))]
        links = links.unionByName(redirects.select(*ends))
    groups = components(links)
    members = groups.select(
        "node",
        "component",
        host_of(F.concat(F.lit("://"), "node")).alias("host"),
        path_of(F.concat(F.lit("://"), "node")).alias("path"),
    )
    known = urls.select("host", "path").unionByName(members.select("host", "path")).distinct()
    ruled = best_rules(known, named)
    decided = (
        members.join(ruled, ["host", "path"])
        .groupBy("component")
        .agg(F.min("action").alias("__aliases"))
    )
    aliases = groups.join(decided, "component").select("node", "__aliases")
    verdict = F.coalesce("action", "__aliases", F.lit("allow"))
    return (
        urls.join(ruled, ["host", "path"], "left")
        .join(aliases, "node", "left")
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"))
    )
