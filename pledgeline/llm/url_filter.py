"""URL filters: host and path rules, carried over redirects and canonical links.

A rule fits a URL if the URL's host is the rule's host or below it and its path starts with the rule's
path; the longest rule that fits decides, and of equally long ones an allowing one.

URLs that redirect to each other or name each other as canonical are aliases: ``meta refresh`` and
``link rel=canonical`` of the pages, and any further table of redirects, are edges, and the connected
components of these are the alias groups (see ``components``). A URL that no rule fits takes over the
decision of its group: allowed if any alias is explicitly allowed, else blocked if any is blocked, else
allowed. Aliases that are not pages of the table count too.

Everything is DataFrame operations. Rules meet hosts by an equality join on the host's suffixes, of
which there are as many as the host has labels; that is done once per distinct host and path. A host
may hold any share of the pages: joins back to the pages are between written tables, which adaptive
execution splits.

Defined results: a URL that is null or has no ``://`` has an empty host and path, no rule and no alias,
and is allowed. Null html has no links. Links to other schemes than http(s) are ignored. Relative
links lose their ``.`` and ``..`` segments; URLs written in full are compared as they are. An alias is
known by host, path and query, so that scheme and fragment make no difference. Rows with equal ids
or URLs each give a row. Columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeline.llm.common import shared_folder, stored
from pledgeline.llm.components import components

Rule = tuple[str, str, str]


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """``verdict, rule_host, rule_path`` from tuples, for lists short enough to write by hand."""
    values = ", ".join(
        "(" + ", ".join("'" + field.replace("\\", "\\\\").replace("'", "\\'") + "'" for field in rule) + ")"
        for rule in rules
    )
    if not rules:
        return spark.sql("SELECT '' AS verdict, '' AS rule_host, '' AS rule_path WHERE false")
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(verdict, rule_host, rule_path)")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(_lower(host), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _alias(url: Column) -> Column:
    """Host, path (``/`` if empty) and query: what a URL is known by among aliases."""
    rest = _rest(url)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    return F.when(host_of(url) != "", F.concat(host_of(url), path, query))


def _attribute(tag: Column, name: str) -> Column:
    found = rf"""(?is)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    return F.regexp_replace(F.regexp_extract(tag, found, 1), r"""^["']|["']$""", "")


def _resolved() -> Column:
    """An absolute URL of ``target`` on the page of ``host`` and ``path``; null if not on the web."""
    target, site = F.col("target"), F.concat(F.lit("http://"), F.col("host"))
    folder = F.when(F.col("folder") == "", F.lit("/")).otherwise(F.col("folder"))
    return (
        F.when(target.rlike(r"(?i)^https?://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (F.col("host") == ""), F.lit(None))
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, "path", target))
        # to the page itself
        .when((target == "") | target.startswith("#"), F.lit(None))
        .otherwise(F.concat(site, folder, target))
    )


def _without_dots(url: Column) -> Column:
    """The URL without ``.`` and ``..`` segments in its path (RFC 3986, 5.2.4)."""
    segments = F.split(F.regexp_extract(url, r"^http://[^/?#]*/([^?#]*)", 1), "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept)
        .otherwise(F.concat(kept, F.array(s))),
        # a path that ends in dots is that of a folder
        lambda kept: F.when(
            F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))
        ).otherwise(kept),
    )
    site, tail = F.regexp_extract(url, "^([^?#]*?//[^/?#]*/)", 1), F.regexp_extract(url, r"(?s)^[^?#]*(.*)", 1)
    return F.concat(site, F.array_join(kept, "/"), tail)


def page_links(pages: DataFrame) -> DataFrame:
    """``from_url, to_url`` of the pages' canonical links and refreshing redirects."""
    # only head tags that are neither in a comment nor in a script
    visible = F.regexp_replace(
        F.col("html"), r"(?is)<!--.*?-->|<script\b.*?</script|<style\b.*?</style", " "
    )
    tags = pages.filter(F.col("html").rlike("(?i)canonical|refresh")).select(
        "url",
        F.explode(F.regexp_extract_all(visible, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), F.lit(1))).alias(
            "tag"
        ),
    )
    # column by column, so that no expression is worked out more than once
    named = tags.select(
        "url",
        F.lower(F.substring("tag", 2, 4)).alias("name"),
        _attribute(F.col("tag"), "rel").alias("rel"),
        _attribute(F.col("tag"), "href").alias("href"),
        F.lower(F.trim(_attribute(F.col("tag"), "http-equiv"))).alias("equiv"),
        F.regexp_extract(
            _attribute(F.col("tag"), "content"),
            r"""(?is)^\s*[\d.]*\s*[;,]\s*url\s*=\s*['"]?([^'"]*)""",
            1,
        ).alias("refresh"),
    )
    canonical = (F.col("name") == "link") & F.col("rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    redirect = (F.col("name") == "meta") & (F.col("equiv") == "refresh") & (F.col("refresh") != "")
    targets = named.select(
        "url",
        F.when(canonical, F.col("href")).when(redirect, F.col("refresh")).alias("target"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    ).dropna()
    absolute = targets.select(
        F.col("url").alias("from_url"),
        "host",
        "path",
        F.regexp_replace(F.trim("target"), "&amp;", "&").alias("target"),
        F.regexp_extract("path", r"(?s)^(.*/)", 1).alias("folder"),
    )
    # URLs in full and those of the page's own path stay as they are written
    relative = ~F.col("target").rlike(r"(?i)^https?://|^\?")
    links = absolute.select("from_url", _resolved().alias("to_url"), relative.alias("relative")).dropna()
    dotted = F.col("relative") & F.col("to_url").rlike(r"^http://[^/?#]*/([^?#]*/)?\.\.?([/?#]|$)")
    return links.select(
        "from_url",
        F.when(dotted, _without_dots(F.col("to_url"))).otherwise(F.col("to_url")).alias("to_url"),
    )


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` for the distinct hosts and paths that some rule fits."""
    distinct = urls.select("host", "path").filter("host <> ''").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    by_suffix = distinct.select("host", "path", F.explode(suffixes).alias("suffix"))
    fits = by_suffix.join(rules, F.col("suffix") == F.col("rule_host")).filter(
        F.col("path").startswith(F.col("rule_path"))
    )
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(
        F.length(rule).alias("length"), (F.col("verdict") == "allow").alias("allows"), rule.alias("rule")
    )
    return fits.groupBy("host", "path").agg(F.max(rank).alias("best")).select(
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.when(F.col("best.allows"), F.lit("allow")).otherwise(F.lit("block")).alias("verdict"),
    )


def _with_rules(urls: DataFrame, rules: DataFrame, folder: str, name: str) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) and each one's ``rule`` and ``verdict``, or nulls."""
    found = stored(fitting_rules(urls, rules), folder, f"rules-{name}").select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "rule", "verdict"
    )
    same = (urls["host"] == found["_host"]) & (urls["path"] == found["_path"])
    # as many rows as URLs, and far larger in memory than as a file: not to be broadcast
    return urls.join(found.hint("merge"), same, "left").drop("_host", "_path")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, aliases``.

    ``rules`` has ``verdict`` (allow or block), ``rule_host`` and ``rule_path``; ``redirects`` has
    ``from_url`` and ``to_url``. ``aliases`` is whether the page has any.
    """
    folder = shared_folder(pages.sparkSession)
    links = stored(page_links(pages), folder, "links")
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url").dropna())
    edges = links.select(
        _alias(F.col("from_url")).alias("src"), _alias(F.col("to_url")).alias("dst")
    ).dropna()
    roots = components(edges, folder, "aliases")
    as_url = F.concat(F.lit("http://"), F.col("node"))
    nodes = roots.withColumn("host", host_of(as_url)).withColumn("path", path_of(as_url))
    explicit = _with_rules(nodes, rules, folder, "aliases")
    groups = stored(
        explicit.groupBy("root").agg(
            F.when(F.bool_or(F.col("verdict") == "allow"), F.lit("allow"))
            .when(F.bool_or(F.col("verdict") == "block"), F.lit("block"))
            .alias("decision")
        ),
        folder,
        "decisions",
    )
    decided = stored(roots.join(groups, "root").select("node", "decision"), folder, "decided")
    urls = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        _alias(F.col("url")).alias("alias"),
    )
    urls = stored(urls, folder, "urls")
    judged = stored(_with_rules(urls, rules, folder, "pages"), folder, "judged")
    return judged.join(decided.hint("merge"), judged["alias"] == decided["node"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "decision", F.lit("allow")).alias("verdict"),
        F.col("node").isNotNull().alias("aliases"),
    )
