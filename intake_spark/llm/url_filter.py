"""URL filters over redirect equivalence classes (operator 7).

Addresses (host, path, query) joined by a redirect or a canonical link are
aliases. An address that a rule fits takes that rule's verdict. Any other
address takes its aliases': allowed if a rule allows one of them (an explicit
allow takes precedence over any block), else blocked if a rule blocks one,
else allowed. Aliases are the connected components of all edges.

Edges come from the pages' ``<link rel=canonical href>`` and ``<meta
http-equiv=refresh content="..url=">`` (the first of each), and from an optional
table of redirects. Attributes may be unquoted, ``rel`` a list. Targets are
resolved against the page's first ``<base href>`` or else its address, as RFC 3986
has it: relative to the path or query, dot segments removed. Targets of another
kind (``mailto:``) give no edge.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case. Path: from there up to ``?``, ``#`` or the end. Scheme and fragment aren't
part of an address, and an empty path is ``/`` there (not in the path returned
and that rules see). A rule (verdict, host, path) fits its host and all its
subdomains if the path starts with the rule's; the longest ``host + path`` wins,
an allow before a block of the same length.

Defined results: a null URL, or one without ``://``, has empty host and path,
no rule and no aliases: it is allowed; null html has no edges; repeated pages
give a row each; repeated rules count once; tables may be empty; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .files import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Where links stand in a page; CANONICAL and HREF, of quoted
# attributes only, are the SQL's.
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']([^"']*)["']"""
GOTO = r"""(?is)\burl\s*=\s*["']?([^"'>\s]+)"""
CANONICAL_LINK = (r"""(?is)<link\b(?=[^>]*?(?<![\w:-])rel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|"""
                  r"""'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?=[\s>]|/>)))[^>]*>""")
BASE = r"""(?is)<base\b[^>]*>"""
ANY_HREF = r"""(?is)(?<![\w:-])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
DOTS = r"/\.\.?(/|$)"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def address_of(url: Column) -> Column:
    """host, path (``/`` for an empty one) and query; null without a host."""
    host, path = host_of(url), path_of(url)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.regexp_extract(url, SPLIT, 3)))


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x computed once instead of written out wherever f uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def without_dots(path: Column) -> Column:
    """A path from ``/`` with its segments ``.`` and ``..`` worked in."""
    def joined(parts: Column) -> Column:
        left = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda acc, x: (
            F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc)
            .otherwise(F.concat(acc, F.array(x)))))
        return _let(left, lambda got: F.concat(F.lit("/"), F.array_join(got, "/"), F.when(
            F.element_at(parts, -1).isin(".", "..") & (F.size(got) > 0), "/").otherwise("")))

    return F.when(path.rlike(DOTS), _let(F.split(path, "/"), joined)).otherwise(path)


def resolve(target: Column, url: Column) -> Column:
    """A link target as a URL; null for none, and for schemes without a host."""
    def whole(at: Column) -> Column:
        t, root, path = at["t"], F.concat(F.lit("x://"), at["host"]), at["path"]
        return (F.when(t.rlike(SCHEME + "//"), t)
                .when(t.rlike(SCHEME) | (t == "") | t.startswith("#"), F.lit(None))
                .when(t.startswith("//"), F.concat(F.lit("x:"), t))
                .when(t.startswith("/"), F.concat(root, t))
                .when(t.startswith("?"), F.concat(root, F.when(path == "", "/").otherwise(path), t))
                .otherwise(F.concat(root, F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", "")), t)))

    at = F.struct(target.alias("t"), host_of(url).alias("host"), path_of(url).alias("path"))
    return _let(_let(at, whole), lambda w: F.when(w.isNotNull(), F.concat(
        F.lit("x://"), host_of(w), _let(path_of(w), without_dots), F.regexp_extract(w, SPLIT, 3))))


def _href(tag: Column) -> Column:
    return F.trim(F.concat(*[F.regexp_extract(tag, ANY_HREF, i) for i in (1, 2, 3)]), F.lit(" \t\n\r\f"))


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b, to_url): address of a page, and of what it points to."""
    url = F.col("url")
    base = F.coalesce(resolve(_href(F.regexp_extract("html", BASE, 0)), url), url)
    found = (pages.select("url", "html", F.array(
        _href(F.regexp_extract("html", CANONICAL_LINK, 0)),
        F.regexp_extract(F.regexp_extract("html", REFRESH, 0), GOTO, 1)).alias("targets"))
        .where(F.exists("targets", lambda x: x != ""))
        .select("url", base.alias("base"), F.explode("targets").alias("target")))
    return _edges(found.select("url", resolve(F.col("target"), F.col("base")).alias("to_url")))


def _edges(links: DataFrame) -> DataFrame:
    return (links.select(address_of(F.col("url")).alias("a"), _let(F.col("to_url"), address_of).alias("b"), "to_url")
            .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of (host, path), distinct, that a rule fits, with the winning
    rule and its verdict. Hosts are joined by their suffixes of as many labels
    as any rule has."""
    rules = rules.select("verdict", "host", "path").distinct()
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    parts = F.split(F.col("host"), r"\.")
    first = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    suffix = F.transform(F.sequence(first, F.size(parts)),
                         lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    asked = (urls.select("host", "path").where(F.col("host") != "").distinct()
             .select("host", "path", F.explode(suffix).alias("rule_host")))
    fits = (asked.join(rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"), "rule_host")
            .where(F.col("path").startswith(F.col("rule_path"))))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("verdict") == "allow").alias("allow"),
                          rule.alias("rule"), "verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; aliases (long: the
    number of other addresses of its class). ``redirects``: (url, to_url)."""
    spark = pages.sparkSession
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.union(_edges(redirects.select("url", resolve(F.col("to_url"), F.col("url")).alias("to_url"))))
    edges = stored(spark, edges, "links")
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("address"))
    ends = edges.select(host_of(F.col("to_url")).alias("host"), path_of(F.col("to_url")).alias("path"),
                        F.col("b").alias("address"))
    starts = ends.select("host", "path", "address").limit(0)
    if redirects is not None:
        starts = redirects.select(host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("address"))
    known = rows.select("host", "path", "address").union(ends).union(starts)
    # an address with an empty path is the one with "/", with or without edges
    alone = known.where((F.col("path") == "") & F.col("address").isNotNull()).select(F.col("address").alias("id")).distinct()
    known = known.union(known.where((F.col("path") == "") & (F.col("host") != "")).withColumn("path", F.lit("/"))).distinct()
    ruled = stored(spark, apply_rules(known, rules), "ruled")
    classes = connected_components(edges)
    classes = stored(spark, classes.select("id", "component").union(
        alone.join(classes, "id", "left_anti").select("id", F.col("id").alias("component"))), "classes")
    decided = (classes.join(known.withColumnRenamed("address", "id"), "id").join(ruled, ["host", "path"], "left")
               .groupBy("component").agg(
                   F.max(F.coalesce(F.col("verdict") == "allow", F.lit(False))).alias("allowed"),
                   F.max(F.coalesce(F.col("verdict") == "block", F.lit(False))).alias("blocked"),
                   (F.countDistinct("id") - 1).alias("aliases")))
    inherited = classes.join(decided, "component").select(
        F.col("id").alias("address"), (~F.col("allowed") & F.col("blocked")).alias("by_alias"), "aliases")
    return (rows.join(ruled, ["host", "path"], "left").join(inherited, "address", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", F.when(F.col("by_alias"), "block").otherwise("allow")).alias("verdict"),
                    F.coalesce("aliases", F.lit(0).cast("long")).alias("aliases")))
