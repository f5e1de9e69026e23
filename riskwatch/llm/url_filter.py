"""URL rules with redirect equivalence.

A rule (host, path, verdict) fits its host and all subdomains, where the path of
the url starts with the rule's; the longest that fits decides, and among equally
long ones an allow. Pages that a redirect or canonical link joins are one
resource: in such a connected component, what a block rule says of one url also
holds for the aliases that no rule fits. A url's own rule, an allow above all,
comes before what reaches it from aliases. What nothing reaches is allowed.

Edges: every ``<link rel=canonical href>`` and ``<meta http-equiv=refresh>`` of each
page, and a table of redirects (src, dst) if given. Relative targets are resolved.
Two urls are one node if they agree after lower-casing the host and dropping the
fragment.

Defined results: a null url or one without ``://`` has empty host and path, no
rule and no aliases. Repeated rows and ids are judged one by one. A page without
html has no edge. Empty rules allow all. Other columns are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col
from .components import components

CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'>\s]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'>\s]+)"""


def _lower(x: Column) -> Column:
    return F.translate(x, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _node(url: Column) -> Column:
    """One name for all spellings of a url; null where there is no host part."""
    scheme = _lower(F.substring_index(url, "://", 1))
    tail = F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^#]*)", 1)
    return F.when(F.locate("://", url) > 0, F.concat(scheme, F.lit("://"), host_of(url), tail))


def _resolve(target: Column, base: Column) -> Column:
    scheme = F.substring_index(base, "://", 1)
    origin = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(origin, path_of(base), target))
            .when((target != "") & ~target.startswith("#"),
                  F.concat(origin, F.when(folder == "", "/").otherwise(folder), target)))


def links(pages: DataFrame) -> DataFrame:
    """a, b: nodes joined by a page's canonical link or refresh, from columns url and html."""
    def targets(tag: str, attribute: str) -> Column:
        return F.transform(F.regexp_extract_all("html", F.lit(tag), 0), lambda x: F.regexp_extract(x, attribute, 1))

    word = F.lower("html")
    none = F.array().cast("array<string>")
    found = F.concat(
        F.when(word.contains("canonical"), targets(CANONICAL, HREF)).otherwise(none),
        F.when(word.contains("refresh"), targets(REFRESH, REFRESH_URL)).otherwise(none))
    found = pages.where(word.contains("canonical") | word.contains("refresh")).select("url", F.explode(found).alias("to"))
    return found.select(_node(F.col("url")).alias("a"), _node(_resolve(F.col("to"), F.col("url"))).alias("b"))


def match(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, rule_verdict for the distinct (host, path) that a rule fits.

    Each host suffix meets the lengths of that host's rule paths, then the rules
    by equal (host, path prefix): no place meets all rules of a large host.
    """
    rules = rules.select(_lower(F.col("host")).alias("rule_host"), F.col("path").alias("prefix"), "verdict")
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    spread = places.select("host", "path").distinct().select("host", "path", F.explode(suffix).alias("rule_host"))
    spread = spread.join(lengths, "rule_host").select("host", "path", "rule_host", F.explode("lengths").alias("n"))
    spread = spread.where(F.col("n") <= F.length("path")).withColumn("prefix", F.substring("path", F.lit(1), F.col("n")))
    rule = F.concat("rule_host", "prefix")
    best = F.struct(F.length(rule).alias("n"), (F.col("verdict") == "allow").alias("allow"),
                    F.length("rule_host").alias("h"), rule.alias("rule"), "verdict")
    found = spread.join(rules, ["rule_host", "prefix"]).groupBy("host", "path").agg(F.max(best).alias("best"))
    return found.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page id, host, path, rule (null: none fits), verdict for every row of ``pages``."""
    url = col(url_col).cast("string")
    edges = links(pages.select(url.alias("url"), col(html_col).cast("string").alias("html")))
    if redirects is not None:
        edges = edges.union(redirects.select(_node(F.col("src")), _node(F.col("dst"))))
    groups = materialize(components(edges), "components")
    known = groups.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    blocked = known.join(match(known, rules), ["host", "path"]).where("rule_verdict = 'block'")
    blocked = groups.join(blocked.select("component").distinct(), "component").select("node", F.lit(True).alias("alias"))

    rows = pages.select(col(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"),
                        _node(url).alias("node"))
    found = rows.join(match(rows, rules), ["host", "path"], "left").join(blocked, "node", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("alias"), "block"), F.lit("allow"))
    return found.select(id_col, "host", "path", "rule", verdict.alias("verdict"))
