"""URL rules and redirect equivalence, in DataFrame operations only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize
from corpuskiln.llm.components import connected_components

#: host, path, verdict
Rule = tuple[str, str, str]
#: Up to so many rules are written into the expression; longer lists join the suffixes of hosts.
FEW_RULES = 200


def url_host(url: Column) -> Column:
    """What stands after the first ``://``, up to a slash, question mark, hash or the end, in lower ASCII case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of the longest fitting rule (rule, verdict), null if none; of equal lengths, allow comes before block."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "allow", r))
    found = None
    for h, p, v in ordered:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def with_best_rule(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rows`` (host, path and others) with ``best``, as ``best_rule`` gives it, whatever the number of rules.

    A long list meets the distinct hosts and paths by the suffixes of the host, of which a host has as many as labels.
    """
    if len(rules) <= FEW_RULES:
        return rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    listed = rows.sparkSession.createDataFrame(rules, "suffix string, start string, verdict string")
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    met = rows.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes)).join(listed, "suffix").where(F.col("path").startswith(F.col("start")))
    rule = F.concat("suffix", "start")
    order = F.struct(-F.length(rule), F.col("verdict") != "allow", "suffix", "start")
    found = met.groupBy("host", "path").agg(F.min_by(F.struct(rule.alias("rule"), "verdict"), order).alias("best"))
    return rows.join(found, ["host", "path"], "left")


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges (src, dst) from each page's url to all of its canonical links and targets of refresh redirects.

    Relative targets are resolved against the page's ``<base href>``, if it has one, and its url; links to itself are left out.
    """
    html = F.coalesce("html", F.lit(""))
    canonical = F.regexp_extract_all(html, F.lit(r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"), F.lit(1))
    refresh = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>]+)"), F.lit(1))
    targets = F.array_union(canonical, refresh)
    base = F.regexp_extract(html, r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    found = pages.where(F.col("url").contains("://") & (F.size(targets) > 0)).select("url", F.coalesce(resolve(F.col("url"), base), "url").alias("base"), F.explode(targets).alias("to"))
    found = found.select(url_key(F.col("url")).alias("src"), url_key(resolve(F.col("base"), F.col("to"))).alias("dst"))
    return found.where("src <> dst")


def resolve(base: Column, target: Column) -> Column:
    """``target`` as an absolute url: one with ``scheme://`` as it is, any other against ``base`` by RFC 3986; null if it has another scheme."""
    target = F.regexp_replace(target, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    scheme, site = F.regexp_extract(base, r"(?s)^(.*?)://", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(url_path(base), r"(?s)^(.*/)", 1)
    merged = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(path != "", F.concat(site, without_dots(merged), rest))
        .when(target.startswith("?"), F.concat(site, url_path(base), target))
        .otherwise(base)
    )


def without_dots(path: Column) -> Column:
    """A path from ``/`` on without the segments ``.`` and ``..``, each of the latter with the segment before it."""
    up = lambda kept: F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
    step = lambda kept, x: F.when(x == ".", kept).when(x == "..", up(kept)).otherwise(F.concat(kept, F.array(x)))
    segments = F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), step)
    whole = F.array_join(F.when(path.rlike(r"(?s)/\.\.?\z"), F.concat(segments, F.array(F.lit("")))).otherwise(segments), "/")
    return F.when(path.contains("/."), whole).otherwise(path)


def url_key(url: Column) -> Column:
    """A url without its fragment; two spellings that differ in the host's case are the same node."""
    rest = F.regexp_extract(url, r"(?s)^(.*?://)[^/?#]*([^#]*)", 2)
    return F.concat(url_host(url), F.lit("\x00"), rest)


def judge_urls(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """Columns page_id, host, path, rule and verdict, one row per row of ``pages`` (page_id, url, html; others are ignored).

    The longest fitting rule decides. A page that no rule fits is blocked if its component over ``edges`` (src and dst
    as ``url_key`` values; by default the canonical links and refresh redirects in ``html``) holds a url that a rule
    blocks; an allow rule of its own always comes first. All else gets ``default``. Null urls and those without
    ``://`` have an empty host and path and no aliases; repeated rows are judged alike; no rows give no rows.
    """
    url = F.col("url")
    judged = with_best_rule(pages.select("page_id", url, url_host(url).alias("host"), url_path(url).alias("path")), rules)
    alone = F.concat(F.lit("\x01"), F.xxhash64("page_id", "url").cast("string"))  # no node, and not all in one partition
    judged = judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own"), F.when(url.contains("://"), url_key(url)).otherwise(alone).alias("node"))
    edges = materialize((link_edges(pages) if edges is None else edges).distinct(), "links")
    if edges.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit(default)).alias("verdict"))
    members = materialize(connected_components(edges, name="aliases"), "aliases")
    at = F.concat(F.lit("x://"), F.regexp_replace("node", "\x00", ""))
    fate = with_best_rule(members.select("component", url_host(at).alias("host"), url_path(at).alias("path")), rules).where("best.verdict = 'block'")
    blocked = fate.select("component").distinct()
    tainted = members.join(blocked, "component", "left_semi").select("node", F.lit("block").alias("alias"))
    return judged.join(tainted, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("own", "alias", F.lit(default)).alias("verdict"))
