"""Operator 5, URL rules with redirect equivalence. DataFrame operations only.

A rule is a host and the start of a path; it fits its host and all subdomains, and the longest that fits decides. Pages
that no rule fits take the decision of their aliases: canonical links and redirects are edges between addresses, and
the connected components are found by alternating stars (components.py). A component with an explicitly allowed address
is allowed; else, with a blocked one, it is blocked; else the default holds. A page's own rule always comes first.

Addresses are judged once each, not once per page. Host suffixes meet the rules' hosts in a join that adaptive execution
can turn into a broadcast if the rules are small, or split if a host is hot. What is known of addresses grows with the
pages and compresses well, so that its files tell little of its size: it is never broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .components import components

DEFAULT = "allow"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(df: DataFrame, url: str) -> DataFrame:
    """df with host, path and node: the address without scheme and fragment."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(F.col(url), F.instr(url, "://") + F.lit(3), F.length(url))), F.lit(""))
    df = df.withColumn("_rest", rest)
    host = F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), _UPPER, _LOWER)
    df = df.withColumn("host", host).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
    return df.withColumn("node", F.concat("host", F.regexp_extract("_rest", r"^[^/?#]*([^#]*)", 1))).drop("_rest")


def judged(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """addresses(host, path), rules(host, path, verdict) -> host, path, rule, verdict of those that a rule fits."""
    each = addresses.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = rules.select(F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")).dropna().distinct()
    fits = each.withColumn("rule_host", F.explode(suffixes)).join(named, "rule_host").where(F.startswith("path", "rule_path"))
    # the longest; of equal rules an allow comes first
    best = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"), (F.col("rule_verdict") == "allow").alias("a"), F.concat("rule_host", "rule_path").alias("rule"))
    return fits.groupBy("host", "path").agg(F.max(best).alias("best")).select("host", "path", "best.rule", F.when(F.col("best.a"), "allow").otherwise("block").alias("verdict"))


def link_edges(pages: DataFrame) -> DataFrame:
    """pages(url, html) -> (a, b): address of a page, address that its canonical link or its redirect names."""
    small = F.lower("html")
    some = pages.where(small.contains("canonical") | small.contains("refresh")).select("url", "html")
    value = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s>]*)"""
    canonical = F.regexp_extract(F.regexp_extract("html", r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", 0), rf"(?is)\bhref{value}", 1)
    refresh = F.regexp_extract(F.regexp_extract(F.regexp_extract("html", r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0), rf"(?is)\bcontent{value}", 1), r"""(?is)url\s*=\s*["']?([^"'\s>]+)""", 1)
    some = some.select("url", F.explode(F.array(canonical, refresh)).alias("to")).withColumn("to", F.replace(F.regexp_replace("to", r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&"))).where("to <> ''")
    some = stored(some, "targets")  # few rows; html is searched once
    some = with_parts(some, "url").withColumnRenamed("node", "a")
    folder = F.concat("host", F.regexp_replace(F.when(F.col("path") == "", "/").otherwise(F.col("path")), r"[^/]*$", ""))
    whole = F.when(F.instr("to", "://") > 0, F.col("to")).when(F.startswith("to", F.lit("//")), F.concat(F.lit("x:"), F.col("to"))).when(F.startswith("to", F.lit("/")), F.concat(F.lit("x://"), F.col("host"), F.col("to"))).otherwise(F.concat(F.lit("x://"), folder, F.col("to")))
    return with_parts(some.select("a", whole.alias("to")), "to").select("a", F.col("node").alias("b")).where("a <> '' AND b <> '' AND a <> b").distinct()


def filtered(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, default: str = DEFAULT) -> DataFrame:
    """pages(page_id, url, html, ...), rules(host, path, verdict) -> page_id, host, path, rule, verdict; one row per row.

    edges(a, b): redirects that are known otherwise, as addresses with ://. A null url, or one without ://, has an
    empty host and path and the default verdict. Null ids stay null, rows that repeat are judged each; pages of any
    length are searched whole for their links; other columns are not looked at. Without pages the result is empty; without
    rules all verdicts are the default. Rows without a host meet no rule, so they are not dealt by it."""
    rows = with_parts(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html"), "url")
    links = link_edges(rows.select("url", "html"))
    if edges is not None:
        known = with_parts(edges.select("a", "b"), "a").select(F.col("node").alias("x"), "b")
        known = with_parts(known, "b").select(F.col("x").alias("a"), F.col("node").alias("b")).where("a <> '' AND b <> '' AND a <> b")
        links = links.unionByName(known)
    aliases = components(links).select("node", "component")
    ends = with_parts(aliases.select(F.concat(F.lit("x://"), "node").alias("url"), "component"), "url")
    addresses = rows.select("host", "path").unionByName(ends.select("host", "path"))
    own = stored(judged(addresses, rules), "judged")
    of = ends.join(own.hint("merge"), ["host", "path"]).groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allowed"))
    spread = aliases.join(of, "component").select("node", F.when(F.col("allowed"), "allow").otherwise("block").alias("alias_verdict"))
    some = rows.select("page_id", "host", "path", "node")
    out = some.where("host <> ''").join(own.hint("merge"), ["host", "path"], "left").join(spread.hint("merge"), "node", "left").select("page_id", "host", "path", "rule", "verdict", "alias_verdict")
    bare = some.where("host = ''").select("page_id", "host", "path", *(F.lit(None).cast("string").alias(c) for c in ("rule", "verdict", "alias_verdict")))
    return out.unionByName(bare).select("page_id", "host", "path", "rule", F.coalesce("verdict", "alias_verdict", F.lit(default)).alias("verdict"))


def rules_frame(spark, rules=RULES) -> DataFrame:
    """A few rules as rows that the optimizer sees as constants."""
    one = [spark.range(1).select(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return reduce(DataFrame.unionByName, one)


def op5_redirect_equivalence(spark, sf_dir):
    return filtered(table(spark, sf_dir, "pages"), rules_frame(spark))


#: The same in one statement; components are found by walking the edges from every address that has one.
ORACLE = r"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM (SELECT page_id, html, coalesce(rest, '') AS rest FROM u)),
t AS (SELECT host, path, host || tail AS a, unnest([
        trim(regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is'), '\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s>]*)', 1, 'is'), '"'''),
        regexp_extract(trim(regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is'), '\bcontent\s*=\s*("[^"]*"|''[^'']*''|[^\s>]*)', 1, 'is'), '"'''), 'url\s*=\s*["'']?([^"''\s>]+)', 1, 'is')]) AS target FROM p),
l AS (SELECT a, replace(CASE WHEN instr(target, '://') > 0 THEN substr(target, instr(target, '://') + 3) WHEN starts_with(target, '//') THEN substr(target, 3)
        WHEN starts_with(target, '/') THEN host || target ELSE host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || target END, '&amp;', '&') AS rest FROM t WHERE target <> ''),
e0 AS (SELECT DISTINCT a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS b FROM l WHERE a <> ''),
e AS (SELECT a, b FROM e0 WHERE b <> '' UNION SELECT b, a FROM e0 WHERE b <> ''),
r(n, m) AS (SELECT a, a FROM e UNION SELECT r.n, e.b FROM r JOIN e ON r.m = e.a),
ends AS (SELECT DISTINCT m, regexp_extract(m, '^[^/?#]*') AS host, regexp_extract(m, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
adr AS (SELECT host, path FROM p UNION SELECT host, path FROM ends),
own AS (SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS v FROM adr JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1, 2),
alias AS (SELECT r.n, bool_or(own.v = 'allow') AS allowed FROM r JOIN ends ON r.m = ends.m JOIN own ON ends.host = own.host AND ends.path = own.path GROUP BY 1)
SELECT p.page_id, p.host, p.path, own.rule, coalesce(own.v, CASE WHEN alias.allowed THEN 'allow' WHEN alias.n IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN own ON p.host = own.host AND p.path = own.path LEFT JOIN alias ON alias.n = p.host || p.tail
"""
