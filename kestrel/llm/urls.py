"""Operator 1: URL filters with redirect equivalence.

A rule ``(host, path)`` fits its host and every subdomain when the URL's path
starts with the rule's path; the longest rule wins.  URLs that no rule fits
take the verdict of their aliases: URLs are reduced to a normal form (scheme,
fragment, default port, dot segments, tracking parameters and a trailing slash
removed), the normal forms are linked by canonical links and refresh redirects
found in the HTML, and connected components of these links are the alias classes.
Within a class an explicit allow outweighs a block; a class without any rule is allowed.

Links are read as a browser with scripts does: comments, scripts, styles,
templates, noscript and raw-text elements hold none (an unclosed one reaches to the
end), references in attributes are decoded, and addresses are resolved against the
first ``<base href>``, else the page's URL.  A ``<`` or ``>`` inside an attribute ends its tag.
"""

from __future__ import annotations

import string
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.components import connected_components
from kestrel.llm.store import Scratch, columns, values

#: (host, path, verdict); fixed values of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Query parameters that do not select content.
TRACKING = r"utm_[a-z]+|gclid|fbclid|ref|source|sessionid"

_RAW = "script style template noscript textarea title xmp iframe noembed noframes".split()
#: Parts of a page whose text is no markup of the page.
UNREAD = r"(?is)<!--.*?(?:--!?>|\z)" + "".join(rf"|<{tag}\b.*?(?:</{tag}\b|\z)" for tag in _RAW)
CANONICAL = r"""(?is)<link[\s/](?:[^<>]*[\s"'/])?rel\s*=\s*["']?(?:[^"'<>=]*\s)?canonical(?:["'\s/][^<>]*)?>"""
REFRESH = r"""(?is)<meta[\s/](?:[^<>]*[\s"'/])?http-equiv\s*=\s*["']?\s*refresh(?:["'\s/][^<>]*)?>"""
BASE = r"""(?is)<base[\s/](?:[^<>]*[\s"'/])?href\s*=[^<>]*>"""
HREF = r"""(?is)[\s"'/]href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
CONTENT = r"""(?is)[\s"'/]content\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
REFRESH_URL = r"""(?is)^\s*[0-9.]+\s*[;,\s]\s*(?:url\s*=\s*)?["']?([^"']*)"""
SPACE = " \t\r\n\f"
#: Pieces of an attribute's value: references with their semicolon, and the text between them.
PIECES = r"(?s)&#[xX][0-9a-fA-F]{1,6};|&#[0-9]{1,7};|&[A-Za-z]+;|[^&]+|&"
#: Named references to one ASCII character.
NAMED = {f"&{name}": char for name, char in sorted(html5.items())
         if name.endswith(";") and len(char) == 1 and char < "\x80"}
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
ORIGIN = r"^([^:/?#]+://[^/?#]*)"
FOLDER = r"^([^:/?#]+://[^/?#]+/(?:[^?#]*/)?)"


def _value(tag: Column, attribute: str) -> Column:
    """An attribute's value with its references decoded."""
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def piece(p):
        code = (F.when(p.rlike("^&#[xX]"), F.conv(F.regexp_extract(p, "([0-9a-fA-F]+);", 1), 16, 10))
                .otherwise(F.regexp_extract(p, "([0-9]+);", 1)).cast("bigint"))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return (F.when(p.startswith("&#"), F.when(valid, char).otherwise("\ufffd"))
                .otherwise(F.coalesce(F.try_element_at(names, p), p)))

    raw = F.btrim(F.regexp_extract(tag, attribute, 1), F.lit("\"'"))
    return F.array_join(F.transform(F.regexp_extract_all(raw, F.lit(PIECES), F.lit(0)), piece), "")


def _address(value: Column) -> Column:
    return F.translate(F.btrim(value, F.lit(SPACE)), "\t\r\n", "")


def _without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` segments resolved."""
    kept = F.aggregate(F.split(F.substring(path, 2, F.length(path)), "/"), F.lit(""),
                       lambda done, part: F.when(part == "..", F.regexp_replace(done, r"/[^/]*\z", ""))
                       .when(part == ".", done).otherwise(F.concat(done, F.lit("/"), part)))
    return (F.when(path.rlike(r"/\.\.?\z"), F.concat(kept, F.lit("/")))
            .when(path.rlike(r"/\.\.?/"), kept).otherwise(path))


def _step(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later steps and filters read, and do not copy: a one-element explode."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _resolved(df: DataFrame, base: str, target: str, to: str) -> DataFrame:
    """``to``: the address ``target`` as seen from the URL ``base``, without dot segments; null if it names no host."""
    t, origin, folder = F.col(target), F.regexp_extract(base, ORIGIN, 1), F.regexp_extract(base, FOLDER, 1)
    found = (F.when(t.rlike(SCHEME + "//"), t).when(t.rlike(SCHEME), F.lit(None))
             .when(t.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:/?#]+):", 1), F.lit(":"), t))
             .when(t.startswith("/"), F.concat(origin, t))
             .when(t.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), t))
             .when(t.startswith("#") | (t == ""), F.regexp_extract(base, r"^([^#]*)", 1))
             .when(folder != "", F.concat(folder, t)).otherwise(F.concat(origin, F.lit("/"), t)))
    at = _step(df, "_at", found)
    path = _step(at, "_path", F.regexp_extract("_at", r"^[^:/?#]+://[^/?#]*([^?#]*)", 1))
    return (_step(path, to, F.when(F.regexp_extract("_at", ORIGIN, 1) != "", F.concat(
                F.regexp_extract("_at", ORIGIN, 1), _without_dots(F.col("_path")),
                F.regexp_extract("_at", r"(?s)^[^?#]*(.*)", 1))))
            .drop("_at", "_path"))


def split_url(df: DataFrame, url: str, to: str = "") -> DataFrame:
    """Add ``{to}host``, ``{to}path`` and ``{to}key`` of the column ``url``.

    Host and path are empty without ``://``.  The key is the URL's normal form, null
    without a host.  Each step is a column of its own, so nothing is computed twice."""
    at = F.instr(F.col(url), "://")
    kept = F.array_join(F.filter(F.split("_query", "&"),
                                 lambda p: ~p.rlike(rf"(?i)^({TRACKING})(=|$)") & (p != "")), "&")
    host, path = f"{to}host", f"{to}path"
    return (df.withColumn("_rest", F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit("")))
            .withColumn(host, F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1),
                                          string.ascii_uppercase, string.ascii_lowercase))
            .withColumn(path, F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
            .withColumn("_query", F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1))
            .withColumn("_kept", kept)
            .withColumn(f"{to}key", F.when(F.col(host) != "", F.concat(
                F.regexp_replace(host, r":(80|443)$", ""), F.regexp_replace(_without_dots(F.col(path)), r"/+$", ""),
                F.when(F.col("_kept") != "", F.concat(F.lit("?"), F.col("_kept"))).otherwise(F.lit("")))))
            .drop("_rest", "_query", "_kept"))


def link_targets(pages: DataFrame) -> DataFrame:
    """``pages(url, html)`` -> (url, to): the absolute targets of all canonical links and refresh
    redirects of each page; addresses without a host (mailto, javascript) are no targets."""
    # Few pages have such tags: the markup is only cleaned where one seems to stand.
    seen = (pages.where(F.col("html").isNotNull() & F.col("url").contains("://"))
            .where(F.col("html").rlike(CANONICAL) | F.col("html").rlike(REFRESH)))
    markup = _step(seen, "_markup", F.regexp_replace("html", UNREAD, " ")).select("url", "_markup")
    tags = _step(markup, "_tags", F.concat(
        F.transform(F.regexp_extract_all("_markup", F.lit(CANONICAL), F.lit(0)),
                    lambda x: _address(_value(x, HREF))),
        F.transform(F.regexp_extract_all("_markup", F.lit(REFRESH), F.lit(0)),
                    lambda x: _address(F.regexp_extract(_value(x, CONTENT), REFRESH_URL, 1)))))
    based = _step(tags, "_base_href", _address(_value(F.regexp_extract("_markup", BASE, 0), HREF))).drop("_markup")
    targets = _resolved(based, "url", "_base_href", "_own").select(
        "url", F.coalesce("_own", "url").alias("_base"), F.explode(F.array_distinct("_tags")).alias("_target"))
    return _resolved(targets.where("_target != ''"), "_base", "_target", "to").where("to IS NOT NULL").select("url", "to")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``urls(host, path, ...)`` plus ``rule`` and ``rule_verdict`` of the longest fitting rule.

    Rules are joined to distinct hosts on their host suffixes, so the work follows
    hosts, not rows; a host carries only the rules that apply to it.
    """
    suffixes = (urls.select("host").distinct().where("host != ''")
                .withColumn("_labels", F.split("host", r"\."))
                .select("host", F.explode(F.expr(
                    "transform(sequence(1, size(_labels)), i -> "
                    "array_join(slice(_labels, i, size(_labels)), '.'))")).alias("rule_host")))
    found = (suffixes.join(rules, "rule_host")
             .groupBy("host").agg(F.collect_set(F.struct(
                 F.length(F.concat("rule_host", "rule_path")).alias("size"),
                 F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "verdict")).alias("_rules")))
    best = F.expr("array_max(filter(_rules, r -> startswith(path, r.rule_path)))")
    return (urls.join(found, "host", "left").withColumn("_best", best)
            .withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.verdict"))
            .drop("_rules", "_best"))


def url_verdicts(pages: DataFrame, rules: list[tuple] | DataFrame = RULES) -> DataFrame:
    """``pages(page_id, url, html)`` -> one row per page: page_id, url, host, path, rule, verdict, alias.

    ``rules``: (host, path, verdict) rows, or a DataFrame(rule_host, rule_path, verdict).
    ``alias`` is the smallest normal form of the alias class (null without a host).
    Null or scheme-less URLs have empty host and path, no rule and verdict allow;
    repeated rows are judged alike; null html adds no link; extra columns are ignored.
    """
    scratch = Scratch(pages.sparkSession)
    if not isinstance(rules, DataFrame):
        rules = values(pages.sparkSession, "rule_host string,rule_path string,verdict string", rules)
    base = pages.select(*columns(pages, "page_id", "url", "html"))
    judged = scratch.write(split_url(base.select("page_id", "url"), "url"))
    # Tables, so that filters on the derived columns are not pushed into copies of all the regexes.
    found = scratch.write(link_targets(base.select("url", "html")))
    linked = scratch.write(split_url(split_url(found, "url", "from_"), "to")
                           .select(F.col("from_key").alias("a"), "host", "path", F.col("key").alias("b")))
    classes = connected_components(linked.select("a", "b"))
    known = judged.select("host", "path", "key").unionAll(
        linked.select("host", "path", F.col("b").alias("key"))).distinct()
    ruled = match_rules(known, rules).join(classes.select(F.col("node").alias("key"), "component"), "key", "left")
    ruled = ruled.withColumn("alias", F.coalesce("component", "key"))
    verdicts = ruled.where("rule is not null").groupBy("alias").agg(
        F.max(F.col("rule_verdict") == "allow").alias("_allow"))
    settled = (ruled.join(verdicts, "alias", "left")
               .select("host", "path", F.col("key").alias("_key"), "rule", "alias",
                       F.when(F.col("rule").isNotNull(), F.col("rule_verdict"))
                       .when(F.col("_allow") == F.lit(False), "block").otherwise("allow").alias("verdict")))
    return (judged.join(settled.withColumnsRenamed({"host": "_h", "path": "_p"}),
                        (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p"))
                        & F.col("key").eqNullSafe(F.col("_key")), "left")
            .select("page_id", "url", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"),
                    "alias"))
