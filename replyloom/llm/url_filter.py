"""URL filters that see through redirects.

Rules judge a URL by its host and path.  Redirects and canonical links join URLs
into classes of aliases; a block reaches every alias, unless the class holds a
URL that a rule explicitly allows, and a URL's own rule always comes first.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyloom.llm.common import Stored, store
from replyloom.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"


class UrlRule(NamedTuple):
    """Fits ``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str


RULES = (
    UrlRule(ALLOW, "com", "/"),
    UrlRule(BLOCK, "example.com", "/en/"),
    UrlRule(ALLOW, "www.example.com", "/en/"),
    UrlRule(BLOCK, "net", "/es/"),
    UrlRule(BLOCK, "net", "/fr/"),
)
_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""<[Ll][Ii][Nn][Kk]\b[^>]*>"""
_IS_CANONICAL = r"""\b[Rr][Ee][Ll]\s*=\s*["']?[Cc][Aa][Nn][Oo][Nn][Ii][Cc][Aa][Ll]\b"""
_HREF = r"""\b[Hh][Rr][Ee][Ff]\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""<[Mm][Ee][Tt][Aa]\b[^>]*>"""
_IS_REFRESH = r"""\b[Hh][Tt][Tt][Pp]-[Ee][Qq][Uu][Ii][Vv]\s*=\s*["']?[Rr][Ee][Ff][Rr][Ee][Ss][Hh]\b"""
_TARGET = r"""[Uu][Rr][Ll]\s*=\s*["']?([^"'\s>]+)"""
_ORIGIN = r"(?s)^.*?://[^/?#]*"
_DOTS = r"/\.\.?(/|$)"
#: The character references that XML names.
_NAMED = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
_REFERENCE = "&(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _ASCII_UPPER, _ASCII_LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def link_key(url: Column) -> Column:
    """One spelling for URLs that name the same page.

    Scheme and host are lower-cased (A-Z), a fragment is cut, ``.`` and ``..``
    in the path are resolved.  Anything without ``://`` stays as it is.
    """
    head = F.regexp_extract(url, _ORIGIN, 0)
    path = url_path(url)
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    plain = F.concat(F.translate(head, _ASCII_UPPER, _ASCII_LOWER), _without_dots(path), query)
    return F.when(head == "", url).otherwise(plain)


def _without_dots(path: Column) -> Column:
    """A path whose ``.`` and ``..`` segments are carried out; ``..`` stops at the root."""

    def walk(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(path, "/", -1)
    left = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"), walk)
    folder = F.element_at(parts, -1).isin(".", "..") & (F.size(left) > 0)
    walked = F.concat(F.lit("/"), F.array_join(left, "/"), F.when(folder, "/").otherwise(""))
    return F.when(path.rlike(_DOTS), walked).otherwise(path)


def _decoded(value: Column) -> Column:
    """HTML character references of any number, and the five that XML names, as characters."""
    names = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])

    def character(reference: Column) -> Column:
        hexed = F.conv(F.regexp_extract(reference, "^&#[xX](.*);$", 1), 16, 10)
        code = F.when(reference.rlike("^&#[xX]"), hexed).otherwise(F.regexp_extract(reference, "^&#([0-9]+);$", 1))
        code = F.try_to_number(code, F.lit("9999999")).cast("int")
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        written = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.coalesce(F.get(F.array(names[reference]), F.lit(0)), F.when(real, written), F.lit("\ufffd"))

    found = F.transform(F.regexp_extract_all(value, F.lit(_REFERENCE), F.lit(0)), character)
    between = F.split(value, _REFERENCE, -1)
    pieces = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(value.contains("&"), F.array_join(pieces, "")).otherwise(value)


def resolved(target: Column, base: Column) -> Column:
    """The page that a link names, read from a page at ``base``, in the form of ``link_key``.

    Null for links that name no other page: empty ones, mere fragments, and
    schemes without ``//`` such as ``mailto:``.  Null too where ``base`` has no ``://``.
    """
    origin = F.regexp_extract(base, _ORIGIN, 0)
    path = url_path(base)
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", "")
    whole = (
        F.when((origin == "") | (target == "") | target.startswith("#"), None)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, "(?s)^(.*?)://", 1), F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .otherwise(F.concat(origin, folder, target))
    )
    return link_key(whole)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of canonical links and refresh redirects in the pages, both as ``link_key`` spells them.

    Character references are decoded and relative targets resolved against the
    page's URL (``resolved``; a ``<base>`` tag is not read).  Links of a page to
    itself and links of pages with a null URL, or one without ``://``, are left out.
    """
    page, here = F.col(html), F.col(url)

    def targets(tag: str, mark: str, value: str) -> Column:
        tags = F.filter(F.regexp_extract_all(page, F.lit(tag), F.lit(0)), lambda t: t.rlike(mark))
        return F.transform(tags, lambda t: F.regexp_extract(t, value, 1))

    found = F.concat(targets(_CANONICAL, _IS_CANONICAL, _HREF), targets(_REFRESH, _IS_REFRESH, _TARGET))
    # Most pages have neither mark: a plain search is cheaper than cutting out their tags.
    might = page.rlike("[Cc][Aa][Nn][Oo][Nn][Ii][Cc][Aa][Ll]|[Rr][Ee][Ff][Rr][Ee][Ss][Hh]") & here.isNotNull()
    return (
        pages.filter(might)
        .select(here.alias("here"), F.explode(found).alias("t"))
        .select("here", _decoded(F.col("t")).alias("t"))
        .select(link_key(F.col("here")).alias("url"), resolved(F.col("t"), F.col("here")).alias("target"))
        .filter("target is not null and target <> url")
    )


def _rule_table(like: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    return like.sparkSession.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "rule_host string, rule_path string, verdict string"
    )


def rule_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the rule that fits each URL; the longest wins, allow breaks ties.

    ``urls`` has distinct ``url``; a host is looked up under each of its
    suffixes, so the rules may be a table of any size.
    """
    dots = F.split(F.col("host"), r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(dots)), lambda i: F.array_join(F.slice(dots, i, F.size(dots) - i + 1), ".")
    )
    asked = (
        urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .filter("host <> ''")
        .select("url", "path", F.explode(suffixes).alias("rule_host"))
    )
    fits = asked.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(name).alias("n"), (F.col("verdict") == ALLOW).alias("allow"), name.alias("rule"), "verdict"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")


def alias_classes(links: DataFrame) -> Stored:
    """(node, root) for URLs that links join; URLs meet by their 64-bit digests."""
    edges = links.select(F.xxhash64("url").alias("u"), F.xxhash64("target").alias("v"))
    return connected_components(edges, "url-classes")


def judge_urls(
    pages: DataFrame,
    links: DataFrame | None = None,
    rules: Sequence[UrlRule] | DataFrame = RULES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per page: key, host, path, rule (or null), verdict.

    ``links`` (url, target) default to what the pages' html says; targets need
    not be pages.  Pages and links meet by ``link_key``, so case of the host and
    fragments do not keep a page from its aliases.  A URL with a rule gets its verdict.  Without one, it is
    allowed if a rule allows any of its aliases, else blocked if a rule blocks
    one, else allowed.  A null URL, or one without ``://``, has empty host and
    path and no rule, and no alias unless a link names it.  Repeated URLs and pages are judged alike; an
    empty table gives no rows; other columns are not carried.
    """
    if links is None:
        links = page_links(pages, url, html)
    else:
        links = links.select(link_key(F.col("url")).alias("url"), link_key(F.col("target")).alias("target"))
    links = store(links.filter("url is not null and target is not null").distinct(), "url-links")
    table = rules if isinstance(rules, DataFrame) else _rule_table(pages, rules)
    named = links.rows.select("url").unionByName(links.rows.select(F.col("target").alias("url")))
    urls = pages.select(F.col(url).alias("url")).filter("url is not null").unionByName(named).distinct()
    hits = store(rule_hits(urls, table), "url-rules")
    classes = alias_classes(links.rows)
    verdicts = (
        hits.rows.join(classes.rows, F.xxhash64(link_key(hits.rows["url"])) == classes.rows["node"])
        .groupBy("root")
        .agg(F.min("verdict").alias("class_verdict"))  # "allow" sorts before "block"
    )
    spread = classes.rows.join(verdicts, "root").select("node", "class_verdict")
    links.drop()
    pages = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"), F.xxhash64(link_key(F.col(url))).alias("__node"))
    return (
        pages.join(hits.rows, F.col("__url") == hits.rows["url"], "left")
        .join(spread, F.col("__node") == F.col("node"), "left")
        .select(
            F.col("__key").alias(key),
            url_host(F.col("__url")).alias("host"),
            url_path(F.col("__url")).alias("path"),
            "rule",
            F.coalesce("verdict", "class_verdict", F.lit(ALLOW)).alias("verdict"),
        )
    )
