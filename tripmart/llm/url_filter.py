"""URL rules with redirect equivalence.

A rule is a host and a path prefix with a verdict; it fits its host and all
subdomains, and the longest fitting rule wins. URLs that no rule fits take
their verdict from their aliases: pages name another URL as their canonical
link or send the reader on at once (meta refresh), and such URLs are one
resource. Connected components over these edges are found by Spark; in a
component, an explicit allow of any member beats a block of any member, and
without either the URL is allowed. A rule's own verdict is never overruled.

URLs stand for the same node when they differ only in the scheme, letter case
of the host, a fragment, or campaign parameters (``utm_...``).

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is allowed, unless an alias is blocked; relative link
targets are resolved against the page's own URL; links without a target,
self-links and repeated rows add nothing; null html has no links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import connected_components, lower_ascii, stored

# The rules of the registered query (host, path prefix, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
NO_SCHEME = "://"


def host_of(url: Column) -> Column:
    """The host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in ASCII lower case."""
    rest = _rest(url)
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.regexp_replace(_rest(url), r"^[^/?#]*", ""), r"^[^?#]*", 0), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, NO_SCHEME)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """The longest fitting rule as struct (rule, verdict); null if none fits."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def node_of(url: Column) -> Column:
    """The URL without scheme, fragment, dot segments and campaign parameters; null without ``://``."""
    rest = _without_dots(F.regexp_replace(_rest(url), r"#.*$", ""))
    rest = F.regexp_replace(rest, r"(?i)([?&])utm_[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"\?&+", "?"), r"&&+", "&"), r"[?&]$", "")
    return F.concat(host_of(url), F.regexp_replace(rest, r"^[^/?#]*", ""))


def _without_dots(rest: Column) -> Column:
    """``.`` and ``..`` segments of the path taken out; host and query stay as they are."""
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    parts = F.split(path, "/")
    up = lambda done: F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(x == "..", up(done)).otherwise(F.concat(done, F.array(x))))
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    dotted = path.rlike(r"/\.{1,2}(?:/|$)")
    return F.when(dotted, F.concat(F.array_join(kept, "/"), F.regexp_replace(rest, r"^[^?]*", ""))).otherwise(rest)


def _unescape(c: Column) -> Column:
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _resolve(base: Column, target: Column) -> Column:
    """An absolute URL for a link target, seen from the page at ``base``."""
    target = F.btrim(target)
    root = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<!/)/[^/]*$", "")
    return (
        F.when(target == "", None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"^[^:/?#]+:", 0), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), target))
        .when(target.startswith("#"), None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .otherwise(F.concat(folder, F.lit("/"), target))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(u, v) url pairs from canonical links and immediate redirects in pages (url, html)."""
    html = F.regexp_replace(F.col("html"), r"(?is)<!--.*?-->|<(script|style|textarea)\b.*?</\1\s*>", " ")
    attr = r"""(?is)\b%s\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""

    def value(tag: Column, name: str) -> Column:
        return _unescape(F.regexp_replace(F.regexp_extract(tag, attr % name, 1), r"""^["']|["']$""", ""))

    # most pages have neither: the tags are looked for only where their words occur
    marked = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv") & F.col("url").contains(NO_SCHEME))
    tags = marked.select("url", F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = tags.where(F.col("tag").rlike(r"(?i)^<link\b") & F.array_contains(F.split(F.lower(value(F.col("tag"), "rel")), r"\s+"), "canonical"))
    refresh = tags.where(F.col("tag").rlike(r"(?i)^<meta\b") & (F.lower(value(F.col("tag"), "http-equiv")) == "refresh"))
    sent = F.regexp_extract(value(F.col("tag"), "content"), r"""(?i)^\s*[\d.]*\s*[;,]?\s*url\s*=\s*["']?([^"']*)""", 1)
    # written: what reads the pages and what resolves the links are too much code for one generated class
    edges = stored(canonical.select("url", value(F.col("tag"), "href").alias("to")).union(refresh.select("url", sent.alias("to"))), "url_links")
    return edges.select(F.col("url").alias("u"), _resolve(F.col("url"), F.col("to")).alias("v")).where("v is not null")


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict per page.

    ``redirects`` (u, v): further URL pairs known to be one resource, as from a crawl's log.
    """
    url = F.col("url").cast("string")
    df = pages.select("page_id", url.alias("url"), F.col("html").cast("string").alias("html"))
    edges = link_edges(df)
    if redirects is not None:
        edges = edges.union(redirects.select("u", "v"))
    edges = stored(edges.select(
        node_of(F.col("u")).alias("u"), node_of(F.col("v")).alias("v"),
        *[rule_of(host_of(F.col(c)), path_of(F.col(c)), rules)["verdict"].alias(f"{c}_verdict") for c in ("u", "v")]), "url_edges")
    members = connected_components(edges, "url_aliases")
    # every URL on an edge speaks for its component, the targets without a page too
    said = edges.select(F.col("u").alias("node"), F.col("u_verdict").alias("said")).union(edges.select("v", "v_verdict")).where("said is not null")
    decided = (
        members.join(said, "node").groupBy("component")
        .agg(F.max(F.when(F.col("said") == "allow", 1).otherwise(0)).alias("allow"), F.max(F.when(F.col("said") == "block", 1).otherwise(0)).alias("block"))
        .where("allow = 0 and block = 1").select("component")
    )
    blocked = members.join(decided, "component").select(F.col("node").alias("blocked_node")).distinct()
    df = df.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    df = df.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    # only URLs that no rule decides ask their aliases; the others get keys that are no node, spread over all tasks
    apart = F.concat(F.lit(" "), F.xxhash64("page_id", "url").cast("string"))
    df = df.withColumn("node", F.coalesce(F.when(F.col("fit").isNull(), node_of(F.col("url"))), apart))
    df = df.join(blocked, F.col("node") == F.col("blocked_node"), "left")
    other = F.when(F.col("blocked_node").isNotNull(), "block").otherwise("allow")
    return df.select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), other).alias("verdict"))
