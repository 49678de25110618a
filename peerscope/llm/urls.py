"""URL filters with redirect equivalence, in DataFrame operations only.

Rules of host and path block or allow urls. Pages that redirect to one another (meta
refresh) or name a canonical address form connected components; a page without a rule of its
own takes the decision of its aliases, where an explicit allow comes before a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm.components import components
from peerscope.llm.session import materialised

# The registered query's rules, as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
LINK_TAG, META_TAG = r"(?is)<link\b[^<>]*>", r"(?is)<meta\b[^<>]*>"
#: The value of an attribute: in double or single quotes, or bare.
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
CANONICAL = r"(?is)(^|\s)canonical(\s|$)"
REFRESH_URL = r"(?is)^[^;,]*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"'\s]+)"
# References to characters in attribute values; that to & comes last.
ENTITIES = (("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
            ("&#47;", "/"), ("&#x2F;", "/"), ("&#38;", "&"), ("&amp;", "&"))
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, AUTHORITY, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def without_dots(path: Column) -> Column:
    """A path with its segments ``.`` and ``..`` resolved; the empty path is ``/``."""
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    none = F.array().cast("array<string>")
    step = lambda held, part: (
        F.when(part == ".", held)
        .when(part == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
        .otherwise(F.concat(held, F.array(part))))
    folder = F.when(path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(none)
    solved = F.concat(F.lit("/"), F.array_join(F.concat(F.aggregate(parts, none, step), folder), "/"))
    return F.when(path == "", "/").when(F.contains(path, F.lit("/.")), solved).otherwise(path)


def address_of(url: Column) -> Column:
    """What a url names without scheme and fragment, dot segments resolved; null for no url."""
    return F.when(host_of(url) != "", F.concat(host_of(url), without_dots(path_of(url)),
                                               _part(url, 3)))


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, character references resolved; empty without one."""
    pattern = r"(?is)[\s\"']" + name + VALUE
    value = F.concat(*(F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)))
    for entity, char in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return F.trim(value)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict); null if none does."""
    fits = [F.when(((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"),
                            F.lit(v).alias("verdict"))) for v, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b, a_url, b_url) for every canonical link (also where ``rel`` lists more) and every
    refresh of a page: the addresses of the page and of its target, and their urls. Relative
    targets are resolved against the page's url. Expects columns url and html."""
    tags = lambda pattern, kind: F.transform(
        F.regexp_extract_all("html", F.lit(pattern), 0),
        lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("tag")))
    found = pages.filter(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.explode(
        F.concat(tags(LINK_TAG, "link"), tags(META_TAG, "meta"))).alias("x")).select("url", "x.*")
    tag = F.col("tag")
    linked = F.when(attribute(tag, "rel").rlike(CANONICAL), attribute(tag, "href"))
    sent = F.when(F.lower(attribute(tag, "http-equiv")) == "refresh",
                  F.regexp_extract(attribute(tag, "content"), REFRESH_URL, 1))
    t = F.col("t")
    found = found.select("url", F.when(F.col("kind") == "link", linked).otherwise(sent).alias(
        "t")).filter((t != "") & ~F.startswith(t, F.lit("#")))
    path = path_of(F.col("url"))
    folder = F.regexp_replace(path, r"[^/]*$", "")
    here = F.concat(F.lit("http://"), host_of(F.col("url")))
    full = (F.when(t.rlike(ABSOLUTE), t)
            .when(F.startswith(t, F.lit("//")), F.concat(F.lit("http:"), t))
            .when(F.startswith(t, F.lit("/")), F.concat(here, t))
            .when(F.startswith(t, F.lit("?")), F.concat(here, path, t))
            .otherwise(F.concat(here, F.when(folder == "", "/").otherwise(folder), t)))
    found = found.withColumn("target", full)
    return found.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b"),
                        F.col("url").alias("a_url"), F.col("target").alias("b_url"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule, verdict, aliases (the
    component's least address; null without links).

    The verdict is that of the longest fitting rule; without one, that of the aliases (allow
    if any has an allow rule, else block if any has a block rule), else allow. A null url, or
    one without ``://``, has an empty host and path, no rule and no aliases: allow. A null
    html has no links. Repeated rows are judged alike; other columns are ignored; an empty table
    gives an empty result.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         F.col(html_col).alias("html"))
    edges = materialised(link_edges(pages).filter("a IS NOT NULL AND b IS NOT NULL").distinct())
    member = components(edges)
    # decisions of the rules on all linked addresses, pages or mere targets
    ends = edges.select(F.col("a").alias("node"), F.col("a_url").alias("u")).union(
        edges.select("b", "b_url"))
    ruled = ends.withColumn("v", matched_rule(host_of(F.col("u")), path_of(F.col("u")),
                                              rules)["verdict"])
    decided = (ruled.join(member, "node").groupBy("component")
               .agg(F.max(F.col("v") == "allow").alias("allows"),
                    F.max(F.col("v") == "block").alias("blocks")))
    alias = member.join(decided, "component").select(
        "node", "component", F.when(F.col("allows"), "allow").when(F.col("blocks"), "block")
        .otherwise("allow").alias("alias_verdict"))
    own = pages.select("page_id", "url", host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"),
                       address_of(F.col("url")).alias("node"))
    own = own.withColumn("hit", matched_rule(F.col("host"), F.col("path"), rules))
    # pages without url have no aliases and do not meet under a null key
    none = F.lit(None).cast("string")
    met = own.filter("node IS NOT NULL").join(alias, "node", "left").unionByName(
        own.filter("node IS NULL").withColumns({"component": none, "alias_verdict": none}))
    return met.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.col("alias_verdict"), F.lit("allow")).alias("verdict"),
        F.col("component").alias("aliases"))
