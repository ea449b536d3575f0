"""URL filters with redirect equivalence.

A rule blocks or allows a host, its subdomains and the paths below its own; the longest fitting rule judges
an address. Pages that name another address as canonical (``<link rel="canonical">``) or send the reader on
(``<meta http-equiv="refresh">``) are aliases of it. Connected components over these edges, found by a
distributed job, carry decisions to the addresses for which no rule fits: in a component with an
explicitly allowed address they are allowed, else with a blocked one they are blocked, else allowed. An
address with a rule of its own keeps that rule's verdict.

Addresses are one node if they differ only in scheme, its default port, fragment, tracking parameters, a closing
slash, dot segments, or escapes of characters that need none.
Targets that are no pages are nodes too, and rules judge them. Rules are joined by host suffix, so a list
may be long; html is read once and not shuffled.

Defined results: a null address, or one without ``://``, has empty host and path, no rule and no aliases and
is allowed; null or empty html has no links; links in comments do not count; a page may name several targets;
repeated rows get equal results; an empty table gives no rows. Columns other than page_id, url and html are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repotide.llm.common import let, stored, table
from repotide.llm.components import components

#: Action, host, path.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Query parameters that do not change a page.
TRACKING = "(^|&)(utm_[^=&]*|gclid|fbclid|ref)(=[^&]*)?(?=&|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _unescaped(path: Column) -> Column:
    """Escapes of letters, digits and ``-._~`` written out, the others in upper case."""

    def one(part: Column) -> Column:
        code, rest = F.upper(F.substring(part, 1, 2)), F.substring(part, 3, F.length(part))
        byte = F.char(F.conv(code, 16, 10).cast("int"))
        written = F.when(byte.rlike("^[A-Za-z0-9._~-]$"), byte).otherwise(F.concat(F.lit("%"), code))
        return F.when(code.rlike("^[0-9A-F]{2}$"), F.concat(written, rest)).otherwise(F.concat(F.lit("%"), part))

    def joined(parts: Column) -> Column:
        after = F.transform(F.slice(parts, F.lit(2), F.size(parts)), one)
        return F.concat(F.element_at(parts, 1), F.array_join(after, ""))

    return F.when(F.contains(path, F.lit("%")), let(F.split(path, "%"), joined)).otherwise(path)


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` resolved; what would leave the top stays there."""

    def step(kept: Column, part: Column) -> Column:
        shorter = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", shorter).otherwise(F.concat(kept, F.array(part)))

    def resolved(parts: Column) -> Column:
        kept = F.aggregate(parts, F.array().cast("array<string>"), step)
        ends = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
        return F.concat(F.array_join(kept, "/"), ends)

    return F.when(path.rlike("/\\.\\.?(/|$)"), let(F.split(path, "/"), resolved)).otherwise(path)


def normal(url: Column) -> Column:
    """An address with its default port left out and escapes and dot segments of its path resolved."""
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = host_of(url)
    host = F.when(scheme == "http", F.regexp_replace(host, ":(80)?$", "")).when(scheme == "https", F.regexp_replace(host, ":(443)?$", "")).otherwise(host)
    rest = F.regexp_extract(_after_scheme(url), "^[^?#]*(.*)$", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host, _without_dots(_unescaped(path_of(url))), rest))


def node_of(url: Column) -> Column:
    """A normal address without scheme, fragment, tracking parameters and closing slash; null without ``://``."""
    return let(normal(url), _node)


def _node(url: Column) -> Column:
    query = F.regexp_extract(_after_scheme(url), "^[^?#]*\\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&+", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.when(url.isNotNull(), F.concat(host_of(url), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _attribute(tag: Column, name: str) -> Column:
    pattern = f"(?is)\\s{name}\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s>\"']+))"
    return F.trim(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)]))


def _targets(html: Column) -> Column:
    """Addresses in canonical links and refreshes, as written."""
    plain = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    tags = F.regexp_extract_all(plain, F.lit("(?is)<(?:link|meta)\\s[^>]*>"), F.lit(0))
    found = F.transform(
        tags,
        lambda tag: F.when(
            tag.rlike("(?i)^<link") & F.lower(_attribute(tag, "rel")).rlike("(^|\\s)canonical(\\s|$)"), _attribute(tag, "href")
        ).when(
            tag.rlike("(?i)^<meta") & (F.lower(_attribute(tag, "http-equiv")) == "refresh"),
            F.trim(F.regexp_extract(_attribute(tag, "content"), "(?i);\\s*url\\s*=\\s*['\"]?([^'\"]*)", 1)),
        ),
    )
    found = F.filter(found, lambda x: x.isNotNull() & (x != ""))
    return F.when(html.rlike("(?i)canonical|refresh"), F.transform(found, lambda x: F.replace(x, F.lit("&amp;"), F.lit("&"))))


def _absolute(target: Column, url: Column) -> Column:
    scheme = F.regexp_extract(url, "^([^:/?#]+)://", 1)
    folder = F.regexp_extract(path_of(url), "^(.*/)", 1)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(scheme, F.lit("://"), host_of(url), target))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(scheme, F.lit("://"), host_of(url), F.when(folder == "", "/").otherwise(folder), target))
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "action string, rule_host string, rule_path string")


def judged(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``action`` for each distinct host and path that a rule fits."""
    labels = F.split("host", "\\.")
    suffixes = let(labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x)), ".")))
    places = addresses.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    fits = places.join(rules, (F.col("suffix") == F.col("rule_host")) & F.startswith("path", F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    # the longest; of equally long ones an allowing one
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("action") == "allow").alias("allows"), rule.alias("rule"), "action")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.action")


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``alias_of`` is its component or null."""
    url = F.col("url")
    read = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"), _targets(F.col("html")).alias("targets"))
    read = stored(read, "page-links")
    linked = read.where("node is not null and size(targets) > 0").select("node", "url", F.explode("targets").alias("target"))
    linked = linked.select("node", normal(_absolute(F.col("target"), F.col("url"))).alias("target")).where("target is not null")
    linked = linked.select("node", host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"), node_of(F.col("target")).alias("to"))
    linked = stored(linked.distinct(), "alias-edges")
    aliases = components(linked.select("node", "to"))
    addresses = read.select("node", "host", "path").union(linked.select("to", "host", "path")).where("node is not null").distinct()
    decided = stored(judged(addresses, rules), "rule-verdicts")
    # what rules say of the members of each component
    said = addresses.join(decided, ["host", "path"]).join(aliases, "node").groupBy("component").agg(
        F.max(F.col("action") == "allow").alias("allows"), F.max(F.col("action") == "block").alias("blocks")
    )
    carried = aliases.join(said, "component").select("node", "component", (F.col("blocks") & ~F.col("allows")).alias("blocked"))
    own = read.select("page_id", "host", "path", "node").join(decided, ["host", "path"], "left")
    verdict = F.coalesce("action", F.when(F.col("blocked"), "block"), F.lit("allow"))
    return own.join(carried, "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("component").alias("alias_of"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES)).drop("alias_of")
