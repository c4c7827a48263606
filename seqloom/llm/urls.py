"""URL filter with redirect equivalence.

Rules decide the urls they fit. Urls that redirect or name a canonical link are aliases: their
edges form components, found distributed, and a block decided for any member blocks every alias
that no rule decides. An explicit allow takes precedence: an allowed url stays allowed, and does
not unblock its aliases.

Two urls are one node where they differ in the case of scheme and host, in the fragment, or in an
empty path against ``/``; nothing else is equal without an edge. Link targets are resolved against the
page's url.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule, has no
alias and is allowed; null html has no links; a null page_id is kept; repeated rows get the same verdict;
an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, skew_join, store

#: (action, host, path prefix). Rule sets up to MOST_LITERAL are tried per row; larger ones are joined by host suffix.
Rule = tuple[str, str, str]
MOST_LITERAL = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Character references decoded in link targets (fixed values); the ampersand last.
REFERENCES = [(r"(?i)&quot;|&#0*34;|&#x0*22;", '"'), (r"(?i)&apos;|&#0*39;|&#x0*27;", "'"), (r"(?i)&lt;|&#0*60;|&#x0*3c;", "<"), (r"(?i)&gt;|&#0*62;|&#x0*3e;", ">"),
              (r"(?i)&sol;|&#0*47;|&#x0*2f;", "/"), (r"(?i)&amp;|&#0*38;|&#x0*26;", "&")]


def rest_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """The url's node: scheme and host in lower case, path (at least ``/``) and query, no fragment."""
    scheme = F.translate(F.regexp_extract(url, r"^(.*?)://", 1), UPPER, LOWER)
    query = F.regexp_extract(rest_of(url), r"^[^?#]*(\?[^#]*)", 1)
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), path, query))


def resolve(target: Column, url: Column) -> Column:
    """A link's target against the url it stands in (RFC 3986, 5.2): scheme, host, path or query may be missing."""
    scheme, host = F.regexp_extract(url, r"^(.*?)://", 1), F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1)
    site = F.concat(scheme, F.lit("://"), host)
    bare = F.regexp_extract(target, r"^([^?#]*)", 1)
    tail = F.regexp_extract(target, r"^[^?#]*(\??[^#]*)", 1)
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    joined = F.when(bare.startswith("/"), bare).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), bare))
    segments = F.split(F.substring(joined, F.lit(2), F.length(joined)), "/", -1)

    def step(acc: Column, x: Column) -> Column:
        return F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))

    clean = F.aggregate(segments, F.array().cast("array<string>"), step)
    last = F.element_at(segments, -1)
    path = F.concat(F.lit("/"), F.array_join(clean, "/"), F.when(last.isin(".", "..") & (F.size(clean) > 0), F.lit("/")).otherwise(F.lit("")))
    own = F.regexp_extract(rest_of(url), r"^[^?#]*(\??[^#]*)", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))  # mailto: and the like lead to no page
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(bare == "", F.concat(site, path_of(url), F.when(tail == "", own).otherwise(tail)))
        .otherwise(F.concat(site, path, tail))
    )


def html_links(html: Column, url: Column) -> Column:
    """Targets of canonical links and refresh redirects, decoded and made absolute."""
    tags = F.filter(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), F.lit(0)),
                    lambda t: t.rlike(r"""(?i)\brel\s*=\s*["']?\s*canonical\b|http-equiv\s*=\s*["']?\s*refresh\b"""))
    found = F.transform(tags, lambda t: F.regexp_extract(t, r"""(?i)(?:\bhref\s*=\s*["']?|\burl\s*=\s*["']?)\s*([^"'\s>]+)""", 1))

    def decoded(x: Column) -> Column:
        for pattern, char in REFERENCES:
            x = F.regexp_replace(x, pattern, char)
        return x

    return F.filter(F.transform(F.filter(found, lambda x: x != ""), lambda x: resolve(decoded(x), url)), lambda x: x.isNotNull())


def _fits(host: Column, path: Column, rule: Column) -> Column:
    return ((host == rule["host"]) | host.endswith(F.concat(F.lit("."), rule["host"]))) & path.startswith(rule["path"])


def apply_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rule`` and ``action`` to rows(id, host, path, ...): the longest rule that fits, else null."""
    if len(rules) <= MOST_LITERAL:
        table = F.array(*[F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules])
        best = F.array_max(F.filter(table, lambda r: _fits(F.col("host"), F.col("path"), r))) if rules else F.lit(None).cast("struct<rule:string,action:string>")
        return rows.withColumn("_best", best).withColumn("rule", F.col("_best.rule")).withColumn("action", F.col("_best.action")).drop("_best")
    spark = rows.sparkSession
    table = spark.createDataFrame(rules, "action string, _host string, _path string")
    # Judged by distinct (host, path), each keyed by its host's suffixes.
    parts = rows.select("host", "path").distinct().withColumn("_labels", F.split("host", r"\."))
    keyed = parts.withColumn("_host", F.explode(F.expr("transform(sequence(1, size(_labels)), i -> array_join(slice(_labels, i, size(_labels)), '.'))")))
    hits = skew_join(keyed, table, ["_host"]).where("startswith(path, _path)")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length(F.concat("_host", "_path")).alias("n"), F.concat("_host", "_path").alias("rule"), "action")).alias("_b"))
    return skew_join(rows, best, ["host", "path"], "left").select(*rows.columns, F.col("_b.rule").alias("rule"), F.col("_b.action").alias("action"))


def judge(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule, action, verdict of every row of pages(page_id, url, html).

    ``edges(src, dst)`` may add redirects known from elsewhere, as urls.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), alias_key(url).alias("node"), html_links(F.col("html"), url).alias("links"))
    rows = store(apply_rules(rows, rules))
    hops = rows.where("size(links) > 0 AND node IS NOT NULL").select("node", F.explode("links").alias("to"))
    if edges is not None:
        hops = hops.union(edges.select(alias_key(F.col("src")), F.col("dst")))
    hops = store(hops.select("node", alias_key(F.col("to")).alias("dst")).where("node IS NOT NULL AND dst IS NOT NULL").distinct())
    roots = connected_components(hops.select(F.col("node").alias("src"), "dst"))
    # Only urls with an edge have aliases. A block of any of them, page or mere target, is the component's.
    nodes = hops.select("node").union(hops.select("dst")).distinct()
    nodes = skew_join(nodes, roots, ["node"], "left").select("node", F.coalesce("component", "node").alias("component"), host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    nodes = store(apply_rules(nodes, rules))
    blocked = nodes.where("action = 'block'").select("component").distinct()
    aliases = skew_join(nodes.select("node", "component"), blocked, ["component"]).select("node", F.lit(True).alias("bad"))
    out = skew_join(rows.drop("links"), aliases, ["node"], "left")
    verdict = F.coalesce("action", F.when(F.col("bad"), F.lit("block")), F.lit("allow"))
    return out.select("page_id", "url", "host", "path", "rule", "action", verdict.alias("verdict"))
