"""Secret scan with multipart credential linking.

Strong patterns are reported as they stand. Weaker parts (identifiers, high-variety tokens,
endpoints) are reported only where the complementary parts occur within a scope of text: an
identifier needs a secret, a token an identifier, an endpoint both; two parts are in scope where the gap
between them is smaller than ``scope`` code points. The linking is an interval join on bins one scope
wide: per (row, bin, role) only the first start and the last stop are joined, which decides every
distance question exactly without forming pairs.

Defined results: a null text is empty; a null id is an id like any other; a row is linked by its id and
text, so repeated rows get equal results; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import skew_join, store

#: Fixed patterns: kind, pattern, least code points (of group 2 for assign), in the order of kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, ACCESS_LEAST = r"AKIA[A-Z0-9]+", 18
HEX, HEX_LEAST = r"[0-9a-f]{16,}", 16
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
#: Weak parts.
WEAK_ID = r"(?<![A-Za-z0-9+/=_-])[A-Z]{2,5}(?=[A-Z]*[0-9])[A-Z0-9]{8,24}(?![A-Za-z0-9+/=_-])"
WEAK_SECRET = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{20,}"
ENDPOINT = r"""https?://[^\s"'<>]+"""
ROLE = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
NEEDS = {"weak_id": ["secret"], "weak_secret": ["id"], "endpoint": ["id", "secret"]}
SCOPE = 200
#: Elements summed by appending to one array.
BLOCK = 256


def prefix_sums(lengths: str) -> str:
    """SQL for the sums of all elements up to each one of array<int> ``lengths``.

    SQL has no running sum of an array, and appending to one copies it. Sums are therefore made within
    blocks of BLOCK elements and offset by the blocks before, so that a text with m matches costs
    m * BLOCK + (m / BLOCK)^2 cheap steps, not m^2.
    """
    grow = lambda xs, start, value: f"aggregate({xs}, named_struct('at', {start}, 's', cast(array() AS array<bigint>)), (a, v) -> named_struct('at', a.at + {value}, 's', concat(a.s, array(a.at + {value}))), a -> a.s)"
    blocks = f"transform(sequence(0, (size({lengths}) - 1) div {BLOCK}), b -> slice({lengths}, int(b * {BLOCK} + 1), {BLOCK}))"
    totals = "transform(bs, x -> aggregate(x, 0L, (a, v) -> a + v))"
    ends = grow(totals, "0L", "v")
    inner = grow("x", "coalesce(get(es, i - 1), 0L)", "v")
    body = f"element_at(transform(array({blocks}), bs -> element_at(transform(array({ends}), es -> flatten(transform(bs, (x, i) -> {inner}))), 1)), 1)"
    return f"(CASE WHEN size({lengths}) = 0 THEN cast(array() AS array<bigint>) ELSE {body} END)"


def spans(text: str, kind: str, pattern: str, least: tuple[int, int] | None = None) -> Column:
    """array<struct<start, ord, kind, stop>> of the leftmost non-overlapping matches in column ``text``;
    code points. ``least`` = (group, n) drops matches whose group has fewer than n."""
    p = sql_string(pattern)
    fits = f"length(regexp_extract(h, {p}, {least[0]})) >= {least[1]}" if least else "true"
    # Gap and hit lengths alternate; the running sum before a hit is its start.
    lengths = f"flatten(zip_with(hs, slice(split({text}, {p}, -1), 1, size(hs)), (h, g) -> array(length(g), length(h))))"
    ends = prefix_sums("ls")
    one = f"named_struct('start', int(es[2 * i]), 'ord', {KINDS.index(kind)}, 'kind', '{kind}', 'stop', int(es[2 * i + 1]), 'fit', {fits})"
    found = f"element_at(transform(array({lengths}), ls -> element_at(transform(array({ends}), es -> transform(hs, (h, i) -> {one})), 1)), 1)"
    bare = "named_struct('start', x.start, 'ord', x.ord, 'kind', x.kind, 'stop', x.stop)"
    kept = f"transform(filter({found}, x -> x.fit), x -> {bare})"
    empty = "cast(array() AS array<struct<start:int,ord:int,kind:string,stop:int>>)"
    return F.expr(f"element_at(transform(array(regexp_extract_all({text}, {p}, 0)), hs -> CASE WHEN size(hs) = 0 THEN {empty} ELSE {kept} END), 1)")


def sql_string(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def joined(array: str) -> Column:
    return F.expr(f"array_join(transform(array_sort({array}), x -> concat(x.kind, ':', x.start, ':', x.stop)), ',')")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, base (array of strong spans), all (base and linked weak spans) of every row."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    rows = rows.select(
        "doc_id", "_t",
        spans("_t", "assign", ASSIGN, (2, ASSIGN_LEAST)).alias("a"),
        spans("_t", "access", ACCESS, (0, ACCESS_LEAST)).alias("k"),
        spans("_t", "hex", HEX).alias("h"),
        spans("_t", "weak_id", WEAK_ID).alias("wi"),
        spans("_t", "weak_secret", WEAK_SECRET).alias("ws"),
        spans("_t", "endpoint", ENDPOINT).alias("we"),
    )
    rows = rows.select("doc_id", "_t", F.concat("a", "k", "h").alias("base"), F.concat("wi", "ws", "we").alias("weak"))
    # Only a row that holds an identifier and a secret, one of them weak, can link anything.
    has = lambda role: F.exists(F.concat("base", "weak"), lambda x: x["kind"].isin([k for k, r in ROLE.items() if r == role]))
    key = F.when((F.size("weak") > 0) & has("id") & has("secret"), F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("_t")).cast("binary")))
    rows = store(rows.select("doc_id", key.alias("key"), "base", "weak"))

    # Repeated rows have one key and equal parts.
    parts = rows.where("key IS NOT NULL").dropDuplicates(["key"]).select("key", F.explode(F.concat("base", "weak")).alias("p")).select("key", "p.*")
    # A weak part that overlaps a strong one is that one. Strong parts that start at or before it reach
    # beyond its start, or the next one starts before its end; windows run within one text.
    strong = ~F.col("kind").isin(list(NEEDS))
    by_start = Window.partitionBy("key").orderBy("start", (~strong).cast("int"))
    reach = F.max(F.when(strong, F.col("stop"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    from_end = Window.partitionBy("key").orderBy(F.desc("start"), strong.cast("int"))
    ahead = F.min(F.when(strong, F.col("start"))).over(from_end.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_reach", reach).withColumn("_ahead", ahead)
    parts = parts.where(strong | ~(F.coalesce(F.col("_reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_ahead") < F.col("stop"), F.lit(False))))
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    parts = store(parts.select("key", "start", "ord", "kind", "stop", F.element_at(role, F.col("kind")).alias("role")))
    # A part is entered in every bin it covers; per (key, bin, role) the first start and the last stop decide.
    covers = "sequence(start div {0}, (stop - 1) div {0})".format(scope)
    ends = parts.select("key", "role", "start", "stop", F.explode(F.expr(covers)).alias("bin")).groupBy("key", "bin", "role").agg(F.min("start").alias("first"), F.max("stop").alias("last"))
    asks = parts.where(F.col("kind").isin(list(NEEDS)))
    asks = asks.select("key", "start", "ord", "kind", "stop", F.explode(F.expr("sequence(start div {0} - 1, (stop - 1) div {0} + 1)".format(scope))).alias("bin"))
    met = skew_join(asks, ends, ["key", "bin"]).where((F.col("last") > F.col("start") - scope) & (F.col("first") < F.col("stop") + scope))
    met = met.groupBy("key", "start", "ord", "kind", "stop").agg(F.collect_set("role").alias("roles"))  # three roles at most
    needs = F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    linked = met.where(F.size(F.array_except(F.element_at(needs, F.col("kind")), F.col("roles"))) == 0)
    linked = linked.groupBy("key").agg(F.collect_list(F.struct("start", "ord", "kind", "stop")).alias("more"))  # bounded by one text
    with_more = skew_join(rows.where("key IS NOT NULL").drop("weak"), linked, ["key"], "left").select("doc_id", "base", F.when(F.col("more").isNotNull(), F.concat("base", "more")).otherwise(F.col("base")).alias("all"))
    return rows.where("key IS NULL").select("doc_id", "base", F.col("base").alias("all")).union(with_more)
