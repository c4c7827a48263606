"""Line dedup by a log-template tree.

The tree has fixed depth: a line's leaf is its token count and its leading tokens, with tokens that
hold a digit masked. Lines of a leaf with the same masked form share a template outright. Forms
that differ are generalised: a token that fewer than FIELD_DOCS documents have at its place is a
variable field, and forms that agree on everything else share a template, if enough of it is
constant. Long forms that find no partner so are tried again with tokens of two documents as
constants. Rare forms that find none on their own path follow the wildcard children: one of the
leading tokens, one that too few documents have there to be a constant, is passed over as a field, one
token more names the leaf, and WILD_DOCS documents are needed. All of it is counted
with map-side aggregates by (leaf, place, token), so a hot leaf costs no task more than another and
the result depends on no order.

A template of LONG_TOKENS words or more recurs when ``min_docs`` documents have it, a shorter one
when ``short_docs`` have it (a document counts once for each form it has); its lines are dropped from
all documents but the first (the smallest id), which keeps the passage once in the corpus.

Defined results: a null text has no lines and stays null; rows of one id are one document, all of which
keep what it is the first to have, repeated rows included; a row without an id is a document named by its
text, after all others; lines with fewer than ``min_tokens`` words are never dropped; a document may end up
empty, and stays as a row; ids are integers below 2^62; an empty table gives no row; input columns named
n_lines or n_dropped are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, skew_join, store

#: Leading tokens that name a leaf beside the token count.
DEPTH = 3
#: Documents that make a token a constant, and the share of a template that must be constant.
FIELD_DOCS, CONSTANT = 3, 0.75
#: A token with a digit, from its first character on.
NUMBER = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
#: Documents that a template needs on a wildcard path, whatever its length.
WILD_DOCS = 3
#: Tokens from which a line is long.
LONG_TOKENS = 8
#: (leaf) rows that may be broadcast: 8 bytes each, some 60 MB as hashed.
BROADCAST_LEAVES = 1_000_000
#: Columns of a line's leaves: its own path, and those with a wildcard child at one of the leading places.
OWN, WILD = "p0", [f"p{i + 1}" for i in range(DEPTH)]


def row_key() -> list[Column]:
    """Identity of a row: its document, named by the id or after all ids by the text, and a hash of id and text."""
    unnamed = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    return [F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("r1"), F.xxhash64("doc_id", "text").alias("r2")]


def _lines(docs: DataFrame, min_tokens: int) -> DataFrame:
    """r1, r2, line_no, line (its form: tokens with single blanks, masked), n and the leaves of every line with enough words."""
    rows = docs.select("text", *row_key()).where("text IS NOT NULL")
    # Blanks for all white space inside lines; most lines then are their own form, without a token being cut.
    other = reduce(lambda a, b: a | b, [F.col("text").contains(c) for c in "\t\v\f\r"])
    plain = F.when(other, F.translate("text", "\t\v\f\r", "    ")).otherwise(F.col("text"))
    lines = rows.select("r1", "r2", F.posexplode(F.split(plain, "\n")).alias("line_no", "raw"))
    raw = F.col("raw")
    lines = lines.select("r1", "r2", "line_no", F.when(raw.contains("  ") | raw.startswith(" ") | raw.endswith(" "), F.trim(F.regexp_replace("raw", " +", " "))).otherwise(raw).alias("raw"))
    blanks = F.octet_length("raw") - F.octet_length(F.replace("raw", F.lit(" "), F.lit("")))
    # A line of mostly masked tokens (a row of numbers) has no template; it matches itself only.
    masked = F.when(2 * F.regexp_count("raw", F.lit(NUMBER)) <= blanks + 1, F.regexp_replace("raw", NUMBER, "<*>"))
    form = F.when(F.col("raw").rlike("[0-9]"), F.coalesce(masked, "raw")).otherwise(F.col("raw"))
    size = F.when(F.col("raw") == "", 0).otherwise(blanks + 1)
    # As a generator's output these are made once: filters on them stay above it.
    lines = lines.select("r1", "r2", "line_no", F.inline(F.array(F.struct(form.alias("line"), size.cast("int").alias("n"))))).where(F.col("n") >= min_tokens)
    lines = lines.withColumn("_head", F.split("line", " ", DEPTH + 2))
    at = lambda *places: [F.get("_head", F.lit(i)) for i in places]
    wild = [F.xxhash64(F.lit(i), "n", *at(*[j for j in range(DEPTH + 1) if j != i])).alias(WILD[i]) for i in range(DEPTH)]
    return lines.select("r1", "r2", "line_no", "line", "n", F.xxhash64("n", *at(*range(DEPTH))).alias(OWN), *wild)


def _names() -> list[Column]:
    """The name of a form: two hashes of it make 128 bits."""
    return [F.xxhash64("line").alias("t1"), F.xxhash64(F.lit(1), "line").alias("t2")]


def _wild_paths(rare: DataFrame) -> DataFrame:
    """(leaf, own) of the wildcard children worth a look, for rare forms: several tokens stand at the wildcard's
    place, each in fewer than FIELD_DOCS documents, in WILD_DOCS documents together."""
    per = rare.select("docs", F.col(OWN).alias("own"), F.explode(F.array(*WILD)).alias("leaf")).groupBy("leaf", "own").agg(F.sum("docs").alias("d")).where(f"d < {FIELD_DOCS}")
    leaves = per.groupBy("leaf").agg(F.sum("d").alias("d"), F.count(F.lit(1)).alias("f")).where(f"d >= {WILD_DOCS} AND f > 1").select("leaf")
    return skew_join(per.drop("d"), leaves, ["leaf"])


def _with_lines(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """(t1, t2, line, own, paths) of the forms with a leaf among ``leaves``; the leaves of other paths are null."""
    wide = lines.where(f"n > {DEPTH}").select("line", F.col(OWN).alias("own"), OWN, *WILD)
    if leaves.count() <= BROADCAST_LEAVES:
        for p in (OWN, *WILD):
            wide = wide.join(F.broadcast(leaves.select(F.col("leaf").alias("_l"))), F.col(p) == F.col("_l"), "left").withColumn(p, F.col("_l")).drop("_l")
        wide = wide.where(F.coalesce(OWN, *WILD).isNotNull()).select("line", "own", F.array(OWN, *WILD).alias("paths"), *_names())
        return wide.groupBy("t1", "t2").agg(F.first("line").alias("line"), F.first("own").alias("own"), F.first("paths").alias("paths"))
    wide = skew_join(wide.select("line", "own", F.posexplode(F.array(OWN, *WILD)).alias("path", "leaf"), *_names()), leaves, ["leaf"])
    wide = wide.groupBy("t1", "t2", "path").agg(F.first("leaf").alias("leaf"), F.first("own").alias("own"), F.first("line").alias("line"))
    have = F.map_from_entries(F.collect_list(F.struct("path", "leaf")))  # four at most
    return wide.groupBy("t1", "t2").agg(F.first("line").alias("line"), F.first("own").alias("own"), have.alias("_m")).select("t1", "t2", "line", "own", F.array(*[F.try_element_at("_m", F.lit(i)) for i in range(len(WILD) + 1)]).alias("paths"))


def _twos(known: DataFrame, pairs: DataFrame, support: str) -> DataFrame:
    """t1, t2, first of the forms that _shapes() and _merged() would generalise in leaves of two forms, compared as they
    stand. Of two forms that differ only equal tokens can be constants of both, so they share a template
    where either alone has too few documents for a constant and both together have enough."""
    rows = skew_join(known.where("paths[0] IS NOT NULL").select("own", F.struct("t1", "t2", "docs", "holder", "line").alias("x")), pairs, ["own"])
    rows = rows.groupBy("own").agg(F.min("x").alias("a"), F.max("x").alias("b"))  # the two
    rows = rows.select("a", "b", F.split("a.line", " ").alias("u"), F.split("b.line", " ").alias("v")).withColumn("n", F.size("u"))
    same = F.size(F.filter(F.zip_with(F.slice("u", DEPTH + 1, F.col("n")), F.slice("v", DEPTH + 1, F.col("n")), lambda x, y: x == y), lambda e: e))
    a, b = F.col("a.docs"), F.col("b.docs")
    enough = ((a < FIELD_DOCS) & (b < FIELD_DOCS) & (a + b >= FIELD_DOCS)) | ((F.col("n") >= LONG_TOKENS) & (a < 2) & (b < 2))
    rows = rows.where(enough & (a + b >= F.expr(support)) & (same + DEPTH >= CONSTANT * F.col("n")))
    first = F.least("a.holder", "b.holder").alias("first")
    return rows.select(F.explode(F.array("a", "b")).alias("x"), first).select("x.t1", "x.t2", "first")


def _shapes(found: DataFrame, forms: DataFrame) -> DataFrame:
    """For found(t1, t2, docs, path, leaf, line): each form's template on each path, by constants of FIELD_DOCS
    documents and of two."""
    places = found.select("t1", "t2", "docs", "path", "leaf", F.posexplode(F.split("line", " ")).alias("place", "token"))
    # The path's own places are constants, the wildcard's is a field. Place 0 stands for the path, so that every form has a row.
    places = store(places.where(f"place = 0 OR place >= IF(path = 0, {DEPTH}, {DEPTH + 1})").withColumn("token", F.when(F.col("place") > 0, F.xxhash64("token")).otherwise(0)))
    common = places.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("s")).where("s >= 2").select("leaf", "place", "token", "s")
    marked = skew_join(places.drop("docs"), common, ["leaf", "place", "token"], "left")
    # The template's name: hashes of its constants, in any order; two of them make 128 bits.
    constant = lambda s: (F.col("place") > 0) & (F.col("s") >= s)
    named = lambda s, *c: F.bit_xor(F.when(constant(s), F.xxhash64(*c)).otherwise(0))
    per = [x for s in (FIELD_DOCS, 2) for x in (F.count_if(constant(s)).alias(f"same{s}"), named(s, "place", "token").alias(f"g{s}"), named(s, "token", F.lit(7), "place").alias(f"h{s}"))]
    shapes = marked.groupBy("t1", "t2", "path").agg(F.first("leaf").alias("leaf"), *per)
    shapes = store(skew_join(shapes, forms.select("t1", "t2", "n", "docs", "holder"), ["t1", "t2"]))
    discard(places)
    return shapes


def _merged(shapes: DataFrame, s: int, support: str) -> DataFrame:
    """t1, t2, first of the forms that share a recurring template, constants being of s documents, with others."""
    rows = shapes.where(f"same{s} + {DEPTH} >= {CONSTANT} * n").select("t1", "t2", "path", "leaf", "n", "docs", "holder", F.col(f"g{s}").alias("g"), F.col(f"h{s}").alias("h"))
    kinds = rows.groupBy("leaf", "g", "h").agg(F.sum("docs").alias("all_docs"), F.min("holder").alias("first"), F.first("n").alias("n"), F.count(F.lit(1)).alias("f"))
    kinds = kinds.where(f"f > 1 AND all_docs >= {support}").drop("n", "all_docs", "f")
    hit = skew_join(rows.drop("n"), kinds, ["leaf", "g", "h"])
    return hit.groupBy("t1", "t2").agg(F.min(F.struct("path", "first")).alias("m")).select("t1", "t2", F.col("m.first").alias("first"))


def dropped_lines(docs: DataFrame, min_docs: int = 2, min_tokens: int = 3, short_docs: int = 3) -> DataFrame:
    """(r1, r2, line_no) of the lines to drop; r1 and r2 identify the row (see row_key)."""
    support = f"CASE WHEN n >= {LONG_TOKENS} THEN {min_docs} ELSE {short_docs} END"
    lines = _lines(docs, min_tokens)
    narrow = store(lines.select("r1", "r2", "line_no", "n", OWN, *WILD, *_names()))
    facts = [F.first(c).alias(c) for c in ("n", OWN, *WILD)]
    once = narrow.groupBy("t1", "t2", "r1").agg(*facts)
    forms = store(once.groupBy("t1", "t2").agg(*facts, F.count(F.lit(1)).alias("docs"), F.min("r1").alias("holder")))
    # On the own path: several forms, one of them rare. Where every form has FIELD_DOCS documents, so has
    # every token at its place, and each form is its own template. On a wildcard path: several rare forms.
    count = [F.first("n").alias("n"), F.sum("docs").alias("d"), F.count(F.lit(1)).alias("f")]
    own = forms.groupBy(F.col(OWN).alias("leaf")).agg(*count, F.min("docs").alias("least"))
    own = store(own.where(f"d >= {support} AND f > 1 AND least < {FIELD_DOCS}").select("leaf", "f"))
    rare = forms.where(f"docs < {FIELD_DOCS} AND n > {DEPTH}")
    wild = store(_wild_paths(rare))
    leaves = store(own.select("leaf").union(wild.select("leaf").distinct()))  # own and wildcard leaves are hashed apart
    known = store(_with_lines(lines, leaves).join(forms.select("t1", "t2", "docs", "holder"), ["t1", "t2"]))  # a row a form on either side
    two = store(_twos(known, own.where("f = 2").select(F.col("leaf").alias("own")), support))
    more = skew_join(known.where("paths[0] IS NOT NULL"), own.where("f > 2").select(F.col("leaf").alias("own")), ["own"])
    shapes = _shapes(more.select("t1", "t2", "docs", F.lit(0).alias("path"), F.col("own").alias("leaf"), "line"), forms)
    wide = store(_merged(shapes, FIELD_DOCS, support))
    # Long forms that this leaves alone are tried with constants of two documents.
    close = store(_merged(shapes.where(f"n >= {LONG_TOKENS}").join(wide.select("t1", "t2"), ["t1", "t2"], "left_anti"), 2, support))
    general = two.union(wide).union(close)
    # Rare forms left alone take the wildcard children.
    open_ = known.where(f"docs < {FIELD_DOCS}").join(general.select("t1", "t2"), ["t1", "t2"], "left_anti").select("t1", "t2", "docs", "own", "line", F.posexplode("paths").alias("path", "leaf")).where("path > 0 AND leaf IS NOT NULL")
    beside = _shapes(skew_join(open_, wild, ["leaf", "own"]), forms)
    tied = store(_merged(beside, FIELD_DOCS, str(WILD_DOCS)))
    general = general.union(tied)
    spent = [narrow, forms, own, wild, leaves, known, two, shapes, wide, close, beside, tied]
    plain = forms.where(f"docs >= {support}").join(general.select("t1", "t2"), ["t1", "t2"], "left_anti").select("t1", "t2", F.col("holder").alias("first"))
    recurring = store(plain.union(general))
    hit = skew_join(narrow.select("r1", "r2", "line_no", "t1", "t2"), recurring, ["t1", "t2"]).where("r1 <> first")
    out = store(hit.select("r1", "r2", "line_no").distinct())
    for frame in (*spent, recurring):
        discard(frame)
    return out


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_tokens: int = 3, short_docs: int = 3) -> DataFrame:
    """``docs`` with the text that is left, and n_lines and n_dropped."""
    gone = dropped_lines(docs.select("doc_id", "text"), min_docs, min_tokens, short_docs).groupBy("r1", "r2").agg(F.collect_list("line_no").alias("_gone"))  # bounded by one text's lines
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The text goes through the exchange once, inside the packed row.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), *row_key())
    both = skew_join(keyed, gone, ["r1", "r2"], "left").withColumn("_lines", F.split("_row.text", "\n"))
    left = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone"), lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(left)
    both = both.select(F.col("_row").withField("text", text).alias("_row"), F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
    return both.select("_row.*", "n_lines", "n_dropped")
