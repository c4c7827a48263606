"""Relational operators of the assembly and annotation data flow. Every ordering has a total tiebreak."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """The frame itself; raises where it is empty."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def union_tagged(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of all rows, each with the ``tag`` of its frame."""
    tagged = [f.withColumn("tag", F.lit(t)) for t, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def group_exact_n(df: DataFrame, key: str, item: Column, n: int) -> DataFrame:
    """Keys with exactly n items, their items in order. Groups of another size are not emitted."""
    fit = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == n).select(key)  # counted first: a hot key is never gathered
    return df.join(fit, key, "left_semi").groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"))


def channel_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a key that is unique on both sides."""
    return left.join(right, key, "inner")


def top_k(df: DataFrame, name: str, k: int) -> DataFrame:
    """The k most frequent names; ties by name, descending."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc(name)).limit(k)


def best_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in the given total order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def lookup_unique(df: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """Replace a key by its label where the dimension holds the key exactly once."""
    once = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(label).alias("_label")).where("_n = 1").drop("_n")
    return df.join(once, key, "left").withColumn("label", F.coalesce("_label", key)).drop("_label")


def islands_first(df: DataFrame, key: str, order: list[str], within: list[str] | None = None) -> DataFrame:
    """Runs of rows with equal ``key`` collapse to one row: in each column its first value that is not null.

    ``order`` is total. Runs are found within the rows of equal ``within`` columns (one table each), so
    no window spans the input; without it there is one window. ``island`` numbers the runs from 1. A
    column that is null throughout a run stays null.
    """
    within = within or []
    w = Window.partitionBy(*(within or [F.lit(1)])).orderBy(*order)
    new = (~F.col(key).eqNullSafe(F.lag(key).over(w))) | (F.row_number().over(w) == 1)
    runs = df.withColumn("_new", new).withColumn("island", F.sum(F.col("_new").cast("int")).over(w).cast("long"))
    place = F.struct(*order)
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in df.columns if c not in (*within, key)]
    return runs.groupBy(*within, "island", key).agg(*firsts).select(*df.columns, "island")


def status_of(df: DataFrame, keys: list[str], scaffold: DataFrame, partial: Column) -> DataFrame:
    """Completeness per scaffold cell: no hit Missing, more than one Duplicated, a lone partial hit Fragmented."""
    hits = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(partial).alias("p"))
    n = F.coalesce("n", F.lit(0))
    status = F.when(n == 0, "Missing").when(F.col("p") == F.col("n"), "Fragmented").when(n > 1, "Duplicated").otherwise("Complete")
    return scaffold.join(hits, keys, "left").withColumn("status", status).drop("n", "p")


def select_members(df: DataFrame, name: str, pattern: str, key: str) -> DataFrame:
    """The one member of each group whose name matches a regex; a group with several of them raises when it is read."""
    hit = df.where(F.col(name).rlike(pattern))
    many = Window.partitionBy(key)
    one = F.when(F.count(F.lit(1)).over(many) > 1, F.raise_error(F.concat(F.lit("several members match in group "), F.col(key).cast("string"))).cast("boolean")).otherwise(F.lit(True))
    return hit.withColumn("_one", one).where("_one").drop("_one")


def transpose(df: DataFrame, key: str, columns: list[str], keys: list) -> DataFrame:
    """A small table turned: a row per column, a column per key; ``keys`` names and orders them."""
    return df.unpivot(key, columns, "name", "_v").groupBy("name").pivot(key, keys).agg(F.first("_v"))


def records_of(fasta: DataFrame, ids: DataFrame) -> DataFrame:
    """The FASTA records whose id is among ids(id), duplicates kept."""
    return fasta.join(ids.select("id").distinct(), "id", "left_semi")


def status_matrix(cells: DataFrame, key: str, column: str, values: list) -> DataFrame:
    """One row per id, one status column per table."""
    return cells.groupBy(key).pivot(column, values).agg(F.first("status"))


def missing_any(cells: DataFrame, key: str) -> DataFrame:
    return cells.where("status = 'Missing'").select(key).distinct()


def rescue(cells: DataFrame, candidates: DataFrame, key: str, table: str, final, tables: int, min_share: float) -> DataFrame:
    """Ids missing in the final table but Complete in another, with enough support: their best candidate.

    ``candidates(key, table, score, tie)`` come from all tables; those of the final one do not count,
    although the denominator ``tables`` includes it.
    """
    lost = cells.where((F.col(table) == final) & (F.col("status") == "Missing")).select(key)
    found = cells.where(F.col("status") == "Complete").select(key).distinct()
    pool = candidates.where((F.col(table) != final) & F.col("score").isNotNull()).join(lost.join(found, key, "left_semi"), key, "left_semi")
    w = Window.partitionBy(key)
    ranked = pool.withColumn("support", F.size(F.collect_set(table).over(w)).cast("long"))
    ranked = ranked.withColumn("_r", F.row_number().over(w.orderBy(F.desc("score"), table, "tie")))
    return ranked.where((F.col("_r") == 1) & (F.col("support") >= F.lit(tables * min_share))).drop("_r")


def annotation_star(queries: DataFrame, key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Left star: per child the sorted values of the key joined by a backtick, '.' where there is none."""
    out = queries
    for name, (child, value) in children.items():
        cell = child.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), "`").alias(name))
        out = out.join(cell, key, "left").withColumn(name, F.coalesce(name, F.lit(".")))
    return out


def cap_per_key(df: DataFrame, key: str, order: list[str], least: int, most: int) -> DataFrame:
    """Rows of keys with at least ``least`` rows, the first ``most`` of each."""
    w = Window.partitionBy(key)
    return df.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_r", F.row_number().over(w.orderBy(*order))).where(f"_n >= {least} AND _r <= {most}").drop("_n", "_r")


#: Probes that may be broadcast.
MOST_PROBES = 100_000


def contained_in(df: DataFrame, key: str, text: str, probes: DataFrame, probe: str, anchor: int = 6) -> DataFrame:
    """Keys of the rows whose text contains any probe as a substring, each once.

    Where a probe occurs in a text, the words inside it (all but the first and last, which the text may
    extend) are words of the text. So ``anchor`` inner words of a probe are looked up among the text's
    windows by hash, and only the rows found are compared. Probes with fewer inner words have an anchor
    of all of them; those of one or two words have none and are compared with every row, MOST_PROBES
    of them at a time. Null texts and null probes match nothing.
    """
    p = probes.select(F.col(probe).alias("_p")).where("_p IS NOT NULL").distinct()
    p = p.withColumn("_i", F.split("_p", " ", -1)).withColumn("_n", F.least(F.size("_i") - 2, F.lit(anchor)))
    rows = df.select(F.col(key), F.col(text).alias("_t"))
    words = rows.select(key, F.split("_t", " ", -1).alias("_w"))
    inside = F.contains("_t", "_p")
    out = []
    for n in [r[0] for r in p.where("_n > 0").select("_n").distinct().orderBy("_n").collect()]:  # lengths of anchors, at most ``anchor`` of them
        name = lambda c, at, n=n: F.xxhash64(F.lit(n), *[F.get(c, at + j) for j in range(n)])
        anchors = p.where(F.col("_n") == n).select("_p", name("_i", F.lit(1)).alias("_a"))
        windows = words.where(F.size("_w") >= n).select(key, F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("_w") - n), lambda i: name("_w", i)))).alias("_a"))
        # Windows without an anchor go before anything is exchanged, as long as the anchors are few.
        few = anchors.limit(MOST_PROBES + 1).count() <= MOST_PROBES
        found = windows.join(F.broadcast(anchors) if few else anchors, "_a").select(key, "_p")
        out.append(rows.join(found, key).where(inside).select(key))
    short = p.where("_n <= 0").select("_p")
    parts = -(-short.count() // MOST_PROBES)
    for i in range(parts):  # every part is broadcast and tried on every text
        out.append(rows.join(F.broadcast(short.where(F.pmod(F.xxhash64("_p"), F.lit(parts)) == i)), inside, "left_semi").select(key))
    return reduce(DataFrame.unionAll, out).distinct() if out else rows.select(key).limit(0)


def flag_match(df: DataFrame, hit: DataFrame, key: str) -> DataFrame:
    """All rows, with ``matched`` telling whether the key is among ``hit``, whose keys are distinct."""
    return df.join(hit.select(key, F.lit(True).alias("matched")), key, "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def partition_by_match(df: DataFrame, hit: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is among ``hit``, and the others."""
    return df.join(hit, key, "left_semi"), df.join(hit, key, "left_anti")


def n50(lengths: DataFrame, col: str) -> DataFrame:
    """count, total, mean, max and N50 of one column; lengths are counted first, so the window runs over distinct lengths."""
    per = lengths.groupBy(F.col(col).cast("long").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("len")).rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("run", F.sum(F.col("len") * F.col("n")).over(w)).withColumn("all", F.sum(F.col("len") * F.col("n")).over(Window.partitionBy(F.lit(1))))
    return per.agg(F.sum("n").alias("n_seqs"), F.max("all").alias("total"), F.round(F.max("all") / F.sum("n"), 4).alias("mean_len"), F.max("len").alias("max_len"), F.max(F.when(F.col("run") * 2 >= F.col("all"), F.col("len"))).alias("n50"))
