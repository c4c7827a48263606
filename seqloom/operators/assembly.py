"""Read preparation and assembly as relations: pair filter, coverage normalisation, unitigs.

Unitigs are the unbranched paths of the de Bruijn graph of both strands. The graph is two
aggregates; paths are ranked by pointer doubling, so a path of n k-mers takes log2(n) joins, none of
them on a key with more than one row a side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.text import chars, kmers, mean_quality, reverse_complement

from .shuffle import cut, dealt_join


def filter_pairs(reads: DataFrame, min_qual: float, pair: str = "pair_no") -> DataFrame:
    """Pairs in which every mate's mean quality is ``min_qual`` or more; a mate without quality fails."""
    worst = reads.groupBy(pair).agg(F.min(F.coalesce(mean_quality(F.col("qual")), F.lit(-1.0))).alias("_q"))
    return reads.join(worst.where(F.col("_q") >= min_qual).select(pair), pair, "left_semi")


def quality_by_position(reads: DataFrame, shares: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """pos, n, mean and quantiles of the Phred scores at every position of reads(qual), from 1; exact, from counts per score."""
    scores = reads.select(F.posexplode(chars(F.col("qual"))).alias("pos", "c")).groupBy((F.col("pos") + 1).alias("pos"), (F.ascii("c") - 33).alias("q")).agg(F.count(F.lit(1)).alias("k"))
    quantiles = F.percentile("q", [float(s) for s in shares], F.col("k"))
    per = scores.groupBy("pos").agg(F.sum("k").alias("n"), F.round(F.sum(F.col("q") * F.col("k")) / F.sum("k"), 4).alias("mean"), quantiles.alias("_p"))
    return per.select("pos", "n", "mean", *[F.get("_p", F.lit(i)).alias(f"p{round(100 * s)}") for i, s in enumerate(shares)])


def trim_adapters(reads: DataFrame, adapter: str, least: int = 8) -> DataFrame:
    """reads(seq, qual) cut where the adapter begins: at its first whole occurrence, or where the read ends in
    ``least`` or more of its first letters. A read that is all adapter is empty afterwards."""
    whole = F.instr("seq", adapter) - 1
    ends = [F.when(F.endswith("seq", F.lit(adapter[:n])), F.length("seq") - n) for n in range(len(adapter) - 1, least - 1, -1)]
    cut_at = F.when(whole >= 0, whole).otherwise(F.coalesce(*ends, F.length("seq")))
    return reads.withColumn("_at", cut_at).withColumn("seq", F.expr("substring(seq, 1, _at)")).withColumn("qual", F.expr("substring(qual, 1, _at)")).drop("_at")


def normalise_stats(before: DataFrame, after: DataFrame, pair: str = "pair_no") -> DataFrame:
    """pairs_before, pairs_after, discarded, share_kept of a normalisation."""
    n = lambda df, name: df.agg(F.count_distinct(pair).alias(name))
    both = n(before, "pairs_before").join(F.broadcast(n(after, "pairs_after")), F.lit(True))
    return both.withColumn("discarded", F.expr("pairs_before - pairs_after")).withColumn("share_kept", F.expr("round(pairs_after / nullif(pairs_before, 0), 6)"))


def canonical(kmer: Column) -> Column:
    """The lesser of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def pair_coverage(reads: DataFrame, k: int, pair: str = "pair_no") -> DataFrame:
    """(pair, cov): the median count, over all reads, of the k-mers of a pair; none without k-mers."""
    grams = reads.select(pair, F.explode(kmers(F.upper("seq"), k)).alias("g")).select(pair, canonical(F.col("g")).alias("kmer"))
    counts = grams.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))
    return dealt_join(grams, counts, "kmer").groupBy(pair).agg(F.median("n").alias("cov"))


def normalise_pairs(reads: DataFrame, k: int = 25, min_cov: float = 1, max_cov: float = 100, pair: str = "pair_no") -> DataFrame:
    """Pairs of at least ``min_cov``; beyond ``max_cov`` a pair stays with probability max_cov / cov.

    The draw is an md5 of the pair's key: reruns and other partitionings keep the same pairs, and
    mates stay together.
    """
    draw = F.conv(F.substring(F.md5(F.col(pair).cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    kept = pair_coverage(reads, k, pair).where(F.col("cov") >= min_cov).where(draw * F.col("cov") < max_cov)
    return reads.join(kept.select(pair), pair, "left_semi")


def kmer_counts(reads: DataFrame, k: int, min_count: int = 1) -> DataFrame:
    """(kmer, n) of both strands: each strand's k-mer with the count of the two together."""
    grams = reads.select(F.explode(kmers(F.upper("seq"), k)).alias("g")).where(F.col("g").rlike("^[ACGT]+$"))
    counts = grams.groupBy(canonical(F.col("g")).alias("g")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    return counts.select(F.explode(F.array_distinct(F.array(F.col("g"), reverse_complement(F.col("g"))))).alias("kmer"), "n")


def _rank(nodes: DataFrame) -> DataFrame:
    """Pointer doubling over (kmer, up, dist, low, rooted) until every path reaches its head and the
    smallest k-mer of every cycle is known to all its members."""

    def mark(df: DataFrame):
        return df.agg(F.count_if(~F.col("rooted")), F.sum(F.when(~F.col("rooted"), F.xxhash64("low").cast("decimal(38,0)")))).first()

    nodes, seen = cut(nodes), None
    while True:
        now = mark(nodes)
        if now[0] == 0 or now == seen:
            return nodes
        seen = now
        above = nodes.select(F.col("kmer").alias("_k"), F.col("up").alias("_up"), F.col("dist").alias("_d"), F.col("low").alias("_low"), F.col("rooted").alias("_r"))
        open_ = nodes.where("NOT rooted").join(above, F.col("up") == F.col("_k")).select("kmer", F.col("_up").alias("up"), (F.col("dist") + F.col("_d")).alias("dist"), F.least("low", "_low").alias("low"), F.col("_r").alias("rooted"))
        nodes = cut(nodes.where("rooted").unionByName(open_))


def unitigs(reads: DataFrame, k: int, min_count: int = 1, min_len: int = 0) -> DataFrame:
    """id, seq, length, coverage of every unbranched path, one strand of each; ids follow the sequence.

    Reads shorter than k and k-mers with other letters than ACGT add nothing; an empty table gives no
    row. A circular path is opened at its smallest k-mer. One path is one row, so one task joins it.
    """
    grams = cut(kmer_counts(reads, k, min_count))
    none = F.lit(None).cast("string")
    ends = grams.select(F.substring("kmer", 2, k - 1).alias("node"), F.col("kmer").alias("prev"), none.alias("next")).unionAll(grams.select(F.substring("kmer", 1, k - 1), none, "kmer"))
    link = ends.groupBy("node").agg(F.count("prev").alias("i"), F.count("next").alias("o"), F.min("prev").alias("prev"), F.min("next").alias("next"))
    link = link.where("i = 1 AND o = 1 AND prev <> next").select(F.col("next").alias("kmer"), "prev")
    start = grams.join(link, "kmer", "left")
    start = cut(start.select("kmer", "n", F.coalesce("prev", "kmer").alias("up"), F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("dist"), F.coalesce(F.least("prev", "kmer"), "kmer").alias("low"), F.col("prev").isNull().alias("rooted")))
    ranked = _rank(start.drop("n"))
    loops = ranked.where("NOT rooted").select("kmer", F.col("low").alias("head"))
    opened = start.drop("n").join(loops, "kmer")
    top = F.col("kmer") == F.col("head")
    opened = opened.select("kmer", F.when(top, F.col("kmer")).otherwise(F.col("up")).alias("up"), F.when(top, 0).otherwise(F.col("dist")).cast("long").alias("dist"), "low", top.alias("rooted"))
    placed = ranked.where("rooted").withColumn("loop", F.lit(False)).unionByName(_rank(opened).withColumn("loop", F.lit(True)))
    placed = placed.join(start.select("kmer", "n"), "kmer")
    path = placed.groupBy("up").agg(F.sort_array(F.collect_list(F.struct("dist", F.substring("kmer", k, 1).alias("c")))).alias("x"), F.first("loop").alias("loop"), F.round(F.avg("n"), 4).alias("coverage"))
    tail = F.array_join(F.transform(F.slice("x", 2, F.greatest(F.size("x") - 1, F.lit(0))), lambda e: e["c"]), "")
    path = path.select("up", "loop", F.concat("up", tail).alias("seq"), "coverage")
    back = reverse_complement(F.col("seq"))
    # The other strand of a circle is opened elsewhere: the strand with the smaller opening stays.
    one = F.when(F.col("loop"), F.col("up") <= F.array_min(kmers(back, k))).otherwise(F.col("seq") <= back)
    out = path.where(one).where(F.length("seq") >= min_len)
    return out.select(F.concat(F.lit(f"k{k}."), F.substring(F.sha2(F.col("seq").cast("binary"), 256), 1, 24)).alias("id"), "seq", F.length("seq").cast("long").alias("length"), "coverage")
