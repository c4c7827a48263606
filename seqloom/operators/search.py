"""Similarity searches by shared seeds: homology hits with scores, reads against a database, reads against transcripts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.text import chars, kmers, reverse_complement

from .assembly import canonical
from .shuffle import cut, dealt_join

#: Statistics of ungapped scores (fixed values): one for a match, one off for a mismatch.
MATCH, MISMATCH, LAMBDA, KAPPA = 1.0, -1.0, 1.098612, 0.333


def homology_hits(queries: DataFrame, refs: DataFrame, index: DataFrame, k: int, max_evalue: float = 1e-3, min_seeds: int = 2, both_strands: bool = False) -> DataFrame:
    """Hits of queries(id, seq) on refs(id, seq) in the twelve-column layout, ungapped, one for each pair that passes.

    With ``both_strands`` the reverse complement of a query is searched as well; such a hit shows the query's
    own places on that strand and the reference's from the greater to the smaller.

    ``index(seed, id, pos)`` holds the seeds of refs. Shared seeds are counted by (query, reference,
    diagonal); a pair's best diagonal with ``min_seeds`` seeds is extended over all its seeds' range and
    scored letter by letter. The expectation is K * m * n * exp(-lambda * score) over all references.
    """
    own = queries.select(F.col("id").alias("qid"), F.upper("seq").alias("qseq"), F.lit(1).alias("strand"))
    own = own.unionAll(own.select("qid", reverse_complement(F.col("qseq")), F.lit(-1))) if both_strands else own
    asked = own.select("qid", "strand", F.posexplode(kmers(F.col("qseq"), k)).alias("qpos", "seed"))
    met = dealt_join(index.select("seed", F.col("id").alias("sid"), F.col("pos").alias("spos")), asked, "seed")
    runs = met.groupBy("qid", "sid", "strand", (F.col("spos") - F.col("qpos")).alias("diag")).agg(F.count(F.lit(1)).alias("n"), F.min("qpos").alias("a"), F.max("qpos").alias("z")).where(F.col("n") >= min_seeds)
    best = Window.partitionBy("qid", "sid").orderBy(F.desc("n"), F.desc("strand"), "diag")  # diagonals of one pair
    runs = cut(runs.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r"))
    both = dealt_join(runs, own.withColumnRenamed("strand", "_s"), "qid").where("strand = _s")
    both = dealt_join(both, refs.select(F.col("id").alias("sid"), F.upper("seq").alias("sseq")), "sid")
    length = F.col("z") - F.col("a") + k
    part = lambda c, at: F.substring(c, at + 1, length)
    same = F.size(F.filter(F.zip_with(chars(part("qseq", F.col("a"))), chars(part("sseq", F.col("a") + F.col("diag"))), lambda x, y: x == y), lambda e: e))
    total = refs.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).cast("double").alias("_total"))
    rows = both.select("qid", "sid", "strand", "a", "diag", length.alias("length"), same.alias("same"), F.length("qseq").alias("m")).join(F.broadcast(total))
    rows = rows.withColumn("raw", MATCH * F.col("same") + MISMATCH * (F.col("length") - F.col("same")))
    bits = (LAMBDA * F.col("raw") - math.log(KAPPA)) / math.log(2)
    rows = rows.withColumn("bitscore", bits).withColumn("evalue", F.col("m") * F.col("_total") * F.pow(F.lit(2.0), -F.col("bitscore")))
    first, last = F.col("a") + F.col("diag") + 1, F.col("a") + F.col("diag") + F.col("length")
    ahead = F.col("strand") == 1
    return rows.where(F.col("evalue") <= max_evalue).select(
        F.col("qid").alias("qseqid"), F.col("sid").alias("sseqid"), F.round(100 * F.col("same") / F.col("length"), 3).alias("pident"), "length", (F.col("length") - F.col("same")).alias("mismatch"), F.lit(0).alias("gapopen"),
        (F.col("a") + 1).alias("qstart"), (F.col("a") + F.col("length")).alias("qend"), F.when(ahead, first).otherwise(last).alias("sstart"), F.when(ahead, last).otherwise(first).alias("send"), "evalue", "bitscore")


def top_hits(hits: DataFrame, k: int = 1) -> DataFrame:
    """The k best hits of every query: greatest bit score, then least expectation, then the reference's name."""
    w = Window.partitionBy("qseqid").orderBy(F.desc("bitscore"), "evalue", "sseqid")
    return hits.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def _strand_seeds(df: DataFrame, seq: str, k: int, *keep: str) -> DataFrame:
    """A row per k-mer of ACGT, as the lesser of both strands."""
    return df.select(*keep, F.explode(kmers(F.upper(seq), k)).alias("g")).where(F.col("g").rlike("^[ACGT]+$")).select(*keep, canonical(F.col("g")).alias("g"))


def matched_pairs(reads: DataFrame, database: DataFrame, k: int = 18, min_share: float = 0.5, pair: str = "pair_no") -> DataFrame:
    """Pairs of reads(pair, mate, seq) of which **either** mate has at least ``min_share`` of its k-mers in database(seq)."""
    seeds = _strand_seeds(database, "seq", k).distinct()
    grams = _strand_seeds(reads, "seq", k, pair, "mate")
    hit = dealt_join(grams, seeds.withColumn("hit", F.lit(1)), "g").groupBy(pair, "mate").agg(F.sum("hit").alias("hits"))
    all_ = grams.groupBy(pair, "mate").agg(F.count(F.lit(1)).alias("n"))
    return hit.join(all_, [pair, "mate"]).where(F.col("hits") >= min_share * F.col("n")).select(pair).distinct()


def partition_reads(reads: DataFrame, database: DataFrame, k: int = 18, min_share: float = 0.5, pair: str = "pair_no") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reads of the database's kind, the others, and the counts of both; mates stay together. A null pair number matches nothing."""
    hit = cut(matched_pairs(reads, database, k, min_share, pair))
    of, rest = reads.join(hit, pair, "left_semi"), reads.join(hit, pair, "left_anti")
    n = reads.select(pair).distinct().join(hit.withColumn("hit", F.lit(True)), pair, "left").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("hit").alias("matched"))
    return of, rest, n.withColumn("unmatched", F.col("pairs") - F.col("matched"))


def mapping_rate(reads: DataFrame, transcripts: DataFrame, k: int = 21, min_share: float = 0.5, pair: str = "pair_no") -> DataFrame:
    """matched, total and rate: pairs whose reads share enough k-mers with the transcripts(seq), of either strand."""
    hit = matched_pairs(reads, transcripts, k, min_share, pair).withColumn("hit", F.lit(True))
    n = reads.select(pair).distinct().join(hit, pair, "left").agg(F.count_if("hit").alias("matched"), F.count(F.lit(1)).alias("total"))
    return n.withColumn("rate", F.when(F.col("total") > 0, F.round(F.col("matched") / F.col("total"), 6)))


def overall_rate(lines: DataFrame) -> DataFrame:
    """overall_rate of a mapper's log given as (line): the number of the line that names it, null where none does."""
    found = F.regexp_extract("line", r"([0-9.]+)% overall alignment rate", 1)
    return lines.agg(F.max(F.nullif(found, F.lit("")).cast("double")).alias("overall_rate"))
