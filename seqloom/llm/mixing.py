"""Mixing sources to target weights: repetition rates and hash-seeded Bernoulli copies.

Token counts are aggregated per source (map-side combined, so a hot source costs no more than
another). Targets come from one pass over the source totals; each document is then emitted
floor(rate) times plus one copy drawn from a hash of its id. The words taken from a source are
therefore its target in expectation, with a standard deviation of sqrt(f (1 - f) * sum of size^2), f
the fraction of its rate; a few long documents make it large, and no draw exceeds the cap.

Defined results: a null text has size 0; a null source is a source of its own, last in order; an
empty table gives an empty mix; rows that repeat an id share its draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, skew_join

#: Rows of (source, numbers) that may be broadcast: some 20 MB at most. Beyond it the rates are joined by shuffle.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(totals: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Targets for ``totals(source, source_size)``: weights in code point order of the source (null
    last), repeating; all sizes are shared out, no target above cap times its source.

    With shares proportional to weight, the sources that stop at the cap are those with the least
    size per weight, so one ordered pass replaces the repeated resharing: in that order a source is
    capped while its cap is at most its share of what the sources before it left. The windows run
    over one row per source, not over documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("weight", w.cast("long"))
    every = Window.partitionBy(F.lit(1))
    least = Window.partitionBy(F.lit(1)).orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = least.rowsBetween(Window.unboundedPreceding, -1)
    t = (
        t.withColumn("total", F.sum("source_size").over(every))
        .withColumn("w_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("s_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.lit(cap) * F.col("s_before")) / F.col("w_left"))
        .withColumn("full", F.lit(cap) * F.col("source_size") <= F.col("level") * F.col("weight"))
    )
    # The first source that is not full has the largest w_left of those; its level holds for all that follow.
    t = t.withColumn("open_level", F.max(F.when(~F.col("full"), F.struct("w_left", "level"))).over(every)["level"])
    target = F.when(F.col("full"), F.lit(cap) * F.col("source_size")).otherwise(F.col("open_level") * F.col("weight"))
    return t.select("source", "source_size", target.cast("double").alias("target"))


def unit_draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def mix(docs: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3), seed: int = 17, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with size, source_size, target, rate and copies."""
    sized = docs.select(*keep, "source", word_count(F.col("text")).alias("size"))
    rates = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cap, weights)
    rates = rates.withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(0.0))
    rates = rates.withColumn("_no", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit(""))).drop("source")
    sized = sized.withColumn("_no", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit("")))
    if docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        out = sized.join(F.broadcast(rates), ["_no", "_source"])
    else:
        out = skew_join(sized, rates, ["_no", "_source"])
    whole = F.floor("rate")
    copies = whole + F.when(unit_draw(F.col("doc_id"), seed) < F.col("rate") - whole, 1).otherwise(0)
    return out.withColumn("copies", copies.cast("long")).drop("_no", "_source")


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: every document as often as it was taken, columns unchanged."""
    packed = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row"))  # names cannot clash
    mixed = mix(packed, keep=("doc_id", "_row"), **options)
    taken = mixed.where("copies > 0").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("_row.*")
