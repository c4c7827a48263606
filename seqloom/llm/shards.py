"""K-d tree partitioning into shards of near-equal bytes.

Rows become points: the scaled metadata dimensions and a tie-breaking hash. A node that must hold
several leaves is split along its widest dimension at the weighted quantile that gives each side
its share of the bytes. The quantile is found by histogram refinement: byte sums per (node, bin)
are map-side combined, so a hot value or node costs no more than another, and the driver sees only
bins, never rows. A value that holds more than a bin's worth is cut by the hash, so that ties and
hot sources cannot unbalance the leaves.

A text dimension enters by the rank of its whole value. Leaves follow bytes alone: equal texts may lie
in several leaves, as a group of copies can hold more than a leaf's bytes.

Defined results: null metadata sorts before all values; a null id sorts first and is numbered like any
other; a null text weighs nothing but the constant; repeated rows are cut by their columns' hash and so
share a leaf; an empty table gives no shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, inline, skew_join, store

#: Bins per node and pass, and the most (node, bin) sums that one pass may bring to the driver.
BINS, MOST_SUMS = 1024, 1 << 18
#: Slots are numbered within pieces of about this many rows, then offset.
SLOT_ROWS = 20_000
BROADCAST_ROWS = 100_000


def ranks(values: DataFrame) -> DataFrame:
    """(v, rank double) of the distinct non-null values of one column ``v``, in their order from 0.

    Ranges are numbered apart and offset by the counts of the ranges before them, so that a dimension of
    many values is sorted by many tasks.
    """
    dealt = store(values.where("v IS NOT NULL").distinct().repartitionByRange("v").withColumn("_p", F.spark_partition_id()))
    counts = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    numbered = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("v")) - 1)
    return numbered.join(F.broadcast(offsets), "_p").select("v", (F.col("_r") + F.col("_off")).cast("double").alias("rank"))


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """Column ``name`` replaced by its value's rank; -1 where it is null."""
    order = store(ranks(rows.select(F.col(name).alias("v"))))
    order = order.select(F.col("v").alias(name), F.col("rank").alias("_rank"))
    out = rows.join(F.broadcast(order), name, "left") if order.count() <= BROADCAST_ROWS else skew_join(rows, order, [name], "left")
    return out.withColumn(name, F.coalesce("_rank", F.lit(-1.0))).drop("_rank")


def _cut(frame: DataFrame, value: Column, nodes: dict[int, tuple]) -> dict[int, tuple[int, float]]:
    """Per node, the bin in which the bytes left of the cut reach their quota, and the bytes before that bin."""
    sums: dict[int, list] = {}
    for node, b, w in frame.groupBy("node", value.alias("b")).agg(F.sum("size")).collect():
        sums.setdefault(node, []).append((b, w))
    out = {}
    for node, got in sums.items():
        got.sort()
        quota, before = nodes[node], 0
        for b, w in got:
            out[node] = (b, before)
            if before + w >= quota:
                break
            before += w
    return out


def kd_leaves(rows: DataFrame, dims: list[str], target_bytes: float | None = None, n_leaves: int | None = None) -> DataFrame:
    """Add ``shard`` to ``rows(size, *dims double)``: leaves of a k-d tree of about target_bytes each.

    ``rows`` should be a stored, narrow table: every level reads it a few times. The tree has
    ceil(total / target_bytes) leaves; the sums brought to the driver are bounded by MOST_SUMS.
    """
    spark = rows.sparkSession
    first = rows.agg(F.sum("size"), *[f(d) for d in dims for f in (F.min, F.max)]).first()
    total = first[0]
    if total is None:
        return rows.withColumn("shard", F.lit(0))
    leaves = n_leaves or max(1, math.ceil(total / target_bytes))
    scale = {d: (first[1 + 2 * i], max(first[2 + 2 * i] - first[1 + 2 * i], 1e-300)) for i, d in enumerate(dims)}
    tie = F.pmod(F.xxhash64(F.lit("tie"), *rows.columns), F.lit(1 << 40)) / float(1 << 40)
    scaled = [((F.col(d) - lo) / span).alias(f"_{d}") for d, (lo, span) in scale.items()]
    frame = rows.select("*", *scaled, tie.alias("_tie"), F.lit(0).alias("node"))
    axes = [f"_{d}" for d in dims]
    plain = rows.columns
    todo, start, count = {0: leaves}, {0: 0}, 1  # node: leaves below it, its first leaf
    level = 0
    final: dict[int, int] = {} if leaves > 1 else {0: 0}
    while any(n > 1 for n in todo.values()):
        open_nodes = [k for k, n in todo.items() if n > 1]
        bins = max(8, min(BINS, MOST_SUMS // len(open_nodes)))
        live = frame.where(F.col("node").isin(open_nodes)) if len(open_nodes) <= 64 else frame.where(F.col("node") >= min(open_nodes))
        boxes = {r["node"]: r for r in live.groupBy("node").agg(F.sum("size").alias("w"), *[f(a).alias(f"{n}{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        plan, quota = [], {}
        for node in open_nodes:
            r = boxes.get(node)
            if r is None:
                continue
            axis = max(range(len(axes)), key=lambda i: (r[f"hi{axes[i]}"] - r[f"lo{axes[i]}"], -i))
            quota[node] = r["w"] * (todo[node] // 2) / todo[node]
            plan.append((node, axis, float(r[f"lo{axes[axis]}"]), max(float(r[f"hi{axes[axis]}"] - r[f"lo{axes[axis]}"]), 1e-300)))
        if not plan:
            break
        cuts = inline(spark, plan, "node int, _axis int, _lo double, _span double")
        # one row per open node: bounded by the leaves, themselves bounded by total / target
        at = live.join(F.broadcast(cuts), "node").withColumn("_x", (F.element_at(F.array(*axes), F.col("_axis") + 1) - F.col("_lo")) / F.col("_span"))
        place, rest = F.col("_x") * bins, dict(quota)
        keys: list[tuple[Column, dict]] = []
        for part in ("_x", "_x2", "_tie"):
            b = F.least(F.floor({"_x": place, "_x2": (place - F.floor(place)) * bins, "_tie": F.col("_tie") * bins}[part]), F.lit(bins - 1)).cast("int")
            here = at
            for k, (key, found) in enumerate(keys):
                chosen = inline(spark, [(n, v[0]) for n, v in found.items()], f"node int, _b{k} int")
                here = here.join(F.broadcast(chosen), "node").where(key == F.col(f"_b{k}"))
            found = _cut(here, b, rest)
            rest = {n: rest[n] - v[1] for n, v in found.items()}
            keys.append((b, found))
        rows_cut = []
        for node, axis, lo, span in plan:
            left = todo[node] // 2
            rows_cut.append((node, axis, lo, span, *[found[node][0] for _, found in keys], count, count + 1))
            todo[count], start[count] = left, start[node]
            todo[count + 1], start[count + 1] = todo[node] - left, start[node] + left
            count += 2
        for node in open_nodes:
            todo.pop(node)
        for k in [k for k, n in todo.items() if n == 1]:
            final[k] = start[k]
        cuts = inline(spark, rows_cut, "node int, _axis int, _lo double, _span double, _c0 int, _c1 int, _c2 int, _left int, _right int")
        at = frame.join(F.broadcast(cuts), "node", "left").withColumn("_x", (F.element_at(F.array(*axes), F.col("_axis") + 1) - F.col("_lo")) / F.col("_span"))
        b0, b1, b2 = (key for key, _ in keys)
        goes_left = (b0 < F.col("_c0")) | ((b0 == F.col("_c0")) & ((b1 < F.col("_c1")) | ((b1 == F.col("_c1")) & (b2 < F.col("_c2")))))
        frame = at.withColumn("node", F.when(F.col("_axis").isNull(), F.col("node")).when(goes_left, F.col("_left")).otherwise(F.col("_right"))).select(*frame.columns)
        level += 1
        frame = store(frame)
        if level > 1:
            discard(kept)
        kept = frame
    names = inline(spark, list(final.items()), "node int, shard int")
    return frame.join(F.broadcast(names), "node").select(*plain, "shard")


def slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """Number the rows of each ``shard`` without gaps from 0, in pieces that no hot shard overfills."""
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    pieces = max(1, math.ceil((sizes.agg(F.max("_n")).first()[0] or 0) / SLOT_ROWS))
    rows = rows.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(pieces)).cast("int"))
    counts = rows.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    at = Window.partitionBy("shard", "_piece").orderBy(*order)
    numbered = rows.withColumn("_rank", F.row_number().over(at) - 1)
    # offsets: shards x pieces rows, one per 20,000 documents or more
    if counts.count() <= BROADCAST_ROWS:
        out = numbered.join(F.broadcast(offsets), ["shard", "_piece"])
    else:
        out = skew_join(numbered, offsets, ["shard", "_piece"])
    return out.withColumn("slot", (F.col("_rank") + F.col("_off")).cast("long")).drop("_piece", "_rank", "_off")


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: float | None = None) -> DataFrame:
    """Shard documents by lang, source, size and id: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("lang").alias("d_lang"), F.col("source").alias("d_source"),
        F.log2(F.octet_length(text) + 1.0).alias("d_size"), F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)).alias("d_id"),
    ))
    dims = ["d_lang", "d_source", "d_size", "d_id"]
    placed = store(_ranked(_ranked(rows, "d_lang"), "d_source").select(*rows.columns))
    leaves = store(kd_leaves(placed, dims, target_bytes, n_shards))
    return slots(leaves, ["doc_id", "text_crc32", "size", "d_lang", "d_source"]).drop(*dims)
