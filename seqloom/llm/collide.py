"""Embedding near-dedup by collision counting over many one-dimensional projections.

Every vector is projected on ``projections`` random lines, each line is sorted, and around each
vector (the query) a window of the same half-width is laid on it. Pairs that fall into each other's
windows are counted; a pair whose count can still reach ``least`` stays, all others drop out after a
few lines, and what has reached it on the last line is verified by its exact cosine.

Pairs are formed by a sweep over one more sorted line: two vectors meet where they lie within a
wider window of each other there. Two further lines cut each label into cells one such window wide, so
that only neighbouring cells are swept; cells are cut into chunks and swept chunk by chunk, so that no
task holds a hot cell. A task holds candidate pairs as a list, never as a matrix, and returns counts per
vector and spanning links, never pairs. Equal vectors collapse beforehand.

Recall of a pair exactly at the threshold: the lines are independent, so it is
``recall * (1 - miss) ** (cell_lines + 1)``, 0.996 by default, and more for closer pairs.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component, or
whose label is null, links with nothing; a null id links like any other but cannot name a component,
and is kept only where no member has an id; vectors of different lengths are never compared; repeated rows are copies of one another, counted as
links to each other; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, skew_join, store

CHUNK = 1024


def half_width(threshold: float, inside: float) -> float:
    """Half-width of the window that holds a pair at the threshold on one line with probability ``inside``.

    Projections of two unit vectors on a standard normal line differ by N(0, d^2), d their distance.
    """
    lo, hi = 0.0, 10.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if math.erf(mid / math.sqrt(2)) < inside else (lo, mid)
    return hi * math.sqrt(2 - 2 * threshold)


def calibrate(threshold: float, projections: int, per_line: float = 0.975, recall: float = 0.999) -> tuple[float, int]:
    """Half-width of the counted windows and the least number of collisions.

    A pair at the threshold falls into one window with probability ``per_line``, so its count is
    binomial: the count returned is the largest that it reaches with probability ``recall``.
    """
    tail, least = 0.0, projections
    while least >= 0:
        tail += math.comb(projections, least) * per_line**least * (1 - per_line) ** (projections - least)
        if tail >= recall:
            break
        least -= 1
    return half_width(threshold, per_line), max(least, 0)


def lines(dim: int, n: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, n))


def _cells(width: float, dim_cells: int):
    """Rows of (vid, copies, vec, label) become their home cell and, as visitors, the cells behind it."""

    def run(it):
        from itertools import product

        ahead = [o for o in product((-1, 0, 1), repeat=dim_cells) if o > (0,) * dim_cells]
        for pdf in it:
            if not len(pdf):
                continue
            out = []
            for dim, part in pdf.groupby(pdf.vec.map(len)):
                x = np.array(part.vec.tolist(), float)
                x /= np.linalg.norm(x, axis=1)[:, None]
                cell = np.floor(x @ lines(dim, dim_cells, 99) / width).astype(int)
                for shift in [(0,) * dim_cells, *ahead]:
                    c = cell - np.array(shift)
                    name = [f"{dim}:" + ",".join(map(str, r)) for r in c.tolist()]
                    out.append(pd.DataFrame({"vid": part.vid.values, "copies": part.copies.values, "vec": part.vec.values, "label": part.label.values, "cell": name, "home": shift == (0,) * dim_cells}))
            yield pd.concat(out)

    return run


def collisions(px: np.ndarray, py: np.ndarray, sweep: float, half: float, least: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of px and py, values on lines: within ``sweep`` on line 0 and within ``half``
    on at least ``least`` of the others. With ``same`` the two are one set and i < j."""

    def windows(k: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(py[:, k], kind="stable")
        s = py[order, k]
        return order, np.searchsorted(s, px[:, k] - width, "left"), np.searchsorted(s, px[:, k] + width, "right")

    order, lo, hi = windows(0, sweep)
    size = hi - lo
    i = np.repeat(np.arange(len(px)), size)
    j = order[np.arange(len(i)) + np.repeat(lo - np.cumsum(size) + size, size)]
    if same:
        i, j = i[i < j], j[i < j]
    count = np.zeros(len(i), np.int16)
    last = px.shape[1] - 1
    for k in range(1, last + 1):
        order, lo, hi = windows(k, half)
        rank = np.empty(len(py), np.int64)
        rank[order] = np.arange(len(py))
        at = rank[j]
        count += (at >= lo[i]) & (at < hi[i])
        if k % 3 == 0 or k == last:
            stays = count + (last - k) >= least
            i, j, count = i[stays], j[stays], count[stays]
    return i, j


def _compare(threshold: float, sweep: float, half: float, least: int, projections: int):
    schema_cols = ["vid", "n", "root"]

    def unit(pdf: pd.DataFrame) -> np.ndarray:
        x = np.array(pdf.vec.tolist(), float)
        return x / np.linalg.norm(x, axis=1)[:, None]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf[pdf.side == 0]
        b = pdf[pdf.side == 1]
        same = not len(b)
        if not len(a) or (same and pdf.pair.iloc[0] == 1):
            return pd.DataFrame(columns=schema_cols).astype("int64")
        x = unit(a)
        y = x if same else unit(b)
        line = lines(x.shape[1], projections + 1)
        i, j = collisions(x @ line, y @ line, sweep, half, least, same)
        near = np.zeros(len(i), bool)
        for s in range(0, len(i), 100_000):
            near[s:s + 100_000] = np.einsum("ij,ij->i", x[i[s:s + 100_000]], y[j[s:s + 100_000]]) >= threshold
        i, j = i[near], j[near]
        vid, copies = (a if same else pd.concat([a, b]))[["vid", "copies"]].to_numpy().T
        if not same:
            j = j + len(a)
        n = np.zeros(len(vid), np.int64)
        np.add.at(n, i, copies[j])
        np.add.at(n, j, copies[i])
        root = vid.copy()
        while True:  # smallest id reachable within this pair of chunks
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"vid": vid, "n": n, "root": root})[n > 0]

    return run


def near_duplicates(rows: DataFrame, threshold: float = 0.93, projections: int = 24, cell_lines: int = 2, miss: float = 0.001, id_col: str = "vec_id") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label)."""
    half, least = calibrate(threshold, projections)
    sweep = half_width(threshold, 1 - miss)
    good = "label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)"
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.expr(f"CASE WHEN {good} THEN transform(embedding, x -> cast(x AS double)) END").alias("vec"), F.col("label").cast("string").alias("label"))
    base = base.withColumn("k1", F.xxhash64("label", "vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec", "label"))
    able = base.where("vec IS NOT NULL")
    # Nodes are the distinct vectors, numbered, so that null or shared ids neither lose a link nor make one.
    distinct = able.groupBy("k1", "k2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"), F.first("label").alias("label"))
    distinct = store(distinct.withColumn("vid", F.monotonically_increasing_id()))
    plain = distinct.select("vid", "copies", "vec", "label")
    celled = store(plain.mapInPandas(_cells(sweep, cell_lines), "vid long, copies long, vec array<double>, label string, cell string, home boolean"))
    counts = celled.groupBy("label", "cell").agg(F.count_if("home").alias("_h"), F.count_if(~F.col("home")).alias("_v")).where("_h > 0 AND _h + _v > 1")
    counts = counts.select("label", "cell", F.ceil(F.col("_h") / CHUNK).cast("int").alias("nh"), F.ceil(F.col("_v") / CHUNK).cast("int").alias("nv"))
    dealt = skew_join(celled, counts, ["label", "cell"])
    own = F.pmod(F.xxhash64("vid"), F.when(F.col("home"), F.col("nh")).otherwise(F.col("nv"))).cast("int")
    # Pairs of chunks: (i, j) of home chunks with i <= j, and (i, nh + v) for visitors' chunk v.
    dealt = dealt.withColumn("own", own).withColumn("others", F.expr("CASE WHEN home THEN sequence(0, nh + nv - 1) ELSE sequence(0, nh - 1) END")).withColumn("o", F.explode("others"))
    me = F.when(F.col("home"), F.col("own")).otherwise(F.col("nh") + F.col("own"))
    dealt = dealt.withColumn("me", me).select("label", "cell", F.least("me", "o").alias("i"), F.greatest("me", "o").alias("j"), F.when(F.col("me") <= F.col("o"), 0).otherwise(1).alias("side"), F.when(F.col("me") == F.col("o"), 0).otherwise(1).alias("pair"), "vid", "copies", "vec")
    met = store(dealt.groupBy("label", "cell", "i", "j").applyInPandas(_compare(threshold, sweep, half, least, projections), "vid long, n long, root long"))
    links = met.groupBy("vid").agg(F.sum("n").alias("n"))
    roots = connected_components(met.where("vid <> root").select(F.col("vid").alias("src"), F.col("root").alias("dst")).distinct())
    named = distinct.select("k1", "k2", "vid", "copies", "least").join(links, "vid", "left").join(roots.withColumnRenamed("node", "vid"), "vid", "left")
    named = store(named.select("k1", "k2", "least", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "vid").alias("comp")))
    named = skew_join(named, named.groupBy("comp").agg(F.min("least").alias("component_id")), ["comp"]).select("k1", "k2", "n_links", "component_id")
    linked = skew_join(able.select("vec_id", "k1", "k2"), named, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = base.where("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for frame in (celled, met):
        discard(frame)
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
