"""SimHash near-dedup by pigeonhole blocks.

Texts become fingerprints (Arrow batches); equal fingerprints collapse at once. A distinct
fingerprint is keyed by blocks of its bits, so that close pairs share a key; members of a key are
joined and their Hamming distance is verified. A key with many distinct members is not expanded
into pairs: at radius 2 or less every member is keyed by its one-bit variants, whose groups lie
within distance 2 of each other by construction (linear, exact); at wider radii its members are
compared in square tiles that return spanning links only. Radii too wide for guaranteed blocks use
a fixed plan of many keys, the same at every size. Components are found distributed.

Defined results: a text without words has fingerprint zero and links like any other; a null id
takes part in a component through its fingerprint, links included, but cannot name one (a component
without ids has a null name); repeated rows share a component; ids are integers; an empty table
gives no row.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, skew_join, store

#: Members of a key that are joined pair by pair; beyond it the exact linear or tiled way is used.
PAIRED_MEMBERS = 32
TILE = 512
#: Up to this radius keys are guaranteed blocks; beyond it they would be too narrow.
GUARANTEED_RADIUS = 4
#: Keys at wider radii, fixed: of 128 bits, a pair 20 apart shares one with probability 0.97.
WIDE_KEYS, WIDE_BITS = 320, 24
#: (key, n) rows that may be broadcast: 16 bytes each.
BROADCAST_KEYS = 500_000


def text_fingerprint(text: bytes | None, words: int, seeds: tuple[int, ...]) -> list[int]:
    """SimHash over word shingles: per seed 64 bits, bit set in over half the hashes; signed."""
    import xxhash

    parts = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not parts:
        return [0] * len(seeds)
    buf = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    n = max(1, len(parts) - words + 1)
    begin = np.concatenate(([0], ends[: n - 1])).tolist()
    end = (ends[min(words, len(parts)) - 1:] - 1).tolist()
    out = []
    for seed in seeds:
        counts = np.zeros(64, np.int64)
        for at in range(0, n, 65536):
            h = np.array([xxhash.xxh64_intdigest(buf[a:b], seed) for a, b in zip(begin[at:at + 65536], end[at:at + 65536])], np.uint64)
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = np.packbits(counts * 2 > n, bitorder="little")
        out.append(int(bits.view(np.int64)[0]))
    return out


def fingerprints(docs: DataFrame, words: int = 3, seeds: tuple[int, ...] = (42,), id_col: str = "doc_id", with_text_hash: bool = False) -> DataFrame:
    """(doc_id, fp array<long>) of every row; with_text_hash adds ``t``, the text's own 64-bit hash."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = b.column(0)
            fps = [text_fingerprint(texts[i].as_py(), words, seeds) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps, pa.list_(pa.int64()))], [*b.schema.names[1:], "fp"])

    more = [F.xxhash64("text").alias("t")] if with_text_hash else []
    plain = docs.select(F.col("text").cast("binary").alias("text"), F.col(id_col).cast("long").alias("doc_id"), *more)
    return plain.mapInArrow(batches, "doc_id long, " + "t long, " * with_text_hash + "fp array<long>")


def block_keys(bits: int, radius: int, keys: int | None = None, key_bits: int = 20) -> list[list[int]]:
    """Bit positions of each key.

    Without ``keys``: radius + 2 blocks, each pair-wise complement a key, so that any pair within the
    radius agrees on at least one (pigeonhole with radius + 2 blocks, two of them whole). With
    ``keys``: blocks of key_bits out of fixed permutations, for radii whose guaranteed blocks
    would be too narrow; the chance that a pair shares none is the caller's to state.
    """
    if keys is None:
        n = radius + 2
        blocks = [list(range(bits * i // n, bits * (i + 1) // n)) for i in range(n)]
        return [a + b for a, b in itertools.combinations(blocks, 2)]
    rng, out = random.Random(20240601), []
    while len(out) < keys:
        order = rng.sample(range(bits), bits)
        out += [order[i:i + key_bits] for i in range(0, bits - key_bits + 1, key_bits)]
    return out[:keys]


def wide_plan(bits: int) -> list[list[int]]:
    """Keys for wide radii: the same WIDE_KEYS keys of WIDE_BITS bits at every size of corpus, so that
    whether a pair is found depends on its own two fingerprints only. See the README for the recall."""
    return block_keys(bits, 0, WIDE_KEYS, WIDE_BITS)


def _keyed(distinct: DataFrame, plan: list[list[int]]) -> DataFrame:
    """(k, key, id, fp): a row for each key of each distinct fingerprint."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not len(b):
                continue
            fp = np.array(b.column(1).to_pylist(), np.int64)
            on = np.unpackbits(fp.view(np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")
            for k, places in enumerate(plan):
                packed = np.packbits(on[:, places], axis=1, bitorder="little")
                key = np.zeros((len(fp), 8), np.uint8)
                key[:, :packed.shape[1]] = packed
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(key.view(np.int64)[:, 0]), b.column(0), b.column(1)], ["k", "key", "id", "fp"])

    return distinct.select("id", "fp").mapInArrow(batches, "k int, key long, id long, fp array<long>")


def _tile_links(radius: int):
    import pandas as pd

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.array(pdf.fp.tolist(), np.int64).view(np.uint64)
        ids = pdf.id.to_numpy()
        near = np.zeros((len(ids), len(ids)), np.int32)
        for w in range(fp.shape[1]):
            near += np.bitwise_count(fp[:, w][:, None] ^ fp[:, w][None, :])
        near = near <= radius
        label = ids.copy()
        while True:
            new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
            if (new == label).all():
                break
            label = new
        far = label != ids
        return pd.DataFrame({"src": ids[far], "dst": label[far]})

    return links


def hamming_links(distinct: DataFrame, bits: int, radius: int, plan: list[list[int]]) -> DataFrame:
    """(src, dst) between ids of ``distinct(id, fp)`` whose components are those of all pairs within
    the radius that share a key: every verified pair of small keys, spanning links of large ones."""
    keyed = store(_keyed(distinct, plan))
    sizes = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = store(skew_join(keyed, sizes, ["k", "key"]))
    small, large = shared.where(f"n <= {PAIRED_MEMBERS}"), shared.where(f"n > {PAIRED_MEMBERS}")
    words = bits // 64
    distance = " + ".join(f"bit_count(a.fp[{i}] ^ b.fp[{i}])" for i in range(words))
    pairs = small.alias("a").join(small.alias("b"), F.expr(f"a.k = b.k AND a.key = b.key AND a.id < b.id AND {distance} <= {radius}"))
    links = pairs.select(F.col("a.id").alias("src"), F.col("b.id").alias("dst"))
    if large.isEmpty():
        return links
    if radius <= 2 and words == 1:
        return links.union(_variant_links(large.select("id", F.col("fp")[0].alias("fp")).distinct(), radius))
    return links.union(_large_links(large, radius))


def _large_links(large: DataFrame, radius: int) -> DataFrame:
    """Spanning links within each key of large(k, key, n, id, fp), compared in square tiles."""
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    dealt = large.withColumn("tiles", tiles).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("k", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "fp").distinct()
    return dealt.groupBy("k", "key", "i", "j").applyInPandas(_tile_links(radius), "src long, dst long")


def _numbered(distinct: DataFrame, plan: list[list[int]]) -> DataFrame:
    """(key, id): the keys of each fingerprint as one number, the key's place in the plan above its bits."""
    places, width = np.array(plan), len(plan[0])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not len(b):
                continue
            fp = np.array(b.column(1).to_pylist(), np.int64)
            on = np.unpackbits(fp.view(np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")
            for at in range(0, len(plan), 64):
                part = places[at:at + 64]
                packed = np.packbits(on[:, part], axis=2, bitorder="little")
                key = np.zeros((len(fp), len(part), 8), np.uint8)
                key[:, :, :packed.shape[2]] = packed
                key = key.view(np.int64)[:, :, 0] + (np.arange(at, at + len(part), dtype=np.int64) << width)
                yield pa.RecordBatch.from_arrays([pa.array(key.T.ravel()), pa.array(np.tile(b.column(0).to_numpy(), len(part)))], ["key", "id"])

    return distinct.select("id", "fp").mapInArrow(batches, "key long, id long")


def wide_links(distinct: DataFrame, bits: int, radius: int, plan: list[list[int]]) -> DataFrame:
    """As hamming_links, for plans of hundreds of keys: keys are counted before anything is joined, and no
    group of near copies is expanded into its pairs.

    One exchange of (key, id) gives each shared key's count, least and greatest id. Every member is compared
    with its key's least one; that is linear and ties most groups together. Only members that this leaves in
    different components are compared with each other, so no link between components is lost.
    """
    keyed = _numbered(distinct, plan)
    groups = store(keyed.repartition("key").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).where("n > 1"))
    hot = groups.where("n > 2").select("key", "a")
    few = hot.count() <= BROADCAST_KEYS
    shared = store((keyed.join(F.broadcast(hot), "key") if few else skew_join(keyed, hot, ["key"])).select("key", "a", "id"))
    side = lambda c: distinct.select(F.col("id").alias(c), F.col("fp").alias(f"f{c}"))
    distance = " + ".join(f"bit_count(fa[{i}] ^ fb[{i}])" for i in range(bits // 64))

    def verified(pairs: DataFrame) -> DataFrame:
        both = skew_join(skew_join(pairs.where("a <> b").distinct(), side("a"), ["a"]), side("b"), ["b"])
        return both.where(F.expr(f"{distance} <= {radius}")).select(F.col("a").alias("src"), F.col("b").alias("dst"))

    near = store(verified(groups.where("n = 2").select("a", "b").union(shared.select("a", F.col("id").alias("b")))))
    label = connected_components(near)
    part = store(skew_join(shared.select("key", F.col("id").alias("node")), label, ["node"], "left").select("key", F.col("node").alias("id"), F.coalesce("component", "node").alias("comp")))
    mixed = part.groupBy("key").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count(F.lit(1)).alias("n")).where("_lo < _hi").select("key", "n")
    part = store(skew_join(part, mixed, ["key"]))
    small, large = part.where(f"n <= {PAIRED_MEMBERS}"), part.where(f"n > {PAIRED_MEMBERS}")
    met = small.alias("x").join(small.alias("y"), F.expr("x.key = y.key AND x.id < y.id AND x.comp <> y.comp")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    links = near.union(verified(met))
    if large.isEmpty():
        return links
    return links.union(_large_links(skew_join(large.select("key", "n", "id"), distinct.select("id", "fp"), ["id"]).withColumn("k", F.lit(0)), radius))


def _variant_links(members: DataFrame, radius: int) -> DataFrame:
    """Links among (id, fp long) by shared variants with at most radius // 2 bits turned, or for an
    odd radius 1 the same with the pair verified: linear in the members, exact for components."""
    turned = members.select("id", "fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("z"))
    least = turned.groupBy("z").agg(F.min(F.struct("id", "fp")).alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    got = skew_join(turned, least, ["z"]).where("id <> m.id")
    return got.where(F.expr(f"bit_count(fp ^ m.fp) <= {radius}")).select(F.col("id").alias("src"), F.col("m.id").alias("dst")).distinct()


def _grouped(fps: DataFrame, bits: int, radius: int, plan: list[list[int]] | None, by_id: bool) -> DataFrame:
    """Rows of ``fps`` with ``comp``, one number per component of fingerprints within the radius; ``by_id``
    links the fingerprints of one id as well. Nodes are the distinct fingerprints, numbered, so that null or
    shared ids neither lose a link nor make one."""
    fps = store(fps)
    distinct = store(fps.select("fp").distinct().withColumn("id", F.monotonically_increasing_id()))
    if plan is None and radius > GUARANTEED_RADIUS:
        links = wide_links(distinct, bits, radius, wide_plan(bits))
    else:
        links = hamming_links(distinct, bits, radius, plan or block_keys(bits, radius))
    rows = store(skew_join(fps, distinct, ["fp"]))
    if by_id:
        several = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("id").alias("dst"), F.max("id").alias("_m")).where("dst < _m").select("doc_id", "dst")
        links = links.union(skew_join(rows.select("doc_id", F.col("id").alias("src")), several, ["doc_id"]).select("src", "dst"))
    roots = connected_components(links)
    named = distinct.select("id").join(roots, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("comp"))
    return skew_join(rows, named, ["id"]).drop("id")


def components(fps: DataFrame, bits: int, radius: int, plan: list[list[int]] | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for ``fps(doc_id, fp)``: the smallest id reachable by links within the
    radius. One id on several texts is one document. Null where no id is reachable."""
    rows = store(_grouped(fps, bits, radius, plan, by_id=True))
    least = rows.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return skew_join(rows, least, ["comp"]).select("doc_id", "fp", "component_id")


def simhash_components(docs: DataFrame, words: int = 5, bits: int = 128, radius: int = 24) -> DataFrame:
    """Near-duplicate components of documents.

    The default takes five words and a radius of 24 of 128 bits: shingle multisets of Jaccard
    similarity 0.8 lie at a cosine of 0.89, that is 19.5 bits apart on average. Radii up to
    GUARANTEED_RADIUS miss no pair; see wide_plan() for the others.
    """
    return components(fingerprints(docs, words, tuple(range(42, 42 + bits // 64))), bits, radius)


def keep_first(docs: DataFrame, words: int = 5, bits: int = 128, radius: int = 24) -> DataFrame:
    """One row of each near-duplicate component of texts: the smallest id (null last), then the smallest text hash.

    Rows are told apart by id and text: rows that share an id only are documents of their own, repeated
    rows are one.
    """
    fps = fingerprints(docs, words, tuple(range(42, 42 + bits // 64)), with_text_hash=True)
    rows = _grouped(fps, bits, radius, None, by_id=False)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("first")
    no_id = F.lit(-(1 << 63))  # join and deduplication share one exchange of the texts, on plain equality
    stays = rows.groupBy("comp").agg(first).select(F.coalesce("first.doc_id", no_id).alias("_a"), F.col("first.t").alias("_b"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), no_id).alias("_a"), F.xxhash64("text").alias("_b"))
    kept = packed.join(stays, ["_a", "_b"], "left_semi").dropDuplicates(["_a", "_b"])
    return kept.select("_row.*")
