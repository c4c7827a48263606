"""Suffix-array dedup of exact byte passages, by linear grouping construction.

lyndon_suffix_array() sorts suffixes by their longest Lyndon prefixes: groups of suffixes are
processed in descending order, every member hands its group's prefix to its previous smaller
position, and a second pass emits each group's order from the order of the suffixes that follow the
prefixes; nothing is renamed or recursed, and all sorting is by buckets.

To find every string of ``length`` bytes that starts twice in a corpus, the work is cut into
independent pieces. Each start of such a string belongs to exactly one anchor, the least hash among
the ``k``-grams of the string, so equal strings share an anchor's hash and their offset to it. Equal
stretches of starts collapse to one with a weight. Where stretches of one anchor differ, they are cut
into pieces of PIECE starts that share a core of length - PIECE + 1 bytes (by 128-bit hash). Whatever
the members of a piece share becomes one symbol; a piece that has one variant only is that symbol. A
piece of more than MOST_VARIANTS variants is dealt by the next bytes on either side, which halves its
starts and lengthens its core, until it is small enough: at one start it is a single symbol. The suffix
order of the pieces' symbols alone tells which starts repeat: those whose windows are neighbours in it
and equal, and weigh two or more together.

Defined results: a null text is empty; a null id is an id like any other; a row is identified by its id
and text, and repeated rows are copies of each other; texts shorter than ``length`` lose nothing; an empty
table gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, skew_join, slices, store

#: PIECE is a power of two. SYMBOLS sorted at once fit 16 bits.
K, PIECE, MOST_VARIANTS, SYMBOLS = 64, 16, 64, 4096


def _by_symbol(t: list[int]) -> list[int]:
    """Positions of t in the order of their symbols; numpy sorts 16-bit keys by radix, wider ones in two passes of it."""
    x = np.array(t, np.int64)
    low = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    if len(x) and x.max() > 0xFFFF:
        low = low[np.argsort((x >> 16).astype(np.uint16)[low], kind="stable")]
    return low.tolist()


def lyndon_suffix_array(t: list[int]) -> list[int]:
    """Starts of the suffixes of t (symbols from 0, below 2^32) in ascending order."""
    n = len(t)
    at = _by_symbol(t)  # suffixes by group
    place = [0] * n
    group = [0] * n  # where the suffix's group begins in ``at``
    for r, i in enumerate(at):
        place[i] = r
        group[i] = r if r == 0 or t[at[r - 1]] != t[i] else group[at[r - 1]]
    size: dict[int, int] = defaultdict(int)
    for i in range(n):
        size[group[i]] += 1
    before, after = list(range(-1, n)), list(range(1, n + 2))  # of the positions not processed yet
    follows: list[list[int]] = [[] for _ in range(n + 1)]  # by the next smaller suffix
    end = n
    while end:
        start = group[at[end - 1]]
        members = set(at[start:end])
        handed: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i in members:
            follows[after[i]].append(i)
        for i in members:
            if before[i] in members:
                continue
            j, count, tail = before[i], 1, i  # a run of the group's prefix, handed on at once
            while after[tail] in members:
                tail = after[tail]
                count += 1
            nxt = after[tail]
            before[nxt] = j
            if j >= 0:
                after[j] = nxt
                handed[group[j]].append((count, j))
        for old, moved in handed.items():
            repeats: list[list[int]] = [[] for _ in range(max(moved)[0])]  # no longer than the runs handed on
            for count, j in moved:
                repeats[count - 1].append(j)
            last = old + size[old]
            size[old] -= len(moved)
            for js in reversed(repeats):  # most repeats go furthest back
                if not js:
                    continue
                for j in js:
                    last -= 1
                    r, other = place[j], at[last]
                    at[r], at[last] = other, j
                    place[other], place[j] = r, last
                    group[j] = last
                for j in js:
                    group[j] = last
                size[last] = len(js)
        end = start
    free = {g: g for g in set(group)}
    out = [0] * n
    for r in range(-1, n):
        for i in follows[n if r < 0 else out[r]]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
    return out


#: One variant of a piece: piece's number, bytes left and right of the core, weight, starts of the piece.
Variant = tuple[int, bytes, bytes, int, int]


def repeated_starts(variants: list[Variant]) -> list[tuple[int, int] | None]:
    """Per variant the least and most offset d, left bytes taken, of its windows
    left[-d:] + core + right[:starts - 1 - d] whose total weight in the piece is two or more.

    Any number of whole pieces may be given: their cores differ, so no window of one equals another's.
    """
    text: list[int] = []
    where: list[tuple[int, int] | None] = []
    ends = len(variants)
    for v, (piece, left, right, _, starts) in enumerate(variants):
        least = starts - 1 - len(right)
        for d in range(len(left), 0, -1):
            text.append(left[-d] + ends)
            where.append((v, d) if d >= least else None)
        text += [ends + 256 + piece, *(c + ends for c in right), v]  # v ends the variant: below every byte, and unique
        where += [(v, 0) if least <= 0 else None] + [None] * (len(right) + 1)
    found: list[tuple[int, int] | None] = [None] * len(variants)
    same: list[tuple[int, int]] = []

    def close() -> None:
        if same and sum(variants[v][3] for v, _ in same) >= 2:
            for v, d in same:
                lo, hi = found[v] or (d, d)
                found[v] = (min(lo, d), max(hi, d))

    last = None
    for i in lyndon_suffix_array(text):
        if where[i] is None:
            continue
        now = text[i:i + variants[where[i][0]][4]]
        if now != last:
            close()
            same.clear()
        same.append(where[i])
        last = now
    close()
    return found


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    whole = np.concatenate((x, np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, w)
    ahead = np.minimum.accumulate(whole, axis=1).ravel()
    behind = np.minimum.accumulate(whole[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:len(x) - w + 1], ahead[w - 1:len(x)])


def anchors(b: bytes, length: int, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches [lo, hi] of starts with one anchor each: lo, hi, anchor's position, anchor's hash."""
    h = np.frombuffer(b, np.uint8).astype(np.uint64) + np.uint64(1)
    power, span = 0x9E3779B97F4A7C15, 1
    while span < k:
        h = h[:-span] * np.uint64(power) + h[span:]
        power, span = power * power % 2**64, span * 2
    v = h ^ (h >> np.uint64(31))
    v = v * np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    key = ((v >> np.uint64(32)) << np.uint64(32)) | np.arange(len(v), dtype=np.uint64)
    pos = (_least(key, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.diff(pos)) + 1
    lo = np.concatenate(([0], cut))
    hi = np.concatenate((cut - 1, [len(pos) - 1]))
    return lo, hi, pos[lo], h[pos[lo]].view(np.int64)


def _digest(b: bytes) -> bytes:
    return hashlib.blake2b(b, digest_size=16).digest()


def _anchor_rows(length: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            parts, digests, r1, r2 = [], [], [], []
            ids = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts = b.column(2)
            for i in range(b.num_rows):
                text = texts[i].as_py()
                if len(text) < length:
                    continue
                got = anchors(text, length)
                parts.append(got)
                digests += [_digest(text[lo:hi + length]) for lo, hi in zip(got[0].tolist(), got[1].tolist())]
                r1.append(np.full(len(got[0]), ids[0][i]))
                r2.append(np.full(len(got[0]), ids[1][i]))
            if parts:
                lo, hi, p, h = (np.concatenate(x) for x in zip(*parts))
                c = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                cols = [np.concatenate(r1), np.concatenate(r2), lo, hi, p, h, c[:, 0].copy(), c[:, 1].copy()]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["r1", "r2", "lo", "hi", "p", "h", "c1", "c2"])

    return run


def _pieces(length: int):
    names = ["h", "c1", "c2", "w", "q", "k1", "k2", "left", "right"]
    kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 2 + [pa.binary()] * 2

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in it:
            for text, stretches in zip(b.column(0), b.column(1)):
                text = text.as_py()
                for s in stretches.as_py():
                    p, far, near = s["p"], s["p"] - s["lo"], s["p"] - s["hi"]
                    for q in range(near // PIECE, far // PIECE + 1):
                        d0 = q * PIECE
                        d_max, d_min = min(far, d0 + PIECE - 1), max(near, d0)
                        at, stop = p - d0, p - d0 - PIECE + 1 + length
                        k = np.frombuffer(_digest(text[at:stop]), np.int64)
                        rows.append((s["h"], s["c1"], s["c2"], s["w"], q, int(k[0]), int(k[1]), text[p - d_max:at], text[stop:p - d_min + length]))
                    if len(rows) >= 10_000:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    return run


PIECE_KEY = ["h", "q", "k1", "k2"]
VARIANT = [*PIECE_KEY, "left", "right"]
SOLVED = "h long, q int, k1 long, k2 long, left binary, right binary, least int, most int"


def _solve(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece key, left, right, w, starts) in the order of pieces to the rows that repeat, with their least and
    most offset. Pieces are sorted together up to SYMBOLS symbols; a piece has at most MOST_VARIANTS rows."""
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
    held: list[tuple] = []  # rows of whole pieces and of the last one
    number, symbols, key, begun = -1, 0, None, 0

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        first = rows[0][0]
        got = repeated_starts([(n - first, left, right, w, starts) for n, _, left, right, w, starts in rows])
        out = [(*r[1], r[2], r[3], *f) for r, f in zip(rows, got) if f]
        cols = list(zip(*out)) if out else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [*VARIANT, "least", "most"])

    for b in it:
        for *name, left, right, w, starts in zip(*(c.to_pylist() for c in b.columns)):
            name = tuple(name)
            if name != key:
                if symbols >= SYMBOLS:
                    yield solve(held)
                    held, symbols = [], 0
                key, number = name, number + 1
            held.append((number, name, left, right, w, starts))
            symbols += len(left) + len(right) + 2
    if held:
        yield solve(held)


def _dealt(sub: DataFrame, starts: int) -> DataFrame:
    """Rows (origin, add, piece key, left, right, w) of large pieces of ``starts`` starts in two halves of them: the
    offsets from half on share half of the left bytes with their core, the others half of the right ones."""
    half = starts // 2
    far = sub.where(f"length(left) >= {half}").select("origin", (F.col("add") + half).alias("add"), *PIECE_KEY, F.expr(f"substring(left, -{half}, {half})").alias("more"), F.lit(1).alias("side"),
                                                      F.expr(f"substring(left, 1, length(left) - {half})").alias("left"), F.expr(f"substring(right, 1, {half - 1})").alias("right"), "w")
    near = sub.where(f"length(right) >= {half}").select("origin", "add", *PIECE_KEY, F.expr(f"substring(right, 1, {half})").alias("more"), F.lit(0).alias("side"),
                                                        F.expr(f"substring(left, {1 - half}, {half - 1})").alias("left"), F.expr(f"substring(right, {half + 1}, {half - 1})").alias("right"), "w")
    both = far.union(near)
    return both.select("origin", "add", "h", "q", F.xxhash64("k1", "k2", "side", "more").alias("k1"), F.xxhash64("more", "side", F.lit(7), "k2", "k1").alias("k2"), "left", "right", "w")


def _sort_pieces(variants: DataFrame) -> DataFrame:
    """(piece key, left, right, least, most) of the variants(piece key, left, right, w) that hold a repeated start."""
    tasks = int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    origin = F.struct(*VARIANT, "w").alias("origin")
    sub = variants.select(origin, F.lit(0).alias("add"), *VARIANT, "w")
    starts, out, done = PIECE, [], []
    while True:
        one = sub.groupBy(*VARIANT).agg(F.sum("w").alias("w")) if starts < PIECE else sub.select(*VARIANT, "w")
        sizes = one.groupBy(*PIECE_KEY).agg(F.count(F.lit(1)).alias("_n"), F.sum("w").alias("_t")).where("_t > 1")
        one = store(skew_join(one, sizes, PIECE_KEY))
        done.append(one)
        # What a lone variant's windows share is all of it: one symbol.
        blank = F.lit(b"").cast("binary")
        lone = one.where("_n = 1").select(*PIECE_KEY, blank.alias("left"), blank.alias("right"), "w", F.lit(1).alias("starts"), F.col("left").alias("l"), F.col("right").alias("r"))
        alone = lone.select(*PIECE_KEY, "left", "right", "w", "starts").mapInArrow(_solve, SOLVED).select(*PIECE_KEY)
        alone = skew_join(lone.select(*PIECE_KEY, F.col("l").alias("left"), F.col("r").alias("right")), alone, PIECE_KEY)
        alone = alone.select(*VARIANT, F.expr(f"{starts - 1} - length(right)").alias("least"), F.expr("length(left)").alias("most"))
        few = one.where(f"_n > 1 AND _n <= {MOST_VARIANTS}").select(*VARIANT, "w", F.lit(starts).alias("starts"))
        few = few.repartition(tasks, *PIECE_KEY).sortWithinPartitions(*PIECE_KEY).mapInArrow(_solve, SOLVED)
        solved = store(alone.union(few))
        done.append(solved)
        if starts == PIECE:
            out.append(solved.select(*VARIANT, "least", "most"))
        else:
            hit = skew_join(sub.select("origin", "add", *VARIANT), solved, VARIANT)
            hit = hit.select("origin.*", (F.col("add") + F.col("least")).alias("least"), (F.col("add") + F.col("most")).alias("most"))
            out.append(hit.select(*VARIANT, "least", "most"))
        large = one.where(f"_n > {MOST_VARIANTS}")
        if large.isEmpty():
            break
        sub = store(_dealt(skew_join(sub, large.select(*PIECE_KEY).distinct(), PIECE_KEY), starts))
        done.append(sub)
        starts //= 2
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    if len(out) > 1:
        found = found.groupBy(*VARIANT).agg(F.min("least").alias("least"), F.max("most").alias("most"))
    found = store(found)
    for frame in done:
        discard(frame)
    return found


def _removed(length: int):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "runs"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for b in slices(whole, 1, 1 << 23):
                out = []
                for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    text, runs = text or b"", []
                    for s in sorted((x["a"], x["z"]) for x in spans or []):
                        if runs and s[0] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], s[1])
                        else:
                            runs.append(list(s))
                    parts, at = [], 0
                    for a, z in runs:
                        parts.append(text[at:a])
                        at = z
                    left = b"".join([*parts, text[at:]]) if runs else text
                    out.append((len(text), sum(z - a for a, z in runs), len(runs), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace"), [{"a": a, "z": z} for a, z in runs]))
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]], names)

    return run


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left; a character cut through reads
    as U+FFFD), runs (array of byte ranges a to z) of every row."""
    keyed = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64("text", F.lit(1), "doc_id").alias("r2"))
    found = store(keyed.select("r1", "r2", "text").mapInArrow(_anchor_rows(length), "r1 long, r2 long, lo long, hi long, p long, h long, c1 long, c2 long"))
    ctx = found.groupBy("h", "c1", "c2").agg(F.count(F.lit(1)).alias("w"), F.min(F.struct("r1", "r2", "lo", "hi", "p")).alias("rep"))
    ctx = store(ctx)
    per = ctx.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("t")).where("t > 1")
    per = store(skew_join(ctx, per.select("h", "n"), ["h"]))
    # Where all stretches of an anchor are equal, the stretch is one symbol; it is named by its digest.
    blank = F.lit(b"").cast("binary")
    same = per.where("n = 1").select("h", F.lit(-1).alias("q"), F.col("c1").alias("k1"), F.col("c2").alias("k2"), blank.alias("left"), blank.alias("right"), "w", F.lit(1).alias("starts"))
    same = same.mapInArrow(_solve, SOLVED).select("h", F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    # Otherwise one bearer of each differing stretch is asked for its bytes.
    asked = per.where("n > 1").select("rep.*", "h", "c1", "c2", "w").groupBy("r1", "r2").agg(F.collect_list(F.struct("h", "c1", "c2", "w", "lo", "hi", "p")).alias("s"))
    with_text = skew_join(keyed.select("r1", "r2", "text"), asked, ["r1", "r2"]).select("text", "s")
    # A repeated row bears its stretches repeatedly; they weigh two or more already, so nothing changes.
    pieces = store(with_text.mapInArrow(_pieces(length), "h long, c1 long, c2 long, w long, q int, k1 long, k2 long, left binary, right binary"))
    variants = store(pieces.groupBy(*VARIANT).agg(F.sum("w").alias("w")))
    solved = _sort_pieces(variants)
    part = skew_join(pieces, solved, VARIANT).groupBy("h", "c1", "c2").agg(F.max(F.expr(f"q * {PIECE} + most")).cast("long").alias("far"), F.min(F.expr(f"q * {PIECE} + least")).cast("long").alias("near"))
    # All windows of a stretch hold its anchor, so what they cover is one range.
    equal = skew_join(per.where("n = 1").select("h", "c1", "c2", "rep"), same, ["h", "c1", "c2"]).select("h", "c1", "c2", F.expr("rep.p - rep.lo").cast("long").alias("far"), F.expr("rep.p - rep.hi").cast("long").alias("near"))
    repeated = store(equal.union(part))
    ranges = skew_join(found, repeated, ["h", "c1", "c2"]).select("r1", "r2", F.expr("p - far").alias("a"), F.expr(f"p - near + {length}").alias("z"))
    ranges = store(ranges.groupBy("r1", "r2").agg(F.collect_set(F.struct("a", "z")).alias("spans")))  # bounded by one text
    for frame in (found, ctx, per, pieces, variants, solved, repeated):
        discard(frame)
    out = skew_join(keyed, ranges, ["r1", "r2"], "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, runs array<struct<a: long, z: long>>")
