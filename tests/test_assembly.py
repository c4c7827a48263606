"""Read preparation, unitigs, streaming groups, the report and the run modes."""

import random
from collections import Counter

import pytest

from seqloom.config import EngineConfig
from seqloom.operators import assembly as A
from seqloom.plans import report, runs
from seqloom.streaming import grouping

FLIP = str.maketrans("ACGT", "TGCA")


def back(s):
    return s[::-1].translate(FLIP)


def brute_unitigs(reads, k):
    """Unitigs by walking; circles as the set of their k-mers."""
    grams = {g for r in reads for s in (r, back(r)) for g in (s[i:i + k] for i in range(len(s) - k + 1)) if set(g) <= set("ACGT")}
    after = {g: [g[1:] + c for c in "ACGT" if g[1:] + c in grams] for g in grams}
    before = {g: [c + g[:-1] for c in "ACGT" if c + g[:-1] in grams] for g in grams}
    step = {g: a[0] for g, a in after.items() if len(a) == 1 and len(before[a[0]]) == 1 and a[0] != g}
    heads = grams - set(step.values())
    lines, seen = set(), set()
    for h in heads:
        s, g = h, h
        seen.add(g)
        while g in step:
            g = step[g]
            seen.add(g)
            s += g[-1]
        lines.add(min(s, back(s)))
    circles = set()
    for g in grams - seen:
        ring, x = [g], step[g]
        while x != g:
            ring.append(x)
            x = step[x]
        circles.add(min(frozenset(ring), frozenset(map(back, ring)), key=min))
    return lines, circles


def parts(rows, k):
    return {frozenset(s[i:i + k] for i in range(len(s) - k + 1)) for s in rows}


@pytest.mark.parametrize("k", [5, 9])
def test_unitigs_brute_force(spark, k):
    rng = random.Random(k)
    genome = "".join(rng.choice("ACGT") for _ in range(160))
    ring = "".join(rng.choice("ACGT") for _ in range(24))
    reads = [genome[i:i + 30] for i in range(0, 130, 7)] + [back(genome[40:75]), ring * 2 + ring[:k], "AAAAAAAAAAAA", "ACGTNACGTA", "AC", "", genome[10:40]]
    got = A.unitigs(spark.createDataFrame([(r,) for r in reads] + [(None,)], "seq string"), k).collect()
    lines, circles = brute_unitigs(reads, k)
    seqs = [r.seq for r in got]
    assert len(seqs) == len(set(seqs)) == len(lines) + len(circles)
    assert lines <= set(seqs)
    assert parts(set(seqs) - lines, k) == circles
    assert all(r.length == len(r.seq) for r in got)


def test_unitigs_of_nothing(spark):
    assert A.unitigs(spark.createDataFrame([], "seq string"), 5).count() == 0


def test_filter_pairs_needs_both_mates(spark):
    rows = [(1, 1, "AC", "II"), (1, 2, "AC", "!!"), (2, 1, "AC", "II"), (2, 2, "AC", "II"), (3, 1, "AC", None)]
    got = A.filter_pairs(spark.createDataFrame(rows, "pair_no long, mate int, seq string, qual string"), 20).collect()
    assert sorted((r.pair_no, r.mate) for r in got) == [(2, 1), (2, 2)]


def test_normalise_keeps_mates_together_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, m, "ACGTTGCAAC" * 3) for i in range(400) for m in (1, 2)] + [(1000, 1, "".join(rng.choice("ACGT") for _ in range(40))), (1001, 1, "AC")]
    frame = spark.createDataFrame(rows, "pair_no long, mate int, seq string")
    got = [r.pair_no for r in A.normalise_pairs(frame, 8, 1, 2000).collect()]
    assert Counter(Counter(p for p in got if p < 1000).values()).keys() == {2} and 1000 in got and 1001 not in got
    assert 0 < len(got) < len(rows)
    assert sorted(got) == sorted(r.pair_no for r in A.normalise_pairs(frame.repartition(7), 8, 1, 2000).collect())


def test_stream_groups_leave_when_full(spark, tmp_path):
    for part in range(3):
        spark.createDataFrame([("a" if i % 2 else "b", part * 10 + i) for i in range(7)] + ([("c", 1)] if part == 0 else []), "k string, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = grouping.drain(grouping.group_exact_n_stream(stream, "k", stream["v"], 4), str(tmp_path / "out")).collect()
    assert Counter(r.key for r in out) == {"a": 2, "b": 3} and all(len(r["items"]) == 4 for r in out)
    assert len({(r.key, i) for r in out for i in r["items"]}) == 20


def test_report_escapes_and_refuses_large_frames(spark):
    page = report.render("run <1>", {"a&b": spark.sql("SELECT '<x>' AS v, CAST(NULL AS INT) AS n"), "none": spark.range(0)})
    assert "&lt;x&gt;" in page and "a&amp;b" in page and "no rows" in page and "<x>" not in page
    with pytest.raises(ValueError):
        report.render("t", {"big": spark.range(11)}, max_rows=10)


def test_run_modes(spark):
    rng = random.Random(9)
    genome = "".join(rng.choice("ACGT") for _ in range(300))
    reads = spark.createDataFrame([(i, m, genome[i * 8:i * 8 + 60], "I" * 60) for i in range(30) for m in (1, 2)], "pair_no long, mate int, seq string, qual string")
    out = runs.run(EngineConfig(mode="all", reads="x", k=(15, 21), max_read_len=60), reads=reads)
    assert set(out) == {"quality", "filter_stats", "normalization_stats", "contigs", "counts", "reduced", "reduced_counts", "metrics", "mapping", "orfs", "orf_stats", "annotation"}
    assert {r.tag for r in out["counts"].collect()} == {"k15", "k21"}
    whole = genome[:29 * 8 + 60]
    assert [r.seq for r in out["reduced"].collect()] == [min(whole, back(whole))]
    contigs = spark.createDataFrame([("x", "ATG" + "GCT" * 120 + "TAA"), ("y", "ACGT")], "id string, seq string")
    hits = {"db": spark.createDataFrame([("x", "h2"), ("x", "h1")], "id string, hit string")}
    ann = runs.run(EngineConfig(mode="only_ann"), contigs=contigs, hits=hits)
    assert {r.id: r.db for r in ann["annotation"].collect()} == {"x": "h1`h2", "y": "."}
    assert ann["orf_stats"].first().total >= 1 and "reduced" not in ann
    assert set(runs.run(EngineConfig(mode="only_evi"), contigs=contigs)) == {"reduced", "metrics"}
    with pytest.raises(ValueError):
        runs.run(EngineConfig(mode="only_evi"))
