"""Searches and sequence operators against plain versions."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.functions import text as T
from seqloom.operators import assembly as A
from seqloom.operators import relational as R
from seqloom.operators import search as X
from seqloom.operators import sequence as S
from seqloom.operators.components import components
from seqloom.sources import files

FLIP = str.maketrans("ACGT", "TGCA")


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_homology(spark):
    rng = random.Random(3)
    refs = [dna(rng, 200) for _ in range(8)]
    refs[5] = refs[2][40:180] + dna(rng, 30)
    mutated = list(refs[2][30:150])
    mutated[60] = "A" if mutated[60] != "A" else "C"
    queries = ["".join(mutated), refs[7][100:], dna(rng, 90), "ACG", ""]
    r = spark.createDataFrame([(f"r{i}", s) for i, s in enumerate(refs)], "id string, seq string")
    q = spark.createDataFrame([(f"q{i}", s) for i, s in enumerate(queries)], "id string, seq string")
    hits = X.homology_hits(q, r, files.seeds(r, "id", "seq", 12), 12)
    got = {(h.qseqid, h.sseqid): h for h in hits.collect()}
    assert set(got) == {("q0", "r2"), ("q0", "r5"), ("q1", "r7")}
    h = got["q0", "r2"]
    assert (h.length, h.mismatch, h.qstart, h.qend, h.sstart, h.send) == (120, 1, 1, 120, 31, 150) and h.pident == round(100 * 119 / 120, 3) and h.evalue < 1e-20
    assert {t.qseqid: t.sseqid for t in X.top_hits(hits).collect()} == {"q0": "r2", "q1": "r7"}
    back = spark.createDataFrame([("b", refs[7][20:120][::-1].translate(FLIP)), ("f", refs[1][5:80])], "id string, seq string")
    both = {h.qseqid: (h.sseqid, h.length, h.mismatch, h.qstart, h.qend, h.sstart, h.send) for h in X.homology_hits(back, r, files.seeds(r, "id", "seq", 12), 12, both_strands=True).collect()}
    assert both == {"b": ("r7", 100, 0, 1, 100, 120, 21), "f": ("r1", 75, 0, 1, 75, 6, 80)}


def test_reads_of_a_kind(spark):
    rng = random.Random(5)
    db = [dna(rng, 300) for _ in range(2)]
    rows = [(1, 1, db[0][10:70]), (1, 2, dna(rng, 60)), (2, 1, dna(rng, 60)), (2, 2, dna(rng, 60)), (3, 1, db[1][50:120][::-1].translate(FLIP)), (3, 2, "ACG"), (4, 1, None), (4, 2, "N" * 40)]
    reads = spark.createDataFrame(rows, "pair_no long, mate int, seq string")
    database = spark.createDataFrame([(s,) for s in db], "seq string")
    of, rest, n = X.partition_reads(reads, database)
    assert sorted(r.pair_no for r in of.collect()) == [1, 1, 3, 3] and sorted(r.pair_no for r in rest.collect()) == [2, 2, 4, 4]
    assert tuple(n.first()) == (4, 2, 2)
    assert tuple(X.mapping_rate(reads, database).first()) == (2, 4, 0.5)
    assert X.mapping_rate(reads.limit(0), database).first().rate is None
    log = spark.createDataFrame([("10 reads",), ("96.53% overall alignment rate",)], "line string")
    assert X.overall_rate(log).first()[0] == 96.53 and X.overall_rate(log.limit(1)).first()[0] is None


def plain_orfs(seq, least, code):
    table, out = S.codon_table(code), []
    for strand, s in ((1, seq), (-1, seq[::-1].translate(FLIP))):
        for f in range(3):
            parts = "".join(table.get(s[i:i + 3], "X") for i in range(f, len(s) - 2, 3)).split("*")
            for n, p in enumerate(parts):
                orf = p if n == 0 and p[:1] != "M" else p[p.find("M"):] if "M" in p else ""
                if len(orf) >= least:
                    last = n == len(parts) - 1
                    out.append((strand * (f + 1), {(1, 0): "complete", (1, 1): "3prime_partial", (0, 0): "5prime_partial", (0, 1): "internal"}[int(orf[0] == "M"), int(last)], orf))
    return sorted(out)


@pytest.mark.parametrize("code", ["Universal", "Mitochondrial-Vertebrates", "Ciliate"])
def test_orfs(spark, code):
    rng = random.Random(7)
    seqs = [dna(rng, rng.randrange(0, 400)) for _ in range(60)] + ["", "AC", "ATG" + "GCT" * 30 + "TAA", "ACGN" * 30, "atgaaatag", "ÄCGT" * 9]
    rows = spark.createDataFrame([(str(i), s) for i, s in enumerate(seqs)] + [("null", None)], "id string, seq string")
    got = defaultdict(list)
    for r in S.find_orfs(rows, 5, code).collect():
        got[r.id].append((r.frame, r.orf_type, r.pep))
    for i, s in enumerate(seqs):
        assert sorted(got[str(i)]) == plain_orfs(s.upper(), 5, code), s
    best = {r.id: r.pep for r in S.best_orfs(S.find_orfs(rows, 5, code)).collect()}
    assert {i: len(p) for i, p in best.items()} == {i: max(len(o[2]) for o in g) for i, g in got.items() if g}


def test_codes():
    assert S.translate("ATGTAA") == "M*" and S.translate("TGAAGA", "Mitochondrial-Vertebrates") == "W*" and S.translate("TAA", "Ciliate") == "Q" and S.translate("ANG") == "X"
    with pytest.raises(ValueError, match="unknown genetic code"):
        S.translate("ATG", "none")


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(500, 200 + i) for i in range(100)] + [(300 + i, 301 + i) for i in range(30)] + [(9, 9), (None, 3)]
    label = list(range(600))
    for _ in range(600):
        new = list(label)
        for a, b in edges:
            if a is not None:
                new[a] = new[b] = min(new[a], new[b])
        if new == label:
            break
        label = new
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: c for i, c in enumerate(label) if i != c}


@pytest.mark.parametrize("sizes", [(30, 12), (200, 3)])
def test_near_groups(spark, sizes):
    rng = random.Random(8)
    texts = []
    for copies in sizes:
        base = [f"w{rng.randrange(5000)}" for _ in range(100)]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(3)):
                t[rng.randrange(100)] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(t) + " tail" * rng.randrange(3))
    texts += [" ".join(f"v{rng.randrange(5000)}" for _ in range(40)) for _ in range(20)] + ["two words", "Two  words", "one", "", None, " ", texts[0]]
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else None for t in texts]
    group = list(range(len(texts)))
    links = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in texts:
        new = list(group)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == group:
            break
        group = new
    got = {r.id: r for r in S.near_groups(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()}
    assert [got[i].group_id for i in range(len(texts))] == group
    size = Counter(group)
    for g in size:
        members = [i for i in range(len(texts)) if group[i] == g]
        assert {got[i].n_in_group for i in members} == {len(members)}
        assert [i for i in members if got[i].kept] == [max(members, key=lambda i: (len(texts[i] or ""), -i))]


def test_profile_hits(spark):
    rows = [("d", "P", p, c, w, 2.0, 0.5) for p, c, w in ((1, "A", 3.0), (2, "C", 3.0), (2, "G", 1.0), (3, "T", 4.0))]
    profile = spark.createDataFrame(rows, "domain string, accession string, pos int, letter string, score double, mu double, lambda double")
    seqs = spark.createDataFrame([("x", "GGACTACT"), ("y", "agt"), ("z", "AC"), ("n", None)], "id string, seq string")
    got = {r.query: (r.score, r.ali_from, r.ali_to, round(r.evalue, 6)) for r in S.profile_hits(seqs, profile, max_evalue=10).collect()}
    assert got == {"x": (10.0, 3, 5, 0.072596), "y": (8.0, 1, 3, 0.194272)}
    assert [r.query for r in S.profile_hits(seqs, profile, max_evalue=0.1).collect()] == ["x"]


def test_quality_adapters_and_stats(spark):
    reads = spark.createDataFrame([(1, "ACGTAGATCGGAAG", "I" * 14), (2, "ACAGATCGGA", "5" * 10), (3, "AGATCGGAAGAA", "I" * 12), (4, "ACGT", "!!!!")], "pair_no long, seq string, qual string")
    cut = {r.pair_no: (r.seq, r.qual) for r in A.trim_adapters(reads, "AGATCGGAAG", 8).collect()}
    assert cut == {1: ("ACGT", "IIII"), 2: ("AC", "55"), 3: ("", ""), 4: ("ACGT", "!!!!")}
    per = {r.pos: r for r in A.quality_by_position(reads).collect()}
    assert per[1].n == 4 and per[1].mean == 25.0 and per[1].p50 == 30.0 and per[13].n == 1 and len(per) == 14
    assert tuple(A.normalise_stats(reads, reads.limit(1)).first()) == (4, 1, 3, 0.25)


def test_relational_pieces(spark):
    files_ = spark.createDataFrame([("s", "x.blastx.out"), ("s", "x.pfam.out"), ("t", "y.pfam.out")], "k string, name string")
    assert sorted(r.k for r in R.select_members(files_, "name", r"\.pfam\.", "k").collect()) == ["s", "t"]
    with pytest.raises(Exception, match="several members"):
        R.select_members(files_, "name", "out", "k").collect()
    turned = R.transpose(spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k string, x int, y int"), "k", ["x", "y"], ["a", "b"])
    assert sorted(map(tuple, turned.collect())) == [("x", 1, 3), ("y", 2, 4)]
    rows = spark.createDataFrame([(i, b, s) for i, (b, s) in enumerate([("A", None), ("A", "x"), ("B", "y"), ("B", None), ("A", "z"), ("C", None)])], "pos int, id string, seq string")
    assert [(r.id, r.seq, r.pos) for r in R.islands_first(rows, "id", ["pos"]).orderBy("island").collect()] == [("A", "x", 0), ("B", "y", 2), ("A", "z", 4), ("C", None, 5)]
    row = spark.sql("SELECT 'g1' AS c1, 'H1^a^b' AS c3, '.' AS c7, CAST(NULL AS STRING) AS c8, 'H9' AS c9, 130 AS n")
    got = row.select(*[T.annotation_header(w) for w in (("swissprot", "nucl"), ("swissprot", "prot"), ("uniprot", "nucl"), ("uniprot", "prot"))], T.annotation_header(("swissprot", "nucl"), ("uniprot", "prot")), T.axis_limit(F.col("n"))).first()
    assert tuple(got) == (">g1 SwissProt_Blastx:H1", ">g1 SwissProt_Blastp:noHit", ">g1 UniProt_Blastx:noHit", ">g1 UniProt_Blastp:H9", ">g1 SwissProt_Blastx:H1 UniProt_Blastp:H9", 300)
    with pytest.raises(ValueError, match="no annotation column"):
        T.annotation_header(("pfam", "prot"))
