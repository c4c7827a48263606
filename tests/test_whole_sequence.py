"""Sequence operators do the whole job: cases that earlier versions cut short."""

import random

from seqloom.operators import sequence as S
from seqloom.plans import queries as Q


def test_near_groups_have_exact_similarity(spark):
    """Pairs just above and below the similarity: those above share a group, those below do not."""
    rng = random.Random(8)
    texts = []
    for _ in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(104)]
        tail = rng.randrange(8, 18)
        texts += [" ".join(base), " ".join(base[:-tail] + [f"x{rng.randrange(5000)}" for _ in range(tail)])]
    texts += ["two words", "Two  words", "one", "", None]
    group = {r.id: r.group_id for r in S.near_groups(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()}
    got = {(a, b) for a in group for b in group if a < b and group[a] == group[b]}
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").lower().split()
        if w:
            sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    want = {p: s for p, s in want.items() if s >= 0.8}
    assert got == set(want) and (80, 81) in got and 10 < len(got) < 41


def test_species_split_predicts_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = Q.q_species_split(spark, sf).collect()
    labelled = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == docs.count() and all(r.prediction in (0.0, 1.0) for r in got)
    assert {r.doc_id for r in got if r.label is not None} == labelled & {r.doc_id for r in got} and any(r.label is None for r in got)


def test_species_split_is_right_about_rows_it_has_not_seen(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("AACT" if i % 2 else "CGGT") for _ in range(80)), float(i % 2) if i % 3 else None) for i in range(600)]
    got = S.species_split(spark.createDataFrame(rows, "doc_id bigint, text string, label double"))
    assert 50 < got.where("held_out").count() < 120 and got.where("held_out AND label IS NULL").isEmpty()
    assert S.accuracy(got) > 0.95
    host, other = S.partition_species(spark.createDataFrame(rows, "doc_id bigint, text string, label double"), got)
    assert host.count() + other.count() == 600 and abs(host.count() - 300) < 15
