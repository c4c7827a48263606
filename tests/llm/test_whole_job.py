"""Operators do the whole job: cases that earlier versions cut short."""

import random

from seqloom.llm import linededup, neardup


def _planted(rng, bits, distance):
    a = rng.getrandbits(bits)
    b = a
    for place in rng.sample(range(bits), distance):
        b ^= 1 << place
    return a, b


def _signed(x):
    words = [x >> s & 2**64 - 1 for s in (0, 64)]
    return [w - 2**64 if w >> 63 else w for w in words]


def test_wide_radius_finds_the_same_pairs_at_every_size(spark):
    rng = random.Random(11)
    pairs = [x for _ in range(100) for x in _planted(rng, 128, 20)]
    found = []
    for strangers in (0, 6000):
        fps = pairs + [rng.getrandbits(128) for _ in range(strangers)]
        frame = spark.createDataFrame([(i, _signed(f)) for i, f in enumerate(fps)], "doc_id long, fp array<long>")
        got = {r.doc_id: r.component_id for r in neardup.components(frame, 128, 24).collect()}
        found.append({i for i in range(0, 200, 2) if got[i] == got[i + 1]})
    assert found[0] == found[1] and len(found[0]) >= 90


def test_wide_radius_compares_members_of_large_keys(spark):
    rng = random.Random(12)
    centre = rng.getrandbits(128)
    fps = list({centre ^ (1 << rng.randrange(128)) ^ (1 << rng.randrange(128)) for _ in range(60)})
    frame = spark.createDataFrame([(i, _signed(f)) for i, f in enumerate(fps)], "doc_id long, fp array<long>")
    assert {r.component_id for r in neardup.components(frame, 128, 24).collect()} == {0}


def _dropped(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.n_dropped for r in linededup.dedup_lines(frame).collect()}


def test_long_line_of_two_documents_recurs(spark):
    words = " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz")
    assert _dropped(spark, [f"own first\n{words}", f"{words}\nown second", words + " more"]) == {0: 0, 1: 1, 2: 0}
    # Two copies with one word changed share a template as well; a short line needs three documents.
    assert _dropped(spark, [words, words.replace("wordm", "other"), "see you soon then", "see you soon then"]) == {0: 0, 1: 1, 2: 0, 3: 0}


def test_short_template_with_a_field_recurs(spark):
    names = ["anna", "bert", "carl", "dora"]
    assert _dropped(spark, [f"Posted by the user {n} today" for n in names]) == {0: 0, 1: 1, 2: 1, 3: 1}


def test_a_rare_form_changes_nothing_for_the_others(spark):
    texts = [f"Posted by the user {n} today" for n in ("anna", "bert") for _ in range(3)]
    texts = [f"{t}\nnote {k}" for k, t in enumerate(texts)]
    want = {0: 0, 1: 1, 2: 1, 3: 0, 4: 1, 5: 1}
    assert _dropped(spark, texts) == want
    assert _dropped(spark, texts + ["Posted by the user carl today"]) == want | {6: 0}
