"""Line templates against the plain version, and the cases the tree must generalise."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from seqloom.llm import linededup  # noqa: E402


def left(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, leaf string, r1 int")
    return [r.text for r in sorted(linededup.dedup_lines(frame).collect(), key=lambda r: r.r1)]


@pytest.mark.parametrize("seed", [0, 3])
def test_brute_force(spark, seed):
    rng = random.Random(seed)
    words = ["red", "blue", "tree", "sky", "x1", "y22", "dog"][: 4 + seed]
    kinds = [[rng.choice(words) for _ in range(n)] for n in (3, 4, 5, 8, 9, 12, 13) for _ in range(3)]
    rare = lambda: "w" + "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = []
    for i in range(70):
        text = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(kinds))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                line[rng.randrange(len(line))] = rare() if rng.random() < 0.7 else rng.choice(words)
            text.append(rng.choice([" ", "  ", "\t"]).join(line))
        rows.append((i if i != 9 else None, "\n".join(text)))
    rows += [rows[3], (500, None), (501, ""), (502, "\n \n"), (503, "one"), (504, "1 2 3 4"), (505, "1 2 3 4"), (506, "1 2 3 4\n1 2 3 5")]
    want = brute.dedup_lines(rows)
    assert left(spark, rows) == want
    assert sum(a != b for (_, a), b in zip(rows, want)) > 25


def test_wildcard_children(spark):
    names = ["anna", "bert", "carl", "dora", "emil"]
    for line in ("login user {} from remote host at noon today", "hello {} welcome back", "{} has left the room now", "user says {} to all of you"):
        rows = [(i, f"own line of {n} only\n" + line.format(n)) for i, n in enumerate(names)]
        got = left(spark, rows)
        assert got[0] == rows[0][1] and all(t == f"own line of {n} only" or t == "" for n, t in zip(names[1:], got[1:])), line


def test_null_id_does_not_keep_the_passage(spark):
    line = " ".join(f"word{c}" for c in "abcdefghijkl")
    assert left(spark, [(None, line), (7, line), (3, line)]) == ["", "", line]


def test_very_long_line_and_hot_leaf(spark):
    long = "a " * 50_000 + "end"
    rows = [(i, f"{long}\nsame first words {i} w{i}x") for i in range(30)]
    got = left(spark, rows)
    assert got[0] == rows[0][1] and set(got[1:]) == {""}
