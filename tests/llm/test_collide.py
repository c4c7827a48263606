"""Collision counting against brute force row by row, and its recall at the threshold."""

import numpy as np

from seqloom.llm import collide

SCHEMA = "vec_id bigint, embedding array<float>, label int, vid int, copies int, cell string"


def brute(rows, threshold):
    """n_links and component by position."""
    ok = [v is not None and lab is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(v) for _, v, lab in rows]
    n, comp = [0] * len(rows), list(range(len(rows)))
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for (_, v, _), o in zip(rows, ok)]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and (unit[a] @ unit[b] >= threshold or rows[a][1] == rows[b][1])]
    for a, b in links:
        n[a] += 1
        n[b] += 1
    while True:
        new = list(comp)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == comp:
            break
        comp = new
    ids = {}
    for c, (i, _, _) in zip(comp, rows):
        if i is not None:
            ids[c] = min(ids.get(c, i), i)
    return n, [ids.get(c) for c in comp], len(links)


def test_every_row(spark, monkeypatch):
    monkeypatch.setattr(collide, "CHUNK", 16)
    rng = np.random.default_rng(4)
    f = lambda v: [float(np.float32(c)) for c in v]
    near = rng.standard_normal((3, 24))
    rows = [(i, f(v), i % 2) for i, v in enumerate(rng.standard_normal((80, 24)))]
    rows += [(100 + i, f(near[i % 3] + 0.27 * rng.standard_normal(24)), i % 2) for i in range(150)]
    rows += [(300 + i, f(2 * near[0]), 0) for i in range(40)]  # a group of copies
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, [1.0, None] * 12, 0), (904, rows[0][1], None), (905, [], 0), (906, [float("inf")] * 24, 1), (907, rows[0][1][:8], 0)]
    rows += [(None, rows[85][1], 1), (None, rows[300][1] if len(rows) > 300 else rows[-9][1], 0), (None, f(rng.standard_normal(24)), 1), rows[90], (100, f(rng.standard_normal(24)), 0)]
    frame = spark.createDataFrame([(*r, 1, 2, "c") for r in rows], SCHEMA)
    n, comp, links = brute(rows, 0.93)
    got = collide.near_duplicates(frame, 0.93, miss=1e-7)
    want = sorted(((i, a, c, c is None if i is None or c is None else i == c) for (i, _, _), a, c in zip(rows, n, comp)), key=str)
    assert links > 1000
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()), key=str) == want


def test_recall_at_the_threshold():
    """Pairs exactly at 0.93, on lines of other vectors than those the widths were made for."""
    rng = np.random.default_rng(9)
    half, least = collide.calibrate(0.93, 24)
    sweep = collide.half_width(0.93, 0.999)
    n, found, strangers = 1000, 0, 0
    for _ in range(4):
        a, u = rng.standard_normal((2, n, 64))
        a /= np.linalg.norm(a, axis=1)[:, None]
        u -= (u * a).sum(axis=1)[:, None] * a
        u /= np.linalg.norm(u, axis=1)[:, None]
        b = 0.93 * a + np.sqrt(1 - 0.93**2) * u
        line = collide.lines(64, 25)
        i, j = collide.collisions(a @ line, b @ line, sweep, half, least, False)
        cell = np.floor(a @ collide.lines(64, 2, 99) / sweep), np.floor(b @ collide.lines(64, 2, 99) / sweep)
        close = (np.abs(cell[0] - cell[1]) <= 1).all(axis=1)
        found += (close[i] & (i == j)).sum()
        strangers += (i != j).sum()
    assert found >= 0.99 * 4 * n
    assert strangers < 0.001 * 4 * n * n
