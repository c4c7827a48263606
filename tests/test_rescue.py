"""The rescue from table files to FASTA, against a plain version that follows the survey's nine steps."""

import random

import pytest

from seqloom.plans.rescue import rescue_run
from seqloom.sources import files, readers


def plain(tables, final, share):
    """tables: name: rows (id, status, sequence, score). Rescued (id, sequence) and the comparison."""
    first = {}
    for name, rows in tables.items():
        runs = []
        for i, *rest in rows:
            if not runs or runs[-1][0] != i:
                runs.append([i, None, None, None])
            runs[-1][1:] = [a if a is not None else b for a, b in zip(runs[-1][1:], rest)]
        for i, *rest in runs:
            first.setdefault(name, {}).setdefault(i, rest)
    lacking = {i for t in first.values() for i, r in t.items() if r[0] == "Missing"}
    compared = {i: {n: t[i][0] for n, t in first.items()} for i in lacking if all(i in t for t in first.values())}
    wanted = [i for i, s in compared.items() if s[final] == "Missing" and "Complete" in s.values()]
    out = {}
    for i in wanted:
        pool = [(t[i][2], n, t[i][1]) for n, t in first.items() if n != final and t[i][1] is not None and t[i][2] is not None]
        if pool and len(pool) >= share * len(first):
            out[i] = min(pool, key=lambda p: (-p[0], p[1]))[2]
    return out, compared


def write(folder, tables):
    for name, rows in tables.items():
        lines = ["# header", *["\t".join("" if x is None else str(x) for x in r) for r in rows]]
        (folder / f"full_table_{name}.tsv").write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("seed", range(3))
def test_rescue(spark, tmp_path, seed):
    rng = random.Random(seed)
    names = [f"k{k}" for k in (25, 35, 55)] + ["single", "final"]
    tables = {}
    for n in names:
        rows = []
        for i in range(40):
            status = "Missing" if rng.random() < (0.6 if n == "final" else 0.15) else rng.choice(["Complete", "Duplicated", "Fragmented"])
            for c in range(2 if status == "Duplicated" else 1):
                known = status != "Missing" and rng.random() < 0.9
                rows.append((f"g{i}", status, f"{n}_s{i}_{c}" if known else None, round(rng.uniform(10, 99), 1) if known else None))
        tables[n] = rows
    tables["k35"] = [r for r in tables["k35"] if r[0] != "g7"]  # not listed everywhere
    write(tmp_path, tables)
    (tmp_path / "all.fa").write_text("".join(f">{s} d\nAC\nGT\n" for rows in tables.values() for _, _, s, _ in rows if s))
    out = rescue_run(files.read_status_tables(spark, f"{tmp_path}/full_table_*.tsv"), readers.read_fasta(spark, f"{tmp_path}/all.fa"), "final", 0.6)
    want, compared = plain(tables, "final", 0.6)
    assert {r.busco_id: r.sequence for r in out["rescued"].collect()} == want and len(want) > 3
    got = {r.busco_id: {n: r[n] for n in names} for r in out["comparison"].collect()}
    assert got == compared
    assert {r.busco_id for r in out["missing_final"].collect()} == {i for i, s in compared.items() if s["final"] == "Missing"}
    readers.write_fasta(out["sequences"], str(tmp_path / "rescued"))
    assert sorted((r.id, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "rescued")).collect()) == sorted((s, "ACGT") for s in want.values())
    with pytest.raises(ValueError, match="no table"):
        rescue_run(files.read_status_tables(spark, f"{tmp_path}/full_table_*.tsv"), out["sequences"], "nothing")


def test_nothing_to_rescue(spark, tmp_path):
    write(tmp_path, {"a": [("g", "Complete", "s", 1.0)], "final": [("g", "Complete", "t", 1.0)]})
    fasta = spark.createDataFrame([("s", "", "AC")], "id string, description string, seq string")
    out = rescue_run(files.read_status_tables(spark, str(tmp_path)), fasta, "final")
    assert out["comparison"].count() == out["rescued"].count() == out["sequences"].count() == 0
    readers.write_fasta(out["sequences"], str(tmp_path / "rescued"))
    assert readers.read_fasta(spark, str(tmp_path / "rescued")).count() == 0
