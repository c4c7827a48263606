"""Scans: JSON reports, named CSV, status tables, file pairs, SQLite, databases and seed indexes."""

import json
import sqlite3

import pytest

from seqloom.sources import files, readers


def report(total, mean, r2=True):
    side = lambda n: {"total_reads": n, "quality_curves": {"mean": mean, "A": [1.0]}}
    out = {"summary": {"before_filtering": {"total_reads": total, "read1_mean_length": 100, "read2_mean_length": 99, "gc_content": 0.5, "q20_rate": 1}, "after_filtering": {"total_reads": total - 3, "read1_mean_length": 98, "gc_content": 0.25}},
           "read1_before_filtering": side(total // 2), "read1_after_filtering": side(total // 2 - 1), "read2_before_filtering": side(total // 2)}
    return out | ({"read2_after_filtering": {"total_reads": total // 2 - 2, "quality_curves": {"mean": mean[:1]}}} if r2 else {})


def test_filter_reports(spark, tmp_path):
    (tmp_path / "a.fastp.json").write_text(json.dumps(report(100, [30.5, 31.0]), indent=2))
    (tmp_path / "b.json").write_text(json.dumps(report(10, [20.0], r2=False)))
    rows = files.read_filter_report(spark, str(tmp_path))
    got = {r.sample_name: r for r in files.reads_stats(rows).collect()}
    assert set(got) == {"a", "b"} and got["a"].reads_discarded == 3 and got["a"].r1_before == 50 and got["a"].r2_after == 48
    assert (got["a"].r1_before_length, got["a"].gc_after, got["a"].r2_after_length, got["b"].r2_after) == (100.0, 0.25, None, None)
    curves = {(r.sample_name, r.mate, r.stage): (r.n, r.mean_quality) for r in files.reads_curves(rows).collect()}
    assert curves["a", 1, "before"] == (2, [30.5, 31.0]) and curves["a", 2, "after"] == (1, [30.5]) and ("b", 2, "after") not in curves and len(curves) == 7


def test_csv_takes_the_given_names(spark, tmp_path):
    (tmp_path / "x.csv").write_text("other,names\n1,x\n2,\n")
    rows = files.read_named_csv(spark, str(tmp_path / "x.csv"), "n int, s string").orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, None)]


def test_status_tables_and_tsv(spark, tmp_path):
    (tmp_path / "full_table_k25.tsv").write_text("# Busco id\tStatus\nA\tComplete\ts1\t9.5\t100\n\nB\tMissing\nA\tDuplicated\ts2\t8\t90\n")
    rows = files.read_status_tables(spark, str(tmp_path)).orderBy("pos").collect()
    assert [tuple(r)[0::1] for r in rows] == [("k25", 1, "A", "Complete", "s1", 9.5, 100), ("k25", 3, "B", "Missing", None, None, None), ("k25", 4, "A", "Duplicated", "s2", 8.0, 90)]
    (tmp_path / "t.tsv").write_text("#c\nx\t.\ny\t2\n")
    assert sorted(map(tuple, readers.read_tsv(spark, str(tmp_path / "t.tsv"), "a string, b int").collect())) == [("x", None), ("y", 2)]


def test_file_pairs(spark, tmp_path):
    names = ["x_R1.fastq.gz", "x_R2.fastq.gz", "y_R1_001.fastq.gz", "y_R2_001.fastq.gz", "z.1.fq", "z.2.fq", "w_a_1.fq", "w_a_2.fq"]
    for n in names:
        (tmp_path / n).write_text("x")
    got = {r.sample_id: [f.rsplit("/", 1)[1] for f in r.files] for r in readers.read_file_pairs(spark, str(tmp_path)).collect()}
    assert got == {"x": names[:2], "y": names[2:4], "z": names[4:6], "w_a": names[6:]}
    (tmp_path / "lone_1.fq").write_text("x")
    with pytest.raises(ValueError, match="lone"):
        readers.read_file_pairs(spark, str(tmp_path))
    (tmp_path / "lone_1.fq").unlink()
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(ValueError, match="no mate"):
        readers.read_file_pairs(spark, str(tmp_path))
    assert readers.read_file_pairs(spark, str(tmp_path), None).count() == 5


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "t.sqlite")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE "ann" (id TEXT, n INTEGER, s REAL)')
        db.executemany("INSERT INTO ann VALUES (?,?,?)", [(f"g{i}", i if i % 7 else None, i / 2) for i in range(1000)])
        db.execute("DELETE FROM ann WHERE rowid BETWEEN 300 AND 600")
        db.execute("CREATE TABLE none (id TEXT)")
    rows = files.read_sqlite(spark, path, "ann", "s double, id string, n bigint")
    again = files.to_parquet(rows, str(tmp_path / "ann"))
    got = {r.id: (r.n, r.s) for r in again.collect()}
    assert len(got) == again.count() == 699 and got["g7"] == (None, 3.5) and got["g999"] == (999, 499.5)
    assert files.read_sqlite(spark, path, "none", "id string").count() == 0


def test_a_missing_database_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="proteins"):
        files.require_database(spark, str(tmp_path / "none*.fa"), "proteins")
    with pytest.raises(FileNotFoundError):
        files.require_database(spark, "", "proteins")
    assert files.require_database(spark, str(tmp_path), "proteins") == str(tmp_path)


def test_seed_index_is_built_once(spark, tmp_path):
    refs = spark.createDataFrame([("a", "acgta"), ("b", "ACG"), ("c", "AC"), ("d", None)], "id string, seq string")
    path = str(tmp_path / "index")
    got = sorted(map(tuple, files.seed_index(refs, path, 3).collect()))
    assert got == [("ACG", "a", 0), ("ACG", "b", 0), ("CGT", "a", 1), ("GTA", "a", 2)]
    made = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    assert sorted(map(tuple, files.seed_index(refs.repartition(3), path, 3).collect())) == got
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")} == made
    assert len(files.seed_index(refs, path, 2).collect()) == 7  # another k, another table
    assert len(files.seed_index(refs.where("id <> 'a'"), path, 3).collect()) == 1


def test_fastq_ends_within_a_record(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r\nAC\n+\n")
    spark.dataSource.register(readers.FastqSource)
    with pytest.raises(Exception, match="ends within a record"):
        spark.read.format("fastq").option("path", str(tmp_path / "a.fastq")).load().collect()
