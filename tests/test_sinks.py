"""Sinks: result folders, CSV headers, gzip reads, FASTA, run information, KEGG ids, top-k as typed columns."""

import gzip

import pytest

from seqloom import sinks
from seqloom.config import EngineConfig
from seqloom.operators import relational as R
from seqloom.sources import readers


def test_publish(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x")], "n int, s string")
    got = sinks.publish({"counts": ("stats", frame), "hits": ("figures_go", frame)}, str(tmp_path), "s1")
    assert got == {"counts": f"{tmp_path}/stats/sample_id=s1/counts", "hits": f"{tmp_path}/figures/GO/sample_id=s1/hits"}
    sinks.publish({"counts": ("stats", frame.union(frame))}, str(tmp_path), "s1")  # overwrites
    assert spark.read.parquet(got["counts"]).count() == 2
    with pytest.raises(ValueError, match="nowhere"):
        sinks.publish({"x": ("nowhere", frame)}, str(tmp_path))


def one(folder):
    files = list(folder.glob("part-*.csv"))
    assert len(files) == 1
    return files[0].read_text()


def test_csv(spark, tmp_path):
    frame = spark.createDataFrame([("s", 5, 3, 1, 1, 0)], "a string, b int, c int, d int, e int, f int")
    sinks.write_csv(frame, str(tmp_path / "orf"), sinks.ORF_COUNTS)
    assert one(tmp_path / "orf") == "Sample,Total_orf,orf_complete,orf_5prime_partial,orf_3prime_partial,orf_internal\ns,5,3,1,1,0\n"
    sinks.write_csv(frame, str(tmp_path / "bare"), None)
    assert one(tmp_path / "bare") == "s,5,3,1,1,0\n"
    with pytest.raises(ValueError, match="names"):
        sinks.write_csv(frame, str(tmp_path / "orf"), ["a"])
    with pytest.raises(ValueError, match="rows"):
        sinks.write_csv(spark.range(11), str(tmp_path / "big"), None, max_rows=10)


def test_top_k_csv_keeps_names_with_digits(spark, tmp_path):
    rows = spark.createDataFrame([("RNA POL 2 COMPLEX",)] * 3 + [("B",)], "name string")
    sinks.write_csv(R.top_k(rows, "name", 2).select("n", "name"), str(tmp_path / "go"), ["count", "name"])
    assert one(tmp_path / "go") == "count,name\n3,RNA POL 2 COMPLEX\n1,B\n"


def test_reads_and_fasta(spark, tmp_path):
    reads = spark.createDataFrame([("a/1", 1, "AC", "II"), ("a/2", 2, "GT", "@@")], "read_id string, mate int, seq string, qual string").coalesce(1)
    sinks.write_reads(reads, str(tmp_path / "reads"))
    parts = {m: gzip.open(next((tmp_path / "reads" / f"mate={m}").glob("*.gz")), "rt").read() for m in (1, 2)}
    assert parts == {1: "@a/1\nAC\n+\nII\n", 2: "@a/2\nGT\n+\n@@\n"}
    spark.dataSource.register(readers.FastqSource)
    back = spark.read.format("fastq").option("path", f"{tmp_path}/reads/mate=2/*.gz").load().first()
    assert (back.read_id, back.seq, back.qual) == ("a/2", "GT", "@@")
    readers.write_fasta(spark.createDataFrame([("x", "ACGT"), ("y", "")], "id string, seq string"), str(tmp_path / "fa"))
    assert sorted((r.id, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "fa")).collect()) == [("x", "ACGT"), ("y", "")]
    readers.write_fasta(spark.createDataFrame([], "id string, seq string"), str(tmp_path / "none"))
    assert readers.read_fasta(spark, str(tmp_path / "none")).count() == 0


def test_run_info_and_kegg(spark, tmp_path):
    info = sinks.run_info(spark, EngineConfig(mode="only_ann"), {"uniprot": "", "pfam": "2020-01-01"})
    got = {r.component: r.version for r in info.collect()}
    assert got["spark"] == spark.version and got["parameter mode"] == "only_ann" and got["database uniprot"] == "no information"
    sinks.write_run_info(info, str(tmp_path / "info"))
    assert "database pfam: 2020-01-01" in next((tmp_path / "info").glob("part-*")).read_text()
    cells = spark.createDataFrame([("KEGG:hsa:1`KO:K001`KO:K002",), (".",), (None,), ("KO:K001",), ("KEGG:x`KO:K009",)], "kegg string")
    assert sorted(r.ko for r in sinks.kegg_ids(cells).collect()) == ["K001", "K009"]
    assert sinks.write_alignments(info, str(tmp_path), False) is None
    assert spark.read.parquet(sinks.write_alignments(info, str(tmp_path), True)).count() == info.count()
