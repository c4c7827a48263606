"""Substring containment by anchors against brute force, and FASTQ files of several kinds."""

import gzip

from pyspark.sql import functions as F

from seqloom.operators import relational as R
from seqloom.sources import readers


def test_contained_in_equals_brute_force(spark):
    base = "one two three four five six seven eight nine ten eleven"
    texts = [base, "x" + base + "y", base.replace(" ", "  "), "pre " + base[:30], base + "\n" + base, "", None, " " + base + " ", "two", base.upper(), "a b c d e f g h"]
    probes = ["two three four five six seven eight nine", "wo three four five six seven eight ni", "two", "  three  four", None, "", "a b c d e f g h", "b c d e f g h i", "e\none two three four five six seven eight"]
    for use in (probes, [x for x in probes if x is None or len(x) > 5], []):
        docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
        got = R.contained_in(docs, "id", "t", spark.createDataFrame([(x,) for x in use], "p string"), "p").collect()
        want = [i for i, t in enumerate(texts) if t is not None and any(x in t for x in use if x is not None)]
        assert sorted(r.id for r in got) == want
        flags = R.flag_match(docs, R.contained_in(docs, "id", "t", spark.createDataFrame([(x,) for x in use], "p string"), "p"), "id")
        assert sorted(r.id for r in flags.where("matched").collect()) == want and flags.count() == len(texts)


def test_fastq_plain_and_gzip(spark, tmp_path):
    record = "@r{0}/1 extra\nACGT\n+\n@III\n"
    (tmp_path / "a.fastq").write_text("".join(record.format(i) for i in range(3)))
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(record.format(9))
    (tmp_path / "c.txt").write_text("no reads")
    spark.dataSource.register(readers.FastqSource)
    for path in (f"{tmp_path}/*.fastq*", f"file://{tmp_path}/*.fastq*"):
        rows = spark.read.format("fastq").option("path", path).load().orderBy("path", "pair_no").collect()
        assert [(r.pair_no, r.read_id, r.seq, r.qual) for r in rows] == [(0, "r0/1", "ACGT", "@III"), (1, "r1/1", "ACGT", "@III"), (2, "r2/1", "ACGT", "@III"), (0, "r9/1", "ACGT", "@III")]
    assert spark.read.format("fastq").option("path", f"{tmp_path}/a.fastq").load().agg(F.max("pair_no")).first()[0] == 2
