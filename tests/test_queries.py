"""Every core query with SQL against DuckDB, and golden values of the text rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

from seqloom.config import EngineConfig
from seqloom.functions import text as T
from seqloom.operators import relational as R
from seqloom.operators import sequence as S
from seqloom.plans import queries as Q
from seqloom.sources import readers

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_oracle(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*cols).collect())
    want = sorted(tuple(map(str, r)) for r in duck.sql(f"SELECT {', '.join(cols)} FROM ({Q.SQL[name]})").fetchall())
    assert got == want


def test_queries_without_sql_have_tests_of_their_own():
    """q_species_split: tests/test_whole_sequence.py; q_assemble: below."""
    assert set(Q.QUERIES) - set(Q.SQL) == {"q_species_split", "q_assemble"}


def test_assembly_of_the_query_equals_walking_the_graph(spark):
    from test_assembly import brute_unitigs, parts

    seqs = [r.seq for r in spark.read.parquet(f"{SF}/benchmark.parquet").select(Q._nucleotides().alias("seq")).collect()]
    lines, circles = brute_unitigs(seqs, 25)
    got = {r.seq for r in Q.q_assemble(spark, SF).collect()}
    assert lines <= got and parts(got - lines, 25) == circles and len(got) == len(lines) + len(circles) > 10


def test_text_rules(spark):
    row = spark.sql(r"SELECT 'KEGG:hsa:1`KO:K001`KO:K002' AS kegg, 'ENOG1^d1`COG2^d2' AS og, 'Transcripts > 500 bp       100' AS kv, 'C:95.1%[S:90.0%,D:5.1%],F:2.0%' AS b, 'GO:1^c^a, b`GO:2^x^d`GO:1^c^a, b' AS go")
    label, value = T.key_value(F.col("kv"))
    r = row.select(T.first_ko(F.col("kegg")), T.split_levels(F.col("og")), label, value, T.busco_percent(F.col("b"), "D"), T.go_terms([F.col("go")])).first()
    assert tuple(r) == ("K001", "ENOG1;COG2", "Transcripts >500 bp", "100", 5.1, ["GO:1^c^a, b", "GO:2^x^d"])


def test_top_k_ties_by_name_descending(spark):
    df = spark.createDataFrame([(x,) for x in ["A"] * 3 + ["B"] * 3 + ["C"] * 3 + ["Z"] * 10], "name string")
    assert [r["name"] for r in R.top_k(df, "name", 4).collect()] == ["Z", "C", "B", "A"]


def test_rescue_is_within_missing_final(spark):
    cells = Q._cells(spark, SF)
    lost = {r[0] for r in cells.where("day = 30 AND status = 'Missing'").select("user_id").collect()}
    assert {r.user_id for r in Q.entry(spark, SF).collect()} <= lost


def test_semi_and_anti_make_the_input(spark):
    assert Q.q_partition_semi_anti(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_fasta_round_trip(spark, tmp_path):
    src = tmp_path / "a.fa"
    src.write_text(">x one two\nAC\nGT\n>y\nA\n")
    rows = readers.read_fasta(spark, str(src)).select("id", "description", "seq").collect()
    assert sorted(map(tuple, rows)) == [("x", "one two", "ACGT"), ("y", "", "A")]
    assert spark.createDataFrame([("ACGTA",), ("AC",)], "s string").select(T.kmers(F.col("s"), 3).alias("k")).collect()[0].k == ["ACG", "CGT", "GTA"]


def test_orf_types():
    assert ("complete" in {k for _, k, _ in S.orfs_of(b"TAA" + b"ATG" + b"GCT" * 5 + b"TAA" + b"TT", 3, S.Translator())})
    assert S.translate("ATGTAA") == "M*"


def test_config():
    assert EngineConfig(reads="x", k=(25, 53), max_read_len=100).n_tables == 10
    with pytest.raises(ValueError):
        EngineConfig(mode="all")
