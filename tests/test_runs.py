"""A run from read files to result folders; every parameter is read or refused; resume."""

import gzip
import random

import pytest

from seqloom.config import EngineConfig
from seqloom.plans import runs
from seqloom.plans.stages import Stages, digest
from seqloom.sources import readers

FLIP = str.maketrans("ACGT", "TGCA")


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(9)
    at = tmp_path_factory.mktemp("run")
    genes = [dna(rng, 240) for _ in range(3)]
    rrna = dna(rng, 200)
    pairs = [(g[i:i + 60], g[i + 20:i + 80][::-1].translate(FLIP)) for g in genes for i in range(0, 161, 8)] + [(rrna[i:i + 60], dna(rng, 60)) for i in range(0, 140, 20)]
    for m in (0, 1):
        with gzip.open(at / f"s_R{m + 1}_001.fastq.gz", "wt") as f:
            f.write("".join(f"@p{n}/{m + 1}\n{p[m]}\n+\n{'I' * 60 if n else '!' * 60}\n" for n, p in enumerate(pairs)))
    (at / "rrna.fa").write_text(f">r\n{rrna}\n")
    (at / "markers.fa").write_text("".join(f">m{i}\n{g[30:200]}\n" for i, g in enumerate(genes)) + f">lost\n{dna(rng, 100)}\n")
    (at / "host.fa").write_text("".join(f">h{i}\n{''.join(rng.choice('AACT') for _ in range(120))}\n" for i in range(60)))
    (at / "symbiont.fa").write_text("".join(f">y{i}\n{''.join(rng.choice('CGGT') for _ in range(120))}\n" for i in range(60)))
    (at / "signal.tsv").write_text("c1\t20\t0.9\n")
    return at, genes


def reads_of(spark, at):
    files = readers.read_file_pairs(spark, f"{at}/*.fastq.gz").first().files
    spark.dataSource.register(readers.FastqSource)
    from pyspark.sql import functions as F

    one = lambda p, m: spark.read.format("fastq").option("path", p).load().select("pair_no", F.lit(m).alias("mate"), "seq", "qual")
    return one(files[0], 1).unionByName(one(files[1], 2))


def test_from_files_to_folders(spark, folder, tmp_path):
    at, genes = folder
    cfg = EngineConfig(mode="all", reads=str(at), k=(21, 31), max_read_len=60, outdir=f"file://{tmp_path}/out", rrna_filter=True, rrna_db=f"{at}/rrna.fa", save_reads=True, save_alignments=True, completeness_db=f"{at}/markers.fa", all_buscos=True, busco_dist=True,
                       filter_species=True, host=f"{at}/host.fa", symbiont=f"{at}/symbiont.fa", with_signal=True, signal_table=f"{at}/signal.tsv", add_annotation=True, with_kegg=True, min_aa=20, resume=True)
    hits = {"kegg": spark.createDataFrame([("c1", "KEGG:x`KO:K001")], "id string, hit string")}
    out = runs.run(cfg, reads=reads_of(spark, at), hits=hits)
    both = {s for g in genes for s in (g, g[::-1].translate(FLIP))}
    contigs = [r.seq for r in out["reduced"].collect()]
    assert len(contigs) == 3 and all(any(c in g for g in both) and len(c) > 200 for c in contigs)
    assert tuple(out["rrna_stats"].first())[1:] == (7, 63) or out["rrna_stats"].first().matched == 7
    assert {(r.table, r.busco_id): r.status for r in out["completeness"].collect()} == {(t, m): "Missing" if m == "lost" else "Complete" for t in ("k21", "k31", "final") for m in ("m0", "m1", "m2", "lost")}
    assert [r.busco_id for r in out["missing_final"].collect()] == ["lost"] and out["rescued"].count() == out["sequences"].count() == 0
    assert out["mapping"].first().rate == 1.0 and out["species_accuracy"].first().accuracy > 0.9
    assert [r.ko for r in out["kegg"].collect()] == ["K001"] and out["signal"].first().peptide_end == 20
    published = {str(p.parent.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("_SUCCESS")}
    for want in ("fastqc/quality", "filter/filter_stats", "rRNA_reads/rrna_stats", "stats/normalization_stats", "assemblies/contigs", "evigene/reduced", "rnaQuast/metrics", "mapping/mapping", "mapping/alignments", "busco4/completeness", "busco4_dist/comparison",
                 "transdecoder/orfs", "trinotate/annotation", "addAnnotation/headers", "figures/kegg/kegg", "psytrans_output/host", "saveReads/filter/reads", "saveReads/rRNA/reads", "saveReads/normalization/reads", "run_info"):
        assert want in published, want
    page = (tmp_path / "out" / "report" / "report.html").read_text()
    assert all(t in page for t in ("Read quality by position", "Mapping rate", "Completeness by gene", "Before and after reduction", "Transcript lengths", "Reading frames"))
    assert gzip.open(next((tmp_path / "out" / "saveReads" / "rRNA" / "reads" / "mate=1").glob("*.gz")), "rt").read().startswith("@")
    # An equal run reads its stages; one with another parameter does not.
    made = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / ".stages").rglob("*.parquet")}
    again = runs.run(cfg, reads=reads_of(spark, at), hits=hits)
    assert sorted(r.seq for r in again["reduced"].collect()) == sorted(contigs)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / ".stages").rglob("*.parquet")} == made


def test_stages(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for mark, resume, want in (("a", True, 1), ("a", True, 1), ("a", False, 2), ("b", True, 3)):
        assert Stages(str(tmp_path), [mark], resume)("x", build).count() == 3 and len(calls) == want
    rows = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert digest(rows) == digest(rows.repartition(2)) != digest(rows.limit(1)) and digest(None) == []
    assert Stages("", [], False)("x", build).count() == 3


def test_parameters_are_refused(spark):
    for bad in (dict(mode="none"), dict(mode="only_asm"), dict(rrna_filter=True), dict(filter_species=True, host="x"), dict(busco_dist=True, completeness_db="x"), dict(min_perc=2.0), dict(gen_code="none"), dict(norm_min_cov=200), dict(resume=True), dict(with_signal=True), dict(save_reads=True)):
        with pytest.raises(ValueError):
            EngineConfig(**({"mode": "only_ann"} | bad))
    contigs = spark.createDataFrame([("c", "ACGT")], "id string, seq string")
    with pytest.raises(ValueError, match="kegg"):
        runs.run(EngineConfig(mode="only_ann", with_kegg=True), contigs=contigs)
    with pytest.raises(FileNotFoundError):
        runs.run(EngineConfig(mode="only_evi", completeness_db="/nowhere.fa"), contigs=contigs)
    with pytest.raises(ValueError, match="tagged"):
        runs.run(EngineConfig(mode="only_evi", completeness_db=__file__, all_buscos=True), contigs=contigs)
    reads = spark.createDataFrame([(1, 1, "ACGTACGT", "IIIIIIII")], "pair_no long, mate int, seq string, qual string")
    with pytest.raises(ValueError, match="max_read_len"):
        runs.run(EngineConfig(mode="only_asm", reads="x", k=(5,), max_read_len=6), reads=reads)
    assert runs.predictor_table(spark, "membrane", "").columns == ["id", "helices", "topology"] and runs.predictor_table(spark, "rrna", "").count() == 0


def test_frames_without_hits_are_kept_apart(spark):
    contigs = spark.createDataFrame([("x", "ATG" + "GCT" * 120 + "TAA"), ("y", "ATG" + "GAT" * 120 + "TAA")], "id string, seq string")
    hits = {"db": spark.createDataFrame([("x", "h1")], "id string, hit string")}
    orfs = runs.run(EngineConfig(mode="only_ann"), contigs=contigs, hits=hits)["orfs"].collect()
    assert {(r.id, r.annotated) for r in orfs} == {("x", True), ("y", False)}
    assert "annotated" not in runs.run(EngineConfig(mode="only_ann", short_orfs=True), contigs=contigs, hits=hits)["orfs"].columns
