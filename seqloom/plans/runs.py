"""The run modes: reads to contigs, contigs to a reduced set, the set to annotations, and all of it published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom import sinks
from seqloom.config import EngineConfig
from seqloom.functions.text import kmers
from seqloom.operators import assembly, relational, search, sequence
from seqloom.plans import report
from seqloom.plans.rescue import rescue_run
from seqloom.plans.stages import Stages, digest
from seqloom.sources import files, readers

#: (id, hit) frames by database name.
Hits = dict[str, DataFrame]
#: Columns of the tables that licensed predictors make (their layout is the contract; the programs are not part of this engine).
PREDICTORS = {
    "signal": "id string, peptide_end int, probability double",
    "membrane": "id string, helices int, topology string",
    "rrna": "id string, kind string, start int, stop int, strand string, score double",
}
#: Seed lengths of searches: contigs against contigs or markers, and the share of a marker that a whole hit covers.
SEARCH_K, WHOLE_MARKER = 15, 0.9


def predictor_table(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A licensed predictor's table, tab-separated; an empty frame of its columns where no path is given."""
    return readers.read_tsv(spark, files.require_database(spark, path, kind), PREDICTORS[kind]) if path else spark.createDataFrame([], PREDICTORS[kind])


def prepare(cfg: EngineConfig, reads: DataFrame, out: dict[str, DataFrame] | None = None) -> DataFrame:
    """Reads (pair_no, mate, seq, qual) after adapters, the quality filter, the rRNA filter and the coverage
    normalisation; ``out`` takes what each step has to report and the reads to save."""
    out = {} if out is None else out
    spark = reads.sparkSession
    if cfg.max_read_len:
        longest = reads.agg(F.max(F.length("seq"))).first()[0] or 0
        if longest > cfg.max_read_len:
            raise ValueError(f"a read has {longest} letters, max_read_len is {cfg.max_read_len}")
    if not cfg.skip_qc:
        out["quality"] = assembly.quality_by_position(reads)
    if not cfg.skip_filter:
        kept = assembly.filter_pairs(assembly.trim_adapters(reads, cfg.adapter) if cfg.adapter else reads, cfg.min_qual)
        out["filter_stats"] = assembly.normalise_stats(reads, kept)
        reads = out["reads_filter"] = kept
    if cfg.rrna_filter:
        database = readers.read_fasta(spark, files.require_database(spark, cfg.rrna_db, "rRNA database"))
        out["reads_rrna"], reads, out["rrna_stats"] = search.partition_reads(reads, database)
    if not cfg.skip_normalization:
        kept = assembly.normalise_pairs(reads, min(cfg.k), cfg.norm_min_cov, cfg.norm_max_cov)
        out["normalization_stats"] = assembly.normalise_stats(reads, kept)
        reads = out["reads_normalized"] = kept
    return reads


def assemble(cfg: EngineConfig, reads: DataFrame) -> DataFrame:
    """(tag, id, seq, length, coverage) of the unitigs of every k."""
    return relational.union_tagged({f"k{k}": assembly.unitigs(reads, k, cfg.min_kmer_count) for k in cfg.k})


def reduce(contigs: DataFrame, least: float = 0.9, k: int = SEARCH_K) -> DataFrame:
    """(id, seq): equal sequences once, by the smallest id; of those that share most of their k-mers, the longest."""
    once = contigs.groupBy("seq").agg(F.min("id").alias("id")).select("id", "seq")
    groups = sequence.near_groups(once.select("id", F.array_join(kmers(F.col("seq"), k), " ").alias("text")), shingle=1, least=least)
    return once.join(groups.where("kept").select("id"), "id", "left_semi")


def completeness(contigs: DataFrame, markers: DataFrame) -> DataFrame:
    """table, pos, busco_id, status, sequence, score, length of every marker(id, seq) in every table of contigs(table, id, seq).

    A marker's hit is whole if it covers WHOLE_MARKER of it. Several whole hits make it Duplicated, partial
    ones only Fragmented, none Missing; its row shows the best hit.
    """
    named = contigs.select(F.concat_ws("|", "table", "id").alias("id"), "seq")
    hits = search.homology_hits(markers.select("id", "seq"), named, files.seeds(named, "id", "seq", SEARCH_K), SEARCH_K, both_strands=True)
    size = markers.select(F.col("id").alias("busco_id"), F.length("seq").alias("marker_length"))
    hits = hits.select(F.col("qseqid").alias("busco_id"), F.split_part("sseqid", F.lit("|"), F.lit(1)).alias("table"), F.col("sseqid").alias("sequence"), F.col("bitscore").alias("score"), "length").join(size, "busco_id")
    hits = hits.withColumn("whole", F.col("length") >= WHOLE_MARKER * F.col("marker_length"))
    best = hits.groupBy("table", "busco_id").agg(F.count_if("whole").alias("w"), F.max_by(F.struct("sequence", "score", "length"), F.struct("score", "sequence")).alias("b"))
    scaffold = size.select("busco_id").crossJoin(contigs.select("table").distinct())  # markers times assemblies
    status = F.when(F.col("w").isNull(), "Missing").when(F.col("w") == 0, "Fragmented").when(F.col("w") > 1, "Duplicated").otherwise("Complete")
    rows = scaffold.join(best, ["table", "busco_id"], "left").withColumn("status", status)
    return rows.select("table", F.lit(0).cast("long").alias("pos"), "busco_id", "status", F.substring_index("b.sequence", "|", -1).alias("sequence"), "b.score", "b.length")


def species(cfg: EngineConfig, contigs: DataFrame) -> dict[str, DataFrame]:
    """Contigs told apart by a classifier fitted on labelled host and symbiont sequences, and its held-out accuracy."""
    spark = contigs.sparkSession
    known = [readers.read_fasta(spark, files.require_database(spark, p, "labelled sequences")).select(F.concat(F.lit(f"{i}|"), "id").alias("doc_id"), F.col("seq").alias("text"), F.lit(i).cast("double").alias("label")) for i, p in ((1, cfg.host), (0, cfg.symbiont))]
    rows = contigs.select(F.concat(F.lit("c|"), "id").alias("doc_id"), F.col("seq").alias("text"), F.lit(None).cast("double").alias("label")).unionByName(known[0]).unionByName(known[1])
    predicted = sequence.species_split(rows, seed=cfg.species_seed)
    of = predicted.where("label IS NULL").select(F.expr("substring(doc_id, 3)").alias("id"), "prediction")
    host, symbiont = sequence.partition_species(contigs, of, "id")
    share = predicted.where("held_out").agg(F.count(F.lit(1)).alias("held_out"), F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 4).alias("accuracy"))
    return {"host": host, "symbiont": symbiont, "species_accuracy": share}


def annotate(contigs: DataFrame, hits: Hits, min_aa: int = 100, cfg: EngineConfig | None = None) -> dict[str, DataFrame]:
    """Reading frames, their statistics and the annotation star of (id, seq).

    A frame is annotated if its sequence has a hit; unless short_orfs asks for frames as they are, the best
    frame of every sequence without one goes only by its length.
    """
    cfg = cfg or EngineConfig(mode="only_ann", min_aa=min_aa, short_orfs=True)
    orfs = sequence.find_orfs(contigs, cfg.min_aa, cfg.gen_code)
    kinds = ("complete", "5prime_partial", "3prime_partial", "internal")
    if not cfg.short_orfs and hits:
        supported = relational.union_tagged({n: h.select("id") for n, h in hits.items()}).select("id").distinct().withColumn("_s", F.lit(True))
        orfs = orfs.join(supported, "id", "left").withColumn("annotated", F.coalesce("_s", F.lit(False))).drop("_s")
    stats = orfs.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("orf_type") == x).alias(x) for x in kinds])
    star = relational.annotation_star(contigs.select("id"), "id", {n: (h, "hit") for n, h in hits.items()})
    out = {"orfs": orfs, "orf_stats": stats, "annotation": star}
    if cfg.add_annotation:
        parts = [x for n in hits for x in (F.lit(f" {n}:"), F.when(F.col(n) == ".", "noHit").otherwise(F.substring_index(F.split_part(n, F.lit("`"), F.lit(1)), "^", 1)))]
        out["headers"] = star.select("id", F.concat(F.lit(">"), "id", *parts).alias("header"))
    if cfg.with_kegg:
        if "kegg" not in hits:
            raise ValueError("with_kegg needs hits named kegg")
        out["kegg"] = sinks.kegg_ids(hits["kegg"], "hit")
    spark = contigs.sparkSession
    for flag, kind, path in ((cfg.with_signal, "signal", cfg.signal_table), (cfg.with_membrane, "membrane", cfg.membrane_table), (cfg.with_rrna_table, "rrna", cfg.rrna_table)):
        if flag:
            out[kind] = predictor_table(spark, kind, path)
    return out


#: The kind of result of each frame that run() publishes.
KINDS = {
    "quality": "quality", "filter_stats": "filter", "rrna_stats": "rrna", "normalization_stats": "stats", "contigs": "assemblies", "counts": "stats", "reduced": "reduced", "reduced_counts": "stats", "metrics": "metrics",
    "mapping": "mapping", "completeness": "completeness", "comparison": "completeness_rescue", "missing_final": "completeness_rescue", "rescued": "completeness_rescue", "sequences": "completeness_rescue", "host": "species",
    "symbiont": "species", "species_accuracy": "species", "orfs": "orfs", "orf_stats": "stats", "annotation": "annotation", "headers": "headers", "kegg": "kegg", "signal": "annotation", "membrane": "annotation", "rrna": "annotation", "run_info": "stats",
}


def run(cfg: EngineConfig, reads: DataFrame | None = None, contigs: DataFrame | None = None, hits: Hits | None = None) -> dict[str, DataFrame]:
    """The frames of a run by cfg.mode: ``all`` and ``only_asm`` start at reads, ``only_evi`` and
    ``only_ann`` at contigs (id, seq). With cfg.outdir they are published under its result folders, with a
    report and the run's information; with cfg.resume finished stages of an equal run are read instead of made."""
    need = "reads" if cfg.mode in ("all", "only_asm") else "contigs"
    given = {"reads": reads, "contigs": contigs}[need]
    if given is None:
        raise ValueError(f"{cfg.mode} needs {need}")
    spark = given.sparkSession
    folder = f"{cfg.outdir}/.stages" if cfg.outdir else ""
    plain = {n: v for n, v in vars(cfg).items() if n not in ("outdir", "resume", "skip_report", "skip_run_info", "save_reads", "save_alignments")}
    stage = Stages(folder, [plain, digest(given), {n: digest(h) for n, h in sorted((hits or {}).items())}] if folder else [], cfg.resume)
    out: dict[str, DataFrame] = {}
    kept: dict[str, DataFrame] = {}
    if need == "reads":
        made: dict[str, DataFrame] = {}
        reads = stage("reads", lambda: prepare(cfg, given, made))
        if not made:  # resumed: the steps' reports are made from the reads again
            prepare(cfg, given, made)
        kept = {n: made.pop(n) for n in list(made) if n.startswith("reads_")}
        out |= made
        contigs = out["contigs"] = stage("contigs", lambda: assemble(cfg, reads))
        out["counts"] = contigs.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    whole = contigs
    if cfg.mode != "only_ann":
        contigs = out["reduced"] = stage("reduced", lambda: reduce(whole))
        out["metrics"] = relational.n50(contigs.select(F.length("seq").alias("len")), "len")
    if need == "reads":
        out["reduced_counts"] = out["contigs"].join(contigs.select("id"), "id", "left_semi").groupBy("tag").agg(F.count_distinct("id").alias("n"))
        out["mapping"] = search.mapping_rate(reads, contigs, min(21, min(cfg.k)))
    if cfg.completeness_db:
        markers = readers.read_fasta(spark, files.require_database(spark, cfg.completeness_db, "marker genes"))
        sets = contigs.select(F.lit("final").alias("table"), "id", "seq")
        if cfg.all_buscos:
            if "tag" not in whole.columns:
                raise ValueError("all_buscos needs contigs tagged by assembly")
            sets = sets.unionByName(whole.select(F.col("tag").alias("table"), "id", "seq"))
        out["completeness"] = stage("completeness", lambda: completeness(sets, markers))
        if cfg.busco_dist:
            records = whole.select("id", F.lit("").alias("description"), "seq").dropDuplicates(["id"])
            out |= rescue_run(out["completeness"], records, "final", cfg.min_perc)
    if cfg.filter_species:
        out |= species(cfg, contigs)
    if cfg.mode in ("all", "only_ann"):
        out |= annotate(contigs, hits or {}, cfg=cfg)
    if not cfg.skip_run_info and cfg.outdir:
        out["run_info"] = sinks.run_info(spark, cfg)
    if cfg.outdir:
        sinks.publish({n: (KINDS[n], f) for n, f in out.items()}, cfg.outdir)
        if cfg.save_reads:
            folders = {"reads_filter": "saved_filter", "reads_rrna": "saved_rrna", "reads_normalized": "saved_normalized"}
            for n, f in kept.items():
                sinks.write_reads(f.withColumn("read_id", F.concat_ws("/", F.col("pair_no").cast("string"), F.col("mate").cast("string"))), f"{cfg.outdir}/{sinks.FOLDERS[folders[n]]}/reads")
        if cfg.save_alignments and need == "reads":
            asked = reads.select(F.concat_ws("/", F.col("pair_no").cast("string"), F.col("mate").cast("string")).alias("id"), "seq")
            refs = contigs.select("id", "seq")
            sinks.write_alignments(search.homology_hits(asked, refs, files.seed_index(refs, f"{folder}/seeds", SEARCH_K), SEARCH_K, both_strands=True), cfg.outdir, True)
        if not cfg.skip_report:
            sinks.write_page(spark, report.render(f"run of {cfg.mode}", report.sections(out)), f"{cfg.outdir}/{sinks.FOLDERS['report']}/report.html")
        if "run_info" in out:
            sinks.write_run_info(out["run_info"], f"{cfg.outdir}/run_info")
    return out
