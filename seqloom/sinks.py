"""Sinks: result folders, CSV with a fixed header, gzip reads, alignments, the run's information."""

from __future__ import annotations

import platform

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.config import EngineConfig
from seqloom.functions.text import first_ko

#: Result folders by kind of result (fixed values).
FOLDERS = {
    "quality": "fastqc", "filter": "filter", "saved_filter": "saveReads/filter", "saved_rrna": "saveReads/rRNA", "saved_normalized": "saveReads/normalization", "rrna": "rRNA_reads",
    "assemblies": "assemblies", "reduced": "evigene", "metrics": "rnaQuast", "mapping": "mapping", "completeness": "busco4", "completeness_all": "busco4_all", "completeness_rescue": "busco4_dist",
    "stats": "stats", "figures_completeness": "figures/BUSCO4", "figures_go": "figures/GO", "figures_hits": "figures/CustomUniProt", "kegg": "figures/kegg", "orfs": "transdecoder",
    "annotation": "trinotate", "species": "psytrans_output", "headers": "addAnnotation", "report": "report",
}
#: CSV headers (fixed values).
ASSEMBLY_COUNTS = ["Total", "Trinity", "SOAP", "Velvet", "SPADES", "TransBySS"]
ORF_COUNTS = ["Sample", "Total_orf", "orf_complete", "orf_5prime_partial", "orf_3prime_partial", "orf_internal"]
READS_STATS = ["Sample_name", "Total_before", "R1_before", "R1_before_length", "R2_before", "R2_before_length", "GC_before", "Total_after", "R1_after", "R1_after_length", "R2_after", "R2_after_length", "GC_after", "Reads_discarded"]


def publish(frames: dict[str, tuple[str, DataFrame]], outdir: str, sample: str | None = None) -> dict[str, str]:
    """Write each ``name: (kind, frame)`` as Parquet under the kind's folder, overwriting; with a sample, under its own.

    Returns the paths. An unknown kind raises before anything is written.
    """
    unknown = {k for k, _ in frames.values()} - set(FOLDERS)
    if unknown:
        raise ValueError(f"unknown result kind {sorted(unknown)}")
    out = {}
    for name, (kind, frame) in frames.items():
        out[name] = "/".join([outdir, FOLDERS[kind], *([f"sample_id={sample}"] if sample else []), name])
        frame.write.mode("overwrite").parquet(out[name])
    return out


def write_csv(df: DataFrame, path: str, header: list[str] | None, max_rows: int = 100_000) -> str:
    """One CSV file in folder ``path``, its columns under ``header`` by position, or without one where it is None.

    For summaries: more than ``max_rows`` rows raise, as they would go through one task.
    """
    if header is not None and len(header) != len(df.columns):
        raise ValueError(f"{len(header)} names for {len(df.columns)} columns")
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows; write Parquet")
    named = df.toDF(*header) if header is not None else df
    named.coalesce(1).write.mode("overwrite").csv(path, header=header is not None)
    return path


def write_reads(reads: DataFrame, path: str) -> str:
    """FASTQ, gzip, in folders of their own by mate: reads(read_id, mate, seq, qual); records keep their order within a file."""
    rows = reads.select("mate", F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))
    rows.write.mode("overwrite").partitionBy("mate").option("compression", "gzip").text(path)
    return path


def write_alignments(hits: DataFrame, outdir: str, save: bool) -> str | None:
    """Alignments as Parquet, where they are asked for."""
    return publish({"alignments": ("mapping", hits)}, outdir)["alignments"] if save else None


def kegg_ids(annotation: DataFrame, cell: str = "kegg") -> DataFrame:
    """The distinct first KEGG orthology id of every annotated row: what a pathway map is drawn from."""
    return annotation.select(F.nullif(first_ko(F.col(cell)), F.lit("")).alias("ko")).where("ko IS NOT NULL").distinct()


def run_info(spark: SparkSession, cfg: EngineConfig, databases: dict[str, str] | None = None) -> DataFrame:
    """component, version: the engine's true versions, the parameters it runs with and the databases' dates."""
    rows = [("spark", spark.version), ("python", platform.python_version()), ("java", spark._jvm.System.getProperty("java.version")), ("k", ",".join(map(str, cfg.k)))]
    rows += [(f"parameter {n}", str(v)) for n, v in vars(cfg).items()]
    rows += [(f"database {n}", v or "no information") for n, v in (databases or {}).items()]
    return spark.createDataFrame(rows, "component string, version string")


def write_run_info(info: DataFrame, path: str) -> str:
    """The run's information as one text file in folder ``path``, a line a component."""
    info.select(F.concat_ws(": ", "component", "version").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def write_page(spark: SparkSession, page: str, path: str) -> str:
    """A page as one file, in whatever store Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(page.encode()))
    finally:
        stream.close()
    return path
