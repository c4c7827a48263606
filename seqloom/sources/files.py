"""Scans of report files and databases: JSON by path, CSV with forced names, status tables, SQLite, seed indexes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import kmers

#: The parts of a read filter's JSON report that are read.
_SIDE = "struct<total_reads: bigint, quality_curves: struct<mean: array<double>>>"
_SUMMARY = "struct<total_reads: bigint, read1_mean_length: double, read2_mean_length: double, gc_content: double>"
FILTER_REPORT = (f"summary struct<before_filtering: {_SUMMARY}, after_filtering: {_SUMMARY}>, read1_before_filtering {_SIDE}, read2_before_filtering {_SIDE}, "
                 f"read1_after_filtering {_SIDE}, read2_after_filtering {_SIDE}")


def file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def sample_of(name: Column) -> Column:
    """A file's sample: its name up to the first point."""
    return F.substring_index(name, ".", 1)


def read_filter_report(spark: SparkSession, path: str) -> DataFrame:
    """sample_name and the nested counts and curves of every JSON report under ``path``; missing paths are null."""
    return spark.read.option("multiLine", True).schema(FILTER_REPORT).json(path).select(sample_of(file_name()).alias("sample_name"), "*")


def reads_stats(report: DataFrame) -> DataFrame:
    """Reads before and after filtering, one row a sample, and how many were discarded."""
    b, a = "summary.before_filtering", "summary.after_filtering"
    cols = {"total_before": f"{b}.total_reads", "r1_before": "read1_before_filtering.total_reads", "r1_before_length": f"{b}.read1_mean_length", "r2_before": "read2_before_filtering.total_reads", "r2_before_length": f"{b}.read2_mean_length", "gc_before": f"{b}.gc_content",
            "total_after": f"{a}.total_reads", "r1_after": "read1_after_filtering.total_reads", "r1_after_length": f"{a}.read1_mean_length", "r2_after": "read2_after_filtering.total_reads", "r2_after_length": f"{a}.read2_mean_length", "gc_after": f"{a}.gc_content"}
    return report.select("sample_name", *[F.col(c).alias(n) for n, c in cols.items()]).withColumn("reads_discarded", F.expr("total_before - total_after"))


def reads_curves(report: DataFrame) -> DataFrame:
    """sample_name, mate, stage, n, mean_quality: the four quality curves of a sample, of any lengths; none where it has no curve."""
    rows = F.array(*[F.struct(F.lit(m).alias("mate"), F.lit(s).alias("stage"), F.col(f"read{m}_{s}_filtering.quality_curves.mean").alias("mean_quality")) for s in ("before", "after") for m in (1, 2)])
    return report.select("sample_name", F.inline(rows)).where("mean_quality IS NOT NULL").select("sample_name", "mate", "stage", F.size("mean_quality").alias("n"), "mean_quality")


def read_named_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV whose columns take the given names by position; a header row is passed over, whatever it says."""
    return spark.read.csv(path, sep=sep, header=header, enforceSchema=True, schema=schema)


#: A completeness scan's table, tab-separated, columns by position.
STATUS_COLUMNS = [("busco_id", "string"), ("status", "string"), ("sequence", "string"), ("score", "double"), ("length", "int")]


def read_status_tables(spark: SparkSession, path: str, prefix: str = "full_table_") -> DataFrame:
    """table, pos, busco_id, status, sequence, score, length of every status table under ``path``.

    A table is named by its file, between ``prefix`` and the suffix, so that no file order matters. Lines
    that start with '#' and empty ones are dropped, absent cells are null, ``pos`` is the line's place.
    One file is one row on the way: a table has one line per gene of a lineage.
    """
    whole = spark.read.text(path, wholetext=True).select(file_name().alias("file"), "value")
    name = F.regexp_replace(F.regexp_replace("file", r"\.[^.]*$", ""), f"^{prefix}", "")
    lines = whole.select(name.alias("table"), F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line")).where("line <> '' AND NOT startswith(line, '#')")
    cell = lambda i, kind: F.nullif(F.get(F.split("line", "\t"), F.lit(i)), F.lit("")).cast(kind)
    return lines.select("table", F.col("pos").cast("long").alias("pos"), *[cell(i, k).alias(n) for i, (n, k) in enumerate(STATUS_COLUMNS)])


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, key: str = "rowid", parts: int = 8) -> DataFrame:
    """A table of a local SQLite file, by ranges of its integer ``key``; the file is shipped to the executors.

    ``schema`` names the columns read. The file is opened read-only and is as large as one node's disk
    allows; to_parquet() converts it once.
    """
    import os
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        low, high = db.execute(f'SELECT min({key}), max({key}) FROM "{table}"').fetchone()
    spark.sparkContext.addFile(path)
    base, arrow = os.path.basename(path), spark.createDataFrame([], schema)
    names = arrow.columns
    if low is None:
        return arrow
    step = -(-(high - low + 1) // parts)
    ranges = spark.range(0, parts, 1, parts).select((F.col("id") * step + low).alias("a"), (F.col("id") * step + low + step).alias("z"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        with sqlite3.connect(f"file:{SparkFiles.get(base)}?mode=ro", uri=True) as db:
            for b in it:
                for a, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    rows = db.execute(f"""SELECT {", ".join(f'"{n}"' for n in names)} FROM "{table}" WHERE {key} >= ? AND {key} < ?""", (a, z))
                    while part := rows.fetchmany(10_000):
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in part], schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(arrow.schema)
    return ranges.mapInArrow(run, arrow.schema)


def to_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write once, read from then on."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches ``path``, in whatever store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def require_database(spark: SparkSession, path: str, what: str) -> str:
    """The path itself; raises where the database is not there, instead of going on without it."""
    if not path or not exists(spark, path):
        raise FileNotFoundError(f"{what}: no database at {path!r}")
    return path


def seeds(df: DataFrame, id_col: str, seq_col: str, k: int) -> DataFrame:
    """(seed, id, pos) of all k-mers of a sequence column, upper case, from 0."""
    return df.select(F.posexplode(kmers(F.upper(seq_col), k)).alias("pos", "seed"), F.col(id_col).alias("id")).select("seed", "id", "pos")


def seed_index(refs: DataFrame, path: str, k: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """The seed table of ``refs``, built once at ``path`` and read again as long as it was made for the same rows and k.

    The mark beside it is a digest of k and of the rows' hashes, made by one aggregate; an index without a
    mark, or with another one, is built anew. Rows are laid out by seed, so that a join reads ranges.
    """
    spark = refs.sparkSession
    h = F.xxhash64(F.col(id_col).cast("string"), F.col(seq_col))
    sums = refs.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    mark = hashlib.sha256(json.dumps([k, *map(str, sums)]).encode()).hexdigest()
    if not exists(spark, f"{path}/made-{mark}/_SUCCESS"):
        seeds(refs, id_col, seq_col, k).repartitionByRange("seed").sortWithinPartitions("seed").write.mode("overwrite").parquet(f"{path}/made-{mark}")
    return spark.read.parquet(f"{path}/made-{mark}")
