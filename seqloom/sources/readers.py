"""Scans of the domain's files with declared schemas; nulls are normalised here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from seqloom.operators.relational import require_rows


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description, seq, source_file of every record; wrapped sequences are joined."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>|\n+$", "").alias("rec"), F.col("_metadata.file_name").alias("source_file"))
    head = F.substring_index("rec", "\n", 1)
    seq = F.when(F.instr("rec", "\n") > 0, F.regexp_replace(F.expr("substring(rec, instr(rec, '\\n') + 1)"), r"\s", "")).otherwise("")
    return rows.where("rec <> ''").select(F.split_part(head, F.lit(" "), F.lit(1)).alias("id"), F.regexp_extract(head, r"^\S+\s+(.*)$", 1).alias("description"), seq.alias("seq"), "source_file")


def write_fasta(df: DataFrame, path: str) -> None:
    """>id and sequence; always written, even if empty."""
    df.select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").text(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tab-separated, '#' comment lines dropped, '.' read as null."""
    return spark.read.csv(path, sep="\t", comment="#", schema=schema, nullValue=".")


#: sample, mate: a mate is 1 or 2, alone or after R, before the suffixes; a chunk number may follow.
MATE_NAME = r"^(.+?)[._][Rr]?([12])(?:_[0-9]{3})?(?:\.[A-Za-z0-9]+)+$"


def read_file_pairs(spark: SparkSession, path: str, arity: int | None = 2) -> DataFrame:
    """sample_id and its files by mate, from names such as x_1.fq, x.R2.fastq.gz or x_R1_001.fastq.gz.

    A file whose name has no mate raises, and so does a sample with another number of files than
    ``arity``, or with a mate twice; with arity None samples may have any files. Only names are read;
    files without content do not count, as Spark lists none.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    files = files.select("path", F.regexp_extract(name, MATE_NAME, 1).alias("sample_id"), F.regexp_extract(name, MATE_NAME, 2).alias("mate"))
    if arity is None:
        files = files.withColumn("sample_id", F.when(F.col("sample_id") == "", F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1)).otherwise(F.col("sample_id")))
    out = files.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("mate", "path"))).alias("f"))  # a sample's files
    if arity is not None:
        fits = (F.col("sample_id") != "") & (F.size("f") == arity) & (F.size(F.array_distinct("f.mate")) == arity)
        wrong = out.where(~fits).select("sample_id", "f.path").limit(5).collect()
        if wrong:
            raise ValueError("not a set of %d mates: %s" % (arity, "; ".join(f"{r[0] or 'no mate in the name'}: {', '.join(r[1])}" for r in wrong)))
        require_rows(out, path)
    return out.select("sample_id", F.col("f.path").alias("files"))


def manifest(lines: DataFrame) -> DataFrame:
    """section, name, url of a ';' manifest given as (line_no, line); a name with several rows resolves to null.

    One task carries the section down the lines: a manifest is a hand-written file of some hundred lines.
    """
    w = Window.orderBy("line_no")
    rows = lines.withColumn("section", F.last(F.when(F.col("line").startswith("##"), F.regexp_replace("line", "^#+", "")), True).over(w)).where("line LIKE '%;%'")
    parts = F.split("line", ";")
    rows = rows.select("section", parts[0].alias("name"), F.element_at(parts, -1).alias("url"))
    once = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(once, "name").select("section", "name", F.when(F.col("n") == 1, F.col("url")).alias("url"))


class _Fastq(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [InputPartition(p) for p in self.paths]

    def read(self, partition):
        import io
        from itertools import islice

        import pyarrow as pa
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(partition.value)
        with store.open_input_stream(name) as raw, io.TextIOWrapper(io.BufferedReader(raw, 1 << 20), "utf-8") as f:  # gz by its suffix
            no, text = 0, pa.string()
            while lines := list(islice(f, 4 * 10_000)):  # an Arrow batch at a time
                if len(lines) % 4:
                    raise ValueError(f"{partition.value} ends within a record")
                n = len(lines) // 4
                ids = [head[1:].split(None, 1)[0] if len(head) > 2 else "" for head in lines[::4]]
                cols = [pa.array(range(no, no + n), pa.int64()), pa.array(ids, text), pa.array([x.rstrip("\r\n") for x in lines[1::4]], text), pa.array([x.rstrip("\r\n") for x in lines[3::4]], text), pa.array([partition.value] * n, text)]
                yield pa.RecordBatch.from_arrays(cols, ["pair_no", "read_id", "seq", "qual", "path"])
                no += n


class FastqSource(DataSource):
    """FASTQ, gz or plain, four lines a record: a '@' that starts a quality line is no header."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "pair_no bigint, read_id string, seq string, qual string, path string"

    def reader(self, schema):
        import os
        from fnmatch import fnmatch

        from pyarrow import fs

        # Any store that Arrow knows: a local path, file://, hdfs://, s3://, gs://; a pattern in the last part.
        path = self.options["path"]
        folder, _, pattern = (path if "://" in path or path.startswith("file:") else os.path.abspath(path)).rpartition("/")
        store, inside = fs.FileSystem.from_uri(folder)
        files = store.get_file_info(fs.FileSelector(inside))
        return _Fastq(sorted(f"{folder}/{f.base_name}" for f in files if f.is_file and fnmatch(f.base_name, pattern)))
