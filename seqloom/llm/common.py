"""Shared pieces: the written-table cut of lineage, distributed components, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: spark.checkpoint.dir, or one of our own where that is unset and
    driver and executors are one process (tests). On a cluster an unset folder raises."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        conf = "file://" + tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: Tables written by store() and not deleted yet: path and session.
_written: dict[str, SparkSession] = {}


def store(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that survive any executor.

    The files go with discard() or release(), or when the driver exits. The job's shuffle files are of
    no more use; Spark deletes them once the driver's JVM has collected the job's objects, so it is asked to.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/seqloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark._jvm.System.gc()
    p, fs = _fs(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    _written[path] = spark
    return out


def _delete(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is not None:
        p, fs = _fs(spark, path)
        fs.delete(p, True)


def discard(df: DataFrame) -> None:
    """Delete what store() wrote for df, once nothing reads it any more."""
    _delete(df._stored_at)


def written() -> set[str]:
    """The tables that store() has written so far: what release() takes as ``before``."""
    return set(_written)


def release(before: set[str], *keep: DataFrame) -> None:
    """Delete all tables written since ``before`` but those of ``keep``: an operator's own, once its result is stored."""
    for path in set(_written) - before - {k._stored_at for k in keep}:
        _delete(path)


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes in one column, so that what Python builds from
    them stays bounded; a longer text is a run of its own."""
    at, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if i > at and held + n > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n + 64
    if at < batch.num_rows:
        yield batch.slice(at)


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows known to the driver, as a JVM-side local relation."""
    kinds = [c.rsplit(" ", 1) for c in schema.split(", ")]
    lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v) + ("D" if isinstance(v, float) else "")
    values = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    names = ", ".join(f"c{i}" for i in range(len(kinds)))
    cols = ", ".join(f"cast(c{i} AS {k}) AS {n}" for i, (n, k) in enumerate(kinds))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({names})" + ("" if rows else " WHERE false"))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose two sides are always dealt anew on a hash of the keys, so that the adaptive
    skew join may split a hot key even where a side has just been aggregated by it."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    right = right.withColumn("_rh", F.xxhash64(*[F.col(f"_r_{k}") for k in keys]))
    left = left.withColumn("_lh", F.xxhash64(*keys))
    on = F.col("_lh") == F.col("_rh")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(right, on, how).drop("_lh", "_rh", *[f"_r_{k}" for k in keys])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable, for every node that is not itself the smallest.

    ``edges`` has columns ``src`` and ``dst`` of one orderable type; nulls and loops are ignored.
    Alternating large-star and small-star rounds (Kiveris et al. 2014), each written to the shared
    folder; hubs are joined with skew handling and never gathered in one task. Returns
    ``(node, component)``; nodes that are their own component have no row.
    """
    e = store(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            skew_join(both, low, ["u"]).where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = skew_join(large, low, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = store(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        discard(e)
        e, before = new, seen
        seen = mark(e)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
