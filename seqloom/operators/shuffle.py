"""Cutting lineage and joining on keys that may be hot."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder spark.checkpoint.dir names; one of our own only where it is unset and driver and
    executors are one process (tests). On a cluster an unset folder raises."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="seqloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, read from a reliable checkpoint: they survive the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def dealt_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join in which both sides are dealt by a hash of the key, so that the adaptive skew join
    may split a hot key although one side has just been aggregated by it."""
    other = right.withColumnRenamed(key, "_key").withColumn("_right", F.xxhash64("_key"))
    return left.withColumn("_left", F.xxhash64(key)).join(other, (F.col("_left") == F.col("_right")) & (F.col(key) == F.col("_key"))).drop("_left", "_right", "_key")
