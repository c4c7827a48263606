"""Stages of a run as tables: written once, read again by a run that resumes with the same inputs and parameters."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.shuffle import cut
from seqloom.sources.files import exists


def digest(df: DataFrame | None) -> list[str]:
    """What a frame holds, whatever its order: its schema, row count and two sums over row hashes; one aggregate."""
    if df is None:
        return []
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return [df.schema.simpleString(), *map(str, df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())]


class Stages:
    """Stage outputs under ``folder``; without one, stages are reliable checkpoints and nothing is kept.

    A stage's table is named by a mark of the run's inputs and parameters. It is used again only if it was
    written to its end, so an aborted run resumes with the first unfinished stage.
    """

    def __init__(self, folder: str, inputs: list, resume: bool):
        self.folder, self.resume, self.reused = folder, resume, []
        self.mark = hashlib.sha256(json.dumps(inputs, default=str).encode()).hexdigest()[:24]

    def __call__(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.folder:
            return cut(build())
        path = f"{self.folder}/{name}-{self.mark}"
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        if self.resume and exists(spark, f"{path}/_SUCCESS"):
            self.reused.append(name)
            return spark.read.parquet(path)
        df = build()
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
