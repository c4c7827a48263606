"""Exact-N grouping of a stream: a group leaves as soon as its key has n items."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seqloom.operators.shuffle import checkpoint_dir


def group_exact_n_stream(df: DataFrame, key: str, item: Column, n: int) -> DataFrame:
    """(key, items) each time a key has n new items; fewer wait in the state and are never emitted.

    A key holds fewer than n items at any time, however many a micro-batch brings.
    """

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        for pdf in batches:
            held += pdf["item"].tolist()
            full = [held[i:i + n] for i in range(0, len(held) - n + 1, n)]
            held = held[len(full) * n:]
            if full:
                yield pd.DataFrame({"key": [name[0]] * len(full), "items": [sorted(g) for g in full]})
        state.update((held,))

    rows = df.select(F.col(key).cast("string").alias("key"), item.cast("string").alias("item"))
    return rows.groupBy("key").applyInPandasWithState(step, "key string, items array<string>", "held array<string>", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Run a stream over all that its source holds now, into Parquet in the shared folder."""
    spark = stream.sparkSession
    base = path or f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    done = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/rows")
    done.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
