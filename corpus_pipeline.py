"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written to
the shared folder before the next reads it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import linededup, mixing, neardup, quality, spm
from seqloom.llm.common import WORD, release, store, written

#: The SentencePiece model; a parameter of the environment that runs the pipeline.
MODEL = os.environ.get("SEQLOOM_SPM_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of policy v1 rejects: null and empty texts go, null ids and repeated rows are judged like any other."""
    packed = docs.select("text", F.struct(*docs.columns).alias("_row"))
    return quality.apply_policy(quality.ledger(packed), "v1").where("kept").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring template lines go from all documents but their first; n_chars follows the text.

    A document that is left without a word holds nothing of its own and goes. Null ids come last, so they
    never keep a passage that a document with an id has; a null text has no lines.
    """
    out = linededup.dedup_lines(docs).select(*docs.columns).where(F.col("text").rlike(WORD))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words, similarity of 0.8 or more.

    The smallest id stays, a null one only where its group has no other; of rows that share an id, each
    group's own stays; repeated rows are one.
    """
    return neardup.keep_first(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a null source is a source, repeated ids share their draw."""
    return mixing.emit(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, copies included."""
    return spm.encode(docs, MODEL, keep=("doc_id", "source", "lang"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup), ("mixing", mix_sources), ("sentencepiece", encode)]

#: SQL cannot express the near-dedup and encoding stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's own tables go once its result is written, and that once the next one's is.

    An empty table passes through every stage and gives no row.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), written()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs)
            release(before, docs)
    return docs
