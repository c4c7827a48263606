"""The thin opN_ queries: production parameters, whole tables, digest columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collide, linededup, mixing, neardup, quality, secrets, shards, spm, suffix, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = neardup.fingerprints(_table(spark, sf_dir, "documents"), words=3, seeds=(42,))
    out = neardup.components(fps, bits=64, radius=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"), cap=3.0, weights=(1, 2, 3))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: The rule set of the query: action, host, path prefix.
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urls.judge(_table(spark, sf_dir, "pages"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(secrets.joined("base").cast("binary"), 256).alias("base_sha256"), secrets.joined("all").alias("spans"))


def op6_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collide.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")


def op8_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.kd_shards(_table(spark, sf_dir, "documents"), n_shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: A parameter: the model file, read on the driver.
SPM_MODEL = os.environ.get("SEQLOOM_SPM_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode(_table(spark, sf_dir, "documents"), SPM_MODEL).select("doc_id", "n_tokens", "ids_sha256", "decoded_ok", "parity")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.apply_policy(quality.ledger(_table(spark, sf_dir, "documents").select("doc_id", "text")), "v1")
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.mask("base"))) != 0
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}
