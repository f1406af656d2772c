"""The corpus pipeline: five stages from raw documents to token ids.

Each stage is a function of (spark, docs, sf_dir) that works on all rows its
predecessor kept; its result is written and read again as the next stage's
documents.  All but the last return the columns of their input.

1. language_id: profiles learned from the rows with a language; rows whose
   language can't be told (no letter, or too far from every profile) go; if no
   row has a language, all stay;
2. near_dedup: one document of each group of near-duplicates stays;
3. decontamination: documents that hold a window of a benchmark item go;
4. source_mixing: sources are mixed to target weights; a document taken more
   than once appears as often;
5. token_output: the token store is written and read back; a row per document
   with its place and its ids' checksum.

An empty table passes through every stage.  SQL can't express the stages'
models and tokenizer, so ORACLE_SQL is None; tests compare the stages with
plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.llm import decontam, langid, mixing, neardup, token_store
from metricstore.llm.store import small_batches
from metricstore.plans.scratch import scratch_path

#: Documents whose ranks share less than this with the nearest profile are rejected.
LEAST_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    profiles = langid.learn_profiles(docs)
    if not profiles:
        return docs
    out, found = langid.identify(docs, profiles)
    keep = (F.col(found)["lang"] != langid.UND) & (F.col(found)["score"] >= LEAST_LANGUAGE_SCORE)
    return out.where(keep).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontam.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    path = scratch_path(spark, "llm/pipeline-tokens")
    token_store.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, path, payload=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; each result is written below spark.checkpoint.dir and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"llm/pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
