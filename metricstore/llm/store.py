"""Written intermediate tables below the shared checkpoint folder, and settings of jobs that run Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metricstore.plans.scratch import scratch_path
from metricstore.sinks.store import session_settings

#: Texts reach Python tasks in Arrow batches; small ones keep both sides' buffers small.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def stored(df: DataFrame, name: str, options: dict | None = None, batches: dict | None = None) -> DataFrame:
    """Write ``df`` once and read it back: the lineage ends, every later read sees the same rows.

    The write runs with small Arrow batches, or with the settings ``batches``; the session's settings stay as they were.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    with session_settings(spark, {**SMALL_BATCHES, **(batches or {})}):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """For jobs that own their session: small Arrow batches also where results are computed later."""
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)
