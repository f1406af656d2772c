"""File sources used by stages: JSON lines (Parquet/ORC go through ``spark.read`` or a remote stage)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines, compressed or not (the codec follows the file suffix).

    Give a schema for anything large: inference reads the input an extra time.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)

