"""SQL stages: any Spark SQL over the catalog and the views of earlier stages."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def sql_stage(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Run one SQL stage.

    ``params`` binds named parameter markers (``:dt_start``) in the text, so a
    run's time range or a stage's own arguments reach the query as typed
    literals that Catalyst can push into the scan - never by string splicing.
    """
    if params:
        return spark.sql(text, args=dict(params))
    return spark.sql(text)


def time_range_params(dt_start, dt_end) -> dict[str, Any]:
    """Named parameters for a run restricted to ``[dt_start, dt_end)``."""
    if dt_start is not None and dt_end is not None and dt_start >= dt_end:
        raise ValueError(f"empty time range [{dt_start}, {dt_end})")
    params: dict[str, Any] = {}
    if dt_start is not None:
        params["dt_start"] = dt_start
    if dt_end is not None:
        params["dt_end"] = dt_end
    return params
