"""Metric records from a streaming DataFrame into a store.

The record projection is stateless, so it applies unchanged to a stream:
event-time metrics are the user's windowed aggregation (with a watermark, so
state is bounded and late rows are dropped once their window is final);
records are appended by the file sink, whose commit log makes each micro-batch
land exactly once.  The compute stamp is the micro-batch time.

Readers of a streaming store only see committed files (the sink's
``_spark_metadata`` log), so keep streaming and batch stores in separate
folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from metricstore.operators.envelope import PARTITION_COLUMNS, to_envelope


def stream_records(
    df: DataFrame,
    metric,
    *,
    horizontal_level: int | str = 0,
    vertical_level: int | str = 0,
    json_columns: Iterable[str] = (),
) -> DataFrame:
    if not df.isStreaming:
        raise ValueError("stream_records expects a streaming DataFrame")
    return to_envelope(
        df, metric, horizontal_level=horizontal_level, vertical_level=vertical_level,
        json_columns=json_columns,
    )


def store_stream(
    df: DataFrame,
    metric,
    path: str,
    *,
    checkpoint: str | None = None,
    horizontal_level: int | str = 0,
    vertical_level: int | str = 0,
    json_columns: Iterable[str] = (),
    trigger: dict | None = None,
    fmt: str = "orc",
    query_name: str | None = None,
) -> StreamingQuery:
    """Start appending the records of a streaming stage to the store at ``path``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "1 minute"}`` or ``{"availableNow": True}``).  The
    checkpoint defaults to a folder of this metric beside the store's data
    (``<path>/_checkpoints/<metric>``, which readers skip), so a restarted
    stream goes on where it stopped.
    """
    records = stream_records(
        df, metric, horizontal_level=horizontal_level, vertical_level=vertical_level,
        json_columns=json_columns,
    )
    checkpoint = checkpoint or f"{path.rstrip('/')}/_checkpoints/{quote(metric.metric_id, safe='')}"
    writer = (
        records.writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start(path)
