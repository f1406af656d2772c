"""Time buckets and value bins used by stage queries.

Buckets are computed with integer arithmetic on epoch seconds
(``e - pmod(e, w)``), which is the floor for negative times too; bins round
half up, as Spark's ``round`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_of(ts: Column | str) -> Column:
    """Epoch seconds of a timestamp (with or without time zone), floored."""
    col = F.col(ts) if isinstance(ts, str) else ts
    # unix_timestamp truncates towards zero, which is one too much for part seconds before 1970
    before = F.when(
        F.typeof(col) == F.lit("timestamp_ntz"),
        col.cast("timestamp_ntz") < F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    ).otherwise(col.cast("timestamp") < F.timestamp_seconds(F.lit(0)))
    part = F.date_part(F.lit("SECOND"), col) % F.lit(1) != F.lit(0)
    return F.unix_timestamp(col) - (before & part).cast("long")


def bucket_of_epoch(epoch: Column | str, seconds: int) -> Column:
    """Start (epoch seconds, long) of the ``seconds``-wide bucket of an epoch value."""
    if seconds <= 0:
        raise ValueError("bucket width must be positive")
    col = F.col(epoch) if isinstance(epoch, str) else epoch
    whole = F.floor(col).cast("long")
    return whole - F.pmod(whole, F.lit(seconds).cast("long"))


def bucket_epoch(ts: Column | str, seconds: int) -> Column:
    """Start (epoch seconds, long) of the tumbling bucket holding timestamp ``ts``."""
    if seconds <= 0:
        raise ValueError("bucket width must be positive")
    e = epoch_of(ts)
    return e - F.pmod(e, F.lit(seconds).cast("long"))


def bucket_timestamp(ts: Column | str, seconds: int) -> Column:
    """The bucket start as a timestamp."""
    return F.timestamp_seconds(bucket_epoch(ts, seconds))


def metric_bucket(ts: Column | str, metric) -> Column:
    """Bucket by the metric's own ``time_window``."""
    return bucket_epoch(ts, int(metric.time_window))


def value_bin(x: Column | str, width: float = 1.0) -> Column:
    """Centre of the ``width``-wide bin of ``x`` (round half up)."""
    if width <= 0:
        raise ValueError("bin width must be positive")
    col = F.col(x) if isinstance(x, str) else x
    if width == 1:
        return F.round(col)
    return F.round(col / F.lit(width)) * F.lit(width)

