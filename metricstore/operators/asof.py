"""What was known at a time: an as-of join of rows with stored runs.

Each row asks, for one measurement and one point in time, for the newest run at
or before that time.  Rows and runs are put into one stream per measurement and
sorted by time; a row takes the last run before it.  Only the run's time is
carried there; the records follow by a join on measurement and run.

A measurement that many rows ask for is split: times are cut into ``ranges`` equal
stretches, each sorted by itself, and what was known at its start comes from
the stretches before (a row per measurement and stretch).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricstore.operators.envelope import column


def runs_as_of(rows: DataFrame, runs: DataFrame, keys: Sequence[str], time: str, run_time: str, *, name: str = "run",
               ranges: int = 64) -> DataFrame:
    """``rows`` with the newest ``run_time`` of ``runs`` for the same ``keys`` at or before ``time`` (null if none).

    ``keys`` name columns of both; null keys equal each other.  A null ``time``
    finds nothing.
    """
    if name in rows.columns:
        raise ValueError(f"{name!r} is a column of the rows")
    if ranges < 1:
        raise ValueError("ranges must be at least 1")
    key = F.struct(*[column(k) for k in keys])
    asked = rows.select(key.alias("_key"), column(time).cast("long").alias("_t"), F.lit(1).alias("_side"),
                        F.lit(None).cast("long").alias("_run"), F.struct(*[column(c) for c in rows.columns]).alias("_row"))
    known = runs.select(key.alias("_key"), column(run_time).cast("long").alias("_t")).where("_t is not null").distinct()
    ends = known.agg(F.min("_t"), F.max("_t")).first()
    low, high = (ends[0], ends[1]) if ends[0] is not None else (0, 0)
    width = (high - low) // ranges + 1
    stream = known.select("_key", "_t", F.lit(0).alias("_side"), F.col("_t").alias("_run"),
                          F.lit(None).cast(asked.schema["_row"].dataType).alias("_row")).unionAll(asked)
    # Before the first run nothing is known, after the last one nothing changes; without a time nothing is asked.
    place = F.floor((F.greatest(F.lit(low - 1), F.least(F.lit(high), F.col("_t"))) - low) / width)
    stream = stream.withColumn("_part", F.coalesce(place, F.lit(-1)).cast("long"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stream.groupBy("_key", "_part").agg(F.max("_run").alias("_last")).withColumn("_known", F.max("_last").over(before))
    inside = Window.partitionBy("_key", "_part").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = stream.withColumn("_met", F.last("_run", ignorenulls=True).over(inside)).where("_side = 1")
    starts = starts.select(F.col("_key").alias("_k"), F.col("_part").alias("_p"), "_known")
    out = met.join(starts, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p")))
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_met", "_known"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in rows.columns], found.alias(name))


def read_as_of(records: DataFrame, rows: DataFrame, on: Mapping[str, Column], time: str = "as_of", *,
               columns: Mapping[str, Column], how: str = "left", ranges: int = 64) -> DataFrame:
    """``rows`` with ``columns`` (names to expressions over records) of the run that was the newest at ``time``.

    ``on``: names of ``rows`` to expressions over ``records`` that together tell a
    measurement.  All records of the run that fit are returned; a row without a
    run has nulls (``how="inner"``: is left out).  The run's time is ``compute_time``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    clash = {*columns, "compute_time"} & set(rows.columns)
    if clash:
        raise ValueError(f"{sorted(clash)} are columns of the rows already")
    keys = list(on)
    stored = records.select(*[e.alias(f"_on_{k}") for k, e in on.items()], F.col("compute_time").alias("_at"),
                            *[e.alias(c) for c, e in columns.items()])
    runs = stored.select(*[F.col(f"_on_{k}").alias(k) for k in keys], "_at")
    found = runs_as_of(rows, runs, keys, time, "_at", name="compute_time", ranges=ranges)
    same = F.col("compute_time") == F.col("_at")
    for k in keys:
        same = same & column(k).eqNullSafe(F.col(f"_on_{k}"))
    return found.join(stored, same, how).select(*[column(c) for c in found.columns], *[column(c) for c in columns])
