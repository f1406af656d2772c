"""Incremental runs: only the time buckets that are missing or still open are computed.

A run over ``[start, end)`` with a ``lookback`` (how late data may arrive) wants
every bucket of the metric's ``time_window`` in the range.  A bucket is closed once
a run has covered it whose end lies at least ``lookback`` behind the bucket; until
then every run computes it again.  What runs covered is kept beside the store
(``_covered``), one row per metric and run, so buckets without any data are not
computed again either.  Buckets that hold records but that no run covered (stored
by plain runs) count as closed.

Wanted buckets come from a sequence, less the closed ones (an anti join).  Runs of
neighbouring buckets become time ranges, found by two anti joins; each range is
one pass of the metric's stages with ``dt_start`` and ``dt_end`` bound, so the
source is read for these ranges alone.  Beyond ``most_ranges`` one range spans all;
records of buckets that were not wanted are dropped either way, so the result does
not depend on it.

Reading with ``latest=True`` gives each bucket's newest computation.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.operators.envelope import ComputeStamp
from metricstore.plans.scratch import scratch_path
from metricstore.plans.runner import RunResult, Runner, StageOutcome
from metricstore.plans.spec import MetricSpec
from metricstore.sources.store import read_metrics

COVERED_FOLDER = "_covered"
COVERED = "id string, version string, seconds long, start long, closed long, `end` long, compute_time long"


def expected_buckets(spark: SparkSession, start: int, end: int, seconds: int) -> DataFrame:
    """(measure_time) of every bucket that touches ``[start, end)``."""
    return spark.range(start // seconds * seconds, end, seconds).select(F.col("id").alias("measure_time"))


def _bucket(seconds: int):
    return (F.floor(F.col("measure_time") / seconds) * seconds).cast("long")


def covered_ranges(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.schema(COVERED).parquet(f"{store.rstrip('/')}/{COVERED_FOLDER}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _covered_buckets(ranges: DataFrame, first: str, last: str, seconds: int) -> DataFrame:
    some = ranges.where(F.col(first) < F.col(last))
    return some.select(F.explode(F.sequence(F.col(first), F.col(last) - F.lit(seconds), F.lit(seconds))).alias("measure_time"))


def missing_buckets(spark: SparkSession, metric: MetricSpec, start: int, end: int, *, held: DataFrame | None = None,
                    ranges: DataFrame | None = None) -> DataFrame:
    """(measure_time) of the buckets of ``[start, end)`` that are not closed.

    ``held``: stored records; ``ranges``: what runs covered.
    """
    seconds = metric.time_window
    wanted = expected_buckets(spark, start, end, seconds)
    closed = opened = None
    if ranges is not None:
        own = ranges.where((F.col("id") == F.lit(metric.metric_id)) & F.col("version").eqNullSafe(F.lit(_version(metric)))
                           & (F.col("seconds") == F.lit(seconds)))
        closed = _covered_buckets(own, "start", "closed", seconds)
        opened = _covered_buckets(own, "start", "end", seconds)
    if held is not None:
        stored = held.where((F.col("id") == F.lit(metric.metric_id)) & F.col("version").eqNullSafe(F.lit(_version(metric))))
        stored = stored.where(F.col("measure_time").between(start // seconds * seconds, end - 1)).select(
            _bucket(seconds).alias("measure_time")).distinct()
        if opened is not None:
            stored = stored.join(opened, "measure_time", "left_anti")
        closed = stored if closed is None else closed.unionAll(stored)
    return wanted if closed is None else wanted.join(closed.distinct(), "measure_time", "left_anti")


def bucket_ranges(missing: DataFrame, seconds: int, most_ranges: int) -> list[tuple[int, int]]:
    """Half-open time ranges over the buckets, one per run of neighbours; one over all beyond ``most_ranges``."""
    first = missing.join(missing.select((F.col("measure_time") + seconds).alias("measure_time")), "measure_time", "left_anti")
    last = missing.join(missing.select((F.col("measure_time") - seconds).alias("measure_time")), "measure_time", "left_anti")
    starts = [r[0] for r in first.orderBy("measure_time").limit(most_ranges + 1).collect()]
    if len(starts) <= most_ranges:
        ends = [r[0] for r in last.orderBy("measure_time").limit(most_ranges + 1).collect()]
        return [(s, e + seconds) for s, e in zip(starts, ends)]
    span = missing.agg(F.min("measure_time"), F.max("measure_time")).first()
    return [(span[0], span[1] + seconds)]


def _version(metric: MetricSpec) -> str | None:
    return None if metric.version is None else str(metric.version)


def _epoch(when: datetime | int) -> int:
    if isinstance(when, int):
        return when
    return int((when if when.tzinfo else when.replace(tzinfo=timezone.utc)).timestamp())


def _text(epoch: int) -> str:
    return datetime.fromtimestamp(epoch, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def run_incremental(runner: Runner, metrics: MetricSpec | Iterable[MetricSpec], start: datetime | int, end: datetime | int,
                    *, lookback: int = 0, most_ranges: int = 8) -> RunResult:
    """Compute the buckets of ``[start, end)`` that the runner's store lacks, and record what was covered.

    Stages get ``dt_start`` and ``dt_end`` (UTC, as text) as named parameters, for
    each range of buckets, and should filter their source by them.  ``end`` is
    floored to whole buckets: a bucket that has not ended is left to a later
    run.  A metric without a missing bucket is reported ``ok`` with 0 rows.
    """
    if runner.store_path is None:
        raise ValueError("an incremental run needs a store")
    if lookback < 0 or most_ranges < 1:
        raise ValueError("lookback must not be negative, most_ranges at least 1")
    if runner.mode != "append":
        raise ValueError("an incremental run appends: other buckets of its partitions must stay")
    metrics = [metrics] if isinstance(metrics, MetricSpec) else list(metrics)
    spark, store = runner.spark, runner.store_path
    stamp = ComputeStamp.for_session(spark, runner.compute_time)
    result = RunResult(stamp.epoch)
    pending, covered = [], {}
    ranges = covered_ranges(spark, store)
    for metric in metrics:
        seconds = metric.time_window
        if not seconds or seconds < 1:
            raise ValueError(f"{metric.metric_id}: an incremental metric needs a time_window of at least a second")
        low, high = _epoch(start) // seconds * seconds, _epoch(end) // seconds * seconds
        try:
            held = read_metrics(spark, store, ids=[metric.metric_id], fmt=runner.store_format, run_log=runner.run_log)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            held = None
        path = scratch_path(spark, "missing-buckets")
        missing_buckets(spark, metric, low, high, held=held, ranges=ranges).write.parquet(path)
        missing = spark.read.schema("measure_time long").parquet(path)
        spans = bucket_ranges(missing, seconds, most_ranges) if low < high else []
        if not spans:
            result.outcomes.append(StageOutcome(metric.metric_id, f"{metric.metric_id}/-", "-", "-", "ok", rows=0))
            continue
        pieces: dict[str, list] = {}
        failed = False
        for first, last in spans:
            part = Runner(spark, **{**runner.options, "params": {**runner.params, "dt_start": _text(first), "dt_end": _text(last)}})
            found = part._run_metric(metric, stamp, result)
            failed = failed or any(o.metric_id == metric.metric_id and o.status == "failed" for o in result.outcomes)
            for p in found:
                pieces.setdefault(p.stage.stage_id, []).append(p)
        if failed:
            continue
        for parts in pieces.values():
            records = reduce(lambda a, b: a.unionByName(b), [p.records for p in parts])
            wanted = missing.select(F.col("measure_time").alias("_bucket"))
            records = records.join(wanted, _bucket(seconds) == F.col("_bucket"), "left_semi")
            pending.append(replace(parts[0], records=records, seconds=sum(p.seconds for p in parts)))
        covered[metric.metric_id] = (metric.metric_id, _version(metric), seconds, low,
                                     max(low, min(high, (_epoch(end) - lookback) // seconds * seconds)), high, stamp.epoch)
    if pending:
        runner._write_batch(pending, stamp, result)
    done = [row for name, row in covered.items()
            if all(o.status == "ok" for o in result.outcomes if o.metric_id == name)]
    if done:
        spark.createDataFrame(done, COVERED).coalesce(1).write.mode("append").parquet(f"{store.rstrip('/')}/{COVERED_FOLDER}")
    return result
