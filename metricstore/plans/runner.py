"""Run metric definitions: stages in order, records into the store.

Every stage yields a DataFrame (SQL, remote query, or Python); its output kind
decides what happens to it: a temp view for later stages, a written table
plus view (cached view), or the metric store.  A store stage is the record
projection over the stage plan followed by one write, so each store stage's
query runs exactly once.

Store stages are written together: the record frames of a metric's store
stages, or with ``run_all`` of many metrics, are combined with ``unionByName``
into one write.  A metric is never split across writes, so replacing partitions
keeps all it produces.  If a shared write fails, its metrics are written one by
one, and only those that fail by themselves are reported failed.  With a store
and a table, the union is written once below ``spark.checkpoint.dir`` and both
are filled from there, so they hold the same records.

What a write produced is observed while it runs, so nothing that could fail
follows it.  ``run_log`` adds atomic publication (``sinks.runlog``): a write's
records count, in store and table alike, once the run's commit is in the log.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.operators.envelope import ComputeStamp, to_envelope
from metricstore.plans.spec import MetricSpec, OutputKind, StageKind, StageSpec
from metricstore.plans.scratch import scratch_path
from metricstore.sinks.observe import MARKER
from metricstore.sinks.runlog import Commit, log_path, writes_in
from metricstore.sinks.store import write_store
from metricstore.sinks.tables import cached_view, table_name, temp_view, write_table
from metricstore.sources.python_stage import StageContext, python_stage
from metricstore.sources.remote import remote_query
from metricstore.sources.sql import sql_stage
from metricstore.sources.store import stored_files

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("metric_id", T.StringType()),
        T.StructField("stage_id", T.StringType()),
        T.StructField("stage_kind", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class StageOutcome:
    metric_id: str
    stage_id: str
    stage_kind: str
    output: str
    status: str  # ok | failed | skipped
    rows: int | None = None
    seconds: float | None = None
    error: str | None = None
    partitions: tuple[dict, ...] = ()


@dataclass
class RunResult:
    compute_time: int
    outcomes: list[StageOutcome] = field(default_factory=list)

    def partitions(self) -> dict[str, list[dict]]:
        """Partition tuples written (to the store, else to the table) per store stage id."""
        return {
            o.stage_id: list(o.partitions)
            for o in self.outcomes
            if o.output == OutputKind.STORE.value and o.status == "ok"
        }

    @property
    def ok(self) -> bool:
        return all(o.status == "ok" for o in self.outcomes)

    def failed(self) -> list[StageOutcome]:
        return [o for o in self.outcomes if o.status != "ok"]

    def report(self, spark: SparkSession) -> DataFrame:
        """The run report: one row per stage (small, built on the driver)."""
        rows = [
            (o.metric_id, o.stage_id, o.stage_kind, o.output, o.status, o.rows, o.seconds, o.error)
            for o in self.outcomes
        ]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


@dataclass
class _Pending:
    metric: MetricSpec
    stage: StageSpec
    records: DataFrame
    seconds: float


class Runner:
    """Executes definitions against one session and one store.

    ``params`` are named SQL parameters for every SQL stage of the run (for
    example ``dt_start``/``dt_end``); a stage's own ``params`` add to them.
    ``compute_time`` fixes the run's compute stamp (default: now).
    ``spread=n`` repartitions each store stage's result into ``n`` parts
    *before* the record projection (narrow rows shuffle cheaply, records do
    not); only useful when a row-level stage reads a source that yields too
    few splits.  Aggregating stages already end in a shuffle sized by AQE.
    ``run_log`` (``True``: beside the store, or a path) commits each write in a
    log that readers join: a failed or repeated attempt stays invisible, and
    ``overwrite_partitions`` replaces at the commit.  A table copy that fails
    then fails the run.
    """

    def __init__(
        self,
        spark: SparkSession,
        *,
        store_path: str | None = None,
        table: str | None = None,
        table_format: str | None = None,
        cache_database: str = "cache",
        cache_location: str | None = None,
        params: Mapping[str, Any] | None = None,
        compute_time: datetime | int | ComputeStamp | None = None,
        mode: str = "append",
        strict: bool = False,
        max_records_per_file: int | None = None,
        spread: int | None = None,
        store_format: str = "orc",
        run_log: str | bool | None = None,
    ) -> None:
        self.options = {k: v for k, v in locals().items() if k not in ("self", "spark")}
        self.spark = spark
        self.store_path = store_path
        self.table = table
        self.table_format = table_format
        self.cache_database = cache_database
        self.cache_location = cache_location
        self.params = dict(params or {})
        self.compute_time = compute_time
        self.mode = mode
        self.strict = strict
        self.max_records_per_file = max_records_per_file
        self.spread = spread
        self.store_format = store_format
        if run_log is True and store_path is None:
            raise ValueError("without a store, run_log is the path of the log")
        if run_log and table is not None and table_format not in (None, "orc", "parquet"):
            raise ValueError(f"a {table_format} table cannot be read through a run log")
        self.run_log = log_path(store_path) if run_log is True else run_log or None

    # -- single stages ------------------------------------------------------

    def stage_frame(self, metric: MetricSpec, stage: StageSpec, stamp: ComputeStamp) -> DataFrame | None:
        if stage.kind is StageKind.SQL:
            return sql_stage(self.spark, stage.sql, {**self.params, **stage.params})
        if stage.kind is StageKind.REMOTE:
            return remote_query(self.spark, stage.source, stage.sql)
        if stage.kind is StageKind.PYTHON:
            context = StageContext({**self.params, **stage.params}, stamp.epoch, self.store_path)
            return python_stage(
                self.spark, stage.python, stage.python_args, context=context, stage=stage, metric=metric
            )
        raise ValueError(f"unknown stage kind {stage.kind!r}")

    def records(self, metric: MetricSpec, stage: StageSpec, frame: DataFrame, stamp: ComputeStamp) -> DataFrame:
        if self.spread:
            frame = frame.repartition(self.spread)
        return to_envelope(
            frame,
            metric,
            horizontal_level=stage.horizontal_level,
            vertical_level=stage.vertical_level,
            compute_time=stamp,
            strict=self.strict,
            json_columns=stage.json_columns,
        )

    def _output(self, metric, stage, frame, stamp) -> _Pending | None:
        if stage.output is OutputKind.STORE:
            if frame is None:
                raise ValueError(f"{stage.stage_id}: a store stage must produce a DataFrame")
            recs = self.records(metric, stage, frame, stamp)
            if stage.view_name:
                temp_view(frame, stage.view_name)
            return _Pending(metric, stage, recs, 0.0)
        if frame is None:
            return None  # a Python stage that registered its own views
        if stage.output is OutputKind.VIEW:
            if stage.view_name:
                temp_view(frame, stage.view_name)
            return None
        name = stage.cached_view_name or stage.view_name
        cached = cached_view(frame, name, database=self.cache_database, location=self.cache_location,
                             table=table_name(metric.metric_id, name))
        if stage.view_name and stage.view_name != name:
            temp_view(cached, stage.view_name)
        return None

    # -- whole definitions --------------------------------------------------

    def _run_metric(self, metric: MetricSpec, stamp: ComputeStamp, result: RunResult) -> list[_Pending]:
        pending: list[_Pending] = []
        try:
            metric.validate()
        except Exception as exc:  # noqa: BLE001 - reported, run continues
            result.outcomes.append(
                StageOutcome(metric.metric_id, f"{metric.metric_id}/-", "-", "-", "failed", error=str(exc))
            )
            return pending
        failed = False
        for stage in metric.stages:
            base = dict(
                metric_id=metric.metric_id,
                stage_id=stage.stage_id,
                stage_kind=stage.kind.value,
                output=stage.output.value,
            )
            if failed:
                result.outcomes.append(StageOutcome(**base, status="skipped"))
                continue
            started = time.perf_counter()
            try:
                frame = self.stage_frame(metric, stage, stamp)
                later = self._output(metric, stage, frame, stamp)
                seconds = time.perf_counter() - started
                if later is not None:
                    later.seconds = seconds
                    pending.append(later)
                    continue
                result.outcomes.append(StageOutcome(**base, status="ok", seconds=seconds))
            except Exception as exc:  # noqa: BLE001 - reported, run continues
                failed = True
                result.outcomes.append(
                    StageOutcome(
                        **base, status="failed", seconds=time.perf_counter() - started,
                        error=f"{type(exc).__name__}: {exc}",
                    )
                )
        if failed:
            # a later store of this metric must not be written half-way
            for p in pending:
                result.outcomes.append(
                    StageOutcome(p.metric.metric_id, p.stage.stage_id, p.stage.kind.value,
                                 p.stage.output.value, "skipped")
                )
            return []
        return pending

    def plan(self, metrics: MetricSpec | Iterable[MetricSpec]) -> DataFrame:
        """Records the store stages would write, without writing them.

        View and cached-view stages run as usual (later stages need them);
        the records of all store stages come back as one DataFrame, ready to
        ``explain``, check or write elsewhere.  Raises on the first failure.
        """
        if isinstance(metrics, MetricSpec):
            metrics = [metrics]
        stamp = ComputeStamp.for_session(self.spark, self.compute_time)
        result = RunResult(stamp.epoch)
        pending: list[_Pending] = []
        for metric in metrics:
            pending.extend(self._run_metric(metric, stamp, result))
        if result.failed():
            first = result.failed()[0]
            raise RuntimeError(f"{first.stage_id}: {first.error or first.status}")
        if not pending:
            raise ValueError("no store stage to plan")
        return reduce(lambda a, b: a.unionByName(b), [p.records for p in pending])

    def run(self, metric: MetricSpec) -> RunResult:
        """Run one definition; its store stages are written together at the end."""
        return self.run_all([metric])

    def run_all(self, metrics: Iterable[MetricSpec], union_limit: int = 64) -> RunResult:
        """Run many definitions; their store stages are written together.

        A write takes whole metrics, up to ``union_limit`` store stages (one
        metric with more is a write of its own), so no single plan grows
        without bound.  The limit changes only how many jobs there are.
        """
        if union_limit < 1:
            raise ValueError("union_limit must be at least 1")
        metrics = list(metrics)
        ids = [m.metric_id for m in metrics]
        dupes = sorted({i for i in ids if ids.count(i) > 1})
        if dupes:
            raise ValueError(f"duplicate metric ids {dupes}")
        stamp = ComputeStamp.for_session(self.spark, self.compute_time)
        result = RunResult(stamp.epoch)
        batch: list[_Pending] = []
        batches = [batch]
        for metric in metrics:
            pending = self._run_metric(metric, stamp, result)
            if batch and len(batch) + len(pending) > union_limit:
                batch = []
                batches.append(batch)
            batch.extend(pending)
        for batch in batches:
            if batch:
                self._write_batch(batch, stamp, result)
        return result

    def _write_batch(self, batch: list[_Pending], stamp: ComputeStamp, result: RunResult,
                     union: DataFrame | None = None, alone: Callable[[int], list[_Pending]] | None = None) -> None:
        """``union``: the batch's records with their markers, if they come from one plan; ``alone`` gives one's own."""
        started = time.perf_counter()
        try:
            written, parts, table_error = self._write(batch, stamp, union)
        except Exception as exc:  # noqa: BLE001 - reported, run continues
            names = list(dict.fromkeys(p.metric.metric_id for p in batch))
            if len(names) > 1:  # find out which of them fails by itself
                for i, name in enumerate(names):
                    own = alone(i) if alone else [p for p in batch if p.metric.metric_id == name]
                    self._write_batch(own, stamp, result)
                return
            for p in batch:
                result.outcomes.append(
                    StageOutcome(
                        p.metric.metric_id, p.stage.stage_id, p.stage.kind.value, p.stage.output.value,
                        "failed", seconds=p.seconds, error=f"{type(exc).__name__}: {exc}",
                    )
                )
            return
        share = (time.perf_counter() - started) / len(batch)  # the write's time, shared evenly
        for i, p in enumerate(batch):
            result.outcomes.append(
                StageOutcome(
                    p.metric.metric_id, p.stage.stage_id, p.stage.kind.value, p.stage.output.value,
                    "ok", rows=written.counts[i], seconds=p.seconds + share, partitions=parts[i],
                )
            )
        if table_error is not None:  # the store holds the run, the table does not
            for name in dict.fromkeys(p.metric.metric_id for p in batch):
                result.outcomes.append(
                    StageOutcome(name, f"{name}/table", "-", "table", "failed", error=table_error))

    def _write(self, batch: list[_Pending], stamp: ComputeStamp, union: DataFrame | None = None):
        """(observed result, partitions per stage, error of the table copy)."""
        if self.store_path is None and self.table is None:
            raise ValueError("a store stage needs store_path or table")
        if union is None:
            union = reduce(lambda a, b: a.unionByName(b),
                           [p.records.withColumn(MARKER, F.lit(i)) for i, p in enumerate(batch)])
        both = self.store_path is not None and self.table is not None
        if both:
            path = scratch_path(self.spark, "run")
            union.write.parquet(path)
            union = self.spark.read.schema(union.schema).parquet(path)
        ids = sorted({p.metric.metric_id for p in batch})
        commit = Commit(self.spark, self.run_log, self.mode) if self.run_log else None
        mode = "append" if commit else self.mode  # the commit replaces
        error = None
        if self.store_path is not None:
            before = writes_in(self._store_files(ids, stamp)) if commit else set()
            written = write_store(union, self.store_path, mode=mode, markers=len(batch),
                                  max_records_per_file=self.max_records_per_file, fmt=self.store_format)
            if commit and written.rows:
                commit.add("store", self._store_files(ids, stamp), before, stamp.epoch, written.rows)
        if self.table is not None:
            before = writes_in(self._table_files(ids, stamp)) if commit else set()
            try:
                copied = write_table(union, self.table, self.table_format, mode=mode, markers=len(batch))
                if commit and copied.rows:
                    commit.add("table", self._table_files(ids, stamp), before, stamp.epoch, copied.rows)
            except Exception as exc:  # noqa: BLE001 - reported beside the stored stages
                if commit or not both:
                    raise
                error = f"{type(exc).__name__}: {exc}"
            else:
                written = written if both else copied
        if commit:
            commit.publish()
        return written, written.places, error

    def _store_files(self, ids: list[str], stamp: ComputeStamp) -> DataFrame | None:
        return stored_files(self.spark, self.store_path, ids, [stamp.date], self.store_format)

    def _table_files(self, ids: list[str], stamp: ComputeStamp) -> DataFrame | None:
        if not self.spark.catalog.tableExists(self.table):
            return None
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table).where(F.col("id").isin(ids) & (F.col("compute_date") == F.lit(stamp.date)))


def run_definition(spark: SparkSession, metric: MetricSpec, **options: Any) -> RunResult:
    return Runner(spark, **options).run(metric)


def run_all(spark: SparkSession, metrics: Iterable[MetricSpec], **options: Any) -> RunResult:
    return Runner(spark, **options).run_all(metrics)
