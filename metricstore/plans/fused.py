"""Several metrics over one source from one scan and one shuffle.

Each metric aggregates the rows of the same source by its own time buckets,
groups and condition.  Run one by one, each scans the source again.  Here every
row is expanded to the metrics whose condition it fulfils, all of them are
aggregated together (by metric, bucket and the groups the metric has, the others
being null), and each resulting row becomes a record of its metric: one scan,
one partial aggregation, one shuffle of partial results, one write.

A measure is computed once however many metrics have it; in the rows of other
metrics its result is not evaluated.  Aggregation buffers hold every measure, so
metrics that share measures gain most; a metric with a condition adds a row only
where it holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.operators.envelope import MANAGED_COLUMNS, ComputeStamp, column, envelope_columns, epoch_seconds
from metricstore.plans.runner import RunResult, Runner, _Pending
from metricstore.plans.spec import MetricSpec, OutputKind, StageKind, StageSpec
from metricstore.sinks.observe import MARKER


@dataclass(frozen=True)
class AggregateMetric:
    """A metric that aggregates a source's rows: everything is SQL text over the source's columns.

    ``groups``: names to expressions; ``measures``: names to aggregates, ``val``
    among them (the others are functional variables if declared in ``func_vars``
    or named ``func_var_*``, else group attributes).  ``time_window`` 0 gives one
    bucket for all times, at 0.
    """

    metric_id: str
    time_window: int
    measures: Mapping[str, str]
    groups: Mapping[str, str] = field(default_factory=dict)
    where: str | None = None
    func_expr: str | None = None
    version: str = "1"
    func_vars: tuple[str, ...] = ()
    horizontal_level: int = 0
    vertical_level: int = 0
    strict: bool = False

    def validate(self) -> AggregateMetric:
        names = [*self.groups, *self.measures]
        if "val" not in self.measures:
            raise ValueError(f"{self.metric_id}: no measure named val")
        if len({n.lower() for n in names}) != len(names) or "measure_time" in names or "val" in self.groups:
            raise ValueError(f"{self.metric_id}: names must differ, and {MANAGED_COLUMNS} are kept for time and value")
        if self.time_window < 0:
            raise ValueError(f"{self.metric_id}: time_window must not be negative")
        return self

    @property
    def expression(self) -> str:
        return self.func_expr or self.measures["val"]

    def frame(self, source: DataFrame, time: str) -> DataFrame:
        """The metric's stage result by itself."""
        rows = source.where(self.where) if self.where else source
        bucket = _bucket(_epoch(source, time), self.time_window).alias("measure_time")
        return rows.groupBy(bucket, *[F.expr(e).alias(n) for n, e in self.groups.items()]).agg(
            *[F.expr(e).alias(n) for n, e in self.measures.items()])

    def as_metric(self, source: str, time: str) -> MetricSpec:
        """The same as a definition with one store stage over the view ``source``."""
        stage = StageSpec(StageKind.PYTHON, OutputKind.STORE, python=lambda spark: self.frame(spark.table(source), time),
                          horizontal_level=self.horizontal_level, vertical_level=self.vertical_level)
        return MetricSpec(self.metric_id, self.time_window, self.expression, self.version, self.func_vars, stages=(stage,))


def _epoch(source: DataFrame, time: str) -> Column:
    return epoch_seconds(F.expr(time), source.select(F.expr(time)).schema[0].dataType)


def _bucket(epoch: Column, seconds: int) -> Column:
    if not seconds:
        return F.lit(0).cast("long")
    return (F.floor(epoch / seconds) * seconds).cast("long")


def fused_records(source: DataFrame, time: str, metrics: Sequence[AggregateMetric], stamp: ComputeStamp,
                  marker: str | None = None) -> DataFrame:
    """Records of all metrics over ``source``, from one scan of it.

    ``time``: the source's time column (or expression).  ``marker`` names a column
    with the metric's position, put behind the records'.
    """
    metrics = [m.validate() for m in metrics]
    if not metrics:
        raise ValueError("no metric to fuse")
    ids = [m.metric_id for m in metrics]
    if len(set(ids)) != len(ids):
        raise ValueError(f"duplicate metric ids in {ids}")
    # One column per distinct expression, filled for the metrics that group by it.
    users: dict[str, list[int]] = {}
    for i, m in enumerate(metrics):
        for e in m.groups.values():
            users.setdefault(e, []).append(i)
    windows: dict[int, list[int]] = {}
    for i, m in enumerate(metrics):
        windows.setdefault(m.time_window, []).append(i)
    mine = F.col("_metric")
    applies = F.filter(F.array(*[F.when(F.expr(m.where) if m.where else F.lit(True), F.lit(i)) for i, m in enumerate(metrics)]),
                       lambda i: i.isNotNull())
    rows = source.withColumn("_epoch", _epoch(source, time)).withColumn("_metric", F.explode(applies))
    bucket = reduce(lambda c, w: c.when(mine.isin(windows[w]), _bucket(F.col("_epoch"), w)), windows, F.when(F.lit(False), F.lit(0)))
    keys = {e: f"_key{j}" for j, e in enumerate(users)}
    measures = {e: f"_measure{j}" for j, e in enumerate(dict.fromkeys(e for m in metrics for e in m.measures.values()))}
    grouped = rows.groupBy(mine, bucket.alias("_bucket"),
                           *[F.when(mine.isin(users[e]), F.expr(e)).alias(n) for e, n in keys.items()])
    holders = {e: [i for i, m in enumerate(metrics) if e in m.measures.values()] for e in measures}
    table = grouped.agg(*[F.when(mine.isin(holders[e]), F.expr(e)).alias(n) for e, n in measures.items()])
    stages = []
    for i, m in enumerate(metrics):
        fields = [F.col("_bucket").alias("measure_time"), *[F.col(keys[e]).alias(n) for n, e in m.groups.items()],
                  *[F.col(measures[e]).alias(n) for n, e in m.measures.items()]]
        stages.append(F.struct(*fields).alias(f"_stage{i}"))
    staged = table.select("_metric", *stages)
    record = None
    for i, m in enumerate(metrics):
        cols = envelope_columns(
            staged.schema[f"_stage{i}"].dataType, metric_id=m.metric_id, time_window=m.time_window, func_expr=m.expression,
            version=m.version, func_vars=m.func_vars, horizontal_level=m.horizontal_level, vertical_level=m.vertical_level,
            stamp=stamp, strict=m.strict, within=f"_stage{i}")
        own = F.struct(*cols)
        record = F.when(mine == F.lit(i), own) if record is None else record.when(mine == F.lit(i), own)
    out = staged.select(record.alias("_record"), *([mine.alias(marker)] if marker else []))
    return out.select("_record.*", *([column(marker)] if marker else []))


def run_fused(runner: Runner, source: DataFrame | str, time: str, metrics: Iterable[AggregateMetric]) -> RunResult:
    """Compute and store metrics over one source together; the report has a row for each, as ``run_all`` gives.

    If the shared run fails, the metrics are run one by one, and only those that
    fail by themselves are reported failed.
    """
    metrics = list(metrics)
    spark = runner.spark
    frame = spark.table(source) if isinstance(source, str) else source
    stamp = ComputeStamp.for_session(spark, runner.compute_time)
    metrics = [replace(m, strict=m.strict or runner.strict) for m in metrics]
    result = RunResult(stamp.epoch)

    def pending(m: AggregateMetric, records: DataFrame | None) -> _Pending:
        spec = replace(m.as_metric("-", time), stages=())
        return _Pending(spec, replace(m.as_metric("-", time).stages[0], stage_id=f"{m.metric_id}/0"), records, 0.0)

    union = fused_records(frame, time, metrics, stamp, MARKER)
    runner._write_batch([pending(m, None) for m in metrics], stamp, result, union=union,
                        alone=lambda i: [replace(pending(metrics[i], None), records=fused_records(frame, time, [metrics[i]], stamp))])
    return result
