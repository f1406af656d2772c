"""Metric store on Spark: define metrics as stages, store them in one record schema."""

from metricstore.functions.timebins import bucket_epoch, bucket_of_epoch, bucket_timestamp, value_bin
from metricstore.functions.values import VALUE_MAP_TYPE, VALUE_TYPE, value_struct
from metricstore.operators.envelope import (
    ENVELOPE,
    PARTITION_COLUMNS,
    ComputeStamp,
    classify,
    to_envelope,
    to_long,
)
from metricstore.operators.dedupe import latest_records
from metricstore.operators.envelope import check_envelope
from metricstore.operators.asof import read_as_of
from metricstore.operators.bins import equal_frequency_bins
from metricstore.operators.levels import at_levels, roll_up_levels
from metricstore.operators.quantiles import exact_quantiles
from metricstore.operators.samples import distinct_samples
from metricstore.operators.sketches import Distinct, Percentile, Plain, sketch_levels
from metricstore.operators.wide import to_wide
from metricstore.plans.fused import AggregateMetric, run_fused
from metricstore.plans.incremental import run_incremental
from metricstore.plans.runner import RunResult, Runner, run_all, run_definition
from metricstore.plans.spec import (
    MetricSpec,
    OutputKind,
    SourceSpec,
    StageKind,
    StageSpec,
    check_definitions,
    definitions_frame,
    load_definitions,
    sql_folder_loader,
)
from metricstore.plans.scratch import scratch_path
from metricstore.sinks.compact import compact_store
from metricstore.sinks.store import manifest, register_store, write_store
from metricstore.sources.store import read_metrics, read_table

__all__ = [
    "ENVELOPE", "PARTITION_COLUMNS", "VALUE_TYPE", "VALUE_MAP_TYPE", "ComputeStamp",
    "MetricSpec", "StageSpec", "SourceSpec", "StageKind", "OutputKind", "Runner", "RunResult",
    "at_levels", "bucket_epoch", "bucket_of_epoch", "bucket_timestamp", "check_definitions",
    "classify", "definitions_frame", "load_definitions", "sql_folder_loader", "manifest", "read_metrics", "register_store", "run_all",
    "run_definition", "to_envelope", "to_long", "value_bin", "value_struct", "write_store",
    "check_envelope", "latest_records", "exact_quantiles", "scratch_path",
    "AggregateMetric", "Distinct", "Percentile", "Plain", "compact_store", "distinct_samples", "equal_frequency_bins", "read_as_of", "read_table",
    "roll_up_levels", "run_fused", "run_incremental", "sketch_levels", "to_wide",
]
