"""The metric store: ORC files partitioned by metric, compute date/hour and levels.

One write per run: the record count and the set of partitions touched are
gathered with an ``Observation`` while the files are written, so the stage
query runs exactly once (no ``cache``/``count`` before, no ``distinct`` after).
With a run log (``sinks.runlog``), records count only once their run is in it.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.operators.envelope import ENVELOPE, PARTITION_COLUMNS, check_envelope
from metricstore.sinks.observe import MARKER, ObservedWrite, WriteResult
from metricstore.sources.store import read_metrics

WRITE_MODES = ("append", "overwrite_partitions")

# Spark ships two ORC writers.  For records (maps of 13-field structs) the one
# in Spark's Hive module writes about 1.7x faster than the native one (see
# with equal values (map entries in hash order rather than insertion order,
# which nothing relies on: group_keys keeps the column order).
HIVE_ORC_WRITER = "org.apache.spark.sql.hive.orc.OrcFileFormat"
_hive_orc: dict[str, bool] = {}


def _session_key(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return str(id(spark))


def _hive_orc_available(spark: SparkSession) -> bool:
    key = _session_key(spark)
    if key not in _hive_orc:
        try:  # resolving the source runs no job
            spark.read.format(HIVE_ORC_WRITER).schema("probe int").load()
            _hive_orc[key] = True
        except Exception:  # noqa: BLE001 - Spark built without its Hive module
            _hive_orc[key] = False
    return _hive_orc[key]


# A partitioned write is planned with a per-task sort on the partition
# columns.  In a store those are run literals (one folder per metric and run),
# each task streams into its folder through up to 4 open writers and only
# falls back to sorting beyond that.  Both are documented SQL settings, set
# for the duration of the write and restored after it.
SORT_FREE_WRITE = {
    "spark.sql.optimizer.plannedWrite.enabled": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


_settings_lock = threading.Lock()
_settings_users: dict[tuple[int, tuple], list] = {}  # (session, keys) -> [count, saved values]


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Apply ``settings`` while the block runs, restore them afterwards.

    Writes running concurrently in one session share the change: the first
    one in saves the previous values, the last one out restores them.
    """
    if not settings:
        yield
        return
    key = (id(spark), tuple(sorted(settings)))
    with _settings_lock:
        entry = _settings_users.get(key)
        if entry is None:
            entry = _settings_users[key] = [0, {k: spark.conf.get(k, None) for k in settings}]
            for k, v in settings.items():
                spark.conf.set(k, v)
        entry[0] += 1
    try:
        yield
    finally:
        with _settings_lock:
            entry[0] -= 1
            if entry[0] == 0:
                del _settings_users[key]
                for k, v in entry[1].items():
                    if v is None:
                        spark.conf.unset(k)
                    else:
                        spark.conf.set(k, v)


def writer_format(spark: SparkSession, fmt: str, orc_writer: str = "hive") -> str:
    """The data source used to write ``fmt`` (ORC through the faster writer)."""
    if orc_writer not in ("hive", "native"):
        raise ValueError("orc_writer is 'hive' or 'native'")
    if fmt == "orc" and orc_writer == "hive" and _hive_orc_available(spark):
        return HIVE_ORC_WRITER
    return fmt


def write_store(
    records: DataFrame,
    path: str,
    *,
    mode: str = "append",
    max_records_per_file: int | None = None,
    markers: int = 0,
    fmt: str = "orc",
    orc_writer: str = "hive",
    sort_free: bool = True,
) -> WriteResult:
    """Append (or replace the touched partitions of) the store at ``path``.

    ``fmt`` is the file format (ORC by default; the record schema, not the
    format, is the contract, so Parquet stores work the same way).
    ``orc_writer="native"`` picks Spark's native ORC writer instead of the
    faster one from its Hive module.  ``sort_free=False`` keeps Spark's
    planned per-task sort on the partition columns.
    ``mode="overwrite_partitions"`` replaces only the partitions this write
    produces (dynamic partition overwrite), which makes a re-run idempotent.
    With ``markers``, ``records`` carry a column ``_stage`` with values from 0
    to ``markers - 1``; rows and partitions are observed for each, and the
    column is not written.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    check_envelope(records.drop(MARKER) if markers else records)
    observed = ObservedWrite(records, markers)
    source = writer_format(records.sparkSession, fmt, orc_writer)
    writer = observed.frame.write.format(source).partitionBy(*PARTITION_COLUMNS)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    with session_settings(records.sparkSession, SORT_FREE_WRITE if sort_free else {}):
        if mode == "append":
            writer.mode("append").save(path)
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    return observed.result()


def manifest(spark: SparkSession, path: str, **filters) -> DataFrame:
    """One row per stored partition: record count and measurement time span.

    ``filters`` are those of :func:`read_metrics` (ids, dates, ..., fmt).
    """
    return (
        read_metrics(spark, path, **filters)
        .groupBy(*PARTITION_COLUMNS)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("measure_time").alias("min_measure_time"),
            F.max("measure_time").alias("max_measure_time"),
        )
    )


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_store(spark: SparkSession, table: str, path: str, fmt: str = "orc", partitions=None) -> None:
    """Expose the store as a partitioned catalog table.

    ``partitions`` (tuples of a ``WriteResult`` or of ``RunResult.partitions()``)
    adds just those; without it every folder of the store is looked up, which
    is for a first registration.
    """
    cols = ", ".join(f"`{c}`" for c in PARTITION_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(ENVELOPE)}) USING {fmt} "
        f"PARTITIONED BY ({cols}) LOCATION '{path}'"
    )
    if partitions is None:
        spark.catalog.recoverPartitions(table)
        return

    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, int):
            return str(value)
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    specs = [", ".join(f"`{c}` = {literal(p[c])}" for c in PARTITION_COLUMNS) for p in partitions]
    if specs:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({x})" for x in specs))
        spark.catalog.refreshTable(table)
