"""Catalog sinks: a central metrics table, cached views and temp views."""

from __future__ import annotations

import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession

from metricstore.operators.envelope import PARTITION_COLUMNS, check_envelope
from metricstore.sinks.observe import MARKER, ObservedWrite, WriteResult
from metricstore.sinks.store import session_settings


def _exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def write_table(
    records: DataFrame, table: str, fmt: str | None = None, *, mode: str = "append", markers: int = 0
) -> WriteResult:
    """Write records to a catalog table (created partitioned on first use), with observed counts.

    ``mode="overwrite_partitions"`` replaces only the partitions this write
    produces; the table must then be partitioned as the store is.
    ``fmt`` names a connector format for tables kept outside the session
    catalog (e.g. a warehouse); then ``table`` is passed as its option, and
    records can only be appended.  ``markers`` as in ``write_store``.
    """
    check_envelope(records.drop(MARKER) if markers else records)
    observed = ObservedWrite(records, markers)
    if fmt is not None and fmt not in ("orc", "parquet", "delta"):
        if mode != "append":
            raise ValueError(f"a {fmt} table can only be appended to")
        observed.frame.write.format(fmt).mode("append").option("table", table).save()
        return observed.result()
    spark = records.sparkSession
    if not _exists(spark, table):
        writer = observed.frame.write.mode("append").partitionBy(*PARTITION_COLUMNS)
        if fmt:
            writer = writer.format(fmt)
        writer.saveAsTable(table)
        return observed.result()
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if mode == "append":
        writer = observed.frame.write.mode("append")
        # an append must restate the table's own partitioning
        if parts:
            writer = writer.partitionBy(*parts)
        writer.saveAsTable(table)
        return observed.result()
    if set(parts) != set(PARTITION_COLUMNS):
        raise ValueError(f"{table} is partitioned by {parts}; overwrite_partitions needs {list(PARTITION_COLUMNS)}")
    with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        observed.frame.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    return observed.result()


def append_table(records: DataFrame, table: str, fmt: str | None = None) -> None:
    """Append records to a catalog table; see ``write_table``."""
    write_table(records, table, fmt)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def table_name(owner: str, name: str) -> str:
    """A table name of a metric's own for a cached view."""
    full = f"{owner}__{name}"
    plain = re.sub(r"\W", "_", full)
    return plain if plain == full else f"{plain}_{zlib.crc32(full.encode()):08x}"


def cached_view(
    df: DataFrame,
    name: str,
    *,
    database: str = "cache",
    location: str | None = None,
    fmt: str = "parquet",
    table: str | None = None,
) -> DataFrame:
    """Materialise a stage result as table ``database.table`` and view it as ``name``.

    Later stages read the written table, so the stage's lineage is cut and it
    is computed once however often it is read.  ``table`` (default ``name``)
    keeps apart results that share a view name.  Every call writes a new
    folder, so plans over an earlier result keep their files; superseded
    folders stay below the database's folder.  ``location`` places a newly
    created database (use a shared folder on a cluster).
    """
    spark = df.sparkSession
    table = table or name
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")
    qualified = f"`{database}`.`{table}`"
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    path = f"{base}/{table}/{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(qualified)
    cached = spark.table(qualified)
    cached.createOrReplaceTempView(name)
    return cached
