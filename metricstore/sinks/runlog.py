"""A log of committed runs, so that a store and a table show a run wholly or not at all.

A write's files become visible one after the other, a failed or repeated attempt
may leave some, and a run may fill a store and a table.  With a run log, files
count only once a commit names them: the log is written last, as one small
file, and readers join it.  A commit has one row per target, write and
partition, with ``mode`` and a sequence number:

    run, target, seq, mode, write, rows, id, compute_date, compute_hour,
    horizontal_level, vertical_level, compute_time, committed_at

``write`` is the identifier that Spark puts into the names of all files of one
write job; readers get it from the hidden ``_metadata`` column, so files and
records stay as they are and stores without a log are read as before.

``mode="overwrite_partitions"`` writes beside the old files; the commit itself
replaces: in each of its partitions only its own files and those of later
commits count.  A crash at any time leaves the earlier state readable.
``mode="compacted"`` names a write whose files of a partition no longer count
(``sinks.compact``), ``mode="compaction"`` the one that took them over.

One writer per log at a time, as for the store itself.  The log is as large as
the number of partitions ever written; readers prune it by the same id and date
filters as the records, and Catalyst decides by its size whether to broadcast.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.operators.envelope import ENVELOPE, PARTITION_COLUMNS

#: Spark leaves folders with a leading underscore out of a table's files.
LOG_FOLDER = "_runs"
#: What Spark writes into a file's name: part-<task>-<write>... (fixed value).
WRITE_IN_NAME = r"part-\d+-([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})"
WRITE = "_write"

_PARTITION_FIELDS = [ENVELOPE[c] for c in PARTITION_COLUMNS]
LOG_SCHEMA = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("target", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("mode", T.StringType()), T.StructField("write", T.StringType()), T.StructField("rows", T.LongType()),
    *[T.StructField(f.name, f.dataType) for f in _PARTITION_FIELDS],
    T.StructField("compute_time", T.LongType()), T.StructField("committed_at", T.DoubleType())])


def log_path(store: str) -> str:
    return f"{store.rstrip('/')}/{LOG_FOLDER}"


def _missing(exc: AnalysisException) -> bool:
    return exc.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The commits at ``path``, or None where nothing was ever committed."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as exc:
        if not _missing(exc):
            raise
        return None


def write_of_file(name: str = "_metadata.file_name") -> Column:
    """The write that made a record's file; null where the name does not tell."""
    found = F.regexp_extract(F.col(name), WRITE_IN_NAME, 1)
    return F.when(found != "", F.lower(found))


def files_of(records: DataFrame) -> DataFrame:
    """(partition columns, file, write, bytes, rows): one pass over the records, which reads no data column.

    Records are counted by what is fixed for a file; its name is looked at once, afterwards.
    """
    fixed = [*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("_name"),
             F.col("_metadata.file_size").alias("bytes")]
    held = records.groupBy(*fixed).agg(F.count(F.lit(1)).alias("rows"))
    return held.select(*PARTITION_COLUMNS, "file", write_of_file("_name").alias(WRITE), "bytes", "rows")


def live_writes(log: DataFrame, target: str) -> DataFrame:
    """(partition columns, write): what counts after all replacements."""
    last = F.max(F.when(F.col("mode") == F.lit("overwrite_partitions"), F.col("seq"))).over(
        Window.partitionBy(*PARTITION_COLUMNS))
    gone = F.max(F.col("mode") == F.lit("compacted")).over(Window.partitionBy(*PARTITION_COLUMNS, "write"))
    rows = log.where(F.col("target") == F.lit(target)).withColumn("_from", last).withColumn("_gone", gone)
    kept = rows.where(~F.col("_gone") & (F.col("_from").isNull() | (F.col("seq") >= F.col("_from"))))
    return kept.select(*PARTITION_COLUMNS, F.col("write").alias(WRITE)).distinct()


def committed(records: DataFrame, log: DataFrame | None, target: str) -> DataFrame:
    """``records`` (read from files, with ``_metadata`` in reach) that a commit of ``log`` names; none without commits."""
    tagged = records.withColumn(WRITE, write_of_file())
    if log is None:
        return tagged.where("false").drop(WRITE)
    live = live_writes(log, target)
    on = tagged[WRITE] == live[WRITE]
    for c in PARTITION_COLUMNS:
        on = on & tagged[c].eqNullSafe(live[c])
    return tagged.join(live, on, "left_semi").drop(WRITE)


def writes_in(records: DataFrame | None) -> set[str]:
    """Identifiers of the writes whose files ``records`` are read from: one row per write."""
    if records is None:
        return set()
    try:
        names = records.select(F.col("_metadata.file_name").alias("_name")).distinct()
        return {r[0] for r in names.select(write_of_file("_name")).distinct().collect()}
    except AnalysisException as exc:
        if not _missing(exc):
            raise
        return set()


class Commit:
    """One run's commit: ``add`` each finished write, then ``publish`` all of them at once."""

    def __init__(self, spark: SparkSession, path: str, mode: str) -> None:
        self.spark, self.path, self.mode = spark, path, mode
        self.run = uuid.uuid4().hex
        self.rows: list[tuple] = []
        self.replaced: list[tuple] = []

    def add(self, target: str, records: DataFrame, before: set[str], compute_time: int, expected: int) -> None:
        """Find the files written since ``before`` among ``records`` of the run's metrics and dates.

        Reads no data column; refuses a count other than the write observed.
        """
        found = files_of(records).groupBy(*PARTITION_COLUMNS, WRITE).agg(F.sum("rows").alias("n")).collect()
        if any(r[WRITE] is None for r in found):
            raise ValueError("a run log needs file names that name their write")
        mine = [r for r in found if r[WRITE] not in before]
        total = sum(r["n"] for r in mine)
        if total != expected:
            raise RuntimeError(f"{target}: {expected} records written, {total} found in new files")
        self.rows += [(target, r[WRITE], r["n"], *[r[c] for c in PARTITION_COLUMNS], compute_time) for r in mine]

    def publish(self) -> None:
        log = read_log(self.spark, self.path)
        seq = 1 + (0 if log is None else log.agg(F.max("seq")).first()[0] or 0)
        now = time.time()
        rows = [(self.run, target, seq, mode, write, n, *rest, now)
                for mode, some in ((self.mode, self.rows), ("compacted", self.replaced)) for target, write, n, *rest in some]
        if rows:
            self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def unpublished(records: DataFrame, log: DataFrame | None, target: str) -> DataFrame:
    """(partition columns, file, rows) of files that no live commit names: left by failed attempts or replaced."""
    files = files_of(records).drop("bytes")
    if log is not None:
        live = live_writes(log, target)
        on = files[WRITE] == live[WRITE]
        for c in PARTITION_COLUMNS:
            on = on & files[c].eqNullSafe(live[c])
        files = files.join(live, on, "left_anti")
    return files.drop(WRITE)
