"""Compaction of a store with a run log: many small files of a partition become few of a target size.

Only files of committed runs take part.  A partition's files are packed in order
of their names into bins of ``target_bytes``; the records of a bin are written as
one file, beside the old ones, and one commit then names the new files and the
writes they replace.  So readers see either state, and a run that appends to
the same partition meanwhile is untouched: its write is not among those
replaced.  The old files stay until they are removed (``unpublished`` lists
them).

A partition is rewritten if that makes fewer files of it; one that holds the
files of a single compaction is left alone, so a second run does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricstore.operators.envelope import ENVELOPE_COLUMNS, PARTITION_COLUMNS
from metricstore.sinks.runlog import WRITE, Commit, files_of, live_writes, log_path, read_log, writes_in
from metricstore.sinks.store import write_store
from metricstore.sources.store import stored_files


def live_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """(partition columns, file, write, bytes, rows) of the files that commits of ``log`` name."""
    held = files_of(files)
    live = live_writes(log, "store").withColumnRenamed(WRITE, "_live")
    on = held[WRITE] == live["_live"]
    for c in PARTITION_COLUMNS:
        on = on & held[c].eqNullSafe(live[c])
    return held.join(live, on, "left_semi").withColumnRenamed(WRITE, "write")


def compact_store(spark: SparkSession, path: str, *, ids: list[str], dates: list[str], target_bytes: int = 128 << 20,
                  fmt: str = "orc", run_log: str | None = None) -> DataFrame:
    """Compact the partitions of these metrics and compute dates; a row per partition that had files.

    Returns the partition columns, ``files`` and ``bytes`` before, and
    ``files_after``.  The partitions' summary, a row each, comes to the driver.
    """
    if target_bytes < 1:
        raise ValueError("target_bytes must be at least 1")
    run_log = run_log or log_path(path)
    log = read_log(spark, run_log)
    files = stored_files(spark, path, ids, dates, fmt)
    if log is None or files is None:
        raise ValueError(f"{path}: compaction needs a store with a run log")
    before = Window.partitionBy(*PARTITION_COLUMNS).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # A bin takes files until it holds target_bytes: as many bins as that fills, numbered without gaps.
    start = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes)
    packed = live_files(files, log).withColumn("_start", start)
    packed = packed.withColumn("bin", F.dense_rank().over(Window.partitionBy(*PARTITION_COLUMNS).orderBy("_start")) - 1).drop("_start")
    shape = packed.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        (F.max("bin") + 1).alias("bins"), F.collect_set("write").alias("writes")).collect()
    compactions = {r["write"] for r in log.where("mode = 'compaction'").select("write").distinct().collect()}
    todo = [r for r in shape if r["bins"] < r["files"] and not (len(r["writes"]) == 1 and r["writes"][0] in compactions)]
    if todo:
        first, at = [], 0
        for r in todo:
            first.append((*[r[c] for c in PARTITION_COLUMNS], at))
            at += r["bins"]
        kinds = ", ".join(f"{c} {files.schema[c].dataType.simpleString()}" for c in PARTITION_COLUMNS)
        places = spark.createDataFrame(first, f"{kinds}, first long")
        on = F.lit(True)
        for c in PARTITION_COLUMNS:
            on = on & packed[c].eqNullSafe(places[c])
        # (file, number of the new file): a row per old file
        numbered = packed.join(places, on).select("file", (F.col("first") + F.col("bin")).cast("int").alias("_number"))
        rows = files.withColumn("_file", F.col("_metadata.file_path"))
        rows = rows.join(numbered, F.col("_file") == F.col("file")).select(*ENVELOPE_COLUMNS, "_number")
        rows = rows.repartitionById(at, F.col("_number")).select(*ENVELOPE_COLUMNS)
        commit = Commit(spark, run_log, "compaction")
        known = writes_in(files)
        written = write_store(rows, path, fmt=fmt)
        if written.rows != sum(r["rows"] for r in todo):
            raise RuntimeError(f"{written.rows} records written, {sum(r['rows'] for r in todo)} expected")
        commit.add("store", stored_files(spark, path, ids, dates, fmt), known, 0, written.rows)
        commit.replaced = [("store", w, 0, *[r[c] for c in PARTITION_COLUMNS], 0) for r in todo for w in r["writes"]]
        commit.publish()
    done = {tuple(r[c] for c in PARTITION_COLUMNS) for r in todo}
    kinds = ", ".join(f"{c} {files.schema[c].dataType.simpleString()}" for c in PARTITION_COLUMNS)
    out = [(*(k := tuple(r[c] for c in PARTITION_COLUMNS)), r["files"], r["bytes"], r["bins"] if k in done else r["files"]) for r in shape]
    return spark.createDataFrame(out, f"{kinds}, files long, bytes long, files_after long")
