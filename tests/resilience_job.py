"""Run in its own process by test_resilience.py: a store write whose first
attempt of one task fails half-way must still write every record exactly once."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(store):
    marker = store + ".injected"
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from metricstore import ComputeStamp, MetricSpec, read_metrics, to_envelope, write_store

    spark = (
        SparkSession.builder.master("local[2,3]")  # up to 3 attempts per task
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    @F.udf(T.LongType())
    def fail_first_attempt(x):  # test-only fault injection
        ctx = TaskContext.get()
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0 and x % 1000 == 999:
            with open(marker, "a") as handle:  # proves the failure happened
                handle.write("failed attempt\n")
            raise RuntimeError("injected task failure")
        return x

    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(4, "event_id")
    stage = events.select(
        F.unix_timestamp("ts").alias("measure_time"), F.col("value").alias("val"),
        fail_first_attempt("event_id").alias("event_id"),
    )
    rec = to_envelope(stage, MetricSpec("retry", 0, "x", "1"), compute_time=ComputeStamp.of(1706788800))
    result = write_store(rec, store)
    back = read_metrics(spark, store)
    distinct_ids = back.select(F.col("group_map")["event_id"]["long"]).distinct().count()
    print("RESULT", result.rows, back.count(), distinct_ids, events.count(), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
