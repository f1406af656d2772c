"""Streaming: records of a watermarked windowed aggregation land in a store exactly once."""

from pyspark.sql import functions as F

from metricstore import MetricSpec, read_metrics
from metricstore.streaming.store_stream import store_stream

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_windowed_stream_into_store(spark, tmp_path):
    src = str(tmp_path / "events_in")
    spark.read.parquet(EVENTS).repartition(3).write.parquet(src)  # a folder of files to stream
    schema = spark.read.parquet(EVENTS).schema
    stream = spark.readStream.schema(schema).parquet(src)
    hourly = (
        stream.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", "1 hour")
        .groupBy(F.window("ts", "1 day"), "event_type")
        .agg(F.sum("value").alias("val"), F.count(F.lit(1)).alias("func_var_n"))
        .select(F.col("window.start").alias("measure_time"), "event_type", "val", "func_var_n")
    )
    metric = MetricSpec("daily_stream", 86400, "sum(value) per day", "1")
    path = str(tmp_path / "stream_store")
    q = store_stream(hourly, metric, path, checkpoint=str(tmp_path / "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(300)
    stored = read_metrics(spark, path)
    got = {(r["measure_time"], r["group_map"]["event_type"]["string"]): (round(r["val"], 6), r["func_vars"]["n"]["long"])
           for r in stored.collect()}
    batch = spark.read.parquet(EVENTS).groupBy(
        (F.unix_timestamp("ts") - F.pmod(F.unix_timestamp("ts"), F.lit(86400))).alias("d"), "event_type"
    ).agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"))
    want = {(r["d"], r["event_type"]): (round(r["s"], 6), r["n"]) for r in batch.collect()}
    # only windows closed by the watermark are emitted, each exactly once and complete
    assert got and set(got) <= set(want)
    assert all(got[k] == want[k] for k in got)
    assert stored.count() == len(got)
    assert {r["compute_time"] for r in stored.collect()}  # stamped per micro-batch


def test_late_rows_are_dropped_once_window_is_final(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("value", T.DoubleType())])
    src = tmp_path / "in"
    src.mkdir()

    def batch(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(src / name))

    day = dt.datetime(2024, 1, 1)
    batch("b1", [(day + dt.timedelta(hours=1), 1.0), (day + dt.timedelta(days=2), 5.0)])
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(src))
    daily = (
        stream.withWatermark("ts", "1 hour")
        .groupBy(F.window("ts", "1 day"))
        .agg(F.sum("value").alias("val"))
        .select(F.col("window.start").alias("measure_time"), "val")
    )
    path, ckpt = str(tmp_path / "store"), str(tmp_path / "ckpt")
    metric = MetricSpec("late", 86400, "sum(value) per day", "1")
    store_stream(daily, metric, path, checkpoint=ckpt, trigger={"availableNow": True}).awaitTermination(300)
    # a row for the first day arrives after the watermark passed it: dropped
    batch("b2", [(day + dt.timedelta(hours=2), 100.0), (day + dt.timedelta(days=4), 7.0)])
    store_stream(daily, metric, path, checkpoint=ckpt, trigger={"availableNow": True}).awaitTermination(300)
    got = {r["measure_time"]: r["val"] for r in read_metrics(spark, path).collect()}
    first_day = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    assert got[first_day] == 1.0


def test_a_restart_without_a_checkpoint_argument_goes_on(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "store")
    events = spark.read.parquet(EVENTS)
    events.coalesce(1).write.parquet(src)
    metric = MetricSpec("a/b rows", 0, "value", "1")

    def run():
        stream = spark.readStream.schema(events.schema).parquet(src).select(
            F.col("ts").alias("measure_time"), F.col("value").alias("val"), "event_id")
        store_stream(stream, metric, path, trigger={"availableNow": True}).awaitTermination(300)
        return read_metrics(spark, path).count()

    n = events.count()
    assert run() == n
    events.limit(1).coalesce(1).write.mode("append").parquet(src)
    assert run() == n + 1
    assert run() == n + 1
