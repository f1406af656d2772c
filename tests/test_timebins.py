"""Time buckets and value bins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricstore import MetricSpec
from metricstore.functions.timebins import (
    bucket_epoch, bucket_of_epoch, bucket_timestamp, metric_bucket, value_bin,
)


def test_buckets_floor_also_before_1970(spark):
    df = spark.createDataFrame([(-1.0,), (-500.0,), (-501.0,), (0.0,), (499.0,), (500.0,), (1234.9,)], "t double")
    got = [r[0] for r in df.select(bucket_of_epoch("t", 500)).collect()]
    assert got == [-500, -500, -1000, 0, 0, 500, 1000]


def test_timestamp_buckets(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 3, 59, 59),)], "ts timestamp_ntz")
    row = df.select(bucket_epoch("ts", 3600).alias("e"), bucket_timestamp("ts", 3600).alias("t"),
                    metric_bucket("ts", MetricSpec("m", 900, "f", "1")).alias("q")).first()
    assert row["e"] == 1577847600
    assert row["q"] == 1577850300
    assert row["t"].replace(tzinfo=None) == dt.datetime(2020, 1, 1, 3, 0)


def test_value_bins_round_half_up(spark):
    df = spark.createDataFrame([(35.5,), (35.49,), (-0.5,), (2.25,)], "x double")
    assert [r[0] for r in df.select(value_bin("x")).collect()] == [36.0, 35.0, -1.0, 2.0]
    assert [r[0] for r in df.select(value_bin("x", 0.5)).collect()] == [35.5, 35.5, -0.5, 2.5]
    with pytest.raises(ValueError):
        value_bin("x", 0)
    with pytest.raises(ValueError):
        bucket_epoch(F.col("t"), 0)


def test_timestamp_buckets_floor_before_1970_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.sql("select ms * 1000 as us from values (-500001L), (-500000L), (-1L), (0L), (1L), (500000L) as t(ms)").select(
                F.timestamp_micros("us").alias("t"),
                (F.to_timestamp_ntz(F.lit("1970-01-01")) + F.expr("make_dt_interval(0, 0, 0, us / 1000000.0)")).alias("n"))
            got = [(r["t"], r["n"]) for r in df.select(bucket_epoch("t", 500).alias("t"), bucket_epoch("n", 500).alias("n")).collect()]
            assert got == [(x, x) for x in (-1000, -500, -500, 0, 0, 500)], zone
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
