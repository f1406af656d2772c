"""Sources: remote readers (option building), generic formats, JSON lines, time ranges."""

import pytest
from pyspark.sql import functions as F

from metricstore.plans.spec import SourceSpec
from metricstore.sources.remote import jdbc_source, reader_source, remote_query
from metricstore.sources.sql import sql_stage, time_range_params


def test_jdbc_source_options():
    s = jdbc_source("jdbc:postgresql://db/x", driver="org.postgresql.Driver", user="u", password="p", fetch_size=1000)
    assert s.format == "jdbc"
    assert s.options == {"url": "jdbc:postgresql://db/x", "driver": "org.postgresql.Driver",
                         "user": "u", "password": "p", "fetchsize": "1000"}
    assert reader_source("presto", {"url": "jdbc:presto://h"}).format == "jdbc"
    assert reader_source("bigquery").format == "bigquery"
    assert reader_source("spark") is None
    presto = reader_source("presto", uri="jdbc:presto://h:8080/hive", user="u", driver="com.facebook.presto.jdbc.PrestoDriver")
    assert presto.options == {"url": "jdbc:presto://h:8080/hive", "driver": "com.facebook.presto.jdbc.PrestoDriver", "user": "u"}
    with pytest.raises(ValueError):
        reader_source("nope")


def test_remote_table_read_through_a_format(spark):
    df = remote_query(spark, SourceSpec("parquet", {"path": "/root/testdata/sf0.001/nation.parquet"}))
    assert df.count() == 25


def test_query_and_table_are_exclusive(spark):
    with pytest.raises(ValueError):
        remote_query(spark, SourceSpec("jdbc", {"dbtable": "t"}), "select 1")


def test_file_formats_refuse_queries(spark):
    # a file reader would silently ignore a query option and return the raw table
    with pytest.raises(ValueError):
        remote_query(spark, SourceSpec("parquet", {"path": "/root/testdata/sf0.001/nation.parquet"}), "select 1")


def test_partitioned_jdbc_scan_needs_bounds(spark):
    from metricstore.sources.remote import jdbc_table

    with pytest.raises(ValueError):
        jdbc_table(spark, jdbc_source("jdbc:postgresql://db/x"), "t", partition_column="id")


def test_named_parameters(spark):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").createOrReplaceTempView("ev_params")
    params = time_range_params("2024-01-05 00:00:00", "2024-01-06 00:00:00")
    df = sql_stage(spark, "select count(*) n from ev_params where ts >= to_timestamp_ntz(:dt_start) "
                          "and ts < to_timestamp_ntz(:dt_end)", params)
    want = spark.table("ev_params").where(
        (F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-06").cast("timestamp_ntz"))
    ).count()
    assert df.first()["n"] == want
    with pytest.raises(ValueError):
        time_range_params("2024-01-06", "2024-01-05")


def test_gzip_json_lines(spark, tmp_path):
    from metricstore.plans.event_metrics import SENSOR_SCHEMA
    from metricstore.sources.files import read_json

    path = str(tmp_path / "sensor")
    spark.range(100).select(
        F.col("id").alias("time"), (F.col("id") % 3).alias("location_id"),
        F.array(F.col("id").cast("double")).alias("data"),
    ).write.option("compression", "gzip").json(path)
    df = read_json(spark, path, SENSOR_SCHEMA)
    assert df.count() == 100 and df.schema == SENSOR_SCHEMA


def test_a_partitioned_query_becomes_a_subquery():
    from metricstore.sources.remote import remote_options

    bounds = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 8}
    source = jdbc_source("jdbc:postgresql://db/x", options=bounds)
    assert remote_options(source, "select id, v from t where v > 1;") == {
        "url": "jdbc:postgresql://db/x", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
        "numPartitions": "8", "dbtable": "(select id, v from t where v > 1) stage_query"}
    assert remote_options(jdbc_source("jdbc:x"), "select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        remote_options(jdbc_source("jdbc:x", options={"partitionColumn": "id"}), "select 1")
