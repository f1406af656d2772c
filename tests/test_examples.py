"""The example definitions load and run end to end."""

import datetime as dt
import os

from pyspark.sql import functions as F

from metricstore import ComputeStamp, Runner, load_definitions, read_metrics, sql_folder_loader

HERE = os.path.dirname(os.path.abspath(__file__))
EXAMPLES = os.path.join(os.path.dirname(HERE), "examples")


def test_example_definitions_run(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").createOrReplaceTempView("events")
    with open(os.path.join(EXAMPLES, "metrics.yaml"), encoding="utf-8") as f:
        specs = load_definitions(f.read(), sql_loader=sql_folder_loader(os.path.join(EXAMPLES, "sql")))
    assert [s.metric_id for s in specs] == ["p90_value_hourly", "total_value_daily"]
    store = str(tmp_path / "store")
    runner = Runner(
        spark, store_path=store,
        compute_time=ComputeStamp.of(dt.datetime(2024, 2, 1, 12, tzinfo=dt.timezone.utc)),
        params={"dt_start": "2024-01-01 00:00:00", "dt_end": "2024-02-01 00:00:00"},
        cache_database="example_cache", cache_location=str(tmp_path / "cache"),
    )
    result = runner.run_all(specs)
    assert result.ok, result.failed()
    stored = read_metrics(spark, store)
    counts = {r["id"]: r["count"] for r in stored.groupBy("id").count().collect()}
    events = spark.table("events")
    assert counts["p90_value_hourly"] == events.select(
        F.floor(F.unix_timestamp("ts") / 3600), "event_type").distinct().count()
    assert counts["total_value_daily"] == events.select(
        F.floor(F.unix_timestamp("ts") / 86400), "event_type").distinct().count()
    daily = stored.where("id = 'total_value_daily'").first()
    assert set(daily["func_vars"]) == {"median"} and daily["version"] == "2"


def test_command_line_run(spark, tmp_path):
    from metricstore.__main__ import main

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").createOrReplaceTempView("events")
    store, report = str(tmp_path / "store"), str(tmp_path / "report")
    code = main([
        "--definitions", os.path.join(EXAMPLES, "metrics.yaml"), "--sql-dir", os.path.join(EXAMPLES, "sql"),
        "--store", store, "--dt-start", "2024-01-01 00:00:00", "--dt-end", "2024-02-01 00:00:00",
        "--cache-database", "cli_cache", "--report", report,
    ], spark=spark)
    assert code == 0
    assert {r["id"] for r in read_metrics(spark, store).select("id").distinct().collect()} == {
        "p90_value_hourly", "total_value_daily"}
    assert spark.read.parquet(report).where("status = 'ok'").count() == 4


def test_command_line_in_a_fresh_process(tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(HERE)
    out = subprocess.run(
        [sys.executable, "-m", "metricstore", "--definitions", os.path.join(EXAMPLES, "metrics.yaml"),
         "--sql-dir", os.path.join(EXAMPLES, "sql"), "--view", "events=/root/testdata/sf0.001/events.parquet",
         "--store", str(tmp_path / "store"), "--dt-start", "2024-01-01 00:00:00", "--dt-end", "2024-02-01 00:00:00",
         "--cache-database", "cli_fresh"],
        cwd=str(tmp_path), env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stdout[-2000:] + out.stderr[-3000:]
    assert "p90_value_hourly" in out.stdout and "total_value_daily" in out.stdout
