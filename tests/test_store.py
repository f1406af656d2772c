"""Store: partitioned write, explicit-schema read-back, pruning, re-runs, manifest, registration."""

import datetime as dt

from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec, manifest, read_metrics, register_store, to_envelope, write_store
from metricstore.operators.envelope import PARTITION_COLUMNS

H12 = ComputeStamp.of(dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc))
H13 = ComputeStamp.of(dt.datetime(2024, 2, 1, 13, 5, tzinfo=dt.timezone.utc))


def hourly(spark, metric_id="007", stamp=H12, level=0):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = events.groupBy(
        (F.unix_timestamp("ts") - F.pmod(F.unix_timestamp("ts"), F.lit(3600))).alias("measure_time"),
        "event_type",
    ).agg(F.sum("value").alias("val"), F.count(F.lit(1)).alias("func_var_n"))
    return to_envelope(df, MetricSpec(metric_id, 3600, "sum(value)", "1"), horizontal_level=level, compute_time=stamp)


def test_write_observes_rows_and_partitions(spark, tmp_store):
    rec = hourly(spark)
    expected = rec.count()
    result = write_store(rec, tmp_store)
    assert result.rows == expected
    assert result.partitions == (
        {"id": "007", "compute_date": "2024-02-01", "compute_hour": 12, "horizontal_level": 0, "vertical_level": 0},
    )
    back = read_metrics(spark, tmp_store)
    assert back.columns == list(rec.columns)
    assert back.count() == expected
    # the id keeps its text (no inference to the number 7), partition columns keep types
    row = back.first()
    assert row["id"] == "007" and row["compute_date"] == "2024-02-01" and row["compute_hour"] == 12


def test_partition_filters_prune(spark, tmp_store):
    write_store(hourly(spark, "a"), tmp_store)
    write_store(hourly(spark, "b", level=1), tmp_store)
    df = read_metrics(spark, tmp_store, ids=["b"], horizontal_levels=[1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(id" in plan
    assert {r["id"] for r in df.collect()} == {"b"}
    assert df.count() == hourly(spark, "b").count()


def test_rerun_append_vs_overwrite_partitions(spark, tmp_store):
    n = hourly(spark).count()
    write_store(hourly(spark), tmp_store)
    write_store(hourly(spark), tmp_store)  # append: duplicates
    assert read_metrics(spark, tmp_store).count() == 2 * n
    write_store(hourly(spark), tmp_store, mode="overwrite_partitions")  # idempotent re-run
    assert read_metrics(spark, tmp_store).count() == n


def test_latest_keeps_newest_run(spark, tmp_store):
    write_store(hourly(spark, stamp=H12), tmp_store)
    write_store(hourly(spark, stamp=H13), tmp_store)
    all_rows = read_metrics(spark, tmp_store)
    latest = read_metrics(spark, tmp_store, latest=True)
    n = hourly(spark).count()
    assert all_rows.count() == 2 * n
    assert latest.count() == n
    assert {r["compute_hour"] for r in latest.collect()} == {13}


def test_special_characters_in_id(spark, tmp_store):
    write_store(hourly(spark, "a/b:x y"), tmp_store)
    assert {r["id"] for r in read_metrics(spark, tmp_store).collect()} == {"a/b:x y"}


def test_manifest_and_register(spark, tmp_store):
    write_store(hourly(spark, "m1"), tmp_store)
    write_store(hourly(spark, "m2", level=2), tmp_store)
    rows = {(r["id"], r["horizontal_level"]): r["rows"] for r in manifest(spark, tmp_store).collect()}
    assert rows == {("m1", 0): hourly(spark).count(), ("m2", 2): hourly(spark).count()}
    register_store(spark, "metrics_registered", tmp_store)
    assert spark.table("metrics_registered").count() == 2 * hourly(spark).count()
    assert set(spark.table("metrics_registered").columns) == set(PARTITION_COLUMNS) | set(hourly(spark).columns)
    spark.sql("drop table metrics_registered")


def test_orc_writers_store_equal_records(spark, tmp_path):
    from metricstore.sinks.store import HIVE_ORC_WRITER, writer_format

    assert writer_format(spark, "orc") == HIVE_ORC_WRITER
    assert writer_format(spark, "orc", "native") == "orc"
    assert writer_format(spark, "parquet") == "parquet"
    rec = hourly(spark)
    write_store(rec, str(tmp_path / "h"))
    write_store(rec, str(tmp_path / "n"), orc_writer="native")
    def entries(m):  # map entries as text, in key order
        return F.transform(F.array_sort(F.map_keys(m)), lambda k: F.concat(k, F.lit("="), F.to_json(F.col(m)[k])))

    def keyed(df):
        return df.select("measure_time", "val", "group_keys", entries("group_map").alias("g"),
                         entries("func_vars").alias("f"))

    h, n = keyed(read_metrics(spark, str(tmp_path / "h"))), keyed(read_metrics(spark, str(tmp_path / "n")))
    assert h.count() == n.count() == rec.count()
    assert h.exceptAll(n).count() == 0 and n.exceptAll(h).count() == 0


def test_nulls_and_empties_survive_the_store(spark, tmp_store):
    df = spark.createDataFrame(
        [(None, None, None, [], {}, None), (1, 2.0, "g", [1, None], {"k": None}, 3)],
        "measure_time long, val double, g string, a array<long>, m map<string,double>, func_var_n long",
    )
    rec = to_envelope(df, MetricSpec("nulls", 1, "x", "1"), compute_time=H12)
    write_store(rec, tmp_store)
    back = {r["measure_time"]: r for r in read_metrics(spark, tmp_store).collect()}
    empty = back[None]
    assert empty["val"] is None and empty["group_map"]["g"]["type"] == "string" and empty["group_map"]["g"]["string"] is None
    assert empty["group_map"]["a"]["vec_string"] == [] and empty["group_map"]["m"]["map_string"] == {}
    assert empty["func_vars"]["n"]["type"] == "long" and empty["func_vars"]["n"]["long"] is None
    full = back[1]
    assert full["group_map"]["a"]["vec_string"] == ["1", "null"]
    assert full["group_map"]["m"]["map_string"] == {"k": "null"}
    assert full["group_keys"] == ["g", "a", "m"]


def test_read_filters_by_ranges(spark, tmp_store):
    write_store(hourly(spark, "r", stamp=H12), tmp_store)
    write_store(hourly(spark, "r", stamp=H13), tmp_store)
    all_rows = read_metrics(spark, tmp_store)
    lo, hi = 1704067200, 1704153600  # the first day of January 2024
    want = all_rows.where((F.col("measure_time") >= lo) & (F.col("measure_time") < hi)).count()
    assert read_metrics(spark, tmp_store, measure_range=(lo, hi)).count() == want > 0
    assert read_metrics(spark, tmp_store, hours=[13]).count() == all_rows.count() // 2
    assert read_metrics(spark, tmp_store, date_range=("2024-02-01", "2024-02-02")).count() == all_rows.count()
    assert read_metrics(spark, tmp_store, date_range=(None, "2024-02-01")).count() == 0


def test_sort_free_write_restores_settings(spark, tmp_store):
    key = "spark.sql.optimizer.plannedWrite.enabled"
    before = spark.conf.get(key, None)
    write_store(hourly(spark), tmp_store)
    assert spark.conf.get(key, None) == before
    sorted_path = tmp_store + "_sorted"
    write_store(hourly(spark), sorted_path, sort_free=False)
    assert read_metrics(spark, tmp_store).count() == read_metrics(spark, sorted_path).count() == hourly(spark).count()


def test_concurrent_writes_restore_settings(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    key = "spark.sql.optimizer.plannedWrite.enabled"
    before = spark.conf.get(key, None)
    # separate folders: concurrent appends to one folder collide in the
    # committer's shared _temporary folder (run_all writes one union instead)
    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(lambda i: write_store(hourly(spark, f"c{i}"), str(tmp_path / f"s{i}")), range(3)))
    assert spark.conf.get(key, None) == before
    assert [r.rows for r in results] == [read_metrics(spark, str(tmp_path / f"s{i}")).count() for i in range(3)]


def test_scratch_paths_follow_the_checkpoint_setting(spark):
    from metricstore.plans.scratch import checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert root and not root.endswith("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/metricstore/x-")
    assert scratch_path(spark, "fixed", unique=False) == root + "/metricstore/fixed"


def test_latest_keeps_every_record_of_the_newest_run(spark, tmp_store):
    metric = MetricSpec("rows", 0, "x", "1", ("bin",))
    rows = [(0, float(i), "g", i % 7) for i in range(2000)] + [(1, 0.0, None, 1)]
    df = spark.createDataFrame(rows, "measure_time long, val double, g string, bin long")
    for stamp in (H12, H13):
        write_store(to_envelope(df, metric, compute_time=stamp), tmp_store)
    latest = read_metrics(spark, tmp_store, latest=True)
    assert latest.count() == 2001
    assert {r["compute_hour"] for r in latest.select("compute_hour").distinct().collect()} == {13}
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()


def test_named_folders_alone_are_listed(spark, tmp_store):
    for name in ("a", "b", "a/b:x y", "x=[1]"):
        write_store(hourly(spark, name), tmp_store)
    n = hourly(spark).count()
    only = read_metrics(spark, tmp_store, ids=["a/b:x y", "x=[1]"], dates=["2024-02-01"])
    assert only.count() == 2 * n and all("id=a/" not in f and "id=b/" not in f for f in only.inputFiles())
    assert read_metrics(spark, tmp_store, ids=["a", "never"]).count() == n
    assert read_metrics(spark, tmp_store, ids=["a"], dates=["1999-01-01"]).count() == 0
    assert read_metrics(spark, tmp_store, ids=[]).count() == 0


def test_register_adds_just_the_new_partitions(spark, tmp_store):
    from metricstore.sources.store import read_table

    first = write_store(hourly(spark, "it's"), tmp_store)
    write_store(hourly(spark, "unlisted"), tmp_store)
    try:
        register_store(spark, "metrics_new", tmp_store, partitions=first.partitions)
        assert {r["id"] for r in spark.table("metrics_new").select("id").distinct().collect()} == {"it's"}
        register_store(spark, "metrics_new", tmp_store, partitions=first.partitions)
        assert read_table(spark, "metrics_new", ids=["it's"]).count() == hourly(spark).count()
        register_store(spark, "metrics_new", tmp_store)
        assert spark.table("metrics_new").count() == 2 * hourly(spark).count()
    finally:
        spark.sql("drop table if exists metrics_new")


def test_scratch_leaves_the_session_alone(spark):
    from metricstore.plans.scratch import checkpoint_root

    before = spark.sparkContext.getCheckpointDir()
    assert checkpoint_root(spark) == checkpoint_root(spark)
    assert spark.sparkContext.getCheckpointDir() == before
