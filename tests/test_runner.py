"""Runner: stage chaining, Python stages, outputs, failures, run_all, report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec, OutputKind, Runner, StageKind, StageSpec, read_metrics

STAMP = ComputeStamp.of(dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc))
EVENTS = "/root/testdata/sf0.001/events.parquet"

HOURLY = """select cast(floor(unix_timestamp(ts) / 3600) * 3600 as bigint) as measure_time,
                   event_type, sum(value) as val, count(1) as sample_size
            from events_t group by 1, 2"""


@pytest.fixture(autouse=True)
def events(spark):
    spark.read.parquet(EVENTS).createOrReplaceTempView("events_t")


def sql(text, output=OutputKind.STORE, **kw):
    return StageSpec(StageKind.SQL, output, sql=text, **kw)


def test_view_then_store(spark, tmp_store):
    metric = MetricSpec("chain", 3600, "sum(value)", "1", ("sample_size",), stages=(
        sql(HOURLY, OutputKind.VIEW, view_name="hourly_v"),
        sql("select * from hourly_v where val > 0", horizontal_level=1),
    ))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run(metric)
    assert result.ok, result.failed()
    parts = result.partitions()
    assert list(parts) == ["chain/1"]
    assert parts["chain/1"][0]["horizontal_level"] == 1
    stored = read_metrics(spark, tmp_store)
    assert stored.count() == spark.sql("select * from hourly_v where val > 0").count()
    assert {k for r in stored.collect() for k in r["func_vars"]} == {"sample_size"}


def test_python_stage_callable_and_module(spark, tmp_store):
    def stage(spark, threshold):
        return spark.sql(HOURLY).where(F.col("val") > threshold)

    metric = MetricSpec("py", 3600, "sum(value)", "1", (), stages=(
        StageSpec(StageKind.PYTHON, OutputKind.STORE, python=stage, python_args={"threshold": 0}),
    ))
    assert Runner(spark, store_path=tmp_store, compute_time=STAMP).run(metric).ok

    chained = MetricSpec("mod", 3600, "p90", "1", ("sample_size",), stages=(
        StageSpec(StageKind.PYTHON, OutputKind.VIEW, python="metricstore.plans.sample_stage",
                  python_args={"source": "events_t", "view_name": "p90_v"}),
        sql("select * from p90_v"),
    ))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run(chained)
    assert result.ok, result.failed()
    assert read_metrics(spark, tmp_store, ids=["mod"]).count() == spark.table("p90_v").count()


def test_failure_is_reported_and_later_stages_skipped(spark, tmp_store):
    bad = MetricSpec("bad", 1, "x", "1", (), stages=(
        sql("select * from no_such_table", OutputKind.VIEW, view_name="v"),
        sql("select * from v"),
    ))
    good = MetricSpec("good", 3600, "sum", "1", (), stages=(sql(HOURLY),))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run_all([bad, good])
    status = {o.stage_id: o.status for o in result.outcomes}
    assert status == {"bad/0": "failed", "bad/1": "skipped", "good/0": "ok"}
    report = result.report(spark)
    assert report.where("status = 'failed'").count() == 1
    assert read_metrics(spark, tmp_store).select("id").distinct().collect()[0]["id"] == "good"


def test_run_all_single_write_with_counts(spark, tmp_store):
    a = MetricSpec("a", 3600, "sum", "1", (), stages=(sql(HOURLY),))
    b = MetricSpec("b", 3600, "sum", "1", (), stages=(sql(HOURLY + " having count(1) > 1", horizontal_level=2),))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run_all([a, b])
    assert result.ok
    rows = {o.metric_id: o.rows for o in result.outcomes}
    stored = {r["id"]: r["count"] for r in read_metrics(spark, tmp_store).groupBy("id").count().collect()}
    assert rows == stored
    assert result.partitions()["b/0"][0]["horizontal_level"] == 2


def test_cached_view_and_params(spark, tmp_path):
    metric = MetricSpec("cached", 3600, "sum", "1", (), stages=(
        sql(HOURLY.replace("from events_t", "from events_t where ts >= to_timestamp_ntz(:dt_start)"),
            OutputKind.CACHED_VIEW, cached_view_name="hourly_cached"),
        sql("select measure_time, val from hourly_cached"),
    ))
    runner = Runner(spark, compute_time=STAMP, params={"dt_start": "2024-01-02 00:00:00"},
                    cache_database="test_cache", cache_location=str(tmp_path / "cache_db"))
    records = runner.plan(metric)
    assert records.count() == spark.table("test_cache.cached__hourly_cached").count() > 0
    assert records.agg(F.min("measure_time")).first()[0] >= 1704153600


def test_store_and_table_sinks(spark, tmp_store):
    metric = MetricSpec("both", 3600, "sum", "1", (), stages=(sql(HOURLY),))
    result = Runner(spark, store_path=tmp_store, table="metrics_central", compute_time=STAMP).run(metric)
    assert result.ok, result.failed()
    assert spark.table("metrics_central").count() == read_metrics(spark, tmp_store).count()
    spark.sql("drop table metrics_central")


def test_plan_raises_on_failure(spark):
    metric = MetricSpec("x", 1, "x", "1", (), stages=(sql("select 1 as val"),))
    with pytest.raises(RuntimeError):
        Runner(spark, compute_time=STAMP).plan(metric)


def test_run_all_in_batches(spark, tmp_store):
    metrics = [MetricSpec(f"b{i}", 3600, "sum", "1", (), stages=(sql(HOURLY),)) for i in range(5)]
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run_all(metrics, union_limit=2)
    assert result.ok
    n = spark.sql(HOURLY).count()
    assert [o.rows for o in result.outcomes] == [n] * 5
    assert read_metrics(spark, tmp_store).count() == 5 * n


def test_run_all_into_a_table_only(spark):
    metrics = [MetricSpec(f"t{i}", 3600, "sum", "1", (), stages=(sql(HOURLY),)) for i in range(2)]
    result = Runner(spark, table="metrics_only_table", compute_time=STAMP).run_all(metrics)
    assert result.ok, result.failed()
    got = {r["id"]: r["count"] for r in spark.table("metrics_only_table").groupBy("id").count().collect()}
    assert got == {"t0": spark.sql(HOURLY).count(), "t1": spark.sql(HOURLY).count()}
    spark.sql("drop table metrics_only_table")


def test_table_copy_once_across_batches(spark, tmp_store):
    two_stores = MetricSpec("two", 3600, "sum", "1", (), stages=(
        sql(HOURLY), sql(HOURLY, horizontal_level=1),
    ))
    result = Runner(spark, store_path=tmp_store, table="metrics_two_batches",
                    compute_time=STAMP).run_all([two_stores], union_limit=1)
    assert result.ok, result.failed()
    assert spark.table("metrics_two_batches").count() == read_metrics(spark, tmp_store).count() == 2 * spark.sql(HOURLY).count()
    spark.sql("drop table metrics_two_batches")


def test_repeated_runs_append_to_the_central_table(spark, tmp_store):
    metric = MetricSpec("again", 3600, "sum", "1", (), stages=(sql(HOURLY),))
    for hour in (12, 13):
        stamp = ComputeStamp.of(dt.datetime(2024, 2, 1, hour, tzinfo=dt.timezone.utc))
        assert Runner(spark, store_path=tmp_store, table="metrics_again", compute_time=stamp).run(metric).ok
    assert spark.table("metrics_again").count() == read_metrics(spark, tmp_store).count() == 2 * spark.sql(HOURLY).count()
    spark.sql("drop table metrics_again")


def two(metric_id="two", **kw):
    return MetricSpec(metric_id, 3600, "sum", "1", (), stages=(
        sql(HOURLY, **kw), sql("select 0 as measure_time, 1 as val, 'x' as other")))


@pytest.mark.parametrize("limit", [1, 64])
def test_replacing_partitions_keeps_all_stages_of_a_metric(spark, tmp_store, limit):
    n = spark.sql(HOURLY).count() + 1
    for _ in range(2):
        runner = Runner(spark, store_path=tmp_store, compute_time=STAMP, mode="overwrite_partitions")
        result = runner.run_all([two(), two("other")], union_limit=limit)
        assert result.ok and [o.rows for o in result.outcomes] == [n - 1, 1, n - 1, 1]
        assert read_metrics(spark, tmp_store).count() == 2 * n
    assert Runner(spark, store_path=tmp_store, compute_time=STAMP, mode="overwrite_partitions").run(two()).ok
    assert read_metrics(spark, tmp_store).count() == 2 * n


def test_partitions_are_those_of_each_stage(spark, tmp_store):
    metric = MetricSpec("levels", 3600, "sum", "1", (), stages=(sql(HOURLY), sql(HOURLY, horizontal_level=1)))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run_all([metric])
    assert {k: [p["horizontal_level"] for p in v] for k, v in result.partitions().items()} == {"levels/0": [0], "levels/1": [1]}
    by_column = MetricSpec("column", 3600, "sum", "1", (), stages=(
        sql("select 0 as measure_time, id as val, id % 3 as lv from range(9)", horizontal_level="lv"),))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run(by_column)
    assert [p["horizontal_level"] for p in result.partitions()["column/0"]] == [0, 1, 2]


def test_a_failing_metric_does_not_take_others_down(spark, tmp_store):
    bad = MetricSpec("bad", 1, "x", "1", (), stages=(
        sql("select 0 as measure_time, 1 div (id - 5) as val from range(10)"),))
    good = MetricSpec("good", 3600, "sum", "1", (), stages=(sql(HOURLY),))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run_all([bad, good])
    assert {o.stage_id: o.status for o in result.outcomes} == {"bad/0": "failed", "good/0": "ok"}
    assert "DIVIDE_BY_ZERO" in next(o.error for o in result.outcomes if o.status == "failed")
    counts = {r["id"]: r["count"] for r in read_metrics(spark, tmp_store).groupBy("id").count().collect()}
    assert counts == {"good": spark.sql(HOURLY).count()}


def test_metrics_may_share_a_cached_view_name(spark, tmp_store, tmp_path):
    def metric(name, where):
        return MetricSpec(name, 3600, "sum", "1", (), stages=(
            sql(f"select * from ({HOURLY}) where {where}", OutputKind.CACHED_VIEW, cached_view_name="shared"),
            sql("select * from shared")))

    runner = Runner(spark, store_path=tmp_store, compute_time=STAMP, cache_database="shared_cache",
                    cache_location=str(tmp_path / "db"))
    result = runner.run_all([metric("low", "val < 50"), metric("high", "val >= 50")])
    assert result.ok, result.failed()
    for name, where in (("low", "val < 50"), ("high", "val >= 50")):
        assert read_metrics(spark, tmp_store, ids=[name]).count() == spark.sql(HOURLY).where(where).count()


def test_duplicate_metric_ids_are_refused(spark, tmp_store):
    with pytest.raises(ValueError, match="duplicate"):
        Runner(spark, store_path=tmp_store).run_all([two(), two()])


@pytest.mark.parametrize("mode", ["append", "overwrite_partitions"])
def test_the_table_holds_what_the_store_holds(spark, tmp_store, mode):
    table = f"central_{mode}"
    n = spark.sql(HOURLY).count() + 1
    try:
        for times in (1, 2):
            runner = Runner(spark, store_path=tmp_store, table=table, compute_time=STAMP, mode=mode)
            assert runner.run(two()).ok
            want = n * times if mode == "append" else n
            stored = read_metrics(spark, tmp_store)
            assert stored.count() == want == spark.table(table).count()
            cols = ["measure_time", "val", "group_keys"]
            assert stored.select(cols).exceptAll(spark.table(table).select(cols)).isEmpty()
    finally:
        spark.sql(f"drop table if exists {table}")


def test_a_table_only_run_has_counts_and_partitions(spark):
    try:
        result = Runner(spark, table="central_only", compute_time=STAMP).run(two())
        assert [o.rows for o in result.outcomes] == [spark.sql(HOURLY).count(), 1]
        assert [len(p) for p in result.partitions().values()] == [1, 1]
    finally:
        spark.sql("drop table if exists central_only")


def test_a_failed_table_copy_is_reported_beside_the_stored_stages(spark, tmp_store):
    spark.sql("create table central_odd (a int) using parquet")
    try:
        result = Runner(spark, store_path=tmp_store, table="central_odd", compute_time=STAMP).run(two())
        assert [(o.stage_id, o.status) for o in result.outcomes] == [("two/0", "ok"), ("two/1", "ok"), ("two/table", "failed")]
        assert read_metrics(spark, tmp_store).count() == spark.sql(HOURLY).count() + 1
    finally:
        spark.sql("drop table central_odd")


def test_stage_params(spark):
    metric = MetricSpec("p", 1, "x", "1", (), stages=(
        sql("select 0 as measure_time, :a + :b as val", params={"b": 2}),))
    assert Runner(spark, compute_time=STAMP, params={"a": 40}).plan(metric).first()["val"] == 42.0
