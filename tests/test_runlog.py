"""The run log: what is not committed does not count, whatever is left in the folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec, OutputKind, Runner, StageKind, StageSpec, read_metrics
from metricstore.plans import runner as runner_module
from metricstore.sinks import runlog
from metricstore.sinks.store import write_store
from metricstore.sources.store import read_table

STAMP = ComputeStamp.of(dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc))


def metric(name, rows=9, levels=0, **kw):
    text = f"select id * 3600 as measure_time, id as val, id % 3 as lv from range({rows})"
    return MetricSpec(name, 3600, "id", "1", (), stages=(
        StageSpec(StageKind.SQL, OutputKind.STORE, sql=text, horizontal_level=levels, **kw),))


def counts(df):
    return {r["id"]: r["count"] for r in df.groupBy("id").count().collect()}


def test_abandoned_attempts_do_not_count(spark, tmp_store):
    options = dict(store_path=tmp_store, compute_time=STAMP, run_log=True)
    write_store(Runner(spark, compute_time=STAMP).plan([metric("a"), metric("b")]), tmp_store)
    assert read_metrics(spark, tmp_store).count() == 18  # no log yet: every file counts
    assert read_metrics(spark, tmp_store, run_log=True).count() == 0
    result = Runner(spark, **options).run(metric("a"))
    assert result.ok and [o.rows for o in result.outcomes] == [9]
    assert counts(read_metrics(spark, tmp_store)) == {"a": 9}
    assert counts(read_metrics(spark, tmp_store, ids=["a", "b"], dates=[STAMP.date])) == {"a": 9}
    assert counts(read_metrics(spark, tmp_store, run_log=False)) == {"a": 18, "b": 9}
    log = runlog.read_log(spark, runlog.log_path(tmp_store))
    left = runlog.unpublished(spark.read.schema(read_metrics(spark, tmp_store).schema).orc(tmp_store), log, "store")
    assert {r["id"]: r["n"] for r in left.groupBy("id").agg(F.sum("rows").alias("n")).collect()} == {"a": 9, "b": 9}


def test_replacing_takes_effect_at_the_commit(spark, tmp_store, monkeypatch):
    options = dict(store_path=tmp_store, compute_time=STAMP, run_log=True)
    assert Runner(spark, **options).run(metric("a", levels="lv")).ok
    assert Runner(spark, **options).run(metric("a", levels="lv")).ok
    assert counts(read_metrics(spark, tmp_store)) == {"a": 18}
    replacing = Runner(spark, mode="overwrite_partitions", **options)
    publish = runlog.Commit.publish
    monkeypatch.setattr(runlog.Commit, "publish", lambda self: (_ for _ in ()).throw(OSError("no log today")))
    assert replacing.run(metric("a", rows=6, levels="lv")).failed()[0].error == "OSError: no log today"
    assert counts(read_metrics(spark, tmp_store)) == {"a": 18}
    monkeypatch.setattr(runlog.Commit, "publish", publish)
    for _ in range(2):  # a rerun changes nothing
        assert replacing.run(metric("a", rows=4, levels="lv")).ok
        assert counts(read_metrics(spark, tmp_store)) == {"a": 4}
    # level 2 is replaced alone: 0 and 1 stay
    assert replacing.run(metric("a", rows=1, levels=2)).ok
    got = read_metrics(spark, tmp_store).groupBy("horizontal_level").count().collect()
    assert {r[0]: r[1] for r in got} == {0: 2, 1: 1, 2: 1}
    assert Runner(spark, **options).run(metric("a", rows=5, levels=2)).ok
    assert read_metrics(spark, tmp_store, horizontal_levels=[2]).count() == 6


@pytest.mark.parametrize("failures", [1, 3])
def test_a_commit_that_fails_is_repeated_metric_by_metric(spark, tmp_store, monkeypatch, failures):
    publish, left = runlog.Commit.publish, [failures]

    def failing(self):
        if left[0]:
            left[0] -= 1
            raise OSError("listing failed")
        publish(self)

    monkeypatch.setattr(runlog.Commit, "publish", failing)
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP, run_log=True).run_all([metric("a"), metric("b")])
    want = {"a": 9, "b": 9} if failures == 1 else {}
    assert {o.metric_id: o.rows for o in result.outcomes if o.status == "ok"} == want
    assert counts(read_metrics(spark, tmp_store, run_log=True)) == want


def test_store_and_table_show_a_run_together(spark, tmp_store, monkeypatch):
    table, log = "runlog_central", runlog.log_path(tmp_store)
    options = dict(store_path=tmp_store, table=table, compute_time=STAMP, run_log=True)
    spark.sql(f"drop table if exists {table}")
    write = runner_module.write_table
    try:
        assert Runner(spark, **options).run(metric("a")).ok

        def late(*args, **kw):
            write(*args, **kw)
            raise OSError("lost the connection")

        monkeypatch.setattr(runner_module, "write_table", late)
        assert [o.status for o in Runner(spark, **options).run(metric("b")).outcomes] == ["failed"]
        assert counts(read_metrics(spark, tmp_store)) == counts(read_table(spark, table, run_log=log)) == {"a": 9}
        assert counts(spark.table(table)) == {"a": 9, "b": 9}
        monkeypatch.setattr(runner_module, "write_table", write)
        assert Runner(spark, **options).run(metric("b")).ok
        assert counts(read_metrics(spark, tmp_store)) == counts(read_table(spark, table, run_log=log)) == {"a": 9, "b": 9}
        assert Runner(spark, table=table, compute_time=STAMP, run_log=log, mode="overwrite_partitions").run(metric("a", rows=2)).ok
        assert counts(read_table(spark, table, run_log=log, latest=True)) == {"a": 2, "b": 9}
    finally:
        spark.sql(f"drop table if exists {table}")


def test_a_log_needs_a_place_and_files(spark):
    with pytest.raises(ValueError, match="path of the log"):
        Runner(spark, table="t", run_log=True)
    with pytest.raises(ValueError, match="run log"):
        Runner(spark, table="t", table_format="bigquery", run_log="/tmp/x")


def test_nothing_is_read_after_a_write_without_a_log(spark, tmp_store, monkeypatch):
    def no(*args, **kw):
        raise OSError("the store cannot be listed")

    monkeypatch.setattr(runner_module, "stored_files", no)
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run_all([metric("a", levels="lv"), metric("b", levels="lv")])
    assert {o.stage_id: (o.status, o.rows) for o in result.outcomes} == {"a/0": ("ok", 9), "b/0": ("ok", 9)}
    assert counts(read_metrics(spark, tmp_store)) == {"a": 9, "b": 9}


def test_partitions_belong_to_their_stage(spark, tmp_store):
    both = MetricSpec("m", 3600, "id", "1", (), stages=(
        metric("x", levels="lv").stages[0],
        StageSpec(StageKind.SQL, OutputKind.STORE, sql="select 0 as measure_time, 1 as val", horizontal_level=1, vertical_level=5),
        StageSpec(StageKind.SQL, OutputKind.STORE, sql="select 0 as measure_time, 1 as val where false")))
    result = Runner(spark, store_path=tmp_store, compute_time=STAMP).run(both)
    got = {k: [(p["horizontal_level"], p["vertical_level"]) for p in v] for k, v in result.partitions().items()}
    assert got == {"x/0": [(0, 0), (1, 0), (2, 0)], "m/1": [(1, 5)], "m/2": []}
