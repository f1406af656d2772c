"""Compaction: the same records from fewer files, beside appends, and nothing the second time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec, OutputKind, Runner, StageKind, StageSpec, compact_store, read_metrics
from metricstore.sinks import compact
from metricstore.sinks.runlog import log_path, read_log, unpublished
from metricstore.sources.store import stored_files

STAMP = ComputeStamp.of(dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc))
IDS, DATES = ["m"], [STAMP.date]


def run(spark, store, spread=5, **kw):
    text = "select id as measure_time, id / 3 as val, id % 2 as lv, repeat(cast(id as string), 50) as k from range(400)"
    metric = MetricSpec("m", 0, "x", "1", (), stages=(
        StageSpec(StageKind.SQL, OutputKind.STORE, sql=text, horizontal_level="lv"),))
    assert Runner(spark, store_path=store, compute_time=STAMP, spread=spread, run_log=True, **kw).run(metric).ok


def content(spark, store):
    return sorted((r["measure_time"], r["val"], r["horizontal_level"], r["group_map"]["k"]["string"]) for r in read_metrics(spark, store).collect())


def files(spark, store):
    found = compact.live_files(stored_files(spark, store, IDS, DATES), read_log(spark, log_path(store)))
    return {r["horizontal_level"]: r["count"] for r in found.groupBy("horizontal_level").count().collect()}


def test_one_file_a_partition_then_nothing(spark, tmp_store):
    run(spark, tmp_store)
    run(spark, tmp_store)
    want = content(spark, tmp_store)
    assert files(spark, tmp_store) == {0: 10, 1: 10}
    report = compact_store(spark, tmp_store, ids=IDS, dates=DATES).collect()
    assert sorted((r["horizontal_level"], r["files"], r["files_after"]) for r in report) == [(0, 10, 1), (1, 10, 1)]
    assert files(spark, tmp_store) == {0: 1, 1: 1} and content(spark, tmp_store) == want
    commits = read_log(spark, log_path(tmp_store)).count()
    assert {r["files_after"] for r in compact_store(spark, tmp_store, ids=IDS, dates=DATES).collect()} == {1}
    assert read_log(spark, log_path(tmp_store)).count() == commits
    left = unpublished(stored_files(spark, tmp_store, IDS, DATES), read_log(spark, log_path(tmp_store)), "store")
    assert left.count() == 20
    run(spark, tmp_store)  # new files are packed with the old
    assert files(spark, tmp_store) == {0: 6, 1: 6}
    compact_store(spark, tmp_store, ids=IDS, dates=DATES).collect()
    assert files(spark, tmp_store) == {0: 1, 1: 1} and len(content(spark, tmp_store)) == 1200


def test_bins_follow_the_target(spark, tmp_store):
    run(spark, tmp_store, spread=8)
    want = content(spark, tmp_store)
    before = compact.live_files(stored_files(spark, tmp_store, IDS, DATES), read_log(spark, log_path(tmp_store)))
    size = before.agg(F.avg("bytes")).first()[0]
    report = compact_store(spark, tmp_store, ids=IDS, dates=DATES, target_bytes=int(size * 3)).collect()
    after = files(spark, tmp_store)
    for r in report:
        assert r["files"] == 8 and 2 <= r["files_after"] <= 4 and after[r["horizontal_level"]] == r["files_after"]
    assert content(spark, tmp_store) == want
    assert [r["files"] for r in compact_store(spark, tmp_store, ids=IDS, dates=DATES, target_bytes=1).collect()] == list(after.values())


def test_an_append_meanwhile_is_kept(spark, tmp_store, monkeypatch):
    run(spark, tmp_store)
    write = compact.write_store
    monkeypatch.setattr(compact, "writes_in", lambda df: (lambda known: (run(spark, tmp_store, spread=2), known | later())[1])(old(df)))
    old = __import__("metricstore.sinks.runlog", fromlist=["x"]).writes_in

    def later():
        return old(stored_files(spark, tmp_store, IDS, DATES))

    compact_store(spark, tmp_store, ids=IDS, dates=DATES)
    monkeypatch.undo()
    assert write is compact.write_store
    assert len(content(spark, tmp_store)) == 800 and files(spark, tmp_store) == {0: 3, 1: 3}


def test_a_failed_commit_changes_nothing(spark, tmp_store, monkeypatch):
    run(spark, tmp_store)
    want = content(spark, tmp_store)
    monkeypatch.setattr(compact.Commit, "publish", lambda self: (_ for _ in ()).throw(OSError("no log")))
    with pytest.raises(OSError):
        compact_store(spark, tmp_store, ids=IDS, dates=DATES)
    monkeypatch.undo()
    assert content(spark, tmp_store) == want and files(spark, tmp_store) == {0: 5, 1: 5}


def test_a_store_without_log_is_refused(spark, tmp_store):
    assert Runner(spark, store_path=tmp_store, compute_time=STAMP).run(MetricSpec("m", 0, "x", "1", (), stages=(
        StageSpec(StageKind.SQL, OutputKind.STORE, sql="select 0 as measure_time, 1 as val"),))).ok
    with pytest.raises(ValueError, match="run log"):
        compact_store(spark, tmp_store, ids=IDS, dates=DATES)


def test_live_files_read_the_store_once(spark, tmp_store):
    run(spark, tmp_store, spread=3)
    run(spark, tmp_store, spread=3)
    files = compact.live_files(stored_files(spark, tmp_store, IDS, DATES), read_log(spark, log_path(tmp_store)))
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "orc" in line for line in plan.splitlines()) == 1
    assert len({r["write"] for r in files.collect()}) == 2
