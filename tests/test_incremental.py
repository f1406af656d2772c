"""Incremental runs: missing and open buckets only, whatever was stored before."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec, OutputKind, Runner, StageKind, StageSpec, read_metrics
from metricstore.plans import incremental
from metricstore.plans.incremental import bucket_ranges, covered_ranges, missing_buckets, run_incremental

HOUR, DAY = 3600, 86400
T0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())


def stamp(n):
    return ComputeStamp.of(T0 + 100 * DAY + n * HOUR)


def metric(name="m", seen=None, **kw):
    def stage(spark, dt_start, dt_end):
        if seen is not None:
            seen.append((dt_start, dt_end))
        low, high = F.unix_timestamp(F.lit(dt_start).cast("timestamp")), F.unix_timestamp(F.lit(dt_end).cast("timestamp"))
        rows = spark.table("ticks").where((F.col("t") >= low) & (F.col("t") < high))
        return rows.groupBy((F.floor(F.col("t") / HOUR) * HOUR).alias("measure_time"), "k").agg(F.sum("v").alias("val"))

    return MetricSpec(name, HOUR, "sum(v)", "1", (), stages=(
        StageSpec(StageKind.PYTHON, OutputKind.STORE, python=lambda spark: stage(spark, *bounds[-1]), **kw),))


bounds = [("", "")]


@pytest.fixture(autouse=True)
def ticks(spark, monkeypatch):
    # every 20 minutes for two days, but for hours 10 to 12 of the first
    rows = [(T0 + i * 1200, i % 2, float(i)) for i in range(2 * 72) if not 30 <= i < 39]
    spark.createDataFrame(rows, "t long, k int, v double").createOrReplaceTempView("ticks")
    # a Python stage without parameters of its own reads the run's through this list
    run = Runner.stage_frame
    monkeypatch.setattr(Runner, "stage_frame", lambda self, m, s, st: (
        bounds.append((self.params["dt_start"], self.params["dt_end"])), run(self, m, s, st))[1])


def at(hour):
    return dt.datetime.fromtimestamp(T0 + hour * HOUR, dt.timezone.utc)


def hours(df):
    return sorted({(r[0] - T0) // HOUR for r in df.select("measure_time").collect()})


def whole(spark):
    return {(r["measure_time"], r["k"]): r["v"] for r in spark.table("ticks").groupBy(
        (F.floor(F.col("t") / HOUR) * HOUR).alias("measure_time"), "k").agg(F.sum("v").alias("v")).collect()}


def test_second_run_computes_what_is_missing(spark, tmp_store):
    seen = []
    options = dict(store_path=tmp_store)
    m = metric(seen=seen)
    assert run_incremental(Runner(spark, compute_time=stamp(0), **options), m, at(0), at(20)).ok
    assert run_incremental(Runner(spark, compute_time=stamp(1), **options), m, at(0), at(30), lookback=2 * HOUR).ok
    assert seen[0] == ("2024-01-01 00:00:00", "2024-01-01 20:00:00")
    assert seen[1:] == [("2024-01-01 20:00:00", "2024-01-02 06:00:00")]
    third = run_incremental(Runner(spark, compute_time=stamp(2), **options), m, at(0), at(48))
    assert seen[2:] == [("2024-01-02 04:00:00", "2024-01-03 00:00:00")]  # hours 28 and 29 were still open
    by_run = {n: hours(read_metrics(spark, tmp_store).where(F.col("compute_time") == stamp(n).epoch)) for n in range(3)}
    assert by_run == {0: [h for h in range(20) if not 10 <= h < 13], 1: list(range(20, 30)), 2: list(range(28, 48))}
    got = {(r["measure_time"], r["group_map"]["k"]["long"]): r["val"] for r in read_metrics(spark, tmp_store, latest=True).collect()}
    assert got == whole(spark) and third.outcomes[0].rows == 40
    # nothing left: hours without data are not asked for again
    again = run_incremental(Runner(spark, compute_time=stamp(3), **options), m, at(0), at(48))
    assert again.ok and [o.rows for o in again.outcomes] == [0] and len(seen) == 3
    assert covered_ranges(spark, tmp_store).count() == 3


@pytest.mark.parametrize("most", [1, 8])
def test_gaps_between_stored_buckets(spark, tmp_store, most):
    seen = []
    m = metric(seen=seen)
    for n, (a, b) in enumerate([(2, 4), (8, 10), (20, 21)]):
        assert run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(n)), m, at(a), at(b)).ok
    del seen[:]
    result = run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(5)), m, at(0), at(24), most_ranges=most)
    assert result.ok and len(seen) == (4 if most == 8 else 1)
    written = read_metrics(spark, tmp_store).where(F.col("compute_time") == stamp(5).epoch)
    held = {2, 3, 8, 9, 20}
    assert hours(written) == [h for h in range(24) if h not in held and not 10 <= h < 13]
    assert read_metrics(spark, tmp_store).groupBy("measure_time", F.col("group_map")["k"]["long"]).count().agg(F.max("count")).first()[0] == 1


def test_records_of_plain_runs_count_as_closed(spark, tmp_store):
    m = metric()
    plain = Runner(spark, store_path=tmp_store, compute_time=stamp(0), params={"dt_start": "2024-01-01 00:00:00", "dt_end": "2024-01-01 05:00:00"})
    assert plain.run(m).ok
    assert run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(1)), m, at(0), at(8)).ok
    assert hours(read_metrics(spark, tmp_store).where(F.col("compute_time") == stamp(1).epoch)) == [5, 6, 7]


def test_other_versions_and_unfinished_buckets(spark, tmp_store):
    m = metric()
    assert run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(0)), m, at(0), T0 + 2 * HOUR + 60).ok
    assert hours(read_metrics(spark, tmp_store)) == [0, 1]
    other = MetricSpec("m", HOUR, "sum(v)", "2", (), stages=m.stages)
    assert run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(1)), other, at(0), at(1)).ok
    assert read_metrics(spark, tmp_store).where("version = '2'").count() == 2
    empty = run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(2)), m, at(5), at(5))
    assert empty.ok and empty.outcomes[0].rows == 0


def test_a_failed_run_covers_nothing(spark, tmp_store):
    bad = MetricSpec("bad", HOUR, "x", "1", (), stages=(
        StageSpec(StageKind.SQL, OutputKind.STORE, sql="select 1 div (id - 3) as val, 0 as measure_time from range(5)"),))
    result = run_incremental(Runner(spark, store_path=tmp_store, compute_time=stamp(0)), [bad, metric()], 0, HOUR)
    assert {o.metric_id: o.status for o in result.outcomes} == {"bad": "failed", "m": "ok"}
    assert [r["id"] for r in covered_ranges(spark, tmp_store).collect()] == ["m"]


def test_arguments(spark, tmp_store):
    runner = Runner(spark, store_path=tmp_store)
    with pytest.raises(ValueError, match="time_window"):
        run_incremental(runner, MetricSpec("x", 0, "x", "1"), 0, 10)
    with pytest.raises(ValueError, match="lookback"):
        run_incremental(runner, metric(), 0, 10, lookback=-1)
    with pytest.raises(ValueError, match="store"):
        run_incremental(Runner(spark), metric(), 0, 10)
    with pytest.raises(ValueError, match="append"):
        run_incremental(Runner(spark, store_path=tmp_store, mode="overwrite_partitions"), metric(), 0, 10)


def test_ranges_of_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (0, 10, 20, 50, 70, 80)], "measure_time long")
    assert bucket_ranges(df, 10, 8) == [(0, 30), (50, 60), (70, 90)]
    assert bucket_ranges(df, 10, 2) == [(0, 90)]
    assert bucket_ranges(df.where("false"), 10, 8) == []
    assert hours(missing_buckets(spark, metric(), T0 + 5, T0 + 2 * HOUR + 1)) == [0, 1, 2]
    assert incremental.expected_buckets(spark, -5, 5, 10).collect()[0][0] == -10
