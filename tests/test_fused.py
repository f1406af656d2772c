"""Several metrics from one scan equal the same metrics run one by one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, Runner, read_metrics
from metricstore.plans.event_metrics import six_metrics
from metricstore.plans.fused import AggregateMetric, fused_records, run_fused

STAMP = ComputeStamp.of(dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc))


@pytest.fixture(autouse=True)
def events(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df.createOrReplaceTempView("fused_events")
    return df


def rows(df):
    """Records as comparable texts."""
    return sorted(str(r.asDict(recursive=True)) for r in df.collect())


def test_equals_single_runs(spark, tmp_store):
    single = Runner(spark, compute_time=STAMP).plan([m.as_metric("fused_events", "ts") for m in six_metrics()])
    result = run_fused(Runner(spark, store_path=tmp_store, compute_time=STAMP), "fused_events", "ts", six_metrics())
    assert result.ok, result.failed()
    stored = read_metrics(spark, tmp_store)

    def flat(df):
        return sorted(str(tuple(r)) for r in df.select(
            "id", "measure_time", "time_window", F.round("val", 3), F.array_join("group_keys", ","), "func_expr", "horizontal_level",
            "version", F.col("group_map")["event_type"]["string"], F.col("group_map")["user_id"]["long"],
            F.col("func_vars")["n"]["long"], F.size("group_map"), F.size("func_vars")).collect())

    assert flat(stored) == flat(single)
    counts = {r["id"]: r["count"] for r in stored.groupBy("id").count().collect()}
    assert {o.metric_id: o.rows for o in result.outcomes} == counts
    assert {k: [p["horizontal_level"] for p in v] for k, v in result.partitions().items()} == {
        f"{m.metric_id}/0": [m.horizontal_level] for m in six_metrics()}


def test_one_scan_in_the_plan(spark, events):
    records = fused_records(events, "ts", six_metrics(), STAMP)
    records.collect()
    plan = records._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "Union" not in final and "Python" not in final


def test_conditions_nulls_and_shared_names(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (5, None, 2.0), (12, "b", None), (None, "a", 4.0)], "t long, k string, v double")
    metrics = [
        AggregateMetric("one", 10, {"val": "sum(v)"}, {"k": "k"}),
        AggregateMetric("two", 0, {"val": "sum(v) / count(v)", "extra": "max(v)"}, {"k": "upper(k)"}, where="v > 1", func_vars=("extra",)),
        AggregateMetric("none", 10, {"val": "count(1)"}, where="v > 100"),
        # in the rows of other metrics this would divide by 0
        AggregateMetric("safe", 0, {"val": "1 / (count(v) - 1)"}),
    ]
    got = rows(fused_records(df, "t", metrics, STAMP))
    df.createOrReplaceTempView("fused_small")
    want = rows(Runner(spark, compute_time=STAMP).plan([m.as_metric("fused_small", "t") for m in metrics]))
    assert got == want and len(got) == 4 + 2 + 1


def test_a_metric_that_fails_leaves_the_others(spark, tmp_store):
    metrics = [AggregateMetric("good", 3600, {"val": "count(1)"}),
               AggregateMetric("bad", 3600, {"val": "sum(1 div (event_id - event_id))"})]
    result = run_fused(Runner(spark, store_path=tmp_store, compute_time=STAMP, run_log=True), "fused_events", "ts", metrics)
    assert {o.stage_id: o.status for o in result.outcomes} == {"good/0": "ok", "bad/0": "failed"}
    assert {r["id"] for r in read_metrics(spark, tmp_store).select("id").distinct().collect()} == {"good"}


def test_definitions_are_checked(events):
    with pytest.raises(ValueError, match="val"):
        fused_records(events, "ts", [AggregateMetric("x", 1, {"n": "count(1)"})], STAMP)
    with pytest.raises(ValueError, match="differ"):
        fused_records(events, "ts", [AggregateMetric("x", 1, {"val": "count(1)", "K": "max(value)"}, {"k": "user_id"})], STAMP)
    with pytest.raises(ValueError, match="duplicate"):
        fused_records(events, "ts", [AggregateMetric("x", 1, {"val": "count(1)"})] * 2, STAMP)
    with pytest.raises(ValueError, match="no metric"):
        fused_records(events, "ts", [], STAMP)
