"""Reading back: as of given times, and as typed wide rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec, OutputKind, Runner, StageKind, StageSpec, read_metrics
from metricstore.operators.asof import read_as_of, runs_as_of
from metricstore.operators.envelope import to_envelope
from metricstore.operators.wide import to_wide, value_keys


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_runs_as_of_equals_a_lookup(spark, ranges):
    rng = random.Random(ranges)
    keys = ["a", "b", None, "hot"]
    runs = [(k, rng.randint(-50, 50)) for k in keys for _ in range(6)] + [("b", None), ("hot", 50), ("hot", 50)]
    asked = [(i, "hot" if i % 2 else rng.choice([*keys, "unknown"]), None if i % 17 == 0 else rng.randint(-80, 80)) for i in range(300)]
    left = spark.createDataFrame(asked, "n int, k string, at long").repartition(4)
    right = spark.createDataFrame(runs, "k string, made long")
    got = {r["n"]: r["run"] for r in runs_as_of(left, right, ["k"], "at", "made", ranges=ranges).collect()}
    want = {n: max((t for x, t in runs if x == k and t is not None and at is not None and t <= at), default=None) for n, k, at in asked}
    assert got == want


def test_runs_as_of_edges(spark):
    left = spark.createDataFrame([(1, 5)], "k int, at long")
    none = spark.createDataFrame([], "k int, made long")
    assert [tuple(r) for r in runs_as_of(left, none, ["k"], "at", "made").collect()] == [(1, 5, None)]
    assert runs_as_of(left.where("false"), left, ["k"], "at", "at").count() == 0
    with pytest.raises(ValueError, match="column"):
        runs_as_of(left, none, ["k"], "at", "made", name="at")
    with pytest.raises(ValueError, match="ranges"):
        runs_as_of(left, none, ["k"], "at", "made", ranges=0)


def test_read_as_of_gives_all_records_of_the_run(spark, tmp_store):
    def metric(times):
        return MetricSpec("m", 0, "x", "1", (), stages=(StageSpec(
            StageKind.SQL, OutputKind.STORE,
            sql=f"select 0 as measure_time, id * {times} as val, id % 2 as g, id as func_var_part from range(4)"),))

    for hour in (1, 2):
        stamp = ComputeStamp.of(dt.datetime(2024, 1, 1, hour, tzinfo=dt.timezone.utc))
        assert Runner(spark, store_path=tmp_store, compute_time=stamp).run(metric(hour)).ok
    first = int(dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    rows = spark.createDataFrame([("early", 0, first - 1), ("one", 0, first), ("two", 1, first + 3600), ("no group", 9, first)],
                                 "name string, g long, as_of long")
    on = {"g": F.col("group_map")["g"]["long"]}
    out = read_as_of(read_metrics(spark, tmp_store), rows, on, columns={"val": F.col("val")}).collect()
    got = sorted((r["name"], r["compute_time"], r["val"]) for r in out if r["val"] is not None)
    assert got == [("one", first, 0.0), ("one", first, 2.0), ("two", first + 3600, 2.0), ("two", first + 3600, 6.0)]
    assert sorted(r["name"] for r in out if r["val"] is None) == ["early", "no group"]
    assert read_as_of(read_metrics(spark, tmp_store), rows, on, columns={"val": F.col("val")}, how="inner").count() == 4
    with pytest.raises(ValueError, match="already"):
        read_as_of(read_metrics(spark, tmp_store), rows, on, columns={"name": F.col("val")})


STAMP = ComputeStamp.of(0)


def wide(df, func_vars=(), **kw):
    return to_wide(to_envelope(df, MetricSpec("w", 0, "x", "1", tuple(func_vars)), compute_time=STAMP), **kw)


def test_stored_rows_come_back(spark, tmp_store):
    df = spark.createDataFrame(
        [(1, 1.5, "x", True, 3, [1, 2], ["a"], {"k": 1.0}, None), (2, None, None, None, None, [], ["b", "c"], {}, 2.5),
         (3, 0.0, "y", False, 4, [7, None], [], {"k": None, "l": 2.0}, -1.0)],
        "measure_time long, val double, s string, b boolean, n long, ids array<long>, names array<string>, m map<string,double>, d double")
    df = df.withColumn("dec", F.col("n").cast("decimal(10,1)") / 2)
    stage = StageSpec(StageKind.PYTHON, OutputKind.STORE, python=lambda spark: df)
    metric = MetricSpec("w", 0, "x", "1", ("n", "ids", "m"), stages=(stage,))
    assert Runner(spark, store_path=tmp_store, compute_time=STAMP).run(metric).ok
    got = to_wide(read_metrics(spark, tmp_store, ids=["w"]))
    assert got.columns == ["measure_time", "val", "b", "d", "dec", "names", "s", "ids", "m", "n"]
    want = df.withColumn("dec", F.col("dec").cast("double")).select(got.columns)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_mixed_types(spark):
    parts = ["select 0 as measure_time, 1 as val, 1 as a, 'x' as t", "select 0, 1, 2.5D, 'y'"]
    records = None
    for p in parts:
        one = to_envelope(spark.sql(p).toDF("measure_time", "val", "a", "t"), MetricSpec("w", 0, "x", "1"), compute_time=STAMP)
        records = one if records is None else records.unionByName(one)
    assert sorted(r["a"] for r in to_wide(records).collect()) == [1.0, 2.5]
    big = to_envelope(spark.sql(f"select 0 as measure_time, 1 as val, {(1 << 53) + 1} as a, 'z' as t"), MetricSpec("w", 0, "x", "1"), compute_time=STAMP)
    with pytest.raises(ValueError, match="long"):
        to_wide(records.unionByName(big))
    texts = to_envelope(spark.sql("select 0 as measure_time, 1 as val, 'one' as a, 'z' as t"), MetricSpec("w", 0, "x", "1"), compute_time=STAMP)
    with pytest.raises(ValueError, match="group key 'a'"):
        to_wide(records.unionByName(texts))
    assert sorted(r["a"] for r in to_wide(records.unionByName(texts), on_conflict="text").collect()) == ["1", "2.5", "one"]
    other = to_envelope(spark.sql("select 0 as measure_time, 1 as val, true as c"), MetricSpec("w", 0, "x", "1"), compute_time=STAMP)
    assert {str(tuple(r)) for r in to_wide(records.unionByName(other)).select("a", "c").collect()} == {
        "(1.0, None)", "(2.5, None)", "(None, True)"}


def test_names_and_limits(spark):
    df = spark.sql("select 0 as measure_time, 1 as val, 2 as k, 3 as func_var_k")
    with pytest.raises(ValueError, match="func_prefix"):
        wide(df)
    assert wide(df, func_prefix="f_", scalars=("id",)).columns == ["measure_time", "val", "id", "k", "f_k"]
    with pytest.raises(ValueError, match="record columns"):
        wide(df, scalars=("nothing",))
    with pytest.raises(ValueError, match="more than 1"):
        wide(df, func_prefix="f_", most_keys=1)
    assert wide(df.where("false")).columns == ["measure_time", "val"]
    plain = to_envelope(df, MetricSpec("w", 0, "x", "1"), compute_time=STAMP)
    assert {(r["kind"], r["key"], r["type"], r["n"]) for r in value_keys(plain).collect()} == {
        ("group", "k", "long", 1), ("func", "k", "long", 1)}
