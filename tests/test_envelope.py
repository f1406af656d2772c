"""The record projection: classification rule, record fields, schema, plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore import ENVELOPE, ComputeStamp, MetricSpec, classify, to_envelope, to_long
from metricstore.operators.envelope import check_envelope

STAMP = ComputeStamp.of(dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc))


def test_classification_rule():
    layout = classify(
        ["measure_time", "val", "region", "func_var_bin", "sample_size", "samples"],
        ["sample_size", "samples", "absent"],
    )
    assert [k for k, _ in layout.func_vars] == ["sample_size", "samples", "bin"]
    assert layout.groups == ("region",)


def test_declared_and_prefixed_collision_later_wins():
    layout = classify(["val", "measure_time", "x", "func_var_x", "g"], ["x"])
    assert layout.func_vars == (("x", "func_var_x"),)
    assert layout.groups == ("g",)


def test_managed_columns_may_be_functional_variables():
    layout = classify(["val", "measure_time", "g"], ["val"])
    assert layout.func_vars == (("val", "val"),)
    assert layout.groups == ("g",)


def test_rejects_missing_and_case_variant_columns():
    with pytest.raises(ValueError):
        classify(["val", "g"], [])
    with pytest.raises(ValueError):
        classify(["val", "measure_time", "A", "a"], [])


def test_metric_record(spark):
    # discount share of an order line, with a declared variable that the stage lacks
    metric = MetricSpec("discount_share", 900, "discounted / listed", "2.1", ("discounted", "listed", "absent"))
    schema = T.StructType([
        T.StructField("measure_time", T.LongType()), T.StructField("val", T.DoubleType()),
        T.StructField("discounted", T.DoubleType()), T.StructField("listed", T.LongType()),
        T.StructField("warehouse", T.MapType(T.StringType(), T.LongType(), False)),
        T.StructField("carrier", T.StringType()),
    ])
    df = spark.createDataFrame([(1700000100, 0.25, 12.5, 50, {"aisle": 7, "bay": 3}, "rail")], schema)
    rec = to_envelope(df, metric, horizontal_level=2, vertical_level=1, compute_time=STAMP)
    check_envelope(rec)
    row = rec.first()
    assert (row["id"], row["time_window"], row["func_expr"]) == ("discount_share", 900, "discounted / listed")
    assert (row["measure_time"], row["val"]) == (1700000100, 0.25)
    assert row["group_keys"] == ["warehouse", "carrier"]
    assert row["group_map"]["warehouse"]["map_long"] == {"aisle": 7, "bay": 3}
    assert {k: v["type"] for k, v in row["group_map"].items()} == {"warehouse": "map_long", "carrier": "string"}
    assert {k: v["type"] for k, v in row["func_vars"].items()} == {"discounted": "double", "listed": "long"}
    assert (row["compute_time"], row["compute_date"], row["compute_hour"]) == (1706788800, "2024-02-01", 12)
    assert (row["horizontal_level"], row["vertical_level"], row["version"]) == (2, 1, "2.1")


def test_schema_names_order_types(spark):
    df = spark.createDataFrame([(1, 2.0)], "measure_time long, val double")
    rec = to_envelope(df, MetricSpec("m", 60, "x", "1"), compute_time=STAMP)
    assert rec.columns == ENVELOPE.names
    assert [f.dataType.simpleString() for f in rec.schema] == [
        f.dataType.simpleString() for f in ENVELOPE
    ]
    row = rec.first()
    assert row["group_map"] == {} and row["group_keys"] == [] and row["func_vars"] == {}


def test_measure_time_types(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 3, 25, 1, 0), 1.0)], "measure_time timestamp_ntz, val double")
    assert to_envelope(df, MetricSpec("m", 1, "x", "1"), compute_time=STAMP).first()["measure_time"] == 1585098000
    df = spark.createDataFrame([(1585098000.7, 1.0)], "measure_time double, val double")
    assert to_envelope(df, MetricSpec("m", 1, "x", "1"), compute_time=STAMP).first()["measure_time"] == 1585098000
    df = spark.createDataFrame([("2020", 1.0)], "measure_time string, val double")
    with pytest.raises(TypeError):
        to_envelope(df, MetricSpec("m", 1, "x", "1"))


def test_nulls_kept_or_rejected_when_strict(spark):
    df = spark.createDataFrame([(None, None)], "measure_time long, val double")
    m = MetricSpec("m", 1, "x", "1")
    row = to_envelope(df, m, compute_time=STAMP).first()
    assert row["measure_time"] is None and row["val"] is None
    with pytest.raises(Exception):
        to_envelope(df, m, compute_time=STAMP, strict=True).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_value_that_does_not_convert_fails(spark, ansi):
    m = MetricSpec("m", 1, "x", "1")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([(1, "2.5"), (2, None)], "measure_time long, val string")
        assert [r["val"] for r in to_envelope(good, m, compute_time=STAMP).orderBy("measure_time").collect()] == [2.5, None]
        for row, ddl in (((1, "abc"), "measure_time long, val string"), ((1e300, 1.0), "measure_time double, val double")):
            with pytest.raises(Exception, match="does not convert"):
                to_envelope(spark.createDataFrame([row], ddl), m, compute_time=STAMP).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_measure_time_is_floored_before_1970(spark):
    m = MetricSpec("m", 1, "x", "1")
    for ddl in ("timestamp", "timestamp_ntz"):
        df = spark.sql(f"select cast('1969-12-31 23:59:58.5' as {ddl}) as measure_time, 1.0D as val union all "
                       f"select cast('1970-01-01 00:00:01.5' as {ddl}), 2.0D")
        got = {r["val"]: r["measure_time"] for r in to_envelope(df, m, compute_time=STAMP).collect()}
        assert got == {1.0: -2, 2.0: 1}
    df = spark.createDataFrame([(-1.5, 1.0)], "measure_time double, val double")
    assert to_envelope(df, m, compute_time=STAMP).first()["measure_time"] == -2


def test_level_records_name_their_own_attributes(spark):
    from metricstore.operators.levels import at_levels, roll_up_levels

    df = spark.createDataFrame([(0, "a", 1, 2.0), (0, "a", 2, 3.0), (0, None, 1, 5.0)], "measure_time long, g string, h long, v double")
    sets = [["measure_time"], ["measure_time", "g"], ["measure_time", "g", "h"]]
    for frame in (at_levels(df, sets, [F.sum("v").alias("val"), F.max("v").alias("func_var_top")]),
                  roll_up_levels(df, sets, {"val": ("sum", "v"), "func_var_top": ("max", "v")})):
        rec = to_envelope(frame, MetricSpec("m", 1, "x", "1"), horizontal_level="horizontal_level", compute_time=STAMP)
        got = sorted((r["horizontal_level"], tuple(r["group_keys"]), tuple(sorted(r["group_map"])),
                      str(r["group_map"]["g"]["string"]) if "g" in r["group_map"] else "-", r["val"]) for r in rec.collect())
        assert got == [
            (0, (), (), "-", 10.0),
            (1, ("g",), ("g",), "None", 5.0), (1, ("g",), ("g",), "a", 5.0),
            (2, ("g", "h"), ("g", "h"), "None", 5.0), (2, ("g", "h"), ("g", "h"), "a", 2.0), (2, ("g", "h"), ("g", "h"), "a", 3.0),
        ]
    with pytest.raises(ValueError):
        roll_up_levels(df, sets, {"val": ("avg", "v")})


def test_plan_stays_native(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = events.select(F.unix_timestamp("ts").alias("measure_time"), F.col("value").alias("val"),
                       "event_type", F.col("user_id").alias("func_var_user"))
    rec = to_envelope(df, MetricSpec("m", 1, "x", "1"), compute_time=STAMP)
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan
    # a filter on the record reaches the scan; only the needed columns are read
    pruned = rec.where(F.col("val") > 100).select("id", "val")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in plan
    assert "ReadSchema: struct<value:double>" in plan


def test_to_long_one_row_per_entry(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 3)], "measure_time long, val double, g string, func_var_n long")
    rows = to_long(to_envelope(df, MetricSpec("m", 1, "x", "1"), compute_time=STAMP)).collect()
    assert sorted((r["kind"], r["key"], r["type"], r["text"]) for r in rows) == [
        ("func", "n", "long", "3"), ("group", "g", "string", "a")]
    arr = spark.createDataFrame([(1, 2.0, [1, None], {"k": 1.5})], "measure_time long, val double, a array<long>, m map<string,double>")
    texts = {r["key"]: r["text"] for r in to_long(to_envelope(arr, MetricSpec("m", 1, "x", "1"), compute_time=STAMP)).collect()}
    assert texts == {"a": '["1","null"]', "m": '{"k":1.5}'}
    empty = spark.createDataFrame([(1, 2.0)], "measure_time long, val double")
    rows = to_long(to_envelope(empty, MetricSpec("m", 1, "x", "1"), compute_time=STAMP)).collect()
    assert len(rows) == 1 and rows[0]["kind"] is None


PARCELS = [  # time, depot, length in cm, weight in kg; totals by hand below
    ("2021-06-01 05:10:00", "north", 40.2, 1.25),
    ("2021-06-01 05:50:00", "north", 40.5, 2.5),
    ("2021-06-01 05:59:59", "south", 40.4, 4.0),
    ("2021-06-01 06:00:00", "north", 41.4, 0.75),
    ("2021-06-01 06:20:00", "south", 39.6, 3.0),
    ("2021-06-01 06:40:00", "south", 40.0, 1.5),
]


def test_totals_by_hand(spark):
    from metricstore import bucket_epoch, value_bin

    parcels = spark.createDataFrame(PARCELS, "time string, depot string, length double, weight double").withColumn(
        "time", F.to_timestamp("time"))
    hourly = parcels.groupBy(bucket_epoch("time", 3600).alias("measure_time")).agg(F.sum("weight").alias("val"))
    records = to_envelope(hourly, MetricSpec("weight_hourly", 3600, "sum(weight)", "1"), compute_time=STAMP)
    assert sorted((r["measure_time"], r["val"]) for r in records.collect()) == [(1622523600, 7.75), (1622527200, 5.25)]

    binned = parcels.groupBy(
        bucket_epoch("time", 86400).alias("measure_time"), "depot",
        value_bin("length", 1).cast("long").alias("func_var_length_bin"),
    ).agg(F.sum("weight").alias("val"))
    records = to_envelope(binned, MetricSpec("weight_binned", 86400, "sum(weight)", "1"), horizontal_level=1, compute_time=STAMP)
    got = sorted((r["group_map"]["depot"]["string"], r["func_vars"]["length_bin"]["long"], r["val"]) for r in records.collect())
    assert got == [("north", 40, 1.25), ("north", 41, 3.25), ("south", 40, 8.5)]
    assert {(r["measure_time"], r["horizontal_level"]) for r in records.collect()} == {(1622505600, 1)}


@pytest.mark.parametrize("bits", [2, 10])
def test_exact_quantiles(spark, bits):
    from metricstore.operators.quantiles import exact_quantiles

    inf, nan = float("inf"), float("nan")
    rows = ([("a", float(v)) for v in range(1, 11)] + [("b", 5.0), ("b", None), ("c", None), (None, 2.0), (None, 1.0)]
            + [("d", v) for v in (-inf, 1.0, 2.0, inf, nan)] + [("e", 1.0)] * 50 + [("e", 1e300), ("e", -1e300)])
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r["k"]: (r["p90"], r["p50"], r["p0"], r["sample_size"]) for r in
           exact_quantiles(df, ["k"], "v", {"p90": 0.9, "p50": 0.5, "p0": 0.0}, bits=bits).collect()}
    assert got["a"] == (9.0, 5.0, 1.0, 10)
    assert got["b"] == (5.0, 5.0, 5.0, 2)
    assert got["c"] == (None, None, None, 1)
    assert got[None] == (2.0, 1.0, 1.0, 2)
    assert str(got["d"]) == str((nan, 2.0, -inf, 5))
    assert got["e"] == (1.0, 1.0, -1e300, 52)
    assert exact_quantiles(df.where("false"), ["k"], "v", {"p": 0.5}).count() == 0


def test_exact_quantiles_of_one_large_group_are_stable(spark):
    from metricstore.operators.quantiles import exact_quantiles

    df = spark.range(200_000).select(F.lit("k").alias("k"), F.pmod(F.col("id") * 7919, F.lit(200_000)).alias("v"))
    for parts in (1, 3, 8):
        row = exact_quantiles(df.repartition(parts), ["k"], "v", {"p90": 0.9}).first()
        assert (row["p90"], row["sample_size"]) == (179999.0, 200_000)


def test_exact_quantiles_over_all_magnitudes_end_in_seven_rounds(spark, monkeypatch):
    from metricstore.operators import quantiles

    stored, made = quantiles._stored, []
    monkeypatch.setattr(quantiles, "_stored", lambda df: made.append(1) or stored(df))
    df = spark.range(6000).select(F.lit("k").alias("k"), F.pow(F.lit(10.0), F.col("id") / 10 - 300).alias("x")).select(
        "k", F.explode(F.array(F.col("x"), -F.col("x"))).alias("v"))
    row = quantiles.exact_quantiles(df, ["k"], "v", {"p90": 0.9, "p10": 0.1}).first()
    want = sorted(r["v"] for r in df.collect())
    assert (row["p90"], row["p10"], row["sample_size"]) == (want[10799], want[1199], 12000)
    assert len(made) <= 2 + 2 * 7
    # Values that differ in their last bits alone.
    close = spark.range(5000).select(F.lit(1).alias("k"), (1 + F.col("id") * F.lit(2.0 ** -52)).alias("v"))
    assert quantiles.exact_quantiles(close, ["k"], "v", {"p": 0.5}).first()["p"] == 1 + 2499 * 2.0 ** -52


def test_spread_repartitions_before_the_projection(spark):
    from metricstore import OutputKind, Runner, StageKind, StageSpec

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").createOrReplaceTempView("ev_spread")
    metric = MetricSpec("s", 1, "x", "1", (), stages=(
        StageSpec(StageKind.SQL, OutputKind.STORE, sql="select ts as measure_time, value as val, event_type from ev_spread"),))
    rec = Runner(spark, compute_time=STAMP, spread=4).plan(metric)
    plan = rec._jdf.queryExecution().executedPlan().toString()
    # the shuffle carries the three narrow stage columns, the records are built after it
    assert "RoundRobinPartitioning(4)" in plan
    assert rec.rdd.getNumPartitions() == 4


def test_column_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "measure_time long, val double, `a.b` string, `func_var_n m` long")
    row = to_envelope(df, MetricSpec("m", 1, "x", "1"), compute_time=STAMP).first()
    assert row["group_keys"] == ["a.b"] and row["group_map"]["a.b"]["string"] == "x"
    assert row["func_vars"]["n m"]["long"] == 3
