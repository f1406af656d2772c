"""Mergeable summaries across levels, and bounded samples of distinct values."""

import hashlib

import pytest
from pyspark.sql import functions as F

from metricstore import ComputeStamp, MetricSpec
from metricstore.operators.envelope import to_envelope
from metricstore.operators.samples import distinct_samples
from metricstore.operators.sketches import (
    Distinct, Percentile, Plain, distinct_bound, estimates, merge_summaries, rank_bound, sketch_levels, summaries)


def test_levels_are_within_their_bounds(spark):
    n = 60_000
    df = spark.range(n).select(F.lit(0).cast("long").alias("measure_time"), (F.col("id") % 3).alias("a"), (F.col("id") % 7).alias("b"),
                               F.pmod(F.col("id") * 48271, F.lit(n)).cast("double").alias("v"), (F.col("id") % 20_000).alias("u"))
    measures = {"val": Percentile("v", 0.9), "low": Percentile("v", 0.1), "users": Distinct("u"), "total": Plain("sum", "v"), "n": Plain("count", "v")}
    k, lg_k = 400, 12
    got = sketch_levels(df, [["measure_time"], ["measure_time", "a"], ["measure_time", "a", "b"]], measures, k=k, lg_k=lg_k)
    records = to_envelope(got, MetricSpec("s", 0, "p90", "1", ("low", "users", "total", "n")), horizontal_level="horizontal_level",
                          compute_time=ComputeStamp.of(0)).collect()
    rows = [(r["v"], r["a"], r["b"], r["u"]) for r in df.collect()]
    assert len(records) == 1 + 3 + 21
    for r in records:
        keys = {k: v["long"] for k, v in r["group_map"].items()}
        assert sorted(keys) == ["a", "b"][:r["horizontal_level"]]
        mine = [x for x in rows if all(x[1 if k == "a" else 2] == v for k, v in keys.items())]
        values = sorted(x[0] for x in mine)
        f = r["func_vars"]
        for p, value in ((0.9, r["val"]), (0.1, f["low"]["double"])):
            rank = sum(v <= value for v in values) / len(values)
            assert abs(rank - p) <= 2 * rank_bound(k) + 1 / len(values)
        users = len({x[3] for x in mine})
        assert abs(f["users"]["long"] - users) <= 2 * distinct_bound(lg_k) * users
        assert f["n"]["long"] == len(mine) and f["total"]["double"] == sum(values)


def test_summaries_are_stored_and_merged_later(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") % 10).alias("day"), F.col("id").cast("double").alias("v"), (F.col("id") % 50).cast("string").alias("u"))
    measures = {"p": Percentile("v", 0.5), "d": Distinct("u"), "top": Plain("max", "v")}
    path = str(tmp_path / "daily")
    for half in ("day < 5", "day >= 5"):
        summaries(df.where(half), ["day"], measures, k=800).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    row = estimates(merge_summaries(stored, [], measures), measures).first()
    assert abs(row["p"] - 1500) <= 3000 * 2 * rank_bound(800) and abs(row["d"] - 50) <= 1 and row["top"] == 2999.0
    weeks = stored.withColumn("week", F.floor(F.col("day") / 7))
    assert {r["week"]: r["top"] for r in estimates(merge_summaries(weeks, ["week"], measures), measures).collect()} == {0: 2996.0, 1: 2999.0}


def test_groups_without_values(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.0, "x"), (None, 2.0, "x"), (None, float("inf"), None)], "k string, v double, u string")
    m = {"p": Percentile("v", 0.5), "d": Distinct("u")}
    out = {r["k"]: (r["p"], r["d"]) for r in estimates(summaries(df, ["k"], m), m).collect()}
    assert out == {"a": (None, 0), "b": (1.0, 1), None: (2.0, 1)}
    assert estimates(summaries(df.where("false"), ["k"], m), m).count() == 0
    with pytest.raises(ValueError):
        Percentile("v", 1.5)
    with pytest.raises(ValueError):
        Plain("median", "v")


def md5(x):
    return hashlib.md5(str(x).encode()).hexdigest()


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_samples_are_the_smallest_hashes(spark, k):
    rows = [("hot", i % 300) for i in range(3000)] + [("one", 7)] * 4 + [("none", None)] * 2 + [(None, 1), (None, None), (None, 2)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r["k"]: (r["samples"], r["distinct_count"], r["sample_size"]) for r in distinct_samples(df.repartition(6), ["k"], "v", k).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        values = {v for x, v in rows if x == key and v is not None}
        want[key] = (sorted(values, key=lambda v: (md5(v), v))[:k], len(values), sum(x == key for x, _ in rows))
    assert got == want


def test_samples_limit_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    out = distinct_samples(df, ["k"], "v", 5)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan
    with pytest.raises(ValueError):
        distinct_samples(df, ["k"], "v", 0)
    with pytest.raises(ValueError, match="name both"):
        distinct_samples(df.withColumnRenamed("k", "samples"), ["samples"], "v")


def plain_bins(values, n):
    ranked = sorted(v for v in values if v is not None)
    edges = [ranked[max(0, -(-i * len(ranked) // n) - 1)] for i in range(1, n)] if ranked else None
    return edges, [None if v is None else 1 + sum(e < v for e in edges) for v in values]


@pytest.mark.parametrize("n", [1, 2, 4, 10])
def test_equal_frequency_bins(spark, n):
    from metricstore.operators.bins import equal_frequency_bins

    groups = {"a": [float(i * 7 % 40) for i in range(40)], "ties": [1.0] * 9 + [2.0], "one": [5.0], None: [3.0, 1.0, None], "none": [None]}
    rows = [(k, i, v) for k, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(3)
    got = {(r["k"], r["i"]): (r["bin"], r["edges"]) for r in equal_frequency_bins(df, ["k"], "v", n).collect()}
    for k, vs in groups.items():
        edges, bins = plain_bins(vs, n)
        assert [got[k, i] for i in range(len(vs))] == [(b, edges) for b in bins]
    assert equal_frequency_bins(df.where("false"), ["k"], "v", n).count() == 0
    with pytest.raises(ValueError, match="already"):
        equal_frequency_bins(df, ["k"], "v", n, name="i")
