"""Metric definitions over the benchmark tables, and the queries that run them.

Each function takes ``(spark, sf_dir)``, registers the tables it reads as
views, runs one or more metric definitions through the library (stages,
record projection, store, read-back) and returns a flat DataFrame that can
be compared with plain SQL over the same tables.  Record payloads are read
back out of the tagged values, so a comparison checks the whole route.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.functions.timebins import bucket_epoch, bucket_of_epoch, value_bin
from metricstore.operators.asof import read_as_of
from metricstore.operators.bins import equal_frequency_bins
from metricstore.operators.envelope import ComputeStamp, to_long
from metricstore.operators.levels import roll_up_levels
from metricstore.operators.quantiles import exact_quantiles
from metricstore.operators.samples import distinct_samples
from metricstore.operators.sketches import Distinct, Percentile, Plain, distinct_bound, rank_bound, sketch_levels
from metricstore.operators.wide import to_wide
from metricstore.plans.fused import AggregateMetric, run_fused
from metricstore.plans.incremental import run_incremental
from metricstore.plans.runner import Runner
from metricstore.plans.scratch import scratch_path
from metricstore.plans.spec import MetricSpec, OutputKind, SourceSpec, StageKind, StageSpec
from metricstore.sinks.compact import compact_store, live_files
from metricstore.sinks.runlog import log_path, read_log
from metricstore.sinks.store import manifest, register_store, write_store
from metricstore.sinks.tables import write_table
from metricstore.sources.files import read_json
from metricstore.sources.sql import time_range_params
from metricstore.sources.store import read_metrics, read_table, stored_files

# one fixed compute stamp, so stored partitions are reproducible
FIXED_STAMP = ComputeStamp.of(datetime(2024, 2, 1, 12, 0, tzinfo=timezone.utc), "UTC")
LATER_STAMP = ComputeStamp.of(datetime(2024, 2, 1, 13, 30, tzinfo=timezone.utc), "UTC")


def register_tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def _sql(text: str, **kw) -> StageSpec:
    return StageSpec(StageKind.SQL, kw.pop("output", OutputKind.STORE), sql=text, **kw)


def group(name: str, payload: str = "string"):
    return F.col("group_map")[name][payload]


def func(name: str, payload: str = "long"):
    return F.col("func_vars")[name][payload]


# --- definitions ------------------------------------------------------------

P90_HOURLY_SQL = """
select cast(floor(unix_timestamp(ts) / 3600) * 3600 as bigint) as measure_time,
       event_type,
       approx_percentile(value, 0.9) as val,
       count(1) as sample_size
from events
group by 1, 2
"""


def p90_hourly() -> MetricSpec:
    return MetricSpec(
        "p90_value_hourly", 3600, "approx_percentile(value, 0.9) every hour", "1.0",
        ("sample_size",), stages=(_sql(P90_HOURLY_SQL, horizontal_level=1),),
    )


TOTAL_HOURLY_SQL = """
select cast(floor(unix_timestamp(ts) / 3600) * 3600 as bigint) as measure_time,
       round(sum(value), 4) as val
from events
group by 1
"""


def total_hourly(metric_id: str = "total_value_hourly") -> MetricSpec:
    return MetricSpec(metric_id, 3600, "sum(value) every hour", "1", (),
                      stages=(_sql(TOTAL_HOURLY_SQL),))


def _binned_stage(spark: SparkSession, source: str = "events", width: float = 1.0) -> DataFrame:
    # a Python stage written with the DataFrame API and the library's helpers
    events = spark.table(source)
    return events.groupBy(
        bucket_epoch("ts", 3600).alias("measure_time"),
        "event_type",
        value_bin("value", width).cast("long").alias("func_var_value_bin"),
    ).agg(F.round(F.sum("value"), 4).alias("val"))


def total_binned() -> MetricSpec:
    return MetricSpec(
        "total_value_binned", 3600, "sum(value) every hour by event type; value_bin = round(value)",
        "1", (), stages=(
            StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_binned_stage,
                      python_args={"width": 1.0}, horizontal_level=2),
        ),
    )


# --- queries ----------------------------------------------------------------


def q_p90_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly p90 per event type, as records, exploded to long rows."""
    register_tables(spark, sf_dir, "events")
    records = Runner(spark, compute_time=FIXED_STAMP).plan(p90_hourly())
    return to_long(records).select(
        "measure_time", "val", "kind", "key", "type", "long", "string"
    )


def q_p90_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily p90 per user with collection-valued functional variables.

    The collected sets range over bounded domains (event types; hours of the
    day, at most 24), so each stays small however large a group grows, and
    ``collect_set`` combines partially before the shuffle.
    """
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "p90_value_daily_user", 86400, "approx_percentile(value, 0.9) every day per user", "1.0",
        ("sample_size", "samples", "hours"),
        stages=(_sql("""
            select cast(floor(unix_timestamp(ts) / 86400) * 86400 as bigint) as measure_time,
                   user_id,
                   approx_percentile(value, 0.9) as val,
                   count(1) as sample_size,
                   sort_array(collect_set(event_type)) as samples,
                   sort_array(collect_set(hour(ts))) as hours
            from events
            group by 1, 2"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time",
        group("user_id", "long").alias("user_id"),
        "val",
        func("sample_size").alias("sample_size"),
        func("samples", "vec_string").alias("samples"),
        func("hours", "vec_long").alias("hours"),
    )


def q_max_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max/min per 500 s and user.

    The input is a remote stage of the generic format route, here Parquet
    files; it shows nothing about a query run by another engine, which needs a
    database to read from (``tests/test_sources.py`` checks the options).
    """
    metric = MetricSpec(
        "max_value_500s", 500, "max(value) every 500 s", "1.0", ("sample_size", "min_val"),
        stages=(
            StageSpec(StageKind.REMOTE, OutputKind.VIEW, view_name="input_data",
                      source=SourceSpec("parquet", {"path": f"{sf_dir.rstrip('/')}/events.parquet"})),
            _sql("""
                select cast(floor(unix_timestamp(ts) / 500) * 500 as bigint) as measure_time,
                       cast(user_id as int) as user_id,
                       max(value) as val,
                       cast(count(1) as int) as sample_size,
                       min(value) as min_val
                from input_data
                group by 1, 2""", horizontal_level=1),
        ),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time",
        group("user_id", "long").alias("user_id"),
        "val",
        func("sample_size").alias("sample_size"),
        func("min_val", "double").alias("min_val"),
    )


def q_total_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: total per hour."""
    register_tables(spark, sf_dir, "events")
    records = Runner(spark, compute_time=FIXED_STAMP).plan(total_hourly())
    return records.select("measure_time", "val")


def q_total_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: total per hour, event type and 1-unit value bin (a functional variable)."""
    register_tables(spark, sf_dir, "events")
    records = Runner(spark, compute_time=FIXED_STAMP).plan(total_binned())
    return records.select(
        "measure_time",
        group("event_type").alias("event_type"),
        func("value_bin").alias("value_bin"),
        "val",
    )


def _levels_stage(spark: SparkSession) -> DataFrame:
    daily = spark.table("events").select(
        bucket_epoch("ts", 86400).alias("measure_time"), "event_type", "user_id", "value"
    )
    levels = roll_up_levels(
        daily,
        [["measure_time"], ["measure_time", "event_type"], ["measure_time", "event_type", "user_id"]],
        {"val": ("sum", "value")},
    )
    return levels.withColumn("val", F.round("val", 4))


def q_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric at three levels of a hierarchy, rolled up from the finest; each record names its own level's keys."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "total_value_daily_levels", 86400, "sum(value) every day", "1", (),
        stages=(StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_levels_stage,
                          horizontal_level="horizontal_level"),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time",
        group("event_type").alias("event_type"),
        group("user_id", "long").alias("user_id"),
        "horizontal_level",
        F.array_join("group_keys", ",").alias("group_keys"),
        F.array_join(F.array_sort(F.map_keys("group_map")), ",").alias("map_keys"),
        "val",
    )


def _exact_p90_stage(spark: SparkSession, source: str = "events") -> DataFrame:
    return exact_quantiles(
        spark.table(source),
        [bucket_epoch("ts", 3600).alias("measure_time"), F.col("event_type")],
        "value",
        {"val": 0.9},
    )


def q_p90_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly p90 per event type, exact and safe for groups of any size."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "p90_value_hourly_exact", 3600, "p90(value) every hour (exact)", "1.0",
        ("sample_size",),
        stages=(StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_exact_p90_stage, horizontal_level=1),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time",
        group("event_type").alias("event_type"),
        "val",
        func("sample_size").alias("sample_size"),
    )


def _price_stage(spark: SparkSession) -> DataFrame:
    return exact_quantiles(
        spark.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"val": 0.9, "func_var_median": 0.5},
    ).withColumn("measure_time", F.lit(0).cast("long"))


def q_p90_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p90 and median price per return flag: three groups that hold a large share of all rows each."""
    register_tables(spark, sf_dir, "lineitem")
    metric = MetricSpec(
        "p90_price_by_flag", 0, "p90(l_extendedprice)", "1", ("sample_size",),
        stages=(StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_price_stage, horizontal_level=1),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        group("l_returnflag").alias("l_returnflag"), "val", func("median", "double").alias("median"),
        func("sample_size").alias("sample_size"),
    )


def q_value_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal functional variable: integral values tagged long, others double."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_decimal", 0, "value as decimal(18,1)", "1", ("dv",),
        stages=(_sql("""
            select ts as measure_time, value as val, event_id,
                   cast(value as decimal(18, 1)) as dv
            from events"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        group("event_id", "long").alias("event_id"),
        func("dv", "type").alias("type"),
        func("dv", "long").alias("long"),
        func("dv", "double").alias("double"),
    )


def q_value_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array values: without nulls tagged vec_long, with a null element vec_string of JSON texts."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_vec", 0, "event ids as a list", "1", ("ids",),
        stages=(_sql("""
            select ts as measure_time, value as val, user_id,
                   -- an error event carries a second, unknown id
                   case when event_type = 'error' then array(event_id, null) else array(event_id) end as ids
            from events"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    ids = F.col("func_vars")["ids"]
    elements = F.when(ids["type"] == F.lit("vec_long"), F.transform(ids["vec_long"], lambda x: x.cast("string"))) \
        .otherwise(ids["vec_string"])
    return records.select(
        group("user_id", "long").alias("user_id"),
        ids["type"].alias("type"),
        F.posexplode(elements).alias("p", "j"),
    ).select("user_id", "type", F.col("p").cast("int").alias("p"), "j")


def q_value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map values: a map of doubles per event type, exploded to key/value rows."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_range", 0, "max and min of value per event type", "1", (),
        stages=(_sql("""
            select unix_timestamp(min(ts)) as measure_time, count(1) as val, event_type,
                   map('hi', max(value), 'lo', min(value)) as func_var_range
            from events
            group by event_type"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        group("event_type").alias("event_type"),
        F.explode(func("range", "map_double")).alias("key", "value"),
    )


def q_avg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily average per event type (an average metric with its sample size)."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "avg_value_daily", 86400, "avg(value) every day per event type", "1", ("sample_size",),
        stages=(_sql("""
            select cast(floor(unix_timestamp(ts) / 86400) * 86400 as bigint) as measure_time,
                   event_type, round(avg(value), 6) as val, count(value) as sample_size
            from events group by 1, 2""", horizontal_level=1),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time", group("event_type").alias("event_type"), "val",
        func("sample_size").alias("sample_size"),
    )


def _scratch_database(spark: SparkSession, name: str) -> str:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{scratch_path(spark, name, unique=False)}'"
    )
    return name


def _kept(df: DataFrame, table: str) -> DataFrame:
    # the result outlives the table, which is dropped again
    spark = df.sparkSession
    path = scratch_path(spark, "table-result")
    df.write.parquet(path)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path)


def two_stores() -> MetricSpec:
    """Two store stages at the same levels, so they share a partition."""
    return MetricSpec(
        "value_hourly_two_ways", 3600, "sum and p90 of value every hour", "1", (),
        stages=(_sql(TOTAL_HOURLY_SQL), _sql(P90_HOURLY_SQL)),
    )


def q_central_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with two store stages into a store and a central table, read from the table."""
    register_tables(spark, sf_dir, "events")
    database = _scratch_database(spark, "metricstore_tables")
    table = f"{database}.metrics_{uuid.uuid4().hex[:12]}"
    result = Runner(spark, store_path=scratch_path(spark, "store"), table=table,
                    compute_time=FIXED_STAMP).run(two_stores())
    if not result.ok:
        raise RuntimeError(result.failed())
    rows = read_table(spark, table, ids=["value_hourly_two_ways"]).select(
        "measure_time", group("event_type").alias("event_type"), "val")
    return _kept(rows, table)


def q_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store and a table with a run log: an abandoned attempt in both, a commit after it, and one that replaces.

    Only what commits name is read: each record once, the newest state of replaced partitions.
    """
    register_tables(spark, sf_dir, "events")
    database = _scratch_database(spark, "metricstore_tables")
    table, path = f"{database}.metrics_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store")
    options = {"store_path": path, "table": table, "run_log": True, "compute_time": FIXED_STAMP}
    # An attempt that dies before its commit: its records are in the folders of the run that follows.
    abandoned = Runner(spark, compute_time=FIXED_STAMP).plan([p90_hourly(), total_hourly()])
    write_store(abandoned, path)
    write_table(abandoned, table)
    for metrics, mode in (([p90_hourly(), total_hourly()], "append"), ([total_hourly()], "overwrite_partitions")):
        result = Runner(spark, mode=mode, **options).run_all(metrics)
        if not result.ok:
            raise RuntimeError(result.failed())
    ids = ["p90_value_hourly", "total_value_hourly"]
    columns = ["id", "measure_time", group("event_type").alias("event_type"), "val"]
    found = read_metrics(spark, path, ids=ids).select(F.lit("store").alias("place"), *columns).unionAll(
        read_table(spark, table, ids=ids, run_log=log_path(path)).select(F.lit("table").alias("place"), *columns))
    return _kept(found, table)


def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a range stored, then the whole range run: only missing buckets and those still open are computed.

    ``compute_hour`` tells which run computed a bucket, ``runs`` how many did.
    """
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "max_value_hourly_type", 3600, "max(value) every hour", "1", (),
        stages=(_sql("""
            select cast(floor(unix_timestamp(ts) / 3600) * 3600 as bigint) as measure_time, event_type, max(value) as val
            from events where ts >= to_timestamp_ntz(:dt_start) and ts < to_timestamp_ntz(:dt_end)
            group by 1, 2""", horizontal_level=1),),
    )
    path = scratch_path(spark, "store")
    for stamp, end in ((FIXED_STAMP, datetime(2024, 1, 16)), (LATER_STAMP, datetime(2024, 2, 1))):
        result = run_incremental(Runner(spark, store_path=path, compute_time=stamp, run_log=True), metric,
                                 datetime(2024, 1, 1), end, lookback=86400)
        if not result.ok:
            raise RuntimeError(result.failed())
    stored = read_metrics(spark, path, ids=[metric.metric_id])
    runs = stored.groupBy(F.col("measure_time").alias("bucket"), group("event_type").alias("of_type")).agg(
        F.count(F.lit(1)).alias("runs"))
    latest = read_metrics(spark, path, ids=[metric.metric_id], latest=True).select(
        "measure_time", group("event_type").alias("event_type"), "val", "compute_hour")
    return latest.join(runs, (F.col("bucket") == F.col("measure_time")) & (F.col("of_type") == F.col("event_type"))).select(
        "measure_time", "event_type", "val", "compute_hour", "runs")


def six_metrics() -> list[AggregateMetric]:
    """Metrics over ``events`` with other buckets, groups, conditions and measures."""
    return [
        AggregateMetric("f_total_hourly", 3600, {"val": "round(sum(value), 4)", "func_var_n": "count(1)"}),
        AggregateMetric("f_total_daily_type", 86400, {"val": "round(sum(value), 4)", "func_var_n": "count(1)"},
                        {"event_type": "event_type"}, horizontal_level=1),
        AggregateMetric("f_max_daily_user", 86400, {"val": "max(value)", "func_var_n": "count(1)"},
                        {"user_id": "user_id"}, horizontal_level=1),
        AggregateMetric("f_errors_hourly", 3600, {"val": "count(1)", "func_var_n": "count(distinct user_id)"},
                        where="event_type = 'error'"),
        AggregateMetric("f_avg_daily", 86400, {"val": "round(sum(value), 2) / count(value)", "func_var_n": "count(value)"}),
        AggregateMetric("f_range_type", 0, {"val": "max(value) - min(value)", "func_var_n": "count(1)"},
                        {"event_type": "event_type"}, horizontal_level=1),
    ]


def q_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six metrics over one table from one scan, stored together and read back."""
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    result = run_fused(Runner(spark, store_path=path, compute_time=FIXED_STAMP), "events", "ts", six_metrics())
    if not result.ok:
        raise RuntimeError(result.failed())
    return read_metrics(spark, path).select(
        "id", "measure_time", group("event_type").alias("event_type"), group("user_id", "long").alias("user_id"),
        "val", func("n").alias("n"))


def q_sketch_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p90 and distinct users at three levels from merged sketches, held against the exact rank and number.

    ``rank_ok``: the rank of the value found is within twice the bound of its sketch
    (99 %); ``distinct_ok`` the same for the number of users.
    """
    register_tables(spark, sf_dir, "events")
    k, lg_k = 400, 12
    events = spark.table("events").select(bucket_epoch("ts", 86400).alias("day"), "event_type", "user_id", "value")
    sets = [["event_type"], ["day"], ["day", "event_type"]]
    found = sketch_levels(events, sets, {"p90": Percentile("value", 0.9), "users": Distinct("user_id"), "n": Plain("count", "value")},
                          k=k, lg_k=lg_k)
    found = found.select(F.col("day").alias("of_day"), F.col("event_type").alias("of_type"), "horizontal_level", "p90", "users", "n")
    # Every row with the levels it counts in, joined with their estimates (one row per group).
    held = events.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(len(sets))])))
    held = held.select("level", F.when(F.col("level") > 0, F.col("day")).alias("day"),
                       F.when(F.col("level") != 1, F.col("event_type")).alias("event_type"), "user_id", "value")
    pairs = held.join(found, (F.col("level") == F.col("horizontal_level")) & F.col("day").eqNullSafe(F.col("of_day"))
                      & F.col("event_type").eqNullSafe(F.col("of_type")))
    exact = pairs.groupBy("horizontal_level", "day", "event_type", "p90", "users", "n").agg(
        F.count("value").alias("rows"), F.count_if(F.col("value") < F.col("p90")).alias("below"),
        F.count_if(F.col("value") <= F.col("p90")).alias("upto"))
    users = held.groupBy(F.col("level").alias("l"), F.col("day").alias("d"), F.col("event_type").alias("t")).agg(
        F.count_distinct("user_id").alias("exact_users"))
    off = 2 * rank_bound(k)
    out = exact.join(users, (F.col("l") == F.col("horizontal_level")) & F.col("d").eqNullSafe(F.col("day"))
                     & F.col("t").eqNullSafe(F.col("event_type")))
    return out.select(
        "horizontal_level", "day", "event_type", F.col("n").alias("sample_size"), "exact_users",
        ((F.col("below") / F.col("rows") <= 0.9 + off) & (F.col("upto") / F.col("rows") >= 0.9 - off)).alias("rank_ok"),
        (F.abs(F.col("users") - F.col("exact_users")) <= F.greatest(
            F.lit(1.0), 2 * distinct_bound(lg_k) * F.col("exact_users"))).alias("distinct_ok"))


def _samples_stage(spark: SparkSession, k: int) -> DataFrame:
    events = spark.table("events").select(bucket_epoch("ts", 86400).alias("measure_time"), "event_type", "user_id")
    return distinct_samples(events, ["measure_time", "event_type"], "user_id", k, distinct="val")


def q_distinct_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sampled users per day and event type with the exact number of distinct ones, as records."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "distinct_users_daily", 86400, "count(distinct user_id) every day per event type", "1", ("samples", "sample_size"),
        stages=(StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_samples_stage, python_args={"k": 5}, horizontal_level=1),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time", group("event_type").alias("event_type"), "val", func("samples", "vec_long").alias("samples"),
        func("sample_size").alias("sample_size"))


def _frequency_stage(spark: SparkSession, bins: int) -> DataFrame:
    binned = equal_frequency_bins(spark.table("events"), ["event_type"], "value", bins)
    return binned.groupBy(F.lit(0).cast("long").alias("measure_time"), "event_type", F.col("bin").alias("func_var_bin"),
                          F.col("edges").alias("func_var_edges")).agg(F.count(F.lit(1)).alias("val"))


def q_frequency_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type in eight bins of equal frequency; the records keep the edges."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "events_by_frequency_bin", 0, "count(*) by eighths of value", "1", (),
        stages=(StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_frequency_stage, python_args={"bins": 8},
                          horizontal_level=1),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        group("event_type").alias("event_type"), func("bin").alias("bin"), func("edges", "vec_double").alias("edges"), "val")


def q_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of many small files compacted: records per partition and the number of files that hold them."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec("value_rows", 0, "value of each event", "1", (), stages=(_sql(
        "select ts as measure_time, value as val, event_id, user_id % 3 as lv from events", horizontal_level="lv"),))
    path = scratch_path(spark, "store")
    for _ in range(2):
        result = Runner(spark, store_path=path, compute_time=FIXED_STAMP, spread=8, run_log=True).run(metric)
        if not result.ok:
            raise RuntimeError(result.failed())
    compact_store(spark, path, ids=["value_rows"], dates=[FIXED_STAMP.date])
    files = live_files(stored_files(spark, path, ["value_rows"], [FIXED_STAMP.date]), read_log(spark, log_path(path)))
    files = files.groupBy(F.col("horizontal_level").alias("level")).agg(F.count(F.lit(1)).alias("files"))
    held = read_metrics(spark, path, ids=["value_rows"]).groupBy("horizontal_level").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("val"), 2).alias("total"),
        F.sum(group("event_id", "long")).alias("ids"))
    return held.join(files, F.col("horizontal_level") == F.col("level")).select("horizontal_level", "n", "total", "ids", "files")


def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event, what the hourly total of its hour and type was known to be at a time of its own.

    Two runs are stored, the first over part of the events; the times lie before,
    between and after them.
    """
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    for stamp, where in ((FIXED_STAMP, "event_id % 3 > 0"), (LATER_STAMP, "true")):
        metric = MetricSpec("total_hourly_type", 3600, "sum(value) every hour", "1", (), stages=(_sql(f"""
            select cast(floor(unix_timestamp(ts) / 3600) * 3600 as bigint) as measure_time, event_type,
                   round(sum(value), 4) as val
            from events where {where} group by 1, 2""", horizontal_level=1),))
        result = Runner(spark, store_path=path, compute_time=stamp).run(metric)
        if not result.ok:
            raise RuntimeError(result.failed())
    asked = spark.table("events").select(
        "event_id", bucket_epoch("ts", 3600).alias("measure_time"), "event_type",
        (F.lit(FIXED_STAMP.epoch) + (F.col("event_id") % 4 - 1) * 3000).alias("as_of"))
    return read_as_of(read_metrics(spark, path, ids=["total_hourly_type"]), asked,
                      {"measure_time": F.col("measure_time"), "event_type": group("event_type")},
                      columns={"val": F.col("val")}).select("event_id", "as_of", "compute_time", "val")


def q_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records of a metric with nulls, numbers of two types and collections, as typed rows again."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_wide", 0, "value of each event", "1", ("half", "ids", "high"),
        stages=(_sql("""
            select event_id as measure_time, value as val, user_id,
                   case when event_type <> 'error' then event_type end as event_type,
                   cast(user_id / 2 as decimal(10, 1)) as half, value >= 50 as high,
                   case when event_type = 'error' then array(event_id, null) when event_type = 'view' then array()
                        else array(event_id) end as ids
            from events""", horizontal_level=1),),
    )
    path = scratch_path(spark, "store")
    result = Runner(spark, store_path=path, compute_time=FIXED_STAMP).run(metric)
    if not result.ok:
        raise RuntimeError(result.failed())
    return to_wide(read_metrics(spark, path, ids=["value_wide"]))


def q_overwrite_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two store stages in one partition, run twice replacing partitions: all records, once."""
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    for _ in range(2):
        result = Runner(spark, store_path=path, compute_time=FIXED_STAMP, mode="overwrite_partitions").run(two_stores())
        if not result.ok:
            raise RuntimeError(result.failed())
    return read_metrics(spark, path).select("measure_time", group("event_type").alias("event_type"), "val")


def q_registered_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store exposed as a partitioned catalog table; only the run's partitions are added."""
    register_tables(spark, sf_dir, "events")
    database = _scratch_database(spark, "metricstore_tables")
    path = scratch_path(spark, "store")
    result = Runner(spark, store_path=path, compute_time=FIXED_STAMP).run_all([total_hourly(), p90_hourly()])
    if not result.ok:
        raise RuntimeError(result.failed())
    table = f"{database}.store_{uuid.uuid4().hex[:12]}"
    register_store(spark, table, path, partitions=[p for ps in result.partitions().values() for p in ps])
    rows = read_table(spark, table, ids=["total_value_hourly"], dates=[FIXED_STAMP.date])
    return _kept(rows.select("measure_time", "val"), table)


def q_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run restricted to [dt_start, dt_end) through named SQL parameters."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "max_value_5min", 300, "max(value) every 5 min", "1", (),
        stages=(_sql("""
            select cast(floor(unix_timestamp(ts) / 300) * 300 as bigint) as measure_time,
                   max(value) as val
            from events
            where ts >= to_timestamp_ntz(:dt_start) and ts < to_timestamp_ntz(:dt_end)
            group by 1"""),),
    )
    params = time_range_params("2024-01-05 00:00:00", "2024-01-06 00:00:00")
    records = Runner(spark, compute_time=FIXED_STAMP, params=params).plan(metric)
    return records.select("measure_time", "val")


def q_join_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order totals per nation: a joined stage, a func_var_ column."""
    register_tables(spark, sf_dir, "orders", "customer", "nation")
    metric = MetricSpec(
        "order_total_monthly_nation", 2592000, "sum(o_totalprice) every month per nation", "1", (),
        stages=(_sql("""
            with monthly as (
              -- pre-aggregate before the join: orders collapse to one row per
              -- (month, customer), so even a customer owning a large share of
              -- all orders reaches the join as a handful of rows
              select cast(unix_date(trunc(cast(o_orderdate as date), 'MM')) as bigint) * 86400 as month,
                     o_custkey, sum(o_totalprice) as total, count(1) as n
              from orders
              group by 1, 2)
            select month as measure_time,
                   n_name,
                   round(sum(total), 2) as val,
                   sum(n) as func_var_orders
            from monthly
            join customer on o_custkey = c_custkey
            join nation on c_nationkey = n_nationkey
            group by 1, 2"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        F.col("measure_time"),
        group("n_name").alias("n_name"),
        "val",
        func("orders").alias("func_var_orders"),
    )


def q_json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct attribute stored as JSON text, decoded back for comparison."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "events_by_props", 0, "count(*) per event type and props", "1", (),
        stages=(_sql("""
            select unix_timestamp(min(ts)) as measure_time, count(1) as val, event_type,
                   from_json(props, 'k bigint') as props
            from events
            group by event_type, from_json(props, 'k bigint')"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    props = F.col("group_map")["props"]
    return records.select(
        group("event_type").alias("event_type"),
        F.get_json_object(props["string"], "$.k").cast("long").alias("k"),
        F.col("val").cast("long").alias("n"),
        props["type"].alias("_t"),
    ).where(F.col("_t") == F.lit("json")).drop("_t")


def q_store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 written to the store, read back with partition filters."""
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    result = Runner(spark, store_path=path, compute_time=FIXED_STAMP).run(total_hourly())
    if not result.ok:
        raise RuntimeError(result.failed())
    return read_metrics(
        spark, path, ids=["total_value_hourly"], dates=[FIXED_STAMP.date],
        horizontal_levels=[0], vertical_levels=[0],
    ).select("measure_time", "val")


def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of a store after one run of two metrics."""
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    result = Runner(spark, store_path=path, compute_time=FIXED_STAMP).run_all([total_hourly(), p90_hourly()])
    if not result.ok:
        raise RuntimeError(result.failed())
    return manifest(spark, path)


def q_stage_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A module Python stage makes a view; a SQL stage stores it; read back as long rows."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "p90_value_hourly", 3600, "approx_percentile(value, 0.9) every hour", "1.0", ("sample_size",),
        stages=(
            StageSpec(StageKind.PYTHON, OutputKind.VIEW, python="metricstore.plans.sample_stage",
                      python_args={"source": "events", "view_name": "p90_chain", "percentile": 0.9}),
            _sql("select * from p90_chain", horizontal_level=1),
        ),
    )
    path = scratch_path(spark, "store")
    result = Runner(spark, store_path=path, compute_time=FIXED_STAMP).run(metric)
    if not result.ok:
        raise RuntimeError(result.failed())
    stored = read_metrics(spark, path, ids=["p90_value_hourly"])
    return to_long(stored).select("measure_time", "val", "kind", "key", "type", "long", "string")


def q_cached_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cached-view stage (written table) feeding the store stage."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "total_value_hourly_cached", 3600, "sum(value) every hour", "1", (),
        stages=(
            _sql(TOTAL_HOURLY_SQL, output=OutputKind.CACHED_VIEW, cached_view_name="hourly_totals"),
            _sql("select * from hourly_totals"),
        ),
    )
    runner = Runner(
        spark, compute_time=FIXED_STAMP, cache_database="metricstore_cache",
        cache_location=scratch_path(spark, "cache_db", unique=False),
    )
    return runner.plan(metric).select("measure_time", "val")


def q_run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two metrics over two tables in one store write; per-metric totals read back."""
    register_tables(spark, sf_dir, "events", "orders")
    orders_daily = MetricSpec(
        "order_total_daily", 86400, "sum(o_totalprice) every day", "1", (),
        stages=(_sql("""
            select unix_timestamp(o_orderdate) - pmod(unix_timestamp(o_orderdate), 86400) as measure_time,
                   round(sum(o_totalprice), 2) as val
            from orders group by 1"""),),
    )
    path = scratch_path(spark, "store")
    result = Runner(spark, store_path=path, compute_time=FIXED_STAMP).run_all([total_hourly(), orders_daily])
    if not result.ok:
        raise RuntimeError(result.failed())
    return (
        read_metrics(spark, path)
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("val"), 2).alias("total"))
    )


def q_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one metric in different hours; reading keeps the newest."""
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    for stamp in (FIXED_STAMP, LATER_STAMP):
        result = Runner(spark, store_path=path, compute_time=stamp).run(p90_hourly())
        if not result.ok:
            raise RuntimeError(result.failed())
    latest = read_metrics(spark, path, ids=["p90_value_hourly"], latest=True)
    return latest.select(
        "measure_time", group("event_type").alias("event_type"), "val", "compute_time", "compute_hour"
    )


def q_latest_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the binned metric: the newest run keeps every bin of a measurement."""
    register_tables(spark, sf_dir, "events")
    path = scratch_path(spark, "store")
    for stamp in (FIXED_STAMP, LATER_STAMP):
        result = Runner(spark, store_path=path, compute_time=stamp).run(total_binned())
        if not result.ok:
            raise RuntimeError(result.failed())
    latest = read_metrics(spark, path, ids=["total_value_binned"], latest=True)
    return latest.select(
        "measure_time", group("event_type").alias("event_type"), func("value_bin").alias("value_bin"), "val",
        "compute_time",
    )


def q_record_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The descriptive columns of every record of a metric."""
    register_tables(spark, sf_dir, "events")
    records = Runner(spark, compute_time=FIXED_STAMP).plan(p90_hourly())
    return records.select(
        "id", "measure_time", "time_window", "func_expr", "version", "compute_date", "compute_hour",
        F.array_join("group_keys", ",").alias("group_keys"), group("event_type").alias("event_type"),
    )


def q_value_bool_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A boolean functional variable, and an array kept as JSON text by ``json_columns``."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_flags", 0, "value of each event", "1", ("high", "parts"),
        stages=(_sql("""
            select ts as measure_time, value as val, event_id, value >= 50 as high,
                   array(event_id, user_id) as parts
            from events""", json_columns=("parts",)),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        group("event_id", "long").alias("event_id"),
        func("high", "type").alias("high_type"), func("high", "bool").alias("high"),
        func("parts", "type").alias("parts_type"), func("parts", "string").alias("parts"),
    )


def q_stage_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage's own named parameter beside the run's."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "count_high_daily", 86400, "count of values of at least :least every day", "1", (),
        stages=(_sql("""
            select cast(floor(unix_timestamp(ts) / 86400) * 86400 as bigint) as measure_time,
                   count(1) as val
            from events where value >= :least and ts >= to_timestamp_ntz(:dt_start)
            group by 1""", params={"least": 60.0}),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP, params={"dt_start": "2024-01-03 00:00:00"}).plan(metric)
    return records.select("measure_time", "val")


def q_value_map_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps with a null value and with nested values: texts under map_string."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_maps", 0, "value of each event", "1", ("gaps", "nested"),
        stages=(_sql("""
            select ts as measure_time, value as val, event_id,
                   map('id', event_id, 'none', cast(null as bigint)) as gaps,
                   map('ids', array(event_id, user_id)) as nested
            from events"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    gaps, nested = func("gaps", "map_string"), func("nested", "map_string")
    return records.select(
        group("event_id", "long").alias("event_id"),
        func("gaps", "type").alias("gaps_type"), gaps["id"].alias("gaps_id"), gaps["none"].alias("gaps_none"),
        func("nested", "type").alias("nested_type"), nested["ids"].alias("nested_ids"),
    )


def q_value_decimal_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals beyond the long range are doubles; those inside stay long."""
    register_tables(spark, sf_dir, "events")
    metric = MetricSpec(
        "value_decimal_wide", 0, "value of each event", "1", ("wide",),
        stages=(_sql("""
            select ts as measure_time, value as val, event_id,
                   cast(event_id as decimal(38, 0)) * cast('1000000000000000000' as decimal(19, 0)) as wide
            from events"""),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        group("event_id", "long").alias("event_id"),
        func("wide", "type").alias("type"), func("wide", "long").alias("long"), func("wide", "double").alias("double"),
    )


SENSOR_SCHEMA = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("data", T.ArrayType(T.DoubleType())),
    ]
)


def _sensor_json(spark: SparkSession, sf_dir: str) -> str:
    # readings as gzip JSON lines (epoch ``time``, ``location_id``, ``data`` array), derived from events
    path = scratch_path(spark, "sensor_json")
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    events.select(
        F.unix_timestamp("ts").alias("time"),
        F.col("user_id").alias("location_id"),
        F.array("value", F.col("event_id").cast("double")).alias("data"),
    ).write.option("compression", "gzip").json(path)
    return path


def _readings_stage(spark: SparkSession, path: str, seconds: int) -> DataFrame:
    readings = read_json(spark, path, SENSOR_SCHEMA)
    return readings.groupBy(bucket_of_epoch("time", seconds).alias("measure_time"), "location_id").agg(
        F.percentile_approx(F.get("data", F.lit(0)), 0.9).alias("val"),
        F.count(F.lit(1)).alias("func_var_readings"))


def q_sensor_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p90 of the first reading per time bucket and location, from gzip JSON lines.

    A set of raw readings would grow with the group, so none is collected (a
    stage may still return arrays, see ``q_p90_samples`` for sets over bounded
    domains).
    """
    metric = MetricSpec(
        "first_reading_high", 500, "90th percentile of the first reading", "1", (),
        stages=(StageSpec(StageKind.PYTHON, OutputKind.STORE, python=_readings_stage, horizontal_level=1,
                          python_args={"path": _sensor_json(spark, sf_dir), "seconds": 500}),),
    )
    records = Runner(spark, compute_time=FIXED_STAMP).plan(metric)
    return records.select(
        "measure_time",
        group("location_id", "long").alias("location_id"),
        "val",
        func("readings").alias("sample_size"),
    )


QUERIES = {
    "q_p90_envelope": q_p90_envelope,
    "q_p90_samples": q_p90_samples,
    "q_max_min": q_max_min,
    "q_total_hourly": q_total_hourly,
    "q_total_binned": q_total_binned,
    "q_levels": q_levels,
    "q_value_decimal": q_value_decimal,
    "q_value_vec": q_value_vec,
    "q_value_map": q_value_map,
    "q_time_range": q_time_range,
    "q_join_metric": q_join_metric,
    "q_json_value": q_json_value,
    "q_store_roundtrip": q_store_roundtrip,
    "q_manifest": q_manifest,
    "q_stage_chain": q_stage_chain,
    "q_cached_view": q_cached_view,
    "q_run_all": q_run_all,
    "q_latest": q_latest,
    "q_sensor_json": q_sensor_json,
    "q_p90_salted": q_p90_salted,
    "q_avg_daily": q_avg_daily,
    "q_central_table": q_central_table,
    "q_registered_store": q_registered_store,
    "q_p90_lineitem": q_p90_lineitem,
    "q_overwrite_rerun": q_overwrite_rerun,
    "q_committed_runs": q_committed_runs,
    "q_incremental": q_incremental,
    "q_frequency_bins": q_frequency_bins,
    "q_compacted": q_compacted,
    "q_as_of": q_as_of,
    "q_wide": q_wide,
    "q_fused": q_fused,
    "q_sketch_levels": q_sketch_levels,
    "q_distinct_samples": q_distinct_samples,
    "q_latest_binned": q_latest_binned,
    "q_record_metadata": q_record_metadata,
    "q_value_bool_json": q_value_bool_json,
    "q_stage_params": q_stage_params,
    "q_value_map_mixed": q_value_map_mixed,
    "q_value_decimal_wide": q_value_decimal_wide,
}
