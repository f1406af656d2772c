"""

``entry(spark)`` runs the flagship metric on sf0.001; ``queries()`` maps each
implemented operator's query to a callable ``(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` gives the same result in plain SQL (DuckDB dialect) over the
raw tables.  The Spark side always goes through the library: stages, the
record projection, tagged values, the store and its read-back; the oracle
computes the expected payloads directly.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metricstore.plans.event_metrics import QUERIES, q_p90_envelope  # noqa: E402

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _needed(missing: ModuleNotFoundError) -> bool:
    """Whether a module is missing that does not belong to the optional parts."""
    name = missing.name or ""
    return name != "corpus_pipeline" and name != "metricstore.llm" and not name.startswith("metricstore.llm.")


try:  # the subpackage and the pipeline are optional
    from metricstore.llm.queries import ORACLES as LLM_ORACLES  # noqa: E402
    from metricstore.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ModuleNotFoundError as exc:
    if _needed(exc):
        raise
try:
    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as exc:
    if _needed(exc):
        raise
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly p90 per event type as metric records, in long form."""
    return q_p90_envelope(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    pipeline = {"pipeline": corpus_pipeline.run} if corpus_pipeline else {}
    return {**QUERIES, **LLM_QUERIES, **pipeline}


def _bucket(expr: str, seconds: int) -> str:
    return f"cast(floor(epoch({expr}) / {seconds}) * {seconds} as bigint)"


_P90_HOURLY = f"""
with m as (
  select {_bucket('ts', 3600)} as measure_time, event_type,
         quantile_disc(value, 0.9) as val, count(*) as sample_size
  from events group by 1, 2)
select measure_time, val, 'group' as kind, 'event_type' as key, 'string' as type,
       cast(null as bigint) as long, event_type as string from m
union all
select measure_time, val, 'func', 'sample_size', 'long', sample_size, null from m
"""

_TOTAL_HOURLY = f"""
select {_bucket('ts', 3600)} as measure_time, round(sum(value), 4) as val
from events group by 1
"""


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}
    return {**_core_oracles(), **LLM_ORACLES, **pipeline}


_TWO_WAYS = f"""
select {_bucket('ts', 3600)} as measure_time, cast(null as varchar) as event_type, round(sum(value), 4) as val
from events group by 1
union all
select {_bucket('ts', 3600)}, event_type, quantile_disc(value, 0.9) from events group by 1, 2
"""


def _core_oracles() -> dict[str, str]:
    b3600, b86400, b500, b300 = (_bucket("ts", w) for w in (3600, 86400, 500, 300))
    return {
        "q_p90_envelope": _P90_HOURLY,
        "q_p90_samples": f"""
            select {b86400} as measure_time, user_id, quantile_disc(value, 0.9) as val,
                   count(*) as sample_size,
                   list_sort(list(distinct event_type)) as samples,
                   list_sort(list(distinct cast(hour(ts) as bigint))) as hours
            from events group by 1, 2""",
        "q_max_min": f"""
            select {b500} as measure_time, user_id, max(value) as val,
                   count(*) as sample_size, min(value) as min_val
            from events group by 1, 2""",
        "q_total_hourly": _TOTAL_HOURLY,
        "q_total_binned": f"""
            select {b3600} as measure_time, event_type, cast(round(value) as bigint) as value_bin,
                   round(sum(value), 4) as val
            from events group by 1, 2, 3""",
        "q_levels": f"""
            select measure_time, event_type, user_id, level as horizontal_level,
                   ['', 'event_type', 'event_type,user_id'][level + 1] as group_keys,
                   ['', 'event_type', 'event_type,user_id'][level + 1] as map_keys, val
            from (
              select measure_time, event_type, user_id,
                     cast(case grouping_id(measure_time, event_type, user_id)
                          when 3 then 0 when 1 then 1 else 2 end as bigint) as level,
                     round(sum(value), 4) as val
              from (select {b86400} as measure_time, event_type, user_id, value from events)
              group by grouping sets ((measure_time), (measure_time, event_type),
                                      (measure_time, event_type, user_id)))""",
        "q_value_decimal": """
            select event_id,
                   case when dv % 1 = 0 then 'long' else 'double' end as type,
                   case when dv % 1 = 0 then cast(dv as bigint) end as long,
                   case when dv % 1 <> 0 then cast(dv as double) end as double
            from (select event_id, cast(value as decimal(18, 1)) as dv from events)""",
        "q_value_vec": """
            select user_id, case when event_type = 'error' then 'vec_string' else 'vec_long' end as type,
                   0 as p, cast(event_id as varchar) as j
            from events
            union all
            select user_id, 'vec_string', 1, 'null' from events where event_type = 'error'""",
        "q_value_map": """
            select event_type, 'hi' as key, max(value) as value from events group by 1
            union all
            select event_type, 'lo', min(value) from events group by 1""",
        "q_time_range": f"""
            select {b300} as measure_time, max(value) as val
            from events
            where ts >= timestamp '2024-01-05 00:00:00' and ts < timestamp '2024-01-06 00:00:00'
            group by 1""",
        "q_join_metric": """
            select cast(epoch(date_trunc('month', o_orderdate)) as bigint) as measure_time, n_name,
                   round(sum(o_totalprice), 2) as val, count(*) as func_var_orders
            from orders
            join customer on o_custkey = c_custkey
            join nation on c_nationkey = n_nationkey
            group by 1, 2""",
        "q_json_value": """
            select event_type, cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as n
            from events group by 1, 2""",
        "q_store_roundtrip": _TOTAL_HOURLY,
        "q_manifest": f"""
            select 'total_value_hourly' as id, '2024-02-01' as compute_date,
                   cast(12 as bigint) as compute_hour, cast(0 as bigint) as horizontal_level,
                   cast(0 as bigint) as vertical_level, count(*) as rows,
                   min(measure_time) as min_measure_time, max(measure_time) as max_measure_time
            from (select {b3600} as measure_time from events group by 1)
            union all
            select 'p90_value_hourly', '2024-02-01', 12, 1, 0, count(*),
                   min(measure_time), max(measure_time)
            from (select {b3600} as measure_time, event_type from events group by 1, 2)""",
        "q_stage_chain": _P90_HOURLY,
        "q_cached_view": _TOTAL_HOURLY,
        "q_run_all": f"""
            select 'total_value_hourly' as id, count(*) as n, round(sum(val), 2) as total
            from (select round(sum(value), 4) as val from events group by {b3600})
            union all
            select 'order_total_daily', count(*), round(sum(val), 2)
            from (select round(sum(o_totalprice), 2) as val from orders
                  group by {_bucket('o_orderdate', 86400)})""",
        "q_latest": f"""
            select {b3600} as measure_time, event_type, quantile_disc(value, 0.9) as val,
                   cast(1706794200 as bigint) as compute_time, cast(13 as bigint) as compute_hour
            from events group by 1, 2""",
        "q_sensor_json": f"""
            select {b500} as measure_time, user_id as location_id,
                   quantile_disc(value, 0.9) as val, count(*) as sample_size
            from events group by 1, 2""",
        "q_avg_daily": f"""
            select {b86400} as measure_time, event_type, round(avg(value), 6) as val,
                   count(value) as sample_size
            from events group by 1, 2""",
        "q_central_table": _TWO_WAYS,
        "q_overwrite_rerun": _TWO_WAYS,
        "q_frequency_bins": """
            with e as (
              select event_type, quantile_disc(value, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) as edges
              from events group by 1)
            select event_type, cast(1 + len(list_filter(edges, lambda x: x < value)) as bigint) as bin, edges,
                   cast(count(*) as double) as val
            from events join e using (event_type) group by all""",
        "q_compacted": """
            select cast(user_id % 3 as bigint) as horizontal_level, 2 * count(*) as n, round(2 * sum(value), 2) as total,
                   cast(2 * sum(event_id) as bigint) as ids, cast(1 as bigint) as files
            from events group by 1""",
        "q_as_of": f"""
            with runs as (
              select 1706788800 as compute_time, {b3600} as measure_time, event_type, round(sum(value), 4) as val
              from events where event_id % 3 > 0 group by all
              union all
              select 1706794200, {b3600}, event_type, round(sum(value), 4) from events group by all),
            asked as (
              select event_id, {b3600} as measure_time, event_type, 1706788800 + (event_id % 4 - 1) * 3000 as as_of from events),
            found as (
              select event_id, max(compute_time) as compute_time
              from asked join runs using (measure_time, event_type) where compute_time <= as_of group by 1)
            select event_id, as_of, cast(found.compute_time as bigint) as compute_time, val
            from asked left join found using (event_id)
            left join runs on runs.compute_time = found.compute_time and runs.measure_time = asked.measure_time
              and runs.event_type = asked.event_type""",
        "q_wide": """
            select event_id as measure_time, value as val, user_id,
                   case when event_type <> 'error' then event_type end as event_type,
                   cast(user_id / 2 as double) as half, value >= 50 as high,
                   case when event_type = 'error' then [event_id, null] when event_type = 'view' then []
                        else [event_id] end as ids
            from events""",
        "q_incremental": f"""
            select {b3600} as measure_time, event_type, max(value) as val,
                   cast(case when {b3600} < epoch(timestamp '2024-01-15') then 12 else 13 end as bigint) as compute_hour,
                   cast(case when {b86400} = epoch(timestamp '2024-01-15') then 2 else 1 end as bigint) as runs
            from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01' group by all""",
        "q_fused": f"""
            select 'f_total_hourly' as id, {b3600} as measure_time, cast(null as varchar) as event_type,
                   cast(null as bigint) as user_id, round(sum(value), 4) as val, count(*) as n from events group by all
            union all
            select 'f_total_daily_type', {b86400}, event_type, null, round(sum(value), 4), count(*) from events group by all
            union all
            select 'f_max_daily_user', {b86400}, null, user_id, max(value), count(*) from events group by all
            union all
            select 'f_errors_hourly', {b3600}, null, null, count(*), count(distinct user_id)
            from events where event_type = 'error' group by all
            union all
            select 'f_avg_daily', {b86400}, null, null, round(sum(value), 2) / count(value), count(value)
            from events group by all
            union all
            select 'f_range_type', 0, event_type, null, max(value) - min(value), count(*) from events group by all""",
        "q_sketch_levels": f"""
            select cast(case when grouping(day) = 1 then 0 when grouping(event_type) = 1 then 1 else 2 end as bigint) as horizontal_level,
                   day, event_type, count(value) as sample_size, count(distinct user_id) as exact_users,
                   true as rank_ok, true as distinct_ok
            from (select {b86400} as day, event_type, user_id, value from events)
            group by grouping sets ((event_type), (day), (day, event_type))""",
        "q_distinct_samples": f"""
            with v as (select {b86400} as measure_time, event_type, user_id, count(*) as n from events group by all),
            r as (select *, row_number() over (partition by measure_time, event_type
                                               order by md5(cast(user_id as varchar)), user_id) as place from v)
            select measure_time, event_type, cast(count(*) as double) as val,
                   list(user_id order by place) filter (where place <= 5) as samples, cast(sum(n) as bigint) as sample_size
            from r group by 1, 2""",
        "q_committed_runs": f"""
            with records as (
              select 'total_value_hourly' as id, {b3600} as measure_time, cast(null as varchar) as event_type,
                     round(sum(value), 4) as val
              from events group by all
              union all
              select 'p90_value_hourly', {b3600}, event_type, quantile_disc(value, 0.9)
              from events group by all)
            select place, records.* from records, (values ('store'), ('table')) as t(place)""",
        "q_latest_binned": f"""
            select {b3600} as measure_time, event_type, cast(round(value) as bigint) as value_bin,
                   round(sum(value), 4) as val, cast(1706794200 as bigint) as compute_time
            from events group by 1, 2, 3""",
        "q_record_metadata": f"""
            select distinct 'p90_value_hourly' as id, {b3600} as measure_time,
                   cast(3600 as bigint) as time_window,
                   'approx_percentile(value, 0.9) every hour' as func_expr, '1.0' as version,
                   '2024-02-01' as compute_date, cast(12 as bigint) as compute_hour,
                   'event_type' as group_keys, event_type
            from events""",
        "q_value_bool_json": """
            select event_id, 'bool' as high_type, value >= 50 as high, 'json' as parts_type,
                   '[' || event_id || ',' || user_id || ']' as parts
            from events""",
        "q_stage_params": f"""
            select {b86400} as measure_time, cast(count(*) as double) as val
            from events where value >= 60 and ts >= timestamp '2024-01-03 00:00:00' group by 1""",
        "q_value_map_mixed": """
            select event_id, 'map_string' as gaps_type, cast(event_id as varchar) as gaps_id, 'null' as gaps_none,
                   'map_string' as nested_type, '[' || event_id || ',' || user_id || ']' as nested_ids
            from events""",
        "q_value_decimal_wide": """
            select event_id, case when event_id <= 9 then 'long' else 'double' end as type,
                   case when event_id <= 9 then event_id * 1000000000000000000 end as long,
                   case when event_id > 9 then cast(event_id as double) * 1e18 end as double
            from events""",
        "q_p90_lineitem": """
            select l_returnflag, quantile_disc(l_extendedprice, 0.9) as val,
                   quantile_disc(l_extendedprice, 0.5) as median, count(*) as sample_size
            from lineitem group by 1""",
        "q_registered_store": _TOTAL_HOURLY,
        "q_p90_salted": f"""
            select {b3600} as measure_time, event_type,
                   quantile_disc(value, 0.9) as val, count(*) as sample_size
            from events group by 1, 2""",
    }
